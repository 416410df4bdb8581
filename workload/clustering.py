"""Queries over clusters, profiles, embeddings and neighbour graphs."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.operators import clusters as cl, communities as cm, composition, embedding, markers as mk
from cellweave.operators.knn import knn, knn_edges
from cellweave.sources.tables import spread
from workload.registry import query
from workload.views import CELLS, MARKERS, cells, table

DIMS = 64
PANEL = [f"m{i:02d}" for i in range(DIMS)]


def points(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").alias("cluster"), F.col("embedding").cast("array<double>").alias("vector"))


def profiles_input(spark, sf):
    """Vectors as cells with one marker per element, positive where above zero."""
    p = points(spark, sf)
    values = [F.col("vector")[i].alias(m) for i, m in enumerate(PANEL)]
    return p.select("id", "cluster", *values, *[(F.col("vector")[i] > 0).alias(f"{m}_pos") for i, m in enumerate(PANEL)])


LONG = """long AS (SELECT vec_id, CAST(label AS VARCHAR) AS cluster, printf('m%02d', i) AS marker, CAST(embedding[i + 1] AS DOUBLE) AS value
  FROM embeddings, range(64) r(i))"""
MEANS = f"""{LONG}, avgs AS (SELECT cluster, marker, avg(value) AS mean FROM long GROUP BY ALL),
zs AS (SELECT cluster, marker, mean, (mean - avg(mean) OVER w) / (stddev_samp(mean) OVER w + 1e-9) AS z
       FROM avgs WINDOW w AS (PARTITION BY marker))"""


def means(spark, sf):
    cells_ = profiles_input(spark, sf).withColumn("cluster", F.col("cluster").cast("string"))
    return cl.cluster_means(mk.unpivot_markers(cells_, ["cluster"], PANEL))


@query("cluster_sizes", "SELECT label AS cluster, CAST(count(*) AS BIGINT) AS n_cells FROM embeddings GROUP BY label")
def cluster_sizes(spark, sf):
    return composition.cluster_sizes(points(spark, sf))


@query("cluster_order", "SELECT CAST(label AS VARCHAR) AS cluster, CAST(count(*) AS BIGINT) AS n_cells FROM embeddings GROUP BY label ORDER BY label")
def cluster_order(spark, sf):
    named = points(spark, sf).withColumn("cluster", F.col("cluster").cast("string"))
    return composition.cluster_order(composition.cluster_sizes(named))


@query("cluster_label_map", """SELECT vec_id AS id, coalesce(n_name, 'Unassigned') AS cell_type
FROM embeddings LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 4 <> 3) ON label = n_nationkey""")
def cluster_label_map(spark, sf):
    labels = table(spark, sf, "nation").where("n_nationkey % 4 <> 3").select(
        F.col("n_nationkey").alias("cluster"), F.col("n_name").alias("label"))
    return composition.label_clusters(points(spark, sf), labels).select("id", "cell_type")


@query("cluster_profile", f"""WITH {MEANS} SELECT cluster, marker, round(mean, 6) AS mean, round(z, 4) AS z FROM zs""")
def cluster_profile(spark, sf):
    return means(spark, sf).select("cluster", "marker", F.round("mean", 6).alias("mean"), F.round("z", 4).alias("z"))


@query("top_markers", f"""WITH {MEANS},
r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY z DESC, marker) AS from_top,
             row_number() OVER (PARTITION BY cluster ORDER BY z, marker DESC) AS from_bottom FROM zs)
SELECT cluster, string_agg(marker, ',' ORDER BY from_top) FILTER (WHERE from_top <= 8) AS high,
       string_agg(marker, ',' ORDER BY from_top) FILTER (WHERE from_bottom <= 3) AS low,
       (SELECT CAST(count(*) AS BIGINT) FROM embeddings e WHERE CAST(e.label AS VARCHAR) = r.cluster) AS n
FROM r GROUP BY cluster""")
def top_markers(spark, sf):
    profile = cl.cluster_profiles(profiles_input(spark, sf), PANEL)

    def listed(name):
        return F.array_join(F.transform(name, lambda e: e["marker"]), ",").alias(name)

    return profile.select("cluster", listed("high"), listed("low"), "n")


PCT = f"""{LONG}, pct AS (SELECT cluster, marker, round(avg(CAST(value > 0 AS INT)) * 100, 1) AS pct_pos FROM long GROUP BY ALL)"""


@query("cluster_pct_pos", f"WITH {PCT} SELECT cluster, marker, pct_pos FROM pct")
def cluster_pct_pos(spark, sf):
    return cl.percent_positive(profiles_input(spark, sf), PANEL)


@query("top_pct_pos", f"""WITH {PCT}
SELECT cluster, marker, pct_pos, CAST(row_number() OVER (PARTITION BY cluster ORDER BY pct_pos DESC, marker) AS INTEGER) AS place
FROM pct QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY pct_pos DESC, marker) <= 6""")
def top_pct_pos(spark, sf):
    return cl.top_percent_positive(cl.percent_positive(profiles_input(spark, sf), PANEL), PANEL)


_TOTAL = " + ".join(MARKERS)
_LOGS = ", ".join(f"ln(1 + {m} * (10000.0 / ({_TOTAL}))) AS {m}" for m in MARKERS)
_SCALED = ", ".join(f"round(({m} - avg({m}) OVER ()) / stddev_samp({m}) OVER (), 5) AS {m}" for m in MARKERS)


@query("normalize_scale", f"""WITH {CELLS}, logs AS (SELECT image_id, cell_id, {_LOGS} FROM cells)
SELECT image_id, cell_id, {_SCALED} FROM logs""")
def normalize_scale(spark, sf):
    out = embedding.normalize_scale(cells(spark, sf).select("image_id", "cell_id", *MARKERS), MARKERS)
    return out.select("image_id", "cell_id", *[F.round(m, 5).alias(m) for m in MARKERS])


@query("pca", """WITH v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT id, i, e[i] AS x FROM v, range(1, 65) r(i)), m AS (SELECT i, avg(x) AS mean, var_samp(x) AS variance FROM l GROUP BY i),
n AS (SELECT id, sum((x - mean) * (x - mean)) AS length2 FROM l JOIN m USING (i) GROUP BY id)
SELECT id, round(length2, 5) AS length2, (SELECT round(sum(variance), 5) FROM m) AS variance FROM n""")
def pca(spark, sf):
    # With all components, a centred row's squared length and the total variance do not depend on signs or order.
    projected = embedding.principal_components(profiles_input(spark, sf).select("id", *PANEL), PANEL, len(PANEL))
    lengths = projected.select("id", "components")
    total = lengths.select(F.posexplode("components").alias("i", "x")).groupBy("i").agg(F.var_samp("x").alias("v")).agg(
        F.round(F.sum("v"), 5).alias("variance"))
    squared = F.aggregate("components", F.lit(0.0), lambda acc, x: acc + x * x)
    return lengths.select("id", F.round(squared, 5).alias("length2")).join(F.broadcast(total))


KNN = """v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
d AS (SELECT a.id AS src, b.id AS dst,
        list_sum([(a.e[i] - b.e[i]) * (a.e[i] - b.e[i]) for i in range(1, 65)]) AS d2
      FROM v a JOIN v b ON a.id <> b.id),
near AS (SELECT src, dst, d2, row_number() OVER (PARTITION BY src ORDER BY d2, dst) AS place FROM d
         QUALIFY row_number() OVER (PARTITION BY src ORDER BY d2, dst) <= 15)"""


@query("knn_graph", f"WITH {KNN} SELECT src, dst, CAST(place AS INTEGER) AS rank, round(sqrt(d2), 6) AS dist FROM near")
def knn_graph(spark, sf):
    return knn(points(spark, sf), 15).withColumn("dist", F.round("dist", 6))


@query("knn_edges", f"""WITH {KNN}, two_way AS (SELECT src, dst, d2 FROM near UNION SELECT dst, src, d2 FROM near)
SELECT src, dst, round(max(1.0 / (1.0 + sqrt(d2))), 6) AS weight FROM two_way GROUP BY src, dst""")
def edges(spark, sf):
    return knn_edges(knn(points(spark, sf), 15)).withColumn("weight", F.round("weight", 6))


@query("graph_clusters", """SELECT s_suppkey AS node, min(s_suppkey) OVER (PARTITION BY s_nationkey) AS community FROM supplier
QUALIFY count(*) OVER (PARTITION BY s_nationkey) > 1""")
def graph_clusters(spark, sf):
    # Suppliers of one nation all know each other and no one else: one community per nation is the only answer.
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("bigint").alias("id"), "s_nationkey")
    met = spread(s).select(F.col("id").alias("src"), "s_nationkey").join(s.select(F.col("id").alias("dst"), "s_nationkey"), "s_nationkey")
    return cm.communities(met.where("src <> dst").select("src", "dst", F.lit(1.0).alias("weight")))
