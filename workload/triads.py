"""Queries over neighbours and triads."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.operators import neighbors, triads as ops
from cellweave.operators.lineage import materialize
from cellweave.sources.tables import assign_condition
from workload.registry import query
from workload.views import (
    AREAS, CELLS, CONDITIONS, RADIUS, areas, cells, pairs_sql, summary_sql, table, triads_sql)

SEARCH = ops.TriadSearch(RADIUS, 1.0, "A", "N", "R")
EVERY = ops.TriadSearch(RADIUS, 1.0)
REPORT_UM = 20.0


def _slim(spark, sf):
    return cells(spark, sf).select("image_id", "condition", "cell_id", "x", "y", "cell_type")


def found(spark, sf, with_counts=False):
    return ops.find_triads(_slim(spark, sf), SEARCH, with_counts)


def summary(spark, sf):
    return ops.triad_summary(found(spark, sf), SEARCH)


def short_summary(spark, sf):
    """Triads per image from neighbour counts, where distances are not asked for; written once."""
    images = _slim(spark, sf).select("image_id", "condition").distinct()
    counts = ops.triad_counts(_slim(spark, sf), SEARCH)
    return materialize(counts.join(images, "image_id")
                       .withColumn("combo_label", SEARCH.label(*[F.col(t) for t in ops.TYPES])))


@query("radius_join", f"""WITH {CELLS}, {pairs_sql()}
SELECT image_id, anchor_id AS anchor_cell_id, other_id AS neighbor_cell_id, round(dist, 6) AS dist_px FROM pairs""")
def radius_join(spark, sf):
    c = _slim(spark, sf)
    return neighbors.radius_pairs(c, c, RADIUS).select(
        "image_id", "anchor_cell_id", "neighbor_cell_id", F.round("dist_px", 6).alias("dist_px"))


@query("neighbor_counts", f"""WITH {CELLS}, {pairs_sql(where="a.cell_type = 'A' AND b.cell_type IN ('N', 'R')")}
SELECT image_id, anchor_id AS anchor_cell_id, CAST(count_if(other_type = 'N') AS BIGINT) AS n_p1_neighbors,
       CAST(count_if(other_type = 'R') AS BIGINT) AS n_p2_neighbors FROM pairs GROUP BY ALL""")
def neighbor_counts(spark, sf):
    c = _slim(spark, sf)
    return neighbors.neighbor_counts(c.where("cell_type = 'A'"), c, RADIUS,
                                     {"n_p1_neighbors": "N", "n_p2_neighbors": "R"})


@query("triad_join", f"""WITH {CELLS}, {triads_sql()},
n AS (SELECT image_id, anchor_id, count_if(other_type = 'N') AS n1, count_if(other_type = 'R') AS n2
      FROM triads_pairs GROUP BY ALL)
SELECT t.image_id, t.condition, t.anchor_id AS anchor_cell_id, p1_id AS partner1_cell_id, p2_id AS partner2_cell_id,
       round(d1, 6) AS dist_anchor_p1_um, round(d2, 6) AS dist_anchor_p2_um, round(d12, 6) AS dist_p1_p2_um,
       'A__N__R' AS triad_combo_label, CAST(n1 AS BIGINT) AS n_p1_neighbors, CAST(n2 AS BIGINT) AS n_p2_neighbors
FROM triads t JOIN n ON t.image_id = n.image_id AND t.anchor_id = n.anchor_id""")
def triad_join(spark, sf):
    return found(spark, sf, with_counts=True).select(
        "image_id", "condition", "anchor_cell_id", "partner1_cell_id", "partner2_cell_id",
        *[F.round(d, 6).alias(d) for d in ops.DISTANCES], "triad_combo_label", "n_p1_neighbors", "n_p2_neighbors")


# Cells meet by squares as wide as the radius, and each anchor's neighbours are gathered once: no second join.
@query("triad_join_all", f"""WITH {CELLS},
grid AS (SELECT image_id, cell_id, cell_type, x, y, x // {int(RADIUS)} AS gx, y // {int(RADIUS)} AS gy FROM cells),
shifted AS (SELECT image_id, cell_id, cell_type, x, y, gx + dx AS gx, gy + dy AS gy
            FROM grid, (VALUES (-1), (0), (1)) i(dx), (VALUES (-1), (0), (1)) j(dy)),
near AS (SELECT a.image_id, a.cell_id AS anchor_id, a.cell_type AS anchor_type, list(struct_pack(id := b.cell_id, kind := b.cell_type)) AS others
         FROM grid a JOIN shifted b ON a.image_id = b.image_id AND a.gx = b.gx AND a.gy = b.gy
         WHERE a.cell_id <> b.cell_id AND a.cell_type <> b.cell_type
           AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {RADIUS * RADIUS} GROUP BY ALL),
first AS (SELECT *, unnest(others) AS p1 FROM near),
both_partners AS (SELECT image_id, anchor_id, anchor_type, p1, unnest(others) AS p2 FROM first)
SELECT image_id, anchor_id AS anchor_cell_id, p1.id AS partner1_cell_id, p2.id AS partner2_cell_id,
       anchor_type || '__' || p1.kind || '__' || p2.kind AS triad_combo_label
FROM both_partners WHERE p1.kind <> p2.kind""")
def triad_join_all(spark, sf):
    return ops.find_triads(_slim(spark, sf), EVERY, with_counts=False).select(
        "image_id", "anchor_cell_id", "partner1_cell_id", "partner2_cell_id", "triad_combo_label")


@query("triad_counts_all", f"""WITH {CELLS}, {pairs_sql()}
SELECT p.image_id, p.anchor_type, p.other_type AS partner1_type, q.other_type AS partner2_type,
       CAST(count(*) AS BIGINT) AS n_triads
FROM pairs p JOIN pairs q ON p.image_id = q.image_id AND p.anchor_id = q.anchor_id
WHERE p.anchor_type <> p.other_type AND p.anchor_type <> q.other_type AND p.other_type <> q.other_type
GROUP BY ALL""")
def triad_counts_all(spark, sf):
    return ops.triad_counts(_slim(spark, sf), EVERY)


@query("triad_summary", f"""WITH {CELLS}, {triads_sql()}
SELECT image_id, condition, 'A' AS anchor_type, 'N' AS partner1_type, 'R' AS partner2_type,
       'A__N__R' AS combo_label, CAST(count(*) AS BIGINT) AS n_triads, CAST(30.0 AS DOUBLE) AS radius_um,
       CAST(30.0 AS DOUBLE) AS radius_px, round(avg(d1), 3) AS mean_dist_anchor_p1_um,
       round(avg(d2), 3) AS mean_dist_anchor_p2_um, round(avg(d12), 3) AS mean_dist_p1_p2_um
FROM triads GROUP BY image_id, condition""")
def triad_summary(spark, sf):
    return summary(spark, sf)


@query("report_radius_filter", f"""WITH {CELLS}, {triads_sql()}
SELECT image_id, anchor_id AS anchor_cell_id, p1_id AS partner1_cell_id, p2_id AS partner2_cell_id,
       round(greatest(d1, d2), 6) AS max_dist FROM triads WHERE greatest(d1, d2) <= {REPORT_UM}""")
def report_radius_filter(spark, sf):
    return ops.report_radius_filter(found(spark, sf), REPORT_UM).select(
        "image_id", "anchor_cell_id", "partner1_cell_id", "partner2_cell_id",
        F.round(F.greatest("dist_anchor_p1_um", "dist_anchor_p2_um"), 6).alias("max_dist"))


@query("max_anchor_dist", f"""WITH {CELLS}, {triads_sql()}
SELECT image_id, round(max(greatest(d1, d2)), 6) AS widest, round(min(greatest(d1, d2)), 6) AS tightest
FROM triads GROUP BY image_id""")
def max_anchor_dist(spark, sf):
    d = ops.max_anchor_distance(F.col("dist_anchor_p1_um"), F.col("dist_anchor_p2_um"))
    return found(spark, sf).groupBy("image_id").agg(
        F.round(F.max(d), 6).alias("widest"), F.round(F.min(d), 6).alias("tightest"))


FLAGS = """SELECT c.image_id, c.cell_id,
  a.id IS NOT NULL AS is_triad_anchor, p1.id IS NOT NULL AS is_triad_partner1, p2.id IS NOT NULL AS is_triad_partner2,
  (a.id IS NOT NULL OR p1.id IS NOT NULL OR p2.id IS NOT NULL) AS in_any_triad
FROM cells c SEMI JOIN images i ON c.image_id = i.image_id
LEFT JOIN (SELECT DISTINCT image_id, anchor_id AS id FROM kept) a ON c.image_id = a.image_id AND c.cell_id = a.id
LEFT JOIN (SELECT DISTINCT image_id, p1_id AS id FROM kept) p1 ON c.image_id = p1.image_id AND c.cell_id = p1.id
LEFT JOIN (SELECT DISTINCT image_id, p2_id AS id FROM kept) p2 ON c.image_id = p2.image_id AND c.cell_id = p2.id"""
FLAG_COLUMNS = ["image_id", "cell_id", "is_triad_anchor", "is_triad_partner1", "is_triad_partner2", "in_any_triad"]


@query("triad_flags", f"""WITH {CELLS}, {triads_sql()}, kept AS (SELECT * FROM triads),
images AS (SELECT DISTINCT image_id FROM triads) {FLAGS}""")
def triad_flags(spark, sf):
    return ops.flag_cells(_slim(spark, sf), SEARCH).select(*FLAG_COLUMNS)


@query("report_flags", f"""WITH {CELLS}, {triads_sql()},
kept AS (SELECT * FROM triads WHERE greatest(d1, d2) <= {REPORT_UM}),
images AS (SELECT DISTINCT image_id FROM kept) {FLAGS}""")
def report_flags(spark, sf):
    reported = ops.report_radius_filter(found(spark, sf), REPORT_UM)
    return ops.flags_from_triads(_slim(spark, sf), reported).select(*FLAG_COLUMNS)


@query("not_in_triad_anti", f"""WITH {CELLS}, {triads_sql()},
members AS (SELECT image_id, anchor_id AS id FROM triads UNION SELECT image_id, p1_id FROM triads
            UNION SELECT image_id, p2_id FROM triads)
SELECT c.image_id, c.cell_id FROM cells c ANTI JOIN members m ON c.image_id = m.image_id AND c.cell_id = m.id""")
def not_in_triad_anti(spark, sf):
    return ops.outside_triads(_slim(spark, sf), found(spark, sf)).select("image_id", "cell_id")


@query("set_union_ids", f"""WITH {CELLS}, {triads_sql()}
SELECT image_id, anchor_id AS cell_id FROM triads UNION SELECT image_id, p1_id FROM triads
UNION SELECT image_id, p2_id FROM triads""")
def set_union_ids(spark, sf):
    return ops.triad_members(found(spark, sf))


@query("min_triad_size", f"""WITH {CELLS}, {triads_sql()},
big AS (SELECT image_id FROM triads GROUP BY image_id HAVING count(*) >= 60)
SELECT image_id, anchor_id AS anchor_cell_id, p1_id AS partner1_cell_id, p2_id AS partner2_cell_id
FROM triads SEMI JOIN big USING (image_id)""")
def min_triad_size(spark, sf):
    search = ops.TriadSearch(RADIUS, 1.0, "A", "N", "R", min_triads=60)
    return ops.find_triads(_slim(spark, sf), search, with_counts=False).select(
        "image_id", "anchor_cell_id", "partner1_cell_id", "partner2_cell_id")


@query("area_flatten", f"WITH {AREAS} SELECT condition, area_um2 FROM flat_areas")
def area_flatten(spark, sf):
    return ops.condition_areas(areas(spark, sf))


@query("area_lookup", f"""WITH {CELLS}, {AREAS},
counts AS (SELECT CASE WHEN tissue_id = 'core0' THEN 'Unknown' ELSE condition END AS condition, count(*) AS n
           FROM cells GROUP BY 1)
SELECT condition, CAST(n AS BIGINT) AS n, area_um2 / 1e6 AS area_mm2 FROM counts LEFT JOIN flat_areas USING (condition)""")
def area_lookup(spark, sf):
    known = ops.condition_areas(areas(spark, sf))
    counts = (cells(spark, sf)
              .groupBy(F.when(F.col("tissue_id") == "core0", "Unknown").otherwise(F.col("condition")).alias("condition"))
              .agg(F.count(F.lit(1)).alias("n")))
    return (counts.join(known, "condition", "left")
            .select("condition", "n", (F.col("area_um2") / 1e6).alias("area_mm2")))


@query("condition_density", f"""WITH {CELLS}, {summary_sql()}, {AREAS}
SELECT condition, combo_label, CAST(sum(n_triads) AS BIGINT) AS n_triads, any_value(area_um2) / 1e6 AS area_mm2,
       round(sum(n_triads) / (any_value(area_um2) / 1e6), 6) AS triads_per_mm2
FROM summary LEFT JOIN flat_areas USING (condition) GROUP BY condition, combo_label""")
def condition_density(spark, sf):
    known = ops.condition_areas(areas(spark, sf))
    return ops.condition_density(short_summary(spark, sf), known, CONDITIONS).withColumn(
        "triads_per_mm2", F.round("triads_per_mm2", 6))


@query("condition_density_filled", f"""WITH {CELLS}, {summary_sql()}, {AREAS},
dims AS (SELECT DISTINCT combo_label, c.condition FROM summary, (VALUES ('CLR'), ('DII'), ('CTL')) c(condition)),
sums AS (SELECT condition, combo_label, sum(n_triads) AS n FROM summary GROUP BY ALL)
SELECT d.condition, d.combo_label, CAST(coalesce(n, 0) AS BIGINT) AS n_triads,
       round(coalesce(n / (area_um2 / 1e6), 0), 6) AS triads_per_mm2
FROM dims d LEFT JOIN sums s USING (condition, combo_label) LEFT JOIN flat_areas a ON a.condition = d.condition""")
def condition_density_filled(spark, sf):
    conditions = [*CONDITIONS, "CTL"]
    known = ops.condition_areas(areas(spark, sf))
    density = ops.condition_density(short_summary(spark, sf), known, conditions)
    return ops.fill_conditions(density, conditions).withColumn("triads_per_mm2", F.round("triads_per_mm2", 6))


@query("known_condition_filter", f"""WITH {CELLS}, {summary_sql()}
SELECT image_id, condition, n_triads FROM summary WHERE condition IN ('DII')""")
def known_condition_filter(spark, sf):
    return (short_summary(spark, sf).where(F.col("condition").isin("DII"))
            .select("image_id", "condition", "n_triads"))


def _distance_sql() -> str:
    parts = []
    for name, d in (("dist_anchor_p1_um", "d1"), ("dist_anchor_p2_um", "d2"), ("dist_p1_p2_um", "d12")):
        parts += [f"round(avg({d}), 3) AS {name}__mean", f"round(stddev_samp({d}), 3) AS {name}__std",
                  f"round(stddev_samp({d}) / sqrt(count({d})), 3) AS {name}__sem",
                  f"CAST(count({d}) AS BIGINT) AS {name}__count"]
    return ", ".join(parts)


@query("distance_summary", f"WITH {CELLS}, {triads_sql()} SELECT condition, {_distance_sql()} FROM triads GROUP BY condition")
def distance_summary(spark, sf):
    return ops.distance_summary(found(spark, sf), CONDITIONS)


def _trajectory_sql(low: float, high: float, points: int) -> str:
    step = repr((high - low) / (points - 1))
    return f"""WITH {CELLS}, {triads_sql()}, {AREAS},
thresholds AS (SELECT i AS point, CASE WHEN i = {points - 1} THEN CAST({high} AS DOUBLE)
                 ELSE CAST({low} AS DOUBLE) + i * CAST({step} AS DOUBLE) END AS t FROM range({points}) r(i)),
d AS (SELECT condition, greatest(d1, d2) AS m FROM triads)
SELECT d.condition, CAST(point AS INTEGER) AS point, round(t, 6) AS threshold_um, CAST(count_if(m <= t) AS BIGINT) AS n_triads,
       round(count_if(m <= t) / (any_value(area_um2) / 1e6), 6) AS triads_per_mm2
FROM d CROSS JOIN thresholds JOIN flat_areas a ON a.condition = d.condition GROUP BY d.condition, point, t"""


def _trajectory(spark, sf, low):
    known = ops.condition_areas(areas(spark, sf))
    return ops.trajectory(found(spark, sf), known, CONDITIONS, RADIUS, low).select(
        "condition", "point", F.round("threshold_um", 6).alias("threshold_um"), "n_triads",
        F.round("triads_per_mm2", 6).alias("triads_per_mm2"))


@query("triad_trajectory", _trajectory_sql(0.0, 30.0, 300))
def triad_trajectory(spark, sf):
    return _trajectory(spark, sf, 0.0)


@query("radius_sweep", _trajectory_sql(8.0, 30.0, 300))
def radius_sweep(spark, sf):
    return _trajectory(spark, sf, 8.0)


@query("top20_combos", f"""WITH {CELLS}, {pairs_sql()}
SELECT p.anchor_type || '__' || p.other_type || '__' || q.other_type AS combo_label, CAST(count(*) AS BIGINT) AS n_triads
FROM pairs p JOIN pairs q ON p.image_id = q.image_id AND p.anchor_id = q.anchor_id
WHERE p.anchor_type <> p.other_type AND p.anchor_type <> q.other_type AND p.other_type <> q.other_type
GROUP BY 1 ORDER BY n_triads DESC, combo_label LIMIT 20""")
def top20_combos(spark, sf):
    counts = ops.triad_counts(_slim(spark, sf), EVERY)
    return ops.top_combos(counts.withColumn("combo_label", EVERY.label(*[F.col(t) for t in ops.TYPES])))


@query("top_combo", f"""WITH {CELLS}, {pairs_sql()},
n AS (SELECT p.image_id, p.anchor_type AS a, p.other_type AS b, q.other_type AS c, CAST(count(*) AS BIGINT) AS n
  FROM pairs p JOIN pairs q ON p.image_id = q.image_id AND p.anchor_id = q.anchor_id
  WHERE p.anchor_type <> p.other_type AND p.anchor_type <> q.other_type AND p.other_type <> q.other_type GROUP BY ALL)
SELECT image_id, a || '__' || b || '__' || c AS combo_label, n AS n_triads
FROM n QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY n DESC, a, b, c) = 1""")
def top_combo(spark, sf):
    counts = ops.triad_counts(_slim(spark, sf), EVERY)
    return ops.top_combo_per_image(counts.withColumn("combo_label", EVERY.label(*[F.col(t) for t in ops.TYPES])))


@query("distinct_types", f"""WITH {CELLS}
SELECT image_id, string_agg(DISTINCT cell_type, ',' ORDER BY cell_type) AS cell_types,
       CAST(count(DISTINCT cell_type) AS BIGINT) AS n_types FROM cells GROUP BY image_id""")
def distinct_types(spark, sf):
    return ops.distinct_types(cells(spark, sf)).withColumn("cell_types", F.array_join("cell_types", ","))


@query("sorted_types", f"WITH {CELLS} SELECT DISTINCT cell_type FROM cells ORDER BY cell_type")
def sorted_types(spark, sf):
    return cells(spark, sf).select("cell_type").distinct().orderBy("cell_type")


@query("condition_map_join", f"""WITH {CELLS}
SELECT image_id, CASE WHEN s_nationkey % 3 = 0 THEN 'mapped' WHEN s_suppkey % 4 = 1 THEN 'reg' ELSE 'Unknown' END AS condition,
       CAST(count(*) AS BIGINT) AS n
FROM (SELECT CASE WHEN l_suppkey % 4 = 1 THEN printf('reg%03d', l_suppkey) ELSE printf('img%03d', l_suppkey) END AS image_id,
             l_suppkey FROM lineitem) JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL""")
def condition_map_join(spark, sf):
    def named(key):
        return F.when(key % 4 == 1, F.format_string("reg%03d", key)).otherwise(F.format_string("img%03d", key))
    images = table(spark, sf, "lineitem").groupBy(named(F.col("l_suppkey")).alias("image_id")).agg(
        F.count(F.lit(1)).alias("n"))
    explicit = table(spark, sf, "supplier").where("s_nationkey % 3 = 0").select(
        named(F.col("s_suppkey")).alias("image_id"), F.lit("mapped").alias("condition"))
    return assign_condition(images, ["reg"], explicit).select("image_id", "condition", "n")


@query("core_bbox_area", f"""WITH {CELLS},
boxes AS (SELECT image_id, condition, (max(x) - min(x)) * (max(y) - min(y)) AS a FROM cells GROUP BY ALL),
mid AS (SELECT quantile_cont(CAST(a AS DOUBLE), 0.5) AS m FROM boxes)
SELECT condition, CAST(count(*) AS BIGINT) AS n_images, any_value(m) AS median_um2, count(*) * any_value(m) AS area_um2
FROM boxes CROSS JOIN mid GROUP BY condition""")
def core_bbox_area(spark, sf):
    return ops.condition_area_estimate(cells(spark, sf), 1.0)
