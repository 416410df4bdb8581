"""Queries over raw cells: quality control, normalisation, noise."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.operators import composition, markers as mk, qc
from cellweave.operators.lineage import materialize
from cellweave.schema import drop_shape_columns
from cellweave.sources.tables import union_tables
from workload.registry import query
from workload.views import CELLS, CONDITIONS, MARKERS, cells, table

PCT = 5.0

THRESHOLDS = f"""thr AS (
  SELECT image_id, quantile_cont(area, {PCT / 100}) AS area_threshold, quantile_cont(dapi, {PCT / 100}) AS dapi_threshold
  FROM cells GROUP BY image_id)"""
FILTERED = f"""{THRESHOLDS},
filtered AS (SELECT c.* FROM cells c JOIN thr USING (image_id) WHERE area > area_threshold AND dapi > dapi_threshold)"""
_MEANS = ", ".join(f"avg({m}) AS mean_{m}, stddev_pop({m}) AS std_{m}" for m in MARKERS)
_ZS = ", ".join(f"(f.{m} - mean_{m}) / nullif(std_{m}, 0) AS z_{m}" for m in MARKERS)
NORMALISED = f"""{FILTERED},
moments AS (SELECT image_id, {_MEANS} FROM filtered GROUP BY image_id),
normalised AS (SELECT f.image_id, f.cell_id, {_ZS} FROM filtered f JOIN moments USING (image_id)),
scored AS (
  SELECT image_id, cell_id, CAST({" + ".join(f"coalesce(CAST(z_{m} > 0 AS INT), 0)" for m in MARKERS)} AS DOUBLE) AS z_count,
         {" + ".join(f"coalesce(z_{m}, 0.0)" for m in MARKERS)} AS z_sum
  FROM normalised),
scores AS (SELECT image_id, 'z_count' AS score, z_count AS value FROM scored
           UNION ALL SELECT image_id, 'z_sum', z_sum FROM scored)"""


def histogram_sql(source: str, keys: str, bins: int = 50) -> str:
    on = " AND ".join(f"v.{k} = e.{k}" for k in keys.split(", "))
    dims = " AND ".join(f"e.{k} = c.{k}" for k in keys.split(", "))
    ekeys = ", ".join("e." + k for k in keys.split(", "))
    return f"""raw_edges AS (SELECT {keys}, min(value) AS lo, max(value) AS hi FROM {source} GROUP BY {keys}),
edges AS (SELECT {keys}, CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo, CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi
          FROM raw_edges),
bin_counts AS (SELECT {ekeys}, least(floor((value - lo) * {bins} / (hi - lo)), {bins - 1}) AS bin, count(*) AS n
           FROM {source} v JOIN edges e ON {on} GROUP BY ALL),
hist AS (SELECT {ekeys}, b.i AS bin, coalesce(n, 0) AS n, lo + b.i * ((hi - lo) / {bins}) AS bin_low,
                lo + (b.i + 1) * ((hi - lo) / {bins}) AS bin_high, lo + (b.i + 0.5) * ((hi - lo) / {bins}) AS center
         FROM edges e CROSS JOIN range({bins}) b(i) LEFT JOIN bin_counts c ON {dims} AND c.bin = b.i)"""


KNEES = """scaled AS (
  SELECT *, (center - min(center) OVER g) / (max(center) OVER g - min(center) OVER g) AS x,
         (max(n) OVER g - n) / nullif(CAST(max(n) OVER g - min(n) OVER g AS DOUBLE), 0) AS y, count(*) OVER g AS m
  FROM hist WINDOW g AS (PARTITION BY image_id, score)),
gaps AS (SELECT *, y - x AS gap FROM scaled),
ends AS (
  SELECT *, coalesce(lag(gap) OVER o, gap) AS l, coalesce(lead(gap) OVER o, gap) AS r, lead(gap) OVER o AS nxt
  FROM gaps WINDOW o AS (PARTITION BY image_id, score ORDER BY bin)),
marked AS (
  SELECT *, CASE WHEN gap >= l AND gap >= r THEN center END AS top_here,
         CASE WHEN gap <= l AND gap <= r THEN 0.0 WHEN gap >= l AND gap >= r THEN gap - 1.0 / (m - 1) END AS thr_here
  FROM ends),
traced AS (
  SELECT *, last_value(top_here IGNORE NULLS) OVER o AS top_at, last_value(thr_here IGNORE NULLS) OVER o AS thr_at
  FROM marked WINDOW o AS (PARTITION BY image_id, score ORDER BY bin)),
knees AS (
  SELECT image_id, score, arg_min(top_at, bin) FILTER (WHERE top_at IS NOT NULL AND nxt < thr_at) AS knee
  FROM traced GROUP BY image_id, score),
tails AS (SELECT image_id, score, quantile_cont(value, 0.99) AS p99 FROM scores GROUP BY image_id, score),
chosen AS (
  SELECT k.image_id, k.score,
         CASE WHEN coalesce(nullif(knee, 0), p99) < CASE k.score WHEN 'z_count' THEN 10 ELSE 20 END
              THEN p99 ELSE coalesce(nullif(knee, 0), p99) END AS cutoff, knee
  FROM knees k JOIN tails t ON k.image_id = t.image_id AND k.score = t.score),
cutoffs AS (
  SELECT image_id, max(cutoff) FILTER (WHERE score = 'z_count') AS z_count_cutoff,
         max(cutoff) FILTER (WHERE score = 'z_sum') AS z_sum_cutoff
  FROM chosen GROUP BY image_id)"""
CLEANED = f"""{NORMALISED}, {histogram_sql("scores", "image_id, score")}, {KNEES},
cleaned AS (SELECT s.image_id, s.cell_id FROM scored s JOIN cutoffs USING (image_id)
            WHERE NOT (z_count > z_count_cutoff OR z_sum > z_sum_cutoff))"""


def thresholds(spark, sf):
    """One row per image, written once: every later step joins it back."""
    return materialize(qc.percentile_thresholds(cells(spark, sf), PCT, PCT))


def filtered(spark, sf, thr=None):
    return qc.qc_filter(cells(spark, sf), thr if thr is not None else thresholds(spark, sf))


def normalised(spark, sf, thr=None):
    return qc.zscore(filtered(spark, sf, thr).select("image_id", "cell_id", *MARKERS), MARKERS)


def scored(spark, sf, thr=None):
    """Normalised cells with their scores, written once: the cutoffs and the filter both read them."""
    scores = qc.add_scores(normalised(spark, sf, thr), MARKERS)
    return materialize(scores.select("image_id", "cell_id", "z_count", "z_sum"))


def cutoffs(scores):
    return materialize(qc.noise_cutoffs(scores))


def cleaned(spark, sf, thr=None):
    scores = scored(spark, sf, thr)
    return qc.noise_filter(scores, cutoffs(scores))


@query("pct_threshold", f"""WITH {CELLS}, {THRESHOLDS}
SELECT image_id, round(area_threshold, 4) AS area_threshold, round(dapi_threshold, 4) AS dapi_threshold FROM thr""")
def pct_threshold(spark, sf):
    return thresholds(spark, sf).select("image_id", F.round("area_threshold", 4).alias("area_threshold"),
                                        F.round("dapi_threshold", 4).alias("dapi_threshold"))


@query("qc_filter", f"WITH {CELLS}, {FILTERED} SELECT image_id, cell_id, area, dapi FROM filtered")
def qc_filter(spark, sf):
    return filtered(spark, sf).select("image_id", "cell_id", "area", "dapi")


@query("drop_columns", """SELECT l_suppkey AS "image_ID", l_extendedprice AS area, l_quantity AS "DAPI",
  l_orderkey AS x, l_partkey AS y, l_tax AS marker FROM lineitem""")
def drop_columns(spark, sf):
    c = F.col
    raw = table(spark, sf, "lineitem").select(
        c("l_suppkey").alias("image_ID"), c("l_extendedprice").alias("area"), c("l_quantity").alias("DAPI"),
        c("l_orderkey").alias("x"), c("l_partkey").alias("y"), c("l_tax").alias("marker"),
        c("l_linenumber").alias("label"), c("l_discount").alias("eccentricity"), c("l_discount").alias("perimeter"),
        c("l_tax").alias("axis_major_length"), c("l_tax").alias("axis_minor_length"))
    return drop_shape_columns(raw)


@query("zscore_norm", f"""WITH {CELLS}, {NORMALISED}
SELECT image_id, cell_id, {", ".join(f"round(z_{m}, 6) AS {m}" for m in MARKERS)} FROM normalised""")
def zscore_norm(spark, sf):
    return normalised(spark, sf).select("image_id", "cell_id", *[F.round(m, 6).alias(m) for m in MARKERS])


@query("value_histogram", f"""WITH src AS (SELECT event_type, value FROM events), {histogram_sql("src", "event_type")}
SELECT event_type, CAST(bin AS BIGINT) AS bin, CAST(n AS BIGINT) AS n, round(bin_low, 6) AS bin_low,
       round(bin_high, 6) AS bin_high FROM hist""")
def value_histogram(spark, sf):
    return qc.histogram(table(spark, sf, "events").select("event_type", "value"), ["event_type"], "value").select(
        "event_type", "bin", "n", F.round("bin_low", 6).alias("bin_low"), F.round("bin_high", 6).alias("bin_high"))


@query("noise_knee", f"""WITH {CELLS}, {CLEANED}
SELECT image_id, score, round(knee, 6) AS knee FROM knees""")
def noise_knee(spark, sf):
    by = ["image_id", "score"]
    return qc.knee(qc.histogram(qc.score_rows(scored(spark, sf)), by, "value"), by).withColumn("knee", F.round("knee", 6))


@query("noise_cutoffs", f"""WITH {CELLS}, {CLEANED}
SELECT image_id, round(z_count_cutoff, 6) AS z_count_cutoff, round(z_sum_cutoff, 6) AS z_sum_cutoff FROM cutoffs""")
def noise_cutoffs(spark, sf):
    return cutoffs(scored(spark, sf)).select("image_id", F.round("z_count_cutoff", 6).alias("z_count_cutoff"),
                                     F.round("z_sum_cutoff", 6).alias("z_sum_cutoff"))


@query("noise_filter", f"WITH {CELLS}, {CLEANED} SELECT image_id, cell_id FROM cleaned")
def noise_filter(spark, sf):
    return cleaned(spark, sf).select("image_id", "cell_id")


CLASSIFIED = f"""{CLEANED},
classified AS (
  SELECT c.image_id, c.cell_id, CASE WHEN k.cell_id IS NOT NULL THEN 'Included'
    WHEN area < area_threshold AND dapi < dapi_threshold THEN 'Excl_SmallArea_LowDAPI'
    WHEN area < area_threshold THEN 'Excl_SmallArea' WHEN dapi < dapi_threshold THEN 'Excl_LowDAPI'
    ELSE 'Excl_Noise' END AS classification
  FROM cells c JOIN thr USING (image_id) LEFT JOIN cleaned k ON c.image_id = k.image_id AND c.cell_id = k.cell_id)"""


def classified(spark, sf):
    raw = cells(spark, sf).select("image_id", "cell_id", "condition", "tissue_id", "x", "y", "area", "dapi")
    thr = thresholds(spark, sf)
    return qc.classify(raw, cleaned(spark, sf, thr), thr)


@query("qc_classify", f"WITH {CELLS}, {CLASSIFIED} SELECT image_id, cell_id, classification FROM classified")
def qc_classify(spark, sf):
    return classified(spark, sf).select("image_id", "cell_id", "classification")


@query("included_semi", f"""WITH {CELLS}, {FILTERED},
keys AS (SELECT DISTINCT image_id, x, y FROM filtered)
SELECT c.image_id, c.cell_id, k.x IS NOT NULL AS included
FROM cells c LEFT JOIN keys k ON c.image_id = k.image_id AND c.x = k.x AND c.y = k.y""")
def included_semi(spark, sf):
    thr = thresholds(spark, sf)
    marked = qc.classify(cells(spark, sf), filtered(spark, sf, thr), thr, by_coordinates=True)
    return marked.select("image_id", "cell_id", (F.col("classification") == qc.INCLUDED).alias("included"))


@query("qc_counts", f"""WITH {CELLS}, {CLASSIFIED}
SELECT image_id, CAST(count(*) AS BIGINT) AS total_raw,
       {", ".join(f"CAST(count_if(classification = '{c}') AS BIGINT) AS {c}" for c in qc.CLASSES)}
FROM classified GROUP BY image_id""")
def qc_counts(spark, sf):
    return qc.class_counts(classified(spark, sf))


@query("qc_export", f"""WITH {CELLS}, {CLASSIFIED}
SELECT c.x AS centroid_x, c.y AS centroid_y, round(c.x - greatest(sqrt(area / pi()), 3.0), 4) AS roi_x,
       round(c.y - greatest(sqrt(area / pi()), 3.0), 4) AS roi_y, round(2 * greatest(sqrt(area / pi()), 3.0), 4) AS roi_width,
       round(2 * greatest(sqrt(area / pi()), 3.0), 4) AS roi_height, area, dapi AS "DAPI", condition, c.image_id AS "image_ID",
       tissue_id, classification, round(area_threshold, 4) AS area_threshold, round(dapi_threshold, 4) AS dapi_threshold
FROM cells c JOIN classified k USING (image_id, cell_id) JOIN thr USING (image_id)""")
def qc_export(spark, sf):
    out = qc.export_columns(classified(spark, sf))
    rounded = {"roi_x", "roi_y", "roi_width", "roi_height", "area_threshold", "dapi_threshold"}
    return out.select(*[F.round(c, 4).alias(c) if c in rounded else c for c in out.columns])


STATS = f"""{CLEANED},
stats AS (
  SELECT n.image_id, n.n AS original_cells, area_threshold, dapi_threshold, z_count_cutoff, z_sum_cutoff,
         coalesce(f.n, 0) AS after_filter, coalesce(k.n, 0) AS final_cells,
         CASE WHEN n.image_id IN (SELECT printf('reg%03d', s_suppkey) FROM supplier WHERE s_acctbal < 0)
              THEN 'SKIPPED' ELSE 'PROCESSED' END AS status
  FROM (SELECT image_id, count(*) AS n FROM cells GROUP BY 1) n
  LEFT JOIN (SELECT image_id, count(*) AS n FROM filtered GROUP BY 1) f USING (image_id)
  LEFT JOIN (SELECT image_id, count(*) AS n FROM cleaned GROUP BY 1) k USING (image_id)
  LEFT JOIN thr USING (image_id) LEFT JOIN cutoffs USING (image_id))"""


def stats(spark, sf):
    done = table(spark, sf, "supplier").where("s_acctbal < 0").select(
        F.format_string("reg%03d", "s_suppkey").alias("image_id"))
    thr = thresholds(spark, sf)
    scores = scored(spark, sf, thr)
    cuts = cutoffs(scores)
    return qc.processing_stats(cells(spark, sf), filtered(spark, sf, thr), qc.noise_filter(scores, cuts), cuts,
                               thr, done)


@query("processing_stats", f"""WITH {CELLS}, {STATS}
SELECT image_id, CAST(original_cells AS BIGINT) AS original_cells, round(area_threshold, 4) AS area_threshold,
       round(dapi_threshold, 4) AS dapi_threshold, round(z_count_cutoff, 4) AS z_count_cutoff,
       round(z_sum_cutoff, 4) AS z_sum_cutoff, CAST(after_filter AS BIGINT) AS cells_after_size_dapi_filter,
       CAST(original_cells - after_filter AS BIGINT) AS cells_removed_by_filter,
       round((original_cells - after_filter) * 100.0 / original_cells, 4) AS percent_removed_by_filter,
       CAST(final_cells AS BIGINT) AS cells_after_noise_removal,
       CAST(after_filter - final_cells AS BIGINT) AS cells_removed_by_noise,
       round((after_filter - final_cells) * 100.0 / nullif(after_filter, 0), 4) AS percent_removed_by_noise,
       CAST(original_cells - final_cells AS BIGINT) AS total_cells_removed,
       round((original_cells - final_cells) * 100.0 / original_cells, 4) AS total_percent_removed,
       CAST(final_cells AS BIGINT) AS final_cells, status FROM stats""")
def processing_stats(spark, sf):
    out = stats(spark, sf)
    return out.select(*[F.round(c, 4).alias(c) if t == "double" else c for c, t in out.dtypes])


@query("stats_rollup", f"""WITH {CELLS}, {STATS}
SELECT CAST(count_if(status = 'PROCESSED') AS BIGINT) AS processed, CAST(count_if(status = 'SKIPPED') AS BIGINT) AS skipped,
       CAST(0 AS BIGINT) AS errors,
       round(avg(CASE WHEN status = 'PROCESSED' THEN (original_cells - final_cells) * 100.0 / original_cells END), 4)
         AS avg_total_removal FROM stats""")
def stats_rollup(spark, sf):
    return qc.stats_rollup(stats(spark, sf)).withColumn("avg_total_removal", F.round("avg_total_removal", 4))


_LONG = " UNION ALL ".join(f"SELECT image_id, condition, cell_id, '{m}' AS marker, {m} AS value FROM cells" for m in MARKERS)


@query("unpivot_markers", f"""WITH {CELLS}, long AS ({_LONG}) SELECT image_id, cell_id, marker, value FROM long""")
def unpivot_markers(spark, sf):
    return mk.unpivot_markers(cells(spark, sf), ["image_id", "cell_id"], MARKERS)


@query("marker_range", f"""WITH {CELLS}, long AS ({_LONG})
SELECT image_id, marker, round(quantile_cont(value, 0.01), 6) AS p01, round(quantile_cont(value, 0.99), 6) AS p99
FROM long GROUP BY image_id, marker""")
def marker_range(spark, sf):
    return mk.marker_range(cells(spark, sf), MARKERS).select(
        "image_id", "marker", F.round("p01", 6).alias("p01"), F.round("p99", 6).alias("p99"))


@query("share_of_total", f"""WITH {CELLS}, {CLASSIFIED}, n AS (SELECT image_id, classification, count(*) AS n FROM classified GROUP BY ALL)
SELECT image_id, classification, CAST(n AS BIGINT) AS n, round(n * 100.0 / sum(n) OVER (PARTITION BY image_id), 6) AS percent FROM n""")
def share_of_total(spark, sf):
    counts = classified(spark, sf).groupBy("image_id", "classification").agg(F.count(F.lit(1)).alias("n"))
    return composition.share_of_total(counts, ["image_id"]).withColumn("percent", F.round("percent", 6))


@query("union_conditions", f"""WITH {CELLS}
SELECT condition, CAST(count(*) AS BIGINT) AS n, round(sum(l_quantity), 2) AS total FROM cells GROUP BY condition""")
def union_conditions(spark, sf):
    from cellweave.sources.tables import union_conditions as union
    c = cells(spark, sf)
    # The label inside each table is wrong on purpose: the key decides.
    tables = {name: c.where(F.col("condition") == name).withColumn("condition", F.lit("old")) for name in CONDITIONS}
    return union(tables, CONDITIONS).groupBy("condition").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("total"))


@query("union_images", f"""WITH {CELLS}
SELECT image_id, CAST(count(*) AS BIGINT) AS n_cells, round(sum(CASE WHEN l_suppkey_odd THEN NULL ELSE l_tax END), 4) AS tax,
  round(sum(CASE WHEN l_suppkey_odd THEN l_discount END), 4) AS discount
FROM (SELECT *, condition = 'DII' AS l_suppkey_odd FROM cells) GROUP BY image_id""")
def union_images(spark, sf):
    # Images of two panels: each table lacks a column of the other.
    c = cells(spark, sf)
    even = c.where("condition = 'CLR'").select("image_id", "cell_id", "l_tax")
    odd = c.where("condition = 'DII'").select("l_discount", "cell_id", "image_id")
    return union_tables([even, odd]).groupBy("image_id").agg(
        F.count(F.lit(1)).alias("n_cells"), F.round(F.sum("l_tax"), 4).alias("tax"), F.round(F.sum("l_discount"), 4).alias("discount"))
