"""Queries that roll images up to patients, and survival."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.operators import patients as ops, survival as sv
from cellweave.operators.lineage import materialize
from workload.registry import query
from workload.triads import short_summary
from workload.views import CELLS, PATIENTS, erfc_sql, patients, stars_sql, summary_sql, table

AREA = ops.AREA_PER_IMAGE_UM2

def counts_sql(where: str = "TRUE") -> str:
    return f"""{summary_sql()},
universe AS (SELECT printf('reg%03d', s_suppkey) AS image_id, s_suppkey AS reg FROM supplier WHERE {where}),
image_counts AS (SELECT u.image_id, u.reg, coalesce(sum(n_triads), 0) AS n_triads
                 FROM universe u LEFT JOIN summary s USING (image_id) GROUP BY ALL)"""


COUNTS = counts_sql()
# Images outside the universe are dropped; only the query that shows this leaves some out.
KNOWN = "s_suppkey % 10 <> 9"
DENSITY = f"""{COUNTS}, {PATIENTS},
density AS (
  SELECT p.patient, p.grp, count(i.image_id) AS n_images, coalesce(sum(i.n_triads), 0) AS total_triads
  FROM patients p LEFT JOIN patient_spots s USING (patient) LEFT JOIN image_counts i ON i.reg = s.spot GROUP BY ALL),
rated AS (SELECT *, n_images * {AREA} / 1e6 AS area,
                 coalesce(round(total_triads / nullif(n_images * {AREA} / 1e6, 0), 4), 0.0) AS rate FROM density)"""
SPLIT = f"""{DENSITY},
mid AS (SELECT quantile_cont(rate, 0.5) AS m FROM rated),
split AS (SELECT r.*, p.os, p.os_censor, p.dfs, p.dfs_censor, m,
  CASE WHEN m = 0 THEN CASE WHEN rate > 0 THEN 'Triad+' ELSE 'Triad−' END WHEN rate >= m THEN 'High' ELSE 'Low' END AS dg
  FROM rated r CROSS JOIN mid JOIN patients p USING (patient)),
surv AS (
  SELECT 'OS' AS outcome, dg AS grp, os AS t, 1 - os_censor AS e FROM split WHERE os IS NOT NULL AND os_censor IS NOT NULL
  UNION ALL SELECT 'DFS', dg, dfs, 1 - dfs_censor FROM split WHERE dfs IS NOT NULL AND dfs_censor IS NOT NULL)"""
OUTCOMES = {"OS": ("OS", "OS_Censor"), "DFS": ("DFS", "DFS_Censor")}


def universe(spark, sf, where="TRUE"):
    listed = table(spark, sf, "supplier").where(where).select(
        F.format_string("reg%03d", "s_suppkey").alias("image_id"))
    return ops.image_universe(listed, listed)


def counts(spark, sf, where="TRUE"):
    return ops.reindex_zero(ops.image_triads(short_summary(spark, sf)), universe(spark, sf, where))


def merged(spark, sf):
    """Density with clinical columns, written once: split, curves and tests all read it."""
    p = patients(spark, sf)
    return materialize(ops.merge_clinical(ops.patient_density(p, counts(spark, sf)), p))


def split(spark, sf):
    return ops.density_split(merged(spark, sf))


def rows(spark, sf):
    return sv.survival_rows(split(spark, sf), OUTCOMES, "density_group")


@query("scan_patients", f"""WITH {PATIENTS}
SELECT patient AS "Patient", grp AS "Group", spot_1 || ',' || spot_2 AS spots, round(os, 6) AS "OS", os_censor AS "OS_Censor",
       round(dfs, 6) AS "DFS", dfs_censor AS "DFS_Censor" FROM patients""")
def scan_patients(spark, sf):
    p = patients(spark, sf)
    return p.select("Patient", "Group", F.array_join(ops.spot_list(F.col(ops.SPOTS)).cast("array<string>"), ",").alias("spots"),
                    F.round("OS", 6).alias("OS"), "OS_Censor", F.round("DFS", 6).alias("DFS"), "DFS_Censor")


@query("image_universe", "SELECT printf('reg%03d', s_suppkey) AS image_id FROM supplier")
def image_universe(spark, sf):
    return universe(spark, sf)


@query("image_triads", f"""WITH {CELLS}, {summary_sql()}
SELECT image_id, CAST(sum(n_triads) AS BIGINT) AS n_triads FROM summary GROUP BY image_id""")
def image_triads(spark, sf):
    return ops.image_triads(short_summary(spark, sf))


@query("reindex_zero", f"WITH {CELLS}, {counts_sql(KNOWN)} SELECT image_id, CAST(n_triads AS BIGINT) AS n_triads FROM image_counts")
def reindex_zero(spark, sf):
    return counts(spark, sf, KNOWN)


@query("patient_images", f"""WITH {CELLS}, {COUNTS}, {PATIENTS}
SELECT patient AS patient_id, spot AS reg_num, image_id, CAST(n_triads AS BIGINT) AS n_triads
FROM patient_spots JOIN image_counts ON spot = reg""")
def patient_images(spark, sf):
    return ops.patient_images(patients(spark, sf), counts(spark, sf))


@query("patient_density", f"""WITH {CELLS}, {DENSITY}
SELECT patient AS patient_id, CAST(grp AS INTEGER) AS "group", CAST(n_images AS BIGINT) AS n_images,
       CAST(total_triads AS BIGINT) AS total_triads, round(area, 4) AS total_area_mm2, rate AS triads_per_mm2 FROM rated""")
def patient_density(spark, sf):
    return ops.patient_density(patients(spark, sf), counts(spark, sf))


@query("patient_merge", f"""WITH {CELLS}, {DENSITY}
SELECT r.patient AS patient_id, CAST(total_triads AS BIGINT) AS total_triads, p.grp AS clinical_group,
       round(os, 6) AS "OS", os_censor AS "OS_Censor" FROM rated r LEFT JOIN patients p USING (patient)""")
def patient_merge(spark, sf):
    return merged(spark, sf).select("patient_id", "total_triads", "clinical_group", F.round("OS", 6).alias("OS"), "OS_Censor")


@query("patient_presence", f"""WITH {CELLS}, {DENSITY}
SELECT CAST(count(os) AS BIGINT) AS n_with_os, CAST(count_if(total_triads > 0) AS BIGINT) AS n_with_triads
FROM rated JOIN patients USING (patient)""")
def patient_presence(spark, sf):
    return ops.patient_presence(merged(spark, sf))


@query("density_split", f"""WITH {CELLS}, {SPLIT}
SELECT patient AS patient_id, rate AS triads_per_mm2, round(m, 6) AS threshold, dg AS density_group FROM split""")
def density_split(spark, sf):
    return split(spark, sf).select("patient_id", "triads_per_mm2", F.round("threshold", 6).alias("threshold"), "density_group")


@query("km_group_counts", f"""WITH {CELLS}, {SPLIT}
SELECT outcome, grp, CAST(count(*) AS BIGINT) AS n, CAST(sum(e) AS BIGINT) AS n_events FROM surv GROUP BY ALL""")
def km_group_counts(spark, sf):
    return sv.group_counts(rows(spark, sf))


KM = """times AS (SELECT outcome, grp, t, count(*) AS c, sum(e) AS d FROM surv GROUP BY ALL
          UNION ALL SELECT DISTINCT outcome, grp, CAST(0 AS DOUBLE), 0, 0 FROM surv),
merged_times AS (SELECT outcome, grp, t, sum(c) AS c, sum(d) AS d FROM times GROUP BY ALL),
risk AS (SELECT *, sum(c) OVER (PARTITION BY outcome, grp ORDER BY t DESC) AS n FROM merged_times),
curve AS (SELECT outcome, grp, t, n, d,
            product(CASE WHEN n = 0 THEN 1.0 ELSE 1 - CAST(d AS DOUBLE) / n END) OVER w AS s,
            sum(CASE WHEN n = d THEN 0 ELSE CAST(d AS DOUBLE) / (n * (n - d)) END) OVER w AS v
          FROM risk WINDOW w AS (PARTITION BY outcome, grp ORDER BY t))"""


@query("km_curve", f"""WITH {CELLS}, {SPLIT}, {KM}
SELECT outcome, grp, round(t, 6) AS time, CAST(n AS BIGINT) AS at_risk, CAST(d AS BIGINT) AS n_events, round(s, 6) AS survival
FROM curve""")
def km_curve(spark, sf):
    return sv.kaplan_meier(rows(spark, sf)).select(
        "outcome", "grp", F.round("time", 6).alias("time"), "at_risk", "n_events", F.round("survival", 6).alias("survival"))


@query("kaplan_meier", f"""WITH {CELLS}, {SPLIT}, {KM}
SELECT outcome, grp, round(t, 6) AS time, round(s, 6) AS survival,
  round(CASE WHEN s > 0 AND s < 1 THEN pow(s, exp(1.96 * sqrt(v) / abs(ln(s)))) ELSE s END, 6) AS lower,
  round(CASE WHEN s > 0 AND s < 1 THEN pow(s, exp(-1.96 * sqrt(v) / abs(ln(s)))) ELSE s END, 6) AS upper FROM curve""")
def kaplan_meier(spark, sf):
    return sv.kaplan_meier(rows(spark, sf)).select(
        "outcome", "grp", *[F.round(c, 6).alias(c) for c in ("time", "survival", "lower", "upper")])


def logrank_sql(source: str) -> str:
    return f"""groups AS (SELECT outcome, min(grp) AS g1, max(grp) AS g2 FROM {source} GROUP BY outcome
           HAVING count(DISTINCT grp) = 2),
at_t AS (SELECT s.outcome, t, count(*) AS c, sum(e) AS d, count_if(grp = g1) AS c1, sum(CASE WHEN grp = g1 THEN e ELSE 0 END) AS d1
         FROM {source} s JOIN groups USING (outcome) GROUP BY s.outcome, t),
at_risk AS (SELECT *, CAST(sum(c) OVER (PARTITION BY outcome ORDER BY t DESC) AS DOUBLE) AS n,
                   CAST(sum(c1) OVER (PARTITION BY outcome ORDER BY t DESC) AS DOUBLE) AS n1 FROM at_t),
lr AS (SELECT outcome, sum(d1) AS o, sum(n1 * d / n) AS ex,
              sum(CASE WHEN n > 1 THEN n1 * (n - n1) * d * (n - d) / (n * n * (n - 1)) ELSE 0 END) AS v
       FROM at_risk WHERE d > 0 GROUP BY outcome)"""


_LOGRANK_OUT = """SELECT outcome, g1 AS group_1, g2 AS group_2, CAST(o AS BIGINT) AS observed_1, round(ex, 5) AS expected_1,
  round(v, 5) AS variance, round((o - ex) * (o - ex) / v, 5) AS chi2 FROM lr JOIN groups USING (outcome)"""


def _logrank(rows):
    return sv.log_rank(rows).select(
        "outcome", "group_1", "group_2", "observed_1", *[F.round(c, 5).alias(c) for c in ("expected_1", "variance", "chi2")])


@query("logrank", f"WITH {CELLS}, {SPLIT}, {logrank_sql('surv')} {_LOGRANK_OUT}")
def logrank(spark, sf):
    return _logrank(rows(spark, sf))


@query("logrank_by_condition", f"""WITH {PATIENTS},
clinical AS (
  SELECT 'OS' AS outcome, CASE grp WHEN 1 THEN 'CLR' ELSE 'DII' END AS grp, os AS t, 1 - os_censor AS e FROM patients WHERE os IS NOT NULL
  UNION ALL SELECT 'DFS', CASE grp WHEN 1 THEN 'CLR' ELSE 'DII' END, dfs, 1 - dfs_censor FROM patients WHERE dfs IS NOT NULL),
{logrank_sql('clinical')} {_LOGRANK_OUT}""")
def logrank_by_condition(spark, sf):
    from cellweave.functions.labels import group_label
    labelled = patients(spark, sf).withColumn("condition_label", group_label(F.col("Group")))
    return _logrank(sv.survival_rows(labelled, OUTCOMES, "condition_label"))


@query("log_rank_test", f"""WITH {CELLS}, {SPLIT}, {logrank_sql('surv')},
sizes AS (SELECT outcome, count_if(grp = g1) AS n_1, count_if(grp = g2) AS n_2 FROM surv JOIN groups USING (outcome) GROUP BY outcome),
tested AS (SELECT *, (o - ex) * (o - ex) / v AS chi2, sqrt((o - ex) * (o - ex) / v / 2) AS x FROM lr),
p AS (SELECT *, {erfc_sql('x')} AS p FROM tested)
SELECT outcome, 'median' AS split_by, CAST(NULL AS DOUBLE) AS threshold, round(chi2, 5) AS chi2, round(p, 6) AS logrank_p,
  {stars_sql('p')} AS significance, g1 AS group_1, g2 AS group_2, CAST(n_1 AS BIGINT) AS n_1, CAST(n_2 AS BIGINT) AS n_2
FROM p JOIN groups USING (outcome) JOIN sizes USING (outcome)""")
def log_rank_test(spark, sf):
    found = sv.log_rank_results(rows(spark, sf), "median", None)
    return found.withColumns({"chi2": F.round("chi2", 5), "logrank_p": F.round("logrank_p", 6)})
