"""Queries over rank tests of markers inside and outside triads."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.operators import ranktests as rt, triads as ops
from cellweave.operators.lineage import materialize
from workload.registry import query
from workload.triads import REPORT_UM
from workload.views import CELLS, CONDITIONS, RADIUS, cells, erfc_sql, stars_sql, triads_sql

ROLES = {"anchor": "A", "partner1": "N", "partner2": "R"}
NAMES = {"anchor": "Anchor", "partner1": "N", "partner2": "R"}
SHOWN = {"quantity": "l_quantity", "price": "l_extendedprice", "discount": "l_discount"}


def flagged(spark, sf):
    """Cells flagged at the report radius, of images with triads at the search radius; written once."""
    keep = ["image_id", "condition", "cell_id", "cell_type", *SHOWN.values()]
    slim = cells(spark, sf).select("image_id", "condition", "cell_id", "x", "y", "cell_type")
    found = materialize(ops.find_triads(slim, ops.TriadSearch(RADIUS, 1.0, "A", "N", "R"), False))
    images = found.select("image_id").distinct()
    inside = cells(spark, sf).select(*keep).join(images, "image_id", "left_semi")
    return materialize(ops.flags_from_triads(inside, ops.report_radius_filter(found, REPORT_UM), True))


_ROWS = " UNION ALL ".join(
    f"SELECT '{role}' AS role, '{NAMES[role]}' AS cell_type, condition, '{name}' AS marker, {m} AS value, {flag} AS in_a "
    f"FROM flagged WHERE cell_type = '{ROLES[role]}'"
    for role, flag in (("anchor", "fa"), ("partner1", "f1"), ("partner2", "f2")) for name, m in SHOWN.items())
FLAGGED = f"""{triads_sql(RADIUS, "triads")}, {triads_sql(REPORT_UM, "near")},
flagged AS (
  SELECT c.*, a.id IS NOT NULL AS fa, p1.id IS NOT NULL AS f1, p2.id IS NOT NULL AS f2
  FROM cells c SEMI JOIN triads i ON c.image_id = i.image_id
  LEFT JOIN (SELECT DISTINCT image_id, anchor_id AS id FROM near) a ON c.image_id = a.image_id AND c.cell_id = a.id
  LEFT JOIN (SELECT DISTINCT image_id, p1_id AS id FROM near) p1 ON c.image_id = p1.image_id AND c.cell_id = p1.id
  LEFT JOIN (SELECT DISTINCT image_id, p2_id AS id FROM near) p2 ON c.image_id = p2.image_id AND c.cell_id = p2.id),
rows_ AS ({_ROWS})"""


def test_sql(source: str, keys: str) -> str:
    return f"""ranked AS (
  SELECT *, rank() OVER (PARTITION BY {keys} ORDER BY value) + (count(*) OVER (PARTITION BY {keys}, value) - 1) / 2.0 AS r,
         count(*) OVER (PARTITION BY {keys}, value) AS t FROM {source}),
sums AS (
  SELECT {keys}, CAST(count_if(in_a) AS DOUBLE) AS n1, CAST(count_if(NOT in_a) AS DOUBLE) AS n2,
         sum(CASE WHEN in_a THEN r ELSE 0 END) AS ra, sum(CAST(t AS DOUBLE) * t - 1) AS ties,
         avg(value) FILTER (WHERE in_a) AS mean_a, avg(value) FILTER (WHERE NOT in_a) AS mean_b,
         quantile_cont(value, 0.5) FILTER (WHERE in_a) AS median_a, quantile_cont(value, 0.5) FILTER (WHERE NOT in_a) AS median_b
  FROM ranked GROUP BY {keys}),
us AS (SELECT *, ra - n1 * (n1 + 1) / 2 AS ua, n1 * n2 - (ra - n1 * (n1 + 1) / 2) AS ub, n1 + n2 AS n FROM sums),
tested AS (SELECT *, (greatest(ua, ub) - n1 * n2 / 2 - 0.5)
  / sqrt(n1 * n2 / 12 * ((n + 1) - ties / (n * (n - 1)))) AS z FROM us)"""


def _rows(spark, sf):
    return rt.role_rows(flagged(spark, sf), ROLES, NAMES, SHOWN, ["condition"])


@query("mwu_rank", f"""WITH {CELLS}, {FLAGGED}, {test_sql("rows_", "role, cell_type, marker")}
SELECT DISTINCT role, marker, value, r AS midrank, CAST(t AS BIGINT) AS ties FROM ranked""")
def mwu_rank(spark, sf):
    return rt.midranks(_rows(spark, sf), ["role", "marker"]).select("role", "marker", "value", "midrank", "ties")


@query("mann_whitney", f"""WITH {CELLS}, src AS (
  SELECT tissue_id, l_extendedprice AS value, matched AS in_a FROM cells), {test_sql("src", "tissue_id")}
SELECT tissue_id, CAST(n1 AS BIGINT) AS n_a, CAST(n2 AS BIGINT) AS n_b, ua AS u_a, ub AS u_b, round(z, 6) AS z FROM tested""")
def mann_whitney(spark, sf):
    rows = cells(spark, sf).select("tissue_id", F.col("l_extendedprice").alias("value"), F.col("matched").alias("in_a"))
    return rt.mann_whitney(rows, ["tissue_id"]).select(
        "tissue_id", "n_a", "n_b", "u_a", "u_b", F.round("z", 6).alias("z"))


@query("group_location", f"""WITH {CELLS}, {FLAGGED}
SELECT role, marker, CAST(count_if(in_a) AS BIGINT) AS "n_A", CAST(count_if(NOT in_a) AS BIGINT) AS "n_B",
       round(avg(value) FILTER (WHERE in_a), 4) AS "mean_A", round(avg(value) FILTER (WHERE NOT in_a), 4) AS "mean_B",
       round(quantile_cont(value, 0.5) FILTER (WHERE in_a), 4) AS "median_A",
       round(quantile_cont(value, 0.5) FILTER (WHERE NOT in_a), 4) AS "median_B"
FROM rows_ GROUP BY role, marker""")
def group_location(spark, sf):
    out = rt.group_location(_rows(spark, sf), ["role", "marker"])
    return out.select(*[F.round(c, 4).alias(c) if t == "double" else c for c, t in out.dtypes])


_TEST_COLUMNS = """CAST(n1 AS BIGINT) AS "n_A", CAST(n2 AS BIGINT) AS "n_B", round(mean_a, 4) AS "mean_A",
  round(mean_b, 4) AS "mean_B", round(median_a, 4) AS "median_A", round(median_b, 4) AS "median_B",
  CASE WHEN n1 >= 3 AND n2 >= 3 THEN ua END AS u_a, CASE WHEN n1 >= 3 AND n2 >= 3 THEN ub END AS u_b,
  CASE WHEN n1 >= 3 AND n2 >= 3 THEN round(z, 6) END AS z"""


def _shown(tests):
    out = tests.drop("tie_sum", "role")
    digits = {"mean_A": 4, "mean_B": 4, "median_A": 4, "median_B": 4, "z": 6}
    return out.select(*[F.round(c, digits[c]).alias(c) if c in digits else c for c in out.columns])


@query("test_in_vs_out", f"""WITH {CELLS}, {FLAGGED}, {test_sql("rows_", "role, cell_type, marker")}
SELECT cell_type, 'in_triad_vs_out' AS comparison, marker, 'in_triad' AS "group_A", 'not_in_triad' AS "group_B",
  {_TEST_COLUMNS} FROM tested""")
def test_in_vs_out(spark, sf):
    return _shown(rt.in_versus_out(_rows(spark, sf)))


@query("test_between_conditions", f"""WITH {CELLS}, {FLAGGED},
inside AS (SELECT role, cell_type, marker, value, condition = 'CLR' AS in_a FROM rows_ WHERE in_a),
{test_sql("inside", "role, cell_type, marker")}
SELECT cell_type, 'CLR_vs_DII_in_triad' AS comparison, marker, 'CLR' AS "group_A", 'DII' AS "group_B",
  {_TEST_COLUMNS} FROM tested WHERE n >= 6 AND n1 >= 3 AND n2 >= 3""")
def test_between_conditions(spark, sf):
    return _shown(rt.between_conditions(_rows(spark, sf), CONDITIONS))


_SUMMED = """cell_type, comparison, marker, "group_A", "group_B", n1, n2, mean_a, mean_b, median_a, median_b, u,
  CASE WHEN n1 >= 3 AND n2 >= 3 THEN greatest(z, 0) / sqrt(2) END AS x"""


@query("functional_summary", f"""WITH {CELLS}, {FLAGGED},
a AS (WITH {test_sql("rows_", "role, cell_type, marker")} SELECT *, 'in_triad_vs_out' AS comparison, 'in_triad' AS "group_A",
  'not_in_triad' AS "group_B", CASE WHEN n1 >= 3 AND n2 >= 3 THEN ub END AS u FROM tested),
inside AS (SELECT role, cell_type, marker, value, condition = 'CLR' AS in_a FROM rows_ WHERE in_a),
b AS (WITH {test_sql("inside", "role, cell_type, marker")} SELECT *, 'CLR_vs_DII_in_triad' AS comparison, 'CLR' AS "group_A",
  'DII' AS "group_B", CASE WHEN n1 >= 3 AND n2 >= 3 THEN ua END AS u FROM tested WHERE n >= 6 AND n1 >= 3 AND n2 >= 3),
both_ AS (SELECT {_SUMMED} FROM a UNION ALL SELECT {_SUMMED} FROM b),
p AS (SELECT *, CASE WHEN x IS NOT NULL THEN {erfc_sql('x')} END AS p FROM both_)
SELECT cell_type, comparison, marker, CASE marker {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SHOWN.items())} END AS marker_col,
  "group_A", "group_B", CAST(n1 AS BIGINT) AS "n_A", CAST(n2 AS BIGINT) AS "n_B", round(mean_a, 4) AS "mean_A", round(mean_b, 4) AS "mean_B",
  round(median_a, 4) AS "median_A", round(median_b, 4) AS "median_B", u AS "mannwhitney_U", round(p, 6) AS p_value,
  {stars_sql('p')} AS significance, round(0.05 / count(*) OVER (), 8) AS bonferroni_alpha,
  coalesce(p < 0.05 / count(*) OVER (), FALSE) AS sig_bonferroni FROM p""")
def functional_summary(spark, sf):
    out = rt.functional_summary(flagged(spark, sf), ROLES, NAMES, SHOWN, CONDITIONS)
    digits = {"mean_A": 4, "mean_B": 4, "median_A": 4, "median_B": 4, "p_value": 6}
    return out.select(*[F.round(c, digits[c]).alias(c) if c in digits else c for c in out.columns])

