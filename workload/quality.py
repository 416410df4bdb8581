"""Queries that check finished tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.operators import patients as pt, quality as dq, triads as ops
from cellweave.operators.lineage import materialize
from cellweave.schema import missing_columns
from workload.registry import query
from workload.triads import SEARCH, short_summary
from workload.typing import TYPED, typed
from workload.views import AREAS, CELLS, CONDITIONS, areas, cells, summary_sql, table

PREPROCESSING = """SELECT 'preprocessing' AS step, 'table' AS subject, 'columns_present' AS "check", TRUE AS passed, '' AS detail
UNION ALL SELECT 'preprocessing', tissue_id, 'has_cells', n > 0, CAST(n AS VARCHAR) FROM tissues
UNION ALL SELECT 'preprocessing', tissue_id, 'conditions_found', coalesce((clr AND dii) OR k >= 2, FALSE), coalesce(CAST(k AS VARCHAR), '') FROM tissues"""
TISSUES = """tissues AS (
  SELECT t.tissue_id, count(c.cell_id) AS n, bool_or(condition = 'CLR') AS clr, bool_or(condition = 'DII') AS dii,
         nullif(count(DISTINCT condition), 0) AS k
  FROM (SELECT DISTINCT 'core' || CAST(s_nationkey % 9 AS VARCHAR) AS tissue_id FROM supplier
        UNION SELECT DISTINCT tissue_id FROM cells) t LEFT JOIN cells c USING (tissue_id) GROUP BY t.tissue_id)"""


def _preprocessing(spark, sf):
    c = cells(spark, sf)
    named = table(spark, sf, "supplier").select(F.concat(F.lit("core"), (F.col("s_nationkey") % 9).cast("string")).alias("tissue_id"))
    return dq.check_preprocessing(c, CONDITIONS, named.union(c.select("tissue_id")))


@query("dq_preprocessing", f"WITH {CELLS}, {TISSUES} {PREPROCESSING}")
def dq_preprocessing(spark, sf):
    return _preprocessing(spark, sf)


TYPING = """SELECT 'cell_typing' AS step, 'table' AS subject, 'columns_present' AS "check", TRUE AS passed, '' AS detail
UNION ALL SELECT 'cell_typing', 'table', 'has_cells', count(*) > 0, CAST(count(*) AS VARCHAR) FROM typed
UNION ALL SELECT 'cell_typing', 'table', 'two_types', count(DISTINCT assigned) >= 2, CAST(count(DISTINCT assigned) AS VARCHAR) FROM typed
UNION ALL SELECT 'cell_typing', 'table', 'mostly_assigned', avg(CAST(assigned = 'Unassigned' AS INT)) * 100 <= 50,
  CAST(round(avg(CAST(assigned = 'Unassigned' AS INT)) * 100, 1) AS VARCHAR) FROM typed"""


@query("dq_cell_typing", f"WITH {CELLS}, {TYPED} {TYPING}")
def dq_cell_typing(spark, sf):
    return dq.check_cell_typing(typed(spark, sf))


TRIADS = """SELECT 'triads' AS step, 'table' AS subject, 'columns_present' AS "check", TRUE AS passed, '' AS detail
UNION ALL SELECT 'triads', 'table', name, (SELECT count(*) > 0 FROM summary), ''
FROM (VALUES ('summary_filled'), ('condition_counts_filled'), ('any_triad')) v(name)"""


def _triads(spark, sf, summary):
    slim = cells(spark, sf).select("image_id", "condition", "cell_id", "x", "y", "cell_type")
    density = ops.condition_density(summary, ops.condition_areas(areas(spark, sf)), CONDITIONS)
    return dq.check_triads(summary, density, ops.find_triads(slim, SEARCH, with_counts=False))


@query("dq_triads", f"WITH {CELLS}, {summary_sql()}, {AREAS} {TRIADS}")
def dq_triads(spark, sf):
    return _triads(spark, sf, materialize(short_summary(spark, sf)))


@query("dq_report", f"""WITH {CELLS}, {TISSUES}, {TYPED}, {summary_sql()},
report AS ({PREPROCESSING} UNION ALL {TYPING} UNION ALL {TRIADS}
  UNION ALL SELECT 'survival', 'table', 'output_filled', (SELECT count(*) > 0 FROM summary), ''
  UNION ALL SELECT 'functional', 'table', 'no_checks', TRUE, '')
SELECT step, CAST(count(*) AS BIGINT) AS n_checks, CAST(count_if(NOT passed) AS BIGINT) AS n_failed, bool_and(passed) AS passed
FROM report GROUP BY step""")
def dq_report(spark, sf):
    # Three checks read it, so triads are counted once.
    summary = materialize(short_summary(spark, sf))
    written = dq.check_written(pt.image_triads(summary), "survival")
    return dq.all_passed(dq.check_report(
        _preprocessing(spark, sf), dq.check_cell_typing(typed(spark, sf)), _triads(spark, sf, summary), written,
        dq.passing_step(spark, "functional")))


@query("set_diff_columns", """SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'absent,other' WHEN 1 THEN 'absent' ELSE 'other' END AS missing FROM customer""")
def set_diff_columns(spark, sf):
    # Tables that have none, one or the other of two required columns, asked one after the other.
    customers = table(spark, sf, "customer").select("c_custkey")
    shapes = [customers, customers.withColumn("other", F.lit(1)), customers.withColumn("absent", F.lit(1))]
    required = ["absent", "c_custkey", "other"]
    return reduce(DataFrame.unionByName, [
        t.where(F.col("c_custkey") % 3 == k).select("c_custkey", F.lit(",".join(missing_columns(t, required))).alias("missing"))
        for k, t in enumerate(shapes)])
