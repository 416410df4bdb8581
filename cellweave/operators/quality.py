"""Checks of finished tables, as rows (step, subject, check, passed, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.schema import UNASSIGNED, missing_columns

# Fixed value: largest share of cells that may stay without a type.
MOST_UNASSIGNED = 50.0

CHECK_SCHEMA = "step string, subject string, check string, passed boolean, detail string"


def _columns_check(df: DataFrame, step: str, required: list[str]) -> DataFrame:
    missing = missing_columns(df, required)
    return df.sparkSession.createDataFrame(
        [(step, "table", "columns_present", not missing, ",".join(missing))], CHECK_SCHEMA)


def _as_checks(summary: DataFrame, step: str, subject: Column, checks: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One row per check from a table with one row per subject."""
    rows = F.explode(F.array(*[
        F.struct(F.lit(name).alias("check"), F.coalesce(passed, F.lit(False)).alias("passed"),
                 F.coalesce(detail.cast("string"), F.lit("")).alias("detail"))
        for name, (passed, detail) in checks.items()]))
    return summary.select(F.lit(step).alias("step"), subject.cast("string").alias("subject"), rows.alias("c")).select(
        "step", "subject", "c.check", "c.passed", "c.detail")


def check_preprocessing(cells: DataFrame, conditions: list[str], tissues: DataFrame | None = None) -> DataFrame:
    """Columns present; every tissue has cells and enough of the expected conditions.

    ``tissues`` (tissue_id) lists tissues that must be there even if no cell is.
    """
    step = "preprocessing"
    columns = _columns_check(cells, step, ["condition", "image_id", "tissue_id"])
    if missing_columns(cells, ["condition", "tissue_id"]):
        return columns
    stats = cells.groupBy("tissue_id").agg(
        F.count(F.lit(1)).alias("n_cells"), F.count_distinct("condition").alias("n_conditions"),
        *[F.bool_or(F.col("condition") == c).alias(f"has_{i}") for i, c in enumerate(conditions)])
    if tissues is not None:
        stats = tissues.select("tissue_id").distinct().join(stats, "tissue_id", "left")
    n = F.coalesce("n_cells", F.lit(0))
    all_found = reduce(lambda a, b: a & b, [F.coalesce(f"has_{i}", F.lit(False)) for i in range(len(conditions))],
                       F.lit(True))
    return columns.unionByName(_as_checks(stats, step, F.col("tissue_id"), {
        "has_cells": (n > 0, n),
        "conditions_found": (all_found | (F.col("n_conditions") >= 2), F.col("n_conditions"))}))


def check_cell_typing(cells: DataFrame) -> DataFrame:
    """Columns present, cells there, two types or more, at most half unassigned."""
    step = "cell_typing"
    columns = _columns_check(cells, step, ["cell_type", "condition"])
    if "cell_type" not in cells.columns:
        return columns
    per_type = cells.groupBy("cell_type").agg(F.count(F.lit(1)).alias("n"))
    stats = per_type.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_cells"), F.count("cell_type").alias("n_types"),
        F.coalesce(F.sum(F.when(F.col("cell_type") == UNASSIGNED, F.col("n"))), F.lit(0)).alias("n_unassigned"))
    share = F.coalesce(F.try_divide(F.col("n_unassigned") * 100.0, F.col("n_cells")), F.lit(0.0))
    return columns.unionByName(_as_checks(stats, step, F.lit("table"), {
        "has_cells": (F.col("n_cells") > 0, F.col("n_cells")),
        "two_types": (F.col("n_types") >= 2, F.col("n_types")),
        "mostly_assigned": (share <= MOST_UNASSIGNED, F.round(share, 1))}))


def check_triads(summary: DataFrame, counts: DataFrame, triads: DataFrame) -> DataFrame:
    """Summary and condition counts are not empty and complete, and some triad exists."""
    step = "triads"
    columns = _columns_check(summary, step, ["image_id", "condition", "n_triads"])

    def filled(df: DataFrame, name: str) -> DataFrame:
        # One row is enough to know.
        stats = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
        return _as_checks(stats, step, F.lit("table"), {name: (F.col("n") > 0, F.lit(""))})

    return (columns.unionByName(filled(summary, "summary_filled"))
            .unionByName(filled(counts, "condition_counts_filled"))
            .unionByName(filled(triads, "any_triad")))


def check_written(df: DataFrame, step: str) -> DataFrame:
    """Whether a step's output holds any row."""
    stats = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
    return _as_checks(stats, step, F.lit("table"), {"output_filled": (F.col("n") > 0, F.lit(""))})


def check_report(*checks: DataFrame) -> DataFrame:
    """All checks in one table. Steps without their own checks pass."""
    return reduce(DataFrame.unionByName, checks)


def passing_step(spark, step: str) -> DataFrame:
    return spark.createDataFrame([(step, "table", "no_checks", True, "")], CHECK_SCHEMA)


def all_passed(report: DataFrame) -> DataFrame:
    """Checks and failures per step."""
    return report.groupBy("step").agg(
        F.count(F.lit(1)).alias("n_checks"), F.count_if(~F.col("passed")).alias("n_failed"),
        F.bool_and("passed").alias("passed"))
