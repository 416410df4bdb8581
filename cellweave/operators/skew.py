"""Finding heavy groups before a task has to hold one, and joining per-group values.

The check runs one narrow aggregation when the plan is built and brings at most a fixed
number of rows to the driver. Where the bound is passed, the table stays distributed. Small
tables get no hint by a count of their own: the adaptive planner sees their size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.operators.lineage import stage
from cellweave.schema import col

# Rows of one group that a single task may sort or buffer.
GROUP_ROWS = 1_000_000
# Rows of a table that may be broadcast or listed on the driver.
SMALL_ROWS = 20_000
# Rows of per-group values, a few numbers each, that may be broadcast to the rows of their groups.
STATS_ROWS = 500_000


@dataclass(frozen=True)
class Heavy:
    """Groups over the limit: a table, whether it is within the bound, the largest group, and
    how many groups there are if so."""

    table: DataFrame
    bounded: bool
    largest: int
    count: int = 0


def heavy_groups(df: DataFrame, keys: list[str], limit: int = GROUP_ROWS,
                 weight: str | None = None) -> Heavy | None:
    """Groups holding more than ``limit`` rows, as ``keys + group_rows``; None without any."""
    size = F.count(F.lit(1)) if weight is None else F.sum(col(weight))
    over = (df.groupBy(*[col(k) for k in keys])
            .agg(size.cast("bigint").alias("group_rows"))
            .where(F.col("group_rows") > limit))
    listed = over.limit(SMALL_ROWS + 1).collect()
    if not listed:
        return None
    if len(listed) <= SMALL_ROWS:
        spark = df.sparkSession
        return Heavy(spark.createDataFrame(listed, over.schema), True,
                     max(r["group_rows"] for r in listed), len(listed))
    largest = over.agg(F.max("group_rows")).first()[0]
    return Heavy(over, False, largest)


def join_group_stats(df: DataFrame, stats: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Bring per-group values back to the rows.

    The statistics are computed once and stored, if they are not a stored table already. Up to the bound they are broadcast, so the
    rows are not moved; beyond it a shuffle join is left whose hot keys the adaptive skew
    join splits: the statistics hold one row per key.
    """
    stored = stage(stats)
    return df.join(F.broadcast(stored) if stored.count() <= STATS_ROWS else stored, list(keys), how)
