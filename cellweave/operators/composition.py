"""Counts and shares of classes: cell types, clusters, conditions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.schema import UNASSIGNED, col


def share_of_total(counts: DataFrame, within: list[str], n: str = "n") -> DataFrame:
    """Percent of each row's count within its group; ``counts`` has one row per class."""
    total = F.sum(n).over(Window.partitionBy(*[col(w) for w in within] or [F.lit(0)]))
    return counts.withColumn("percent", F.col(n) * 100.0 / total)


def celltype_counts(cells: DataFrame) -> DataFrame:
    """Cells per type with their percent, most first."""
    counts = (cells.where("cell_type is not null").groupBy("cell_type")
              .agg(F.count(F.lit(1)).alias("n")))
    return share_of_total(counts, []).orderBy(F.desc("n"), "cell_type")


def cluster_sizes(cells: DataFrame, cluster: str = "cluster") -> DataFrame:
    return cells.groupBy(col(cluster)).agg(F.count(F.lit(1)).alias("n_cells"))


def cluster_order(clusters: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Numeric cluster ids in number order, others after them by name."""
    number = col(cluster).try_cast("int")
    return clusters.orderBy(number.asc_nulls_last(), col(cluster))


def composition_percent(cells: DataFrame) -> DataFrame:
    """Percent of every cell type in every condition, zero where it does not occur."""
    counts = (cells.where("cell_type is not null and condition is not null")
              .groupBy("condition", "cell_type").agg(F.count(F.lit(1)).alias("n")))
    types = counts.agg(F.array_sort(F.collect_set("cell_type")).alias("types"))
    every = (counts.select("condition").distinct().withColumn("all_rows", F.lit(0))
             .join(F.broadcast(types.withColumn("all_rows", F.lit(0))), "all_rows")
             .select("condition", F.explode("types").alias("cell_type")))
    filled = (every.join(counts, ["condition", "cell_type"], "left")
              .withColumn("n", F.coalesce("n", F.lit(0))))
    return share_of_total(filled, ["condition"])


def composition_table(cells: DataFrame, cell_types: list[str]) -> DataFrame:
    """The same as one row per condition and one column per given type."""
    counts = [F.count_if(F.col("cell_type") == t) for t in cell_types]
    total = F.count_if(F.col("cell_type").isin(*cell_types))
    return (cells.where("condition is not null").groupBy("condition")
            .agg(*[F.try_divide(c * 100.0, total).alias(t) for c, t in zip(counts, cell_types)]))


def label_clusters(cells: DataFrame, labels: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Cell type of each cell's cluster; ids are compared as text, unmapped is Unassigned.

    ``labels`` has columns cluster and label, one row per cluster.
    """
    named = labels.select(F.col("cluster").cast("string").alias("cluster_key"), F.col("label"))
    return (cells.withColumn("cluster_key", col(cluster).cast("string"))
            .join(named, "cluster_key", "left")
            .withColumn("cell_type", F.coalesce("label", F.lit(UNASSIGNED)))
            .drop("cluster_key", "label"))
