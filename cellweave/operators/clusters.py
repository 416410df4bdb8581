"""Marker profiles of clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.operators.markers import unpivot_markers
from cellweave.schema import col

# Fixed value added to a deviation before dividing by it.
TINY = 1e-9


def cluster_means(long: DataFrame) -> DataFrame:
    """Mean of every marker in every cluster, z-scored across the clusters of the marker.

    ``long`` holds (cluster, marker, value). After the grouped mean there is one row per
    cluster and marker, so the window over a marker's clusters is small.
    """
    over = Window.partitionBy("marker")
    means = long.groupBy("cluster", "marker").agg(F.avg("value").alias("mean"))
    return means.withColumn("z", (F.col("mean") - F.avg("mean").over(over))
                            / (F.stddev_samp("mean").over(over) + F.lit(TINY)))


def _panel_place(markers: list[str]) -> Column:
    return F.array_position(F.array(*[F.lit(m) for m in markers]), F.col("marker"))


def top_markers(means: DataFrame, n_top: int = 8, n_bottom: int = 3) -> DataFrame:
    """Highest and lowest markers by z per cluster; both lists run from high to low."""
    down = Window.partitionBy("cluster").orderBy(F.desc("z"), "marker")
    up = Window.partitionBy("cluster").orderBy("z", F.desc("marker"))
    ranked = means.withColumn("from_top", F.row_number().over(down)).withColumn("from_bottom", F.row_number().over(up))
    return ranked.where((F.col("from_top") <= n_top) | (F.col("from_bottom") <= n_bottom))


def percent_positive(cells: DataFrame, markers: list[str], cluster: str = "cluster") -> DataFrame:
    """Percent of cells positive per cluster and marker that has a positivity column."""
    present = {m: f"{m}_pos" for m in markers if f"{m}_pos" in cells.columns}
    flags = cells.select(col(cluster).cast("string").alias("cluster"),
                         *[col(c).cast("int").alias(c) for c in present.values()])
    return (unpivot_markers(flags, ["cluster"], present).groupBy("cluster", "marker")
            .agg(F.round(F.avg("value") * 100, 1).alias("pct_pos")))


def top_percent_positive(percents: DataFrame, markers: list[str], n: int = 6) -> DataFrame:
    """Up to n markers per cluster by percent positive, panel order on ties."""
    order = Window.partitionBy("cluster").orderBy(F.desc("pct_pos"), _panel_place(markers))
    return percents.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def cluster_profiles(cells: DataFrame, markers: list[str], cluster: str = "cluster",
                     n_top: int = 8, n_bottom: int = 3) -> DataFrame:
    """One row per cluster: size, highest and lowest markers with z, percent positive."""
    present = [m for m in markers if m in cells.columns]
    long = unpivot_markers(cells.withColumn("cluster", col(cluster).cast("string")), ["cluster"], present)
    ranked = top_markers(cluster_means(long), n_top, n_bottom)
    entry = F.struct("from_top", "marker", F.round("z", 2).alias("z"))

    def listed(keep: Column) -> Column:
        ordered = F.array_sort(F.collect_list(F.when(keep, entry)))
        return F.transform(ordered, lambda e: F.struct(e["marker"].alias("marker"), e["z"].alias("z")))

    lists = ranked.groupBy("cluster").agg(
        listed(F.col("from_top") <= n_top).alias("high"),
        listed(F.col("from_bottom") <= n_bottom).alias("low"))
    sizes = cells.groupBy(col(cluster).cast("string").alias("cluster")).agg(F.count(F.lit(1)).alias("n"))
    profile = sizes.join(lists, "cluster")
    if any(f"{m}_pos" in cells.columns for m in present):
        shares = (percent_positive(cells, present, cluster).groupBy("cluster")
                  .agg(F.map_from_entries(F.collect_list(F.struct("marker", "pct_pos"))).alias("pct_pos")))
        return profile.join(shares, "cluster", "left")
    return profile.withColumn("pct_pos", F.create_map().cast("map<string,double>"))
