"""Marker columns: long form, ranges, positivity and intensity levels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.operators.ordered import percentiles
from cellweave.operators.skew import GROUP_ROWS
from cellweave.schema import col

# Shares that split positives into three levels, and how many it takes.
LEVEL_SHARES = (0.33, 0.66)
LEVELS_NEED_MORE_THAN = 3


def panel_markers(columns: list[str], panel: list[str], gating_only: list[str]) -> tuple[list[str], list[str]]:
    """Panel markers to analyse, split into those present and those missing."""
    wanted = [m for m in panel if m not in gating_only]
    return [m for m in wanted if m in columns], [m for m in wanted if m not in columns]


def named_markers(columns: list[str], markers: dict[str, str]) -> tuple[dict[str, str], list[str]]:
    """Configured {display name: column} pairs that are present, and the names that are not."""
    present = {n: c for n, c in markers.items() if c in columns}
    return present, [n for n in markers if n not in present]


def unpivot_markers(cells: DataFrame, keys: list[str], markers: list[str] | dict[str, str]) -> DataFrame:
    """Long form: one row per cell and marker. ``markers`` may map display names to columns."""
    named = markers if isinstance(markers, dict) else {m: m for m in markers}
    pairs = F.explode(F.array(*[
        F.struct(F.lit(name).alias("marker"), col(c).cast("double").alias("value"))
        for name, c in named.items()]))
    return (cells.select(*[col(k) for k in keys], pairs.alias("pair"))
            .select(*[col(k) for k in keys], "pair.marker", "pair.value"))


def marker_range(cells: DataFrame, markers: list[str], limit: int = GROUP_ROWS) -> DataFrame:
    """1st and 99th percentile of every marker in every image."""
    return percentiles(unpivot_markers(cells, ["image_id"], markers), ["image_id", "marker"],
                       {"p01": ("value", 0.01), "p99": ("value", 0.99)}, limit)


def positive_columns(thresholds: dict[str, float]) -> dict[str, Column]:
    """``<marker>_pos``: above the marker's threshold; a missing value is not."""
    return {f"{m}_pos": F.coalesce(col(m) > F.lit(float(t)), F.lit(False)) for m, t in thresholds.items()}


def add_positivity(cells: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    present = {m: t for m, t in thresholds.items() if m in cells.columns}
    return cells.withColumns(positive_columns(present))


def level_cuts(cells: DataFrame, thresholds: dict[str, float], limit: int = GROUP_ROWS) -> DataFrame:
    """Per marker: positives, and the two percentiles of their values that split the levels."""
    markers = [m for m in thresholds if m in cells.columns]
    cut = reduce(lambda e, m: e.when(F.col("marker") == m, F.lit(float(thresholds[m]))),
                 markers[1:], F.when(F.col("marker") == markers[0], F.lit(float(thresholds[markers[0]]))))
    positives = unpivot_markers(cells, [], markers).where(F.col("value") > cut)
    shares = percentiles(positives, ["marker"],
                         {"low_cut": ("value", LEVEL_SHARES[0]), "high_cut": ("value", LEVEL_SHARES[1])}, limit)
    counts = positives.groupBy("marker").agg(F.count(F.lit(1)).alias("n_positive"))
    return counts.join(shares, "marker")


def add_intensity_levels(cells: DataFrame, thresholds: dict[str, float], limit: int = GROUP_ROWS) -> DataFrame:
    """``<marker>_intensity``: 0 negative, 1 to 3 by the positives' own percentiles.

    The cuts are one row per marker, read once; levels are plain column expressions.
    """
    present = {m: t for m, t in thresholds.items() if m in cells.columns}
    if not present:
        return cells
    cuts = {r["marker"]: r for r in level_cuts(cells, present, limit).collect()}
    levels = {}
    for m, t in present.items():
        found = cuts.get(m)
        if found is None or found["n_positive"] <= LEVELS_NEED_MORE_THAN:
            level = F.lit(0)
        else:
            level = (F.when(~F.coalesce(col(m) > F.lit(float(t)), F.lit(False)), 0)
                     .when(col(m) <= F.lit(found["low_cut"]), 1)
                     .when(col(m) <= F.lit(found["high_cut"]), 2).otherwise(3))
        levels[f"{m}_intensity"] = level.cast("tinyint")
    return cells.withColumns(levels)


def gate(cells: DataFrame, marker: str, threshold: float) -> DataFrame:
    """Cells above the threshold; every cell where the marker is absent."""
    return cells.where(col(marker) > F.lit(float(threshold))) if marker in cells.columns else cells


def gate_pass_rate(cells: DataFrame, marker: str, threshold: float) -> DataFrame:
    """Cells that pass the gate, all cells, and the percent that pass."""
    passes = F.coalesce(col(marker) > F.lit(float(threshold)), F.lit(False))
    return cells.agg(
        F.count_if(passes).alias("n_pass"), F.count(F.lit(1)).alias("n_total"),
        (F.avg(passes.cast("double")) * 100).alias("percent_pass"))


def threshold_check(cells: DataFrame, thresholds: dict[str, float], lowest: float = 0.01,
                    highest: float = 0.95) -> DataFrame:
    """Positive share per marker, suspect where almost nothing or almost everything passes."""
    rows = unpivot_markers(cells, [], list(thresholds))
    cut = reduce(lambda e, mt: e.when(F.col("marker") == mt[0], F.lit(float(mt[1]))),
                 list(thresholds.items())[1:],
                 F.when(F.col("marker") == next(iter(thresholds)), F.lit(float(next(iter(thresholds.values()))))))
    share = F.avg((F.col("value") > cut).cast("double"))
    verdict = (F.when(F.col("positive_share") < lowest, "suspect_high")
               .when(F.col("positive_share") > highest, "suspect_low").otherwise("ok"))
    return (rows.where("value is not null").groupBy("marker").agg(share.alias("positive_share"))
            .withColumn("verdict", verdict))
