"""Two-peak mixture thresholds for all markers at once, as repeated aggregations.

One pass computes, for every marker and component, the summed responsibilities and their
first two moments; the driver only holds those few numbers per marker. Equal values are
added up before the first pass.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.operators.lineage import materialize
from cellweave.operators.markers import unpivot_markers
from cellweave.operators.ordered import percentiles
from cellweave.operators.skew import GROUP_ROWS, join_group_stats

# Fixed values of the fit.
MAX_ROUNDS = 200
TOLERANCE = 1e-3
VARIANCE_FLOOR = 1e-6
FEWEST_VALUES = 10
FALLBACK_SHARE = 0.95


@dataclass(frozen=True)
class Component:
    weight: float
    mean: float
    variance: float


def finite_values(long: DataFrame) -> DataFrame:
    """Rows whose value is a finite number."""
    value = F.col("value")
    return long.where(value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))))


def sample_cells(long: DataFrame, id_columns: list[str], cap: int, seed: int = 42) -> DataFrame:
    """At most ``cap`` rows per marker: those with the smallest hash of id and seed.

    Rows are counted by the first digits of the hash; digits beyond the one that reaches the
    cap are cut off before ranking, so no task sorts a whole marker.
    """
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in id_columns], F.lit(str(seed))))
    hashed = long.withColumn("digest", digest).withColumn("lead", F.substring("digest", 1, 4))
    sizes = hashed.groupBy("marker", "lead").agg(F.count(F.lit(1)).alias("n_lead"))
    before = Window.partitionBy("marker").orderBy("lead").rowsBetween(Window.unboundedPreceding, -1)
    needed = sizes.withColumn("n_before", F.coalesce(F.sum("n_lead").over(before), F.lit(0))).where(F.col("n_before") < cap)
    last = needed.groupBy("marker").agg(F.max("lead").alias("last_lead"))
    order = Window.partitionBy("marker").orderBy("digest", *id_columns)
    return (join_group_stats(hashed, last, ["marker"]).where(F.col("lead") <= F.col("last_lead"))
            .withColumn("place", F.row_number().over(order)).where(F.col("place") <= cap)
            .drop("digest", "lead", "last_lead", "place"))


def tally(long: DataFrame) -> DataFrame:
    """Finite values per marker with how often each occurs."""
    return finite_values(long).groupBy("marker", "value").agg(F.count(F.lit(1)).alias("w"))


def starting_fits(tallied: DataFrame, n_components: int = 2, limit: int = GROUP_ROWS) -> dict[str, list[Component]]:
    """Split each marker at its median (or even quantiles) and take the moments of the parts."""
    shares = [i / n_components for i in range(1, n_components)] or [0.5]
    cuts = percentiles(tallied, ["marker"], {f"cut_{i}": ("value", p) for i, p in enumerate(shares)}, limit, "w")
    part = sum([(F.col("value") > F.col(f"cut_{i}")).cast("int") for i in range(n_components - 1)], F.lit(0))
    # Values are taken from the first cut, so large values do not cancel out small spreads.
    gap = F.col("value") - F.col("cut_0")
    sums = (tallied.join(F.broadcast(cuts), "marker").groupBy("marker", "cut_0", part.alias("part"))
            .agg(F.sum("w").alias("n"), F.sum(F.col("w") * gap).alias("s1"), F.sum(F.col("w") * gap * gap).alias("s2")))
    shift = F.col("s1") / F.col("n")
    moments = sums.select("marker", "part", "n", (F.col("cut_0") + shift).alias("mean"),
                          (F.col("s2") / F.col("n") - shift * shift).alias("variance"))
    parts: dict[str, dict[int, tuple]] = {}
    for r in moments.collect():
        parts.setdefault(r["marker"], {})[r["part"]] = (r["n"], r["mean"], r["variance"])
    fits = {}
    for marker, found in parts.items():
        total = sum(n for n, _, _ in found.values())
        top = max(found)
        fits[marker] = [
            Component(found[k][0] / total, found[k][1], max(found[k][2], VARIANCE_FLOOR))
            if k in found else Component(0.0, found[top][1], max(found[top][2], VARIANCE_FLOOR))
            for k in range(n_components)]
    return fits


def _round(tallied: DataFrame, fits: dict[str, list[Component]]) -> DataFrame:
    """One expectation and maximisation pass: the sums each marker's next fit needs."""
    n_components = len(next(iter(fits.values())))
    spark = tallied.sparkSession
    rows = [(m, [math.log(c.weight) if c.weight > 0 else -1e300 for c in f],
             [c.mean for c in f], [c.variance for c in f]) for m, f in fits.items()]
    params = spark.createDataFrame(
        rows, "marker string, log_weight array<double>, mean array<double>, variance array<double>")
    # One row per marker still being fitted.
    joined = tallied.join(F.broadcast(params), "marker")
    for k in range(n_components):
        joined = joined.withColumn(f"off_{k}", F.col("value") - F.col("mean")[k])
    logs = [F.col("log_weight")[k] - F.log(F.lit(2 * math.pi) * F.col("variance")[k]) / 2
            - F.col(f"off_{k}") * F.col(f"off_{k}") / (2 * F.col("variance")[k]) for k in range(n_components)]
    joined = joined.withColumns({f"log_{k}": e for k, e in enumerate(logs)})
    peak = F.greatest(*[F.col(f"log_{k}") for k in range(n_components)])
    joined = joined.withColumn("peak", peak)
    joined = joined.withColumn("log_density", F.col("peak") + F.log(
        sum([F.exp(F.col(f"log_{k}") - F.col("peak")) for k in range(n_components)], F.lit(0.0))))
    sums = [F.sum("w").alias("n"), F.sum(F.col("w") * F.col("log_density")).alias("log_likelihood")]
    for k in range(n_components):
        share = F.col("w") * F.exp(F.col(f"log_{k}") - F.col("log_density"))
        sums += [F.sum(share).alias(f"s0_{k}"), F.sum(share * F.col(f"off_{k}")).alias(f"s1_{k}"),
                 F.sum(share * F.col(f"off_{k}") * F.col(f"off_{k}")).alias(f"s2_{k}")]
    return joined.groupBy("marker").agg(*sums)


def fit_mixtures(long: DataFrame, n_components: int = 2, max_rounds: int = MAX_ROUNDS,
                 tolerance: float = TOLERANCE, limit: int = GROUP_ROWS) -> dict[str, list[Component]]:
    """Fitted components per marker, lowest mean first, from rows (marker, value)."""
    return fit_tallied(materialize(tally(long)), n_components, max_rounds, tolerance, limit)


def fit_tallied(tallied: DataFrame, n_components: int = 2, max_rounds: int = MAX_ROUNDS,
                tolerance: float = TOLERANCE, limit: int = GROUP_ROWS,
                unfinished: set[str] | None = None) -> dict[str, list[Component]]:
    """The same from a written table of distinct values.

    Every round is one aggregation over all markers still moving; a marker is done when its
    mean log-likelihood changes by less than the tolerance. Those that were not done in the
    last round are added to ``unfinished``.
    """
    fits = starting_fits(tallied, n_components, limit)
    moving = dict(fits)
    last: dict[str, float] = {}
    for _ in range(max_rounds):
        if not moving:
            break
        for r in _round(tallied, moving).collect():
            marker, old = r["marker"], moving[r["marker"]]
            fits[marker] = [_updated(old[k], r, k) for k in range(n_components)]
            level = r["log_likelihood"] / r["n"]
            if abs(level - last.get(marker, -math.inf)) < tolerance:
                del moving[marker]
            else:
                moving[marker] = fits[marker]
            last[marker] = level
    if unfinished is not None:
        unfinished.update(moving)
    return {m: sorted(f, key=lambda c: c.mean) for m, f in fits.items()}


def _updated(old: Component, sums, k: int) -> Component:
    s0, s1, s2 = sums[f"s0_{k}"], sums[f"s1_{k}"], sums[f"s2_{k}"]
    if not s0 > 0:
        return Component(0.0, old.mean, old.variance)
    shift = s1 / s0
    return Component(s0 / sums["n"], old.mean + shift, max(s2 / s0 - shift * shift, VARIANCE_FLOOR))


def multipliers(panel: list[str], default: float, overrides: dict[str, float],
                gating_only: list[str], gate_multiplier: float) -> dict[str, float]:
    """Deviations above the low peak per marker: default, then overrides, then the gate's."""
    return {**{m: default for m in panel}, **overrides, **{g: gate_multiplier for g in gating_only}}


def thresholds_from_long(long: DataFrame, by_marker: dict[str, float], default: float = 2.0,
                         n_components: int = 2, max_rounds: int = MAX_ROUNDS, tolerance: float = TOLERANCE,
                         max_cells: int | None = None, id_columns: list[str] | None = None,
                         seed: int = 42, limit: int = GROUP_ROWS) -> DataFrame:
    """(marker, threshold, method, converged) with threshold = low mean + multiplier * low deviation.

    Markers with too few finite values, or whose fit breaks down, get their 95th percentile.
    ``max_cells`` fits on a sample of that size, drawn by ``id_columns``; the default fits on
    all cells. ``converged`` is false where the last round still moved the fit, and null
    without a fit.
    """
    if max_cells is not None and not id_columns:
        raise ValueError("a sample of cells needs the columns that name a cell")
    tallied = materialize(tally(long))
    fitted = tallied
    if max_cells is not None:
        fitted = materialize(tally(sample_cells(finite_values(long), id_columns, max_cells, seed)))
    sizes = {r["marker"]: r["n"] for r in tallied.groupBy("marker").agg(F.sum("w").alias("n")).collect()}
    enough = [m for m, n in sizes.items() if n >= FEWEST_VALUES]
    unfinished: set[str] = set()
    fits = fit_tallied(fitted.where(F.col("marker").isin(*enough)), n_components,
                       max_rounds, tolerance, limit, unfinished) if enough else {}
    rows = []
    for marker, components in fits.items():
        low = components[0]
        threshold = low.mean + by_marker.get(marker, default) * math.sqrt(low.variance)
        if math.isfinite(threshold):
            rows.append((marker, threshold, "mixture", marker not in unfinished))
    rest = [m for m in sizes if m not in {r[0] for r in rows}]
    if rest:
        tail = percentiles(tallied.where(F.col("marker").isin(*rest)), ["marker"],
                           {"threshold": ("value", FALLBACK_SHARE)}, limit, "w")
        rows += [(r["marker"], r["threshold"], "percentile", None) for r in tail.collect()]
    return long.sparkSession.createDataFrame(rows, "marker string, threshold double, method string, converged boolean")


def marker_thresholds(cells: DataFrame, markers: list[str], by_marker: dict[str, float], **options) -> DataFrame:
    """Threshold of every marker the table has."""
    present = [m for m in markers if m in cells.columns]
    ids = [c for c in ("image_id", "cell_id") if c in cells.columns]
    long = unpivot_markers(cells, ids, present)
    return thresholds_from_long(long, by_marker, id_columns=ids, **options)


def as_dict(thresholds: DataFrame) -> dict[str, float]:
    """Thresholds as driver-side numbers; one row per marker."""
    return {r["marker"]: r["threshold"] for r in thresholds.select("marker", "threshold").collect()}
