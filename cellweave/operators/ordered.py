"""Running sums and exact percentiles over ordered values, without giant windows.

A window partitioned by a marker, a test or one hot image would sort all its rows in one
task. Here equal values are added up first (partial sums before the shuffle); a group that
is still heavy is cut into value ranges of about equal size. Running totals are then taken
inside each range and shifted by the totals of the ranges before it, which is exact for any
choice of cuts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.operators.lineage import materialize
from cellweave.operators.skew import GROUP_ROWS, SMALL_ROWS, Heavy, heavy_groups
from cellweave.schema import col

# Cuts made at once; ranges that are still heavy are cut again.
_CUTS_AT_ONCE = 1000
_STEP = 32


def _range_number(value: Column, cuts: Column) -> Column:
    """How many cuts are <= value: coarse search over every 32nd cut, then inside one step."""
    coarse = F.filter(cuts, lambda c, i: (i % _STEP == _STEP - 1) & (c <= value))
    start = F.size(coarse) * _STEP
    fine = F.filter(F.slice(cuts, start + 1, F.lit(_STEP)), lambda c: c <= value)
    return start + F.size(fine)


def _cut(rows: DataFrame, keys: list[str], value: str, heavy: Heavy, limit: int, name: str) -> DataFrame:
    """Add the number of the value range inside each heavy group; 0 elsewhere."""
    n_cuts = max(1, min(_CUTS_AT_ONCE, 2 * (heavy.largest // limit + 1)))
    shares = [(i + 1) / (n_cuts + 1) for i in range(n_cuts)]
    cuts = (rows.join(F.broadcast(heavy.table) if heavy.bounded else heavy.table, keys, "left_semi")
            .groupBy(*keys)
            .agg(F.array_distinct(F.percentile_approx(value, shares, 20 * n_cuts)).alias("value_cuts")))
    if heavy.bounded and heavy.count * n_cuts <= 50 * SMALL_ROWS:
        cuts = F.broadcast(cuts)
    return (rows.join(cuts, keys, "left")
            .withColumn(name, F.coalesce(_range_number(col(value), F.col("value_cuts")), F.lit(0)).cast("bigint"))
            .drop("value_cuts"))


def value_ranges(rows: DataFrame, keys: list[str], value: str, limit: int = GROUP_ROWS, heavy: Heavy | None = None):
    """Add ``value_range`` where groups are heavy. Returns (rows, whether any group is).

    ``rows`` hold one row per key and value, so a range can always be cut further. ``heavy``
    may be given where it is known already.
    """
    heavy = heavy or heavy_groups(rows, keys, limit)
    if heavy is None:
        return rows, False
    out = _cut(rows, keys, value, heavy, limit, "value_range")
    while heavy is not None and 2 * (heavy.largest // limit + 1) > _CUTS_AT_ONCE:
        heavy = heavy_groups(out, [*keys, "value_range"], limit)
        if heavy is not None:
            inner = _cut(out, [*keys, "value_range"], value, heavy, limit, "inner_range")
            out = inner.withColumn("value_range", F.col("value_range") * (_CUTS_AT_ONCE + 1) + F.col("inner_range")).drop("inner_range")
    return out, True


def running(rows: DataFrame, keys: list[str], value: str, sums: dict[str, str],
            ranged: bool, product: bool = False, inclusive: bool = False) -> DataFrame:
    """Add running totals ``out`` of columns ``in`` over rows ordered by ``value``.

    ``rows`` hold one row per key and value. Totals cover the rows before each row, and the
    row itself with ``inclusive``; ``product`` multiplies instead of adding.
    """
    total = F.product if product else F.sum
    nothing = F.lit(1.0) if product else F.lit(0)
    parts = keys + (["value_range"] if ranged else [])
    last = 0 if inclusive else -1
    inside = (Window.partitionBy(*[col(k) for k in parts]).orderBy(col(value))
              .rowsBetween(Window.unboundedPreceding, last))
    out = rows.withColumns({
        name: F.coalesce(total(col(source)).over(inside), nothing) for name, source in sums.items()})
    if not ranged:
        return out
    before = (Window.partitionBy(*[col(k) for k in keys]).orderBy("value_range")
              .rowsBetween(Window.unboundedPreceding, -1))
    shifts = (rows.groupBy(*[col(k) for k in parts])
              .agg(*[total(col(source)).alias("range_" + name) for name, source in sums.items()])
              .withColumns({"range_" + name: F.coalesce(total("range_" + name).over(before), nothing)
                            for name in sums}))
    combined = {name: (col(name) * F.col("range_" + name)) if product else (col(name) + F.col("range_" + name))
                for name in sums}
    return (out.join(shifts, parts).withColumns(combined)
            .drop(*["range_" + name for name in sums]))


def running_counts(rows: DataFrame, keys: list[str], value: str, counts: dict[str, Column],
                   limit: int = GROUP_ROWS) -> tuple[DataFrame, bool]:
    """One row per key and distinct value: each count, and ``<count>_before`` of lower values.

    Whether a group is heavy is asked of the distinct values, which are stored: the rows are
    read once.
    """
    tallied = (rows.where(col(value).isNotNull())
               .groupBy(*[col(k) for k in keys], col(value))
               .agg(*[c.alias(name) for name, c in counts.items()]))
    tallied, ranged = value_ranges(materialize(tallied), keys, value, limit)
    return running(tallied, keys, value, {n + "_before": n for n in counts}, ranged), ranged


def percentiles(rows: DataFrame, keys: list[str], wanted: dict[str, tuple[str, float]],
                limit: int = GROUP_ROWS, weight: str | None = None) -> DataFrame:
    """Exact percentiles with linear interpolation: ``wanted`` is {name: (column, share)}.

    ``weight`` names a whole-number column that says how often each row counts.

    Groups within the limit use the built-in exact aggregate. With heavier groups the two
    neighbouring order statistics are looked up by their position in the running counts.
    """
    sources: dict[str, list[float]] = {}
    for source, share in wanted.values():
        sources.setdefault(source, [])
        if share not in sources[source]:
            sources[source].append(share)
    group = [col(k) for k in keys]
    if heavy_groups(rows, keys, limit) is None:
        arrays = rows.groupBy(*group).agg(*[
            F.percentile(col(s), F.array(*[F.lit(float(p)) for p in shares]),
                         F.lit(1) if weight is None else col(weight)).alias(f"percentiles_{i}")
            for i, (s, shares) in enumerate(sources.items())])
        index = {s: i for i, s in enumerate(sources)}
        return arrays.select(*group, *[
            F.col(f"percentiles_{index[s]}")[sources[s].index(p)].alias(name)
            for name, (s, p) in wanted.items()])

    times = (F.lit(1) if weight is None else col(weight)).cast("bigint")
    long = rows.select(*group, times.alias("times"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("source"), col(s).cast("double").alias("value"))
        for i, s in enumerate(sources)])).alias("pair")).select(*group, "times", "pair.*")
    by = keys + ["source"]
    counted, _ = running_counts(long, by, "value", {"n": F.sum("times")}, limit)
    totals = long.where("value is not null").groupBy(*[col(k) for k in by]).agg(
        F.sum("times").alias("n_total"))
    placed = counted.join(totals, by)
    order = list(sources)
    picks = []
    for i, (name, (source, share)) in enumerate(wanted.items()):
        here = F.col("source") == order.index(source)
        place = F.lit(float(share)) * (F.col("n_total") - 1)
        for side, at in (("low", F.floor(place)), ("high", F.ceil(place))):
            holds = here & (F.col("n_before") <= at) & (at < F.col("n_before") + F.col("n"))
            picks.append(F.max(F.when(holds, F.col("value"))).alias(f"{side}_{i}"))
        picks.append(F.max(F.when(here, place - F.floor(place))).alias(f"part_{i}"))
    found = placed.groupBy(*group).agg(*picks)
    return found.select(*group, *[
        (F.col(f"low_{i}") + (F.col(f"high_{i}") - F.col(f"low_{i}")) * F.col(f"part_{i}")).alias(name)
        for i, name in enumerate(wanted)])
