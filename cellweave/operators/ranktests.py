"""Two-sample rank tests for many markers and groups at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions.labels import significance_stars, with_bonferroni
from cellweave.functions.pvalues import mann_whitney_p
from cellweave.operators.lineage import materialize
from cellweave.operators.markers import named_markers, unpivot_markers
from cellweave.operators.ordered import percentiles, running_counts
from cellweave.operators.skew import GROUP_ROWS
from cellweave.operators.triads import ROLE_FLAGS

# Fewest values per group for a test, and in-triad cells for a comparison.
FEWEST_PER_GROUP = 3
FEWEST_IN_TRIAD = 6

SUMMARY_COLUMNS = [
    "cell_type", "comparison", "marker", "marker_col", "group_A", "group_B", "n_A", "n_B",
    "mean_A", "mean_B", "median_A", "median_B", "mannwhitney_U", "p_value", "significance",
    "bonferroni_alpha", "sig_bonferroni"]


def tallied(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of one key, group and value added up to one with their number as ``times``; written once, for several readers."""
    return materialize(rows.where("value is not null").groupBy(*keys, "in_a", "value").agg(F.count(F.lit(1)).alias("times")))


def midranks(rows: DataFrame, keys: list[str], limit: int = GROUP_ROWS, weight: str | None = None) -> DataFrame:
    """Per test and distinct value: members of either group, ties, and their shared rank.

    ``rows`` holds the keys, ``value`` and a boolean ``in_a``; ``weight`` names a whole-number column that says how often
    each row counts.
    """
    times = F.lit(1).cast("bigint") if weight is None else F.col(weight)
    counted, _ = running_counts(rows, keys, "value", {
        "n_a": F.sum(F.when(F.col("in_a"), times).otherwise(0)), "ties": F.sum(times)}, limit)
    return counted.withColumn("midrank", F.col("ties_before") + (F.col("ties") + 1) / 2.0)


def mann_whitney(rows: DataFrame, keys: list[str], limit: int = GROUP_ROWS, weight: str | None = None) -> DataFrame:
    """U of both groups and z with tie and continuity correction; nulls for tiny groups."""
    ranked = midranks(rows, keys, limit, weight)
    t = F.col("ties").cast("double")
    sums = ranked.groupBy(*keys).agg(
        F.sum("n_a").alias("n_a"), F.sum(F.col("ties") - F.col("n_a")).alias("n_b"),
        F.sum(F.col("n_a") * F.col("midrank")).alias("rank_sum_a"),
        F.sum(t * t * t - t).alias("tie_sum"))
    n1, n2 = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    n = n1 + n2
    u_a = F.col("rank_sum_a") - n1 * (n1 + 1) / 2
    variance = n1 * n2 / 12 * ((n + 1) - F.try_divide(F.col("tie_sum"), n * (n - 1)))
    enough = (F.col("n_a") >= FEWEST_PER_GROUP) & (F.col("n_b") >= FEWEST_PER_GROUP)
    top = F.greatest(u_a, n1 * n2 - u_a) - n1 * n2 / 2 - 0.5
    return sums.select(
        *keys, "n_a", "n_b", "tie_sum",
        F.when(enough, u_a).alias("u_a"), F.when(enough, n1 * n2 - u_a).alias("u_b"),
        # All values equal: no spread, so no evidence either way.
        F.when(enough, F.when(variance > 0, top / F.sqrt(variance)).otherwise(0.0)).alias("z"))


def group_location(rows: DataFrame, keys: list[str], limit: int = GROUP_ROWS, weight: str | None = None) -> DataFrame:
    """n, mean and median of group A and group B per test. Without ``weight`` the rows are read once and added up first."""
    if weight is None:
        rows, weight = tallied(rows, keys), "times"
    known = rows.where("value is not null")
    by = [*keys, "in_a"]
    n = F.sum(F.col(weight))
    stats = (known.groupBy(*by).agg(n.alias("n"), (F.sum(F.col("value") * F.col(weight)) / n).alias("mean"))
             .join(percentiles(known, by, {"median": ("value", 0.5)}, limit, weight), by))

    def pick(name: str, a: bool) -> Column:
        return F.max(F.when(F.col("in_a") == F.lit(a), F.col(name)))

    return stats.groupBy(*keys).agg(
        F.coalesce(pick("n", True), F.lit(0)).alias("n_A"), F.coalesce(pick("n", False), F.lit(0)).alias("n_B"),
        pick("mean", True).alias("mean_A"), pick("mean", False).alias("mean_B"),
        pick("median", True).alias("median_A"), pick("median", False).alias("median_B"))


def role_rows(flagged: DataFrame, roles: dict[str, str], names: dict[str, str], markers: dict[str, str],
              keep: list[str] | None = None) -> DataFrame:
    """Long rows of the cells of each role's type, with whether the cell plays the role.

    ``roles`` maps role to cell type, ``names`` role to display name.
    """
    present, _ = named_markers(flagged.columns, markers)
    if not present:
        raise ValueError("none of the markers is a column of the table")
    entries = F.filter(F.array(*[
        F.when(F.col("cell_type") == roles[role],
               F.struct(F.lit(role).alias("role"), F.lit(names.get(role, roles[role])).alias("cell_type"),
                        F.col(flag).alias("in_a")))
        for role, flag in ROLE_FLAGS.items()]), lambda e: e.isNotNull())
    keep = keep or []
    cells = (flagged.withColumn("entry", F.explode(entries))
             .select(*keep, "entry.role", F.col("entry.cell_type").alias("shown_type"), "entry.in_a",
                     *[F.col("`" + c.replace("`", "``") + "`") for c in present.values()]))
    return (unpivot_markers(cells, [*keep, "role", "shown_type", "in_a"], present)
            .withColumnRenamed("shown_type", "cell_type"))


def _tested(rows: DataFrame, keys: list[str], limit: int) -> DataFrame:
    once = tallied(rows, keys)
    return group_location(once, keys, limit, "times").join(mann_whitney(once, keys, limit, "times").drop("n_a", "n_b"), keys, "left")


def _with_p(tests: DataFrame, u: str) -> DataFrame:
    p = mann_whitney_p(F.col("n_A").cast("double"), F.col("n_B").cast("double"), F.col("u_a"),
                       F.col("tie_sum"), F.col("z"))
    return (tests.withColumn("p_value", p).withColumn("mannwhitney_U", F.col(u))
            .withColumn("significance", significance_stars(F.col("p_value"))))


def in_versus_out(rows: DataFrame, limit: int = GROUP_ROWS) -> DataFrame:
    """In-triad against other cells of each role's type, all conditions pooled.

    U is the one of the cells outside, as the statistic is taken out first, in second;
    ``u_a`` is that of the cells inside.
    """
    keys = ["role", "cell_type", "marker"]
    return _tested(rows, keys, limit).select(
        "cell_type", "role", F.lit("in_triad_vs_out").alias("comparison"), "marker",
        F.lit("in_triad").alias("group_A"), F.lit("not_in_triad").alias("group_B"),
        "n_A", "n_B", "mean_A", "mean_B", "median_A", "median_B",
        "u_a", "u_b", "z", "tie_sum")


def compared_conditions(in_triad: DataFrame, conditions: list[str]) -> DataFrame:
    """Per role the first two conditions, in their given order, with enough in-triad cells.

    ``in_triad`` has one row per cell: role, cell_type, condition.
    """
    sizes = in_triad.groupBy("role", "cell_type", "condition").agg(F.count(F.lit(1)).alias("n"))
    places = F.array(*[F.lit(c) for c in conditions])
    place = F.array_position(places, F.col("condition"))
    valid = F.array_sort(F.collect_list(F.when(
        (place > 0) & (F.col("n") >= FEWEST_PER_GROUP), place)))
    return (sizes.groupBy("role", "cell_type").agg(F.sum("n").alias("n_in"), valid.alias("valid"))
            .where((F.col("n_in") >= FEWEST_IN_TRIAD) & (F.size("valid") >= 2))
            .select("role", "cell_type", places[(F.col("valid")[0] - 1).cast("int")].alias("group_A"),
                    places[(F.col("valid")[1] - 1).cast("int")].alias("group_B")))


def between_conditions(rows: DataFrame, conditions: list[str], limit: int = GROUP_ROWS) -> DataFrame:
    """In-triad cells of the first against the second valid condition, per role and marker.

    ``rows`` as from role_rows with ``condition`` kept.
    """
    if len(conditions) < 2:
        conditions = [*conditions, *([""] * (2 - len(conditions)))]
    inside = rows.where("in_a")
    one_marker = inside.groupBy("role").agg(F.min("marker").alias("marker"))
    cells = inside.join(F.broadcast(one_marker), ["role", "marker"]).select("role", "cell_type", "condition")
    # At most one row per role.
    pairs = F.broadcast(compared_conditions(cells, conditions))
    keys = ["role", "cell_type", "marker", "group_A", "group_B"]
    chosen = (inside.join(pairs, ["role", "cell_type"])
              .where(F.col("condition").isin(*conditions)
                     & ((F.col("condition") == F.col("group_A")) | (F.col("condition") == F.col("group_B"))))
              .withColumn("in_a", F.col("condition") == F.col("group_A")))
    return _tested(chosen, keys, limit).select(
        "cell_type", "role", F.concat("group_A", F.lit("_vs_"), "group_B", F.lit("_in_triad")).alias("comparison"),
        "marker", "group_A", "group_B", "n_A", "n_B", "mean_A", "mean_B", "median_A", "median_B",
        "u_a", "u_b", "z", "tie_sum")


def functional_summary(flagged: DataFrame, roles: dict[str, str], names: dict[str, str],
                       markers: dict[str, str], conditions: list[str], limit: int = GROUP_ROWS) -> DataFrame:
    """Both kinds of test with p, stars and the Bonferroni verdict: 17 columns."""
    present, _ = named_markers(flagged.columns, markers)
    rows = role_rows(flagged, roles, names, markers, ["condition"])
    inside = _with_p(in_versus_out(rows, limit), "u_b")
    compared = _with_p(between_conditions(rows, conditions, limit), "u_a")
    names_to_columns = reduce(lambda e, nc: e.when(F.col("marker") == nc[0], F.lit(nc[1])),
                              list(present.items())[1:],
                              F.when(F.col("marker") == next(iter(present)), F.lit(next(iter(present.values())))))
    tests = inside.unionByName(compared).withColumn("marker_col", names_to_columns)
    return with_bonferroni(tests).select(*SUMMARY_COLUMNS)
