"""Survival curves and log-rank tests, as running counts over event times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.functions.labels import event_flag, significance_stars
from cellweave.functions.pvalues import chi_square_one
from cellweave.operators.ordered import running, running_counts
from cellweave.operators.skew import GROUP_ROWS

# Fixed value: normal quantile of a 95 % band.
BAND_Z = 1.96


def survival_rows(patients: DataFrame, outcomes: dict[str, tuple[str, str]], group: str,
                  censor_is_one: bool = True) -> DataFrame:
    """Long rows (outcome, grp, duration, event); rows with a missing part are dropped.

    ``outcomes`` is {name: (duration column, censor column)}.
    """
    present = {n: dc for n, dc in outcomes.items() if set(dc) <= set(patients.columns)}
    entries = F.explode(F.array(*[
        F.struct(F.lit(name).alias("outcome"), F.col(d).cast("double").alias("duration"),
                 event_flag(F.col(c), censor_is_one).alias("event"))
        for name, (d, c) in present.items()]))
    return (patients.select(F.col(group).cast("string").alias("grp"), entries.alias("e"))
            .select("e.outcome", "grp", "e.duration", "e.event")
            .where("duration is not null and event is not null and grp is not null"))


def group_counts(rows: DataFrame) -> DataFrame:
    """Patients and events per outcome and group."""
    return rows.groupBy("outcome", "grp").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event").cast("bigint").alias("n_events"))


def comparable(rows: DataFrame) -> DataFrame:
    """Rows of the outcomes that have at least two groups."""
    groups = rows.groupBy("outcome").agg(F.count_distinct("grp").alias("n_groups")).where("n_groups >= 2")
    return rows.join(groups.select("outcome"), "outcome", "left_semi")


def kaplan_meier(rows: DataFrame, limit: int = GROUP_ROWS) -> DataFrame:
    """Survival at time 0 and every later time per outcome and group, with a 95 % band."""
    rows = comparable(rows)
    by = ["outcome", "grp"]
    weighted = rows.select(*by, "duration", "event", F.lit(1).alias("w"))
    start = rows.select(*by).distinct().select(
        *by, F.lit(0.0).alias("duration"), F.lit(0).alias("event"), F.lit(0).alias("w"))
    counted, ranged = running_counts(weighted.unionByName(start), by, "duration", {
        "n_events": F.sum("event").cast("bigint"), "leaving": F.sum("w").cast("bigint")}, limit)
    sizes = group_counts(rows).withColumnRenamed("n", "n_group").drop("n_events")
    n, d = F.col("at_risk"), F.col("n_events")
    steps = (counted.join(sizes, by)
             .withColumn("at_risk", F.col("n_group") - F.col("leaving_before"))
             .withColumn("stays", 1.0 - F.coalesce(F.try_divide(d, n), F.lit(0.0)))
             .withColumn("spread", F.coalesce(F.try_divide(d.cast("double"), n.cast("double") * (n - d)), F.lit(0.0))))
    curve = running(steps, by, "duration", {"survival": "stays"}, ranged, product=True, inclusive=True)
    curve = running(curve, by, "duration", {"variance": "spread"}, ranged, inclusive=True)
    inner = (F.col("survival") > 0) & (F.col("survival") < 1)
    log_s = F.log(F.when(inner, F.col("survival")))
    wide = F.lit(BAND_Z) * F.sqrt(F.col("variance")) / F.abs(log_s)

    def edge(sign: int):
        return F.coalesce(F.pow(F.col("survival"), F.exp(sign * wide)), F.col("survival"))

    return curve.select(*by, F.col("duration").alias("time"), "at_risk", "n_events", "survival",
                        edge(1).alias("lower"), edge(-1).alias("upper"))


def log_rank(rows: DataFrame, limit: int = GROUP_ROWS) -> DataFrame:
    """Observed and expected events of the first group and chi-square, per outcome of two groups."""
    pairs = (rows.groupBy("outcome").agg(
        F.count_distinct("grp").alias("n_groups"), F.min("grp").alias("group_1"), F.max("grp").alias("group_2"))
        .where("n_groups = 2").drop("n_groups"))
    marked = (rows.join(pairs, "outcome")
              .withColumn("first", F.col("grp") == F.col("group_1")))
    by = ["outcome"]
    counted, _ = running_counts(marked, by, "duration", {
        "d": F.sum("event").cast("bigint"), "c": F.count(F.lit(1)),
        "d1": F.sum(F.when(F.col("first"), F.col("event")).otherwise(0)).cast("bigint"),
        "c1": F.count_if(F.col("first"))}, limit)
    sizes = marked.groupBy("outcome", "group_1", "group_2").agg(
        F.count_if(F.col("first")).alias("n_1"), F.count_if(~F.col("first")).alias("n_2"))
    n = (F.col("n_1") + F.col("n_2") - F.col("c_before")).cast("double")
    n1 = (F.col("n_1") - F.col("c1_before")).cast("double")
    d = F.col("d").cast("double")
    at_times = (counted.where("d > 0").join(sizes, by)
                .withColumn("expected", n1 * d / n)
                .withColumn("variance", F.coalesce(
                    F.try_divide(n1 * (n - n1) * d * (n - d), n * n * (n - 1)), F.lit(0.0))))
    return (at_times.groupBy("outcome", "group_1", "group_2", "n_1", "n_2")
            .agg(F.sum("d1").alias("observed_1"), F.sum("expected").alias("expected_1"),
                 F.sum("variance").alias("variance"))
            .withColumn("chi2", F.try_divide(F.pow(F.col("observed_1") - F.col("expected_1"), 2), F.col("variance"))))


def log_rank_results(rows: DataFrame, split_by: str, threshold: float | None, limit: int = GROUP_ROWS) -> DataFrame:
    """One result row per outcome: p, stars and group sizes."""
    tests = log_rank(rows, limit).withColumn("logrank_p", chi_square_one(F.col("chi2")))
    return tests.select(
        "outcome", F.lit(split_by).alias("split_by"), F.lit(threshold).cast("double").alias("threshold"),
        "chi2", "logrank_p", significance_stars(F.col("logrank_p")).alias("significance"),
        "group_1", "group_2", "n_1", "n_2")
