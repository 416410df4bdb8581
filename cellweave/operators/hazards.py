"""Proportional hazards (Cox) regression with Efron's treatment of ties, by Newton steps.

One step is one aggregation: rows of one time are added up first, risk sets are running sums from the latest time down, over
value ranges where an outcome is heavy, and what each event adds to the gradient and the curvature is summed. The driver holds
as many numbers as there are covariates and pairs of them. Running sums start at the latest time, so that small risk sets are
not differences of large numbers.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions.pvalues import normal_two_sided
from cellweave.operators.lineage import materialize
from cellweave.operators.ordered import running, value_ranges
from cellweave.operators.skew import GROUP_ROWS

TOLERANCE, MOST_STEPS = 1e-10, 50


@dataclass
class _Fit:
    """One outcome: where it stands, and its last accepted step."""

    beta: np.ndarray
    step: np.ndarray
    loglik: float = -np.inf
    information: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    converged: bool = False
    failed: bool = False
    steps: int = 0


def _risk(rows: DataFrame, n: int, betas: dict[str, np.ndarray], ranged: bool) -> DataFrame:
    """Per outcome and time: sums of weights and moments over the risk set and over the tied events."""
    def score(k: int) -> Column:
        return reduce(lambda rest, item: F.when(F.col("outcome") == item[0], F.lit(float(item[1][k]))).otherwise(rest), betas.items(), F.lit(0.0))

    line = reduce(lambda a, b: a + b, [F.col(f"x_{k}") * score(k) for k in range(n)])
    weighted = rows.withColumn("line", line).withColumn("w", F.exp("line"))
    moments = {"s": F.col("w")} | {f"s_{i}": F.col("w") * F.col(f"x_{i}") for i in range(n)} | {
        f"s_{i}_{j}": F.col("w") * F.col(f"x_{i}") * F.col(f"x_{j}") for i in range(n) for j in range(i + 1)}
    dead = F.col("event") == 1
    parts = ["value_range"] if ranged else []
    tied = weighted.groupBy("outcome", "late", *parts).agg(
        *[F.sum(m).alias(name) for name, m in moments.items()],
        *[F.coalesce(F.sum(F.when(dead, m)), F.lit(0.0)).alias("d" + name) for name, m in moments.items()],
        F.count_if(dead).alias("d"), F.coalesce(F.sum(F.when(dead, F.col("line"))), F.lit(0.0)).alias("dline"),
        *[F.coalesce(F.sum(F.when(dead, F.col(f"x_{i}"))), F.lit(0.0)).alias(f"dx_{i}") for i in range(n)])
    return running(materialize(tied) if ranged else tied, ["outcome"], "late", {f"r{name}": name for name in moments}, ranged, inclusive=True)


def _sums(rows: DataFrame, n: int, betas: dict[str, np.ndarray], ranged: bool) -> dict[str, tuple]:
    """Per outcome: partial log-likelihood, gradient and information at the given coefficients."""
    at = _risk(rows, n, betas, ranged).where("d > 0")
    # Efron: of d tied events, the l-th sees the risk set less l/d of the tied ones.
    each = at.withColumn("l", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("d") - 1))).withColumn("f", F.col("l") / F.col("d"))
    less = lambda name: F.col(f"r{name}") - F.col("f") * F.col(f"d{name}")
    mean = lambda i: less(f"s_{i}") / less("s")
    first = F.col("l") == 0
    found = each.groupBy("outcome").agg(
        (F.sum(F.when(first, F.col("dline")).otherwise(0.0)) - F.sum(F.log(less("s")))).alias("loglik"),
        *[(F.sum(F.when(first, F.col(f"dx_{i}")).otherwise(0.0)) - F.sum(mean(i))).alias(f"g_{i}") for i in range(n)],
        *[F.sum(less(f"s_{i}_{j}") / less("s") - mean(i) * mean(j)).alias(f"h_{i}_{j}") for i in range(n) for j in range(i + 1)])
    out = {}
    for r in found.collect():  # one row per outcome
        h = np.array([[r[f"h_{max(i, j)}_{min(i, j)}"] for j in range(n)] for i in range(n)])
        out[r["outcome"]] = r["loglik"], np.array([r[f"g_{i}"] for i in range(n)]), h
    return out


def cox(rows: DataFrame, covariates: list[str], limit: int = GROUP_ROWS) -> DataFrame:
    """``outcome, covariate, coef, hazard_ratio, se, z, p, lower, upper, n, n_events, loglik, converged`` per outcome and covariate.

    ``rows`` have ``outcome``, ``duration``, ``event`` (0 or 1) and the covariates as numbers; rows with a null or NaN in one of
    these are left out. An outcome without events has no row. Coefficients that the data do not determine (a constant or
    repeated covariate) come from the least-norm step; where a step finds no better likelihood ``converged`` is false.
    """
    n = len(covariates)
    if not n:
        raise ValueError("name at least one covariate")
    plain = rows.select("outcome", F.col("duration").cast("double").alias("duration"), F.col("event").cast("int").alias("event"),
                        *[F.col(f"`{c}`").cast("double").alias(f"x_{i}") for i, c in enumerate(covariates)])
    numbers = ["duration", *[f"x_{i}" for i in range(n)]]
    plain = materialize(plain.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) for c in numbers], F.col("event").isNotNull() & F.col("outcome").isNotNull())))
    facts = {r["outcome"]: r for r in plain.groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event").alias("n_events"), *[F.avg(f"x_{i}").alias(f"m_{i}") for i in range(n)]).where("n_events > 0").collect()}
    # Centred covariates: the coefficients are the same and the weights stay near 1.
    center = lambda i: reduce(lambda rest, r: F.when(F.col("outcome") == r["outcome"], F.lit(r[f"m_{i}"])).otherwise(rest), facts.values(), F.lit(0.0))
    centred = plain.where(F.col("outcome").isin(*facts)).select("outcome", (-F.col("duration")).alias("late"), "event", *[(F.col(f"x_{i}") - center(i)).alias(f"x_{i}") for i in range(n)])
    times, ranged = value_ranges(materialize(centred.select("outcome", "late").distinct()), ["outcome"], "late", limit)
    ready = materialize(centred.join(times, ["outcome", "late"]) if ranged else centred)
    fits = {o: _Fit(np.zeros(n), np.zeros(n)) for o in facts}
    while open_ := {o: f for o, f in fits.items() if not (f.converged or f.failed)}:
        found = _sums(ready.where(F.col("outcome").isin(*open_)), n, {o: f.beta + f.step for o, f in open_.items()}, ranged)
        for o, f in open_.items():
            loglik, gradient, information = found[o]
            f.steps += 1
            if np.isfinite(loglik) and loglik >= f.loglik - 1e-9 * (1 + abs(loglik)):
                f.beta, f.information = f.beta + f.step, information
                f.step = np.linalg.lstsq(information, gradient, rcond=1e-12)[0]
                f.converged = bool(np.abs(f.step).max() < TOLERANCE * (1 + np.abs(f.beta).max()))
                f.loglik = loglik
            else:
                f.step = f.step / 2
            f.failed = not f.converged and f.steps >= MOST_STEPS
    out = []
    for o, f in fits.items():
        spread = np.sqrt(np.maximum(np.diag(np.linalg.pinv(f.information)), 0))
        out += [(o, c, float(f.beta[i]), float(np.exp(f.beta[i])), float(spread[i]), float(f.beta[i] / spread[i]) if spread[i] > 0 else None,
                 float(np.exp(f.beta[i] - 1.96 * spread[i])), float(np.exp(f.beta[i] + 1.96 * spread[i])), facts[o]["n"], int(facts[o]["n_events"]),
                 float(f.loglik), f.converged) for i, c in enumerate(covariates)]
    found = rows.sparkSession.createDataFrame(out, "outcome string, covariate string, coef double, hazard_ratio double, se double, z double, "
                                                   "lower double, upper double, n bigint, n_events bigint, loglik double, converged boolean")
    return found.withColumn("p", F.when(F.col("z").isNotNull(), normal_two_sided(F.abs("z"))))
