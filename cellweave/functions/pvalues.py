"""p-values of finished tests, computed on result tables with one row per test.

All ranking and summing happens before; these functions only turn a few numbers per test
into a probability. Spark has no error function, so its complement is written as a sum and a
continued fraction. The rank-sum distribution of small samples is counted in whole numbers.
"""

from __future__ import annotations

import math
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: with no ties, a sample this small gets the exact distribution.
EXACT_UP_TO = 8

# Where the sum hands over to the fraction, and how deep either goes for 12 digits there.
SERIES_BELOW, SERIES_TERMS, FRACTION_TERMS = 2.5, 60, 60


def erfc(x: Column) -> Column:
    """Complement of the error function of a number that is not negative."""
    series = F.lit(1.0)
    for n in range(SERIES_TERMS, 0, -1):
        series = F.lit(1.0) + F.lit(2.0 / (2 * n + 1)) * x * x * series
    fraction = x
    for n in range(FRACTION_TERMS, 0, -1):
        fraction = x + F.lit(n / 2.0) / fraction
    bell = F.exp(-x * x) / F.lit(math.sqrt(math.pi))
    return F.when(x < SERIES_BELOW, F.lit(1.0) - F.lit(2.0) * bell * x * series).otherwise(bell / fraction)


def normal_two_sided(z: Column) -> Column:
    """Two-sided normal tail of z, 1 where z is below 0."""
    return erfc(F.greatest(z, F.lit(0.0)) / F.lit(math.sqrt(2.0)))


def chi_square_one(chi2: Column) -> Column:
    """Upper tail of chi-square with one degree of freedom."""
    return erfc(F.sqrt(F.greatest(chi2, F.lit(0.0)) / F.lit(2.0)))


@cache
def _numerator(parts: int) -> tuple[int, list[int]]:
    """The sums up to t of partitions into parts 1..``parts`` as N(q) / (1 - q^L)^(parts + 1): L and N."""
    period = math.lcm(*range(1, parts + 1))
    poly = [1]
    for step in (1, *range(1, parts + 1)):
        out = [0] * (len(poly) + period - step)
        for shift in range(0, period, step):
            for k, c in enumerate(poly):
                out[k + shift] += c
        poly = out
    return period, poly


def _partitions_up_to(parts: int, t: int) -> int:
    """Partitions of all whole numbers up to t into parts of 1..``parts``."""
    if t < 0:
        return 0
    period, poly = _numerator(parts)
    return sum(poly[k] * math.comb((t - k) // period + parts, parts) for k in range(t % period, min(t, len(poly) - 1) + 1, period))


def rank_sum_tail(small: int, large: int, u: float) -> float:
    """P(U >= u) under no difference, for sample sizes small <= large and no ties; exact at every size.

    The upper tail equals the lower one. Ways to reach a sum are partitions into at most ``small``
    parts of at most ``large``: the unlimited ones, less those with a part too many, and so on.
    """
    top = math.floor(small * large - u)
    reached = {0: 1}
    for i in range(1, small + 1):
        for s, c in list(reached.items()):
            if s + large + i <= top:
                reached[s + large + i] = reached.get(s + large + i, 0) - c
    ways = sum(sign * _partitions_up_to(small, top - s) for s, sign in reached.items())
    return ways / math.comb(small + large, small)


@F.pandas_udf(T.DoubleType())
def exact_rank_sum_p(n1: pd.Series, n2: pd.Series, u1: pd.Series) -> pd.Series:
    """Two-sided exact p of tests whose smaller sample has at most ``EXACT_UP_TO`` members; null for others."""
    def one(n1, n2, u1):
        if pd.isna(u1) or min(n1, n2) > EXACT_UP_TO:
            return None
        return min(1.0, 2.0 * rank_sum_tail(int(min(n1, n2)), int(max(n1, n2)), max(u1, n1 * n2 - u1)))
    return pd.Series([one(*row) for row in zip(n1, n2, u1)], dtype="float64")


def mann_whitney_p(n1: Column, n2: Column, u1: Column, tie_sum: Column, z: Column) -> Column:
    """Two-sided p: exact for a small sample without ties, else from z."""
    exact = (F.least(n1, n2) <= EXACT_UP_TO) & (tie_sum == 0)
    return F.when(u1.isNotNull() & z.isNotNull(), F.when(exact, exact_rank_sum_p(n1, n2, u1)).otherwise(normal_two_sided(z)))
