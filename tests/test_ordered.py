import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.operators.ordered import percentiles, running, running_counts
from cellweave.operators.skew import heavy_groups, join_group_stats


def skewed(n=3000):
    rng = random.Random(2)
    return [("hot" if rng.random() < 0.8 else rng.choice("abc"), float(rng.choice([rng.randrange(7), rng.gauss(0, 50)])))
            for _ in range(n)]


@pytest.mark.parametrize("limit", [10**6, 50])
def test_percentiles_are_exact(spark, limit):
    rows = skewed()
    df = spark.createDataFrame(rows, "k string, v double")
    wanted = {"p01": ("v", 0.01), "p33": ("v", 0.33), "mid": ("v", 0.5), "top": ("v", 1.0)}
    got = {r.k: r for r in percentiles(df, ["k"], wanted, limit).collect()}
    for k in {r[0] for r in rows}:
        values = [v for kk, v in rows if kk == k]
        for name, (_, p) in wanted.items():
            assert got[k][name] == pytest.approx(np.percentile(values, p * 100), abs=1e-9)


@pytest.mark.parametrize("limit", [10**6, 50])
def test_running_counts_are_exact(spark, limit):
    rows = skewed()
    df = spark.createDataFrame(rows, "k string, v double")
    out, ranged = running_counts(df, ["k"], "v", {"n": F.count(F.lit(1))}, limit)
    assert ranged == (limit == 50)
    for r in out.where("k = 'hot'").collect():
        assert r.n_before == sum(k == "hot" and v < r.v for k, v in rows)
        assert r.n == sum(k == "hot" and v == r.v for k, v in rows)


def test_running_product_over_ranges(spark):
    rows = [("k", float(i), i // 3, 0.5) for i in range(9)]
    df = spark.createDataFrame(rows, "k string, v double, value_range int, s double")
    out = running(df, ["k"], "v", {"p": "s"}, True, product=True, inclusive=True).orderBy("v").collect()
    assert [r.p for r in out] == [0.5 ** (i + 1) for i in range(9)]


def test_heavy_groups_and_small_tables(spark):
    df = spark.range(100).select((F.col("id") % 3 == 0).alias("k"))
    heavy = heavy_groups(df, ["k"], 40)
    assert heavy.bounded and heavy.largest == 66 and [r.k for r in heavy.table.collect()] == [False]
    assert heavy_groups(df, ["k"], 70) is None
    stats = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert join_group_stats(df, stats, ["k"]).where("n is null").count() == 0
