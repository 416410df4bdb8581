import math
import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from cellweave.functions import pvalues
from cellweave.operators import mixture, qc, ranktests as rt, survival as sv


def kneedle(x, y):
    """The published rule, step by step, for a convex decreasing curve."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    xn, yn = (x - x.min()) / np.ptp(x), (y.max() - y) / np.ptp(y)
    d = yn - xn
    threshold, top = None, None
    for i in range(len(d) - 1):
        left, right = d[max(i - 1, 0)], d[i + 1]
        if d[i] >= left and d[i] >= right:
            threshold, top = d[i] - np.diff(xn).mean(), i
        if d[i] <= left and d[i] <= right:
            threshold = 0.0
        if top is not None and d[i + 1] < threshold:
            return x[top]
    return None


@pytest.mark.parametrize("seed", range(4))
def test_knee_follows_the_published_rule(spark, seed):
    rng = random.Random(seed)
    n = [max(0, int(1000 * math.exp(-i / (2 + seed * 3)) + rng.gauss(0, 15))) for i in range(50)]
    df = spark.createDataFrame([("g", i, c, i + 0.5) for i, c in enumerate(n)], "k string, bin bigint, n bigint, center double")
    assert qc.knee(df, ["k"]).first().knee == kneedle([i + 0.5 for i in range(50)], n)


def test_knee_does_not_hang_on_rounded_places(spark):
    # Bin 6 is as high as the top, bin 5: it lies on the threshold and not under it, wherever the values lie.
    n = [37, 34, 20, 14, 11, 10, 10, 3, 1, 3] + [0] * 40
    rows = [(f"g{k}", i, c, -4.1 + 0.37 * k + (i + 0.5) * (0.0973 + 0.0111 * k)) for k in range(40) for i, c in enumerate(n)]
    center = {(r[0], r[1]): r[3] for r in rows}
    df = spark.createDataFrame(rows, "k string, bin bigint, n bigint, center double")
    assert {r.k: r.knee for r in qc.knee(df, ["k"]).collect()} == {f"g{k}": center[f"g{k}", 8] for k in range(40)}


def test_histogram_matches_numpy(spark):
    values = [random.Random(4).gauss(0, 3) for _ in range(400)]
    df = spark.createDataFrame([("a", v) for v in values] + [("flat", 2.0)] * 3, "k string, v double")
    out = qc.histogram(df, ["k"], "v")
    assert [r.n for r in out.where("k = 'a'").orderBy("bin").collect()] == np.histogram(values, 50)[0].tolist()
    flat, edges = np.histogram([2.0] * 3, 50)
    got = out.where("k = 'flat'").orderBy("bin").collect()
    assert [r.n for r in got] == flat.tolist() and got[0].bin_low == edges[0] and got[-1].bin_high == edges[-1]


def test_qc_classes_follow_their_order(spark):
    rows = [("i", f"c{k}", float(a), float(d)) for k, (a, d) in enumerate([(1, 1), (1, 9), (9, 1), (9, 9), (9, 9), (5, 9)])]
    raw = spark.createDataFrame(rows, "image_id string, cell_id string, area double, dapi double")
    thr = spark.createDataFrame([("i", 5.0, 5.0)], "image_id string, area_threshold double, dapi_threshold double")
    kept = qc.qc_filter(raw, thr).where("cell_id = 'c3'")
    got = {r.cell_id: r.classification for r in qc.classify(raw, kept, thr).collect()}
    # A cell equal to a threshold is removed, and called noise.
    assert got == {"c0": qc.SMALL_LOW, "c1": qc.SMALL, "c2": qc.LOW, "c3": qc.INCLUDED, "c4": qc.NOISE, "c5": qc.NOISE}


def test_zscore_of_constant_marker_is_null(spark):
    df = spark.createDataFrame([("i", 1.0, 5.0), ("i", 3.0, 5.0)], "image_id string, m double, flat double")
    assert [tuple(r) for r in qc.zscore(df, ["m", "flat"]).orderBy("m").collect()] == [("i", -1.0, None), ("i", 1.0, None)]


def test_mixture_agrees_with_the_library(spark):
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.normal(1.0, 0.3, 3000), rng.normal(6.0, 1.0, 2000)])
    df = spark.createDataFrame([("m", float(v)) for v in values], "marker string, value double")
    low, high = mixture.fit_mixtures(df)["m"]
    rows = VectorAssembler(inputCols=["value"], outputCol="features").transform(df)
    model = GaussianMixture(k=2, seed=1, maxIter=100, tol=1e-4).fit(rows)
    want = sorted((g.mean[0], g.cov.toArray()[0][0]) for g in model.gaussians)
    for got, (mean, var) in zip((low, high), want):
        assert got.mean == pytest.approx(mean, abs=0.02) and got.variance == pytest.approx(var, rel=0.05)
    three = mixture.fit_mixtures(df, n_components=3)["m"]
    assert len(three) == 3 and sum(c.weight for c in three) == pytest.approx(1.0)


def test_few_values_fall_back_to_the_percentile(spark):
    values = [float(v) for v in range(9)] + [float("nan"), float("inf")]
    df = spark.createDataFrame([("m", v) for v in values], "marker string, value double")
    row = mixture.thresholds_from_long(df, {}).first()
    assert row.method == "percentile" and row.threshold == pytest.approx(np.percentile(range(9), 95))


def test_sample_is_stable_and_capped(spark):
    df = spark.range(5000).select(F.lit("m").alias("marker"), "id", F.rand(1).alias("value"))
    a, b = ({r.id for r in mixture.sample_cells(df.repartition(n), ["id"], 700).collect()} for n in (3, 7))
    assert len(a) == 700 and a == b


def exact_p(x, y):
    """Two-sided exact p by listing every way to choose the first sample."""
    pooled, n1 = sorted(x + y), len(x)
    rank = {v: i + 1 for i, v in enumerate(pooled)}

    def u(sample):
        return sum(rank[v] for v in sample) - n1 * (n1 + 1) / 2
    top = max(u(x), n1 * len(y) - u(x))
    ways = [u(c) for c in combinations(pooled, n1)]
    return min(1.0, 2 * sum(w >= top for w in ways) / len(ways))


def test_mann_whitney_and_p_values(spark):
    x, y = [1.5, 2.0, 9.0, 10.0], [0.5, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0]
    tied = [1.0, 1.0, 2.0, 3.0], [1.0, 2.0, 2.0, 5.0, 6.0]
    rows = [("exact", v, True) for v in x] + [("exact", v, False) for v in y]
    rows += [("tied", v, True) for v in tied[0]] + [("tied", v, False) for v in tied[1]]
    rows += [("tiny", 1.0, True), ("tiny", 2.0, False), ("tiny", 3.0, False)]
    rows += [("same", 4.0, i < 5) for i in range(10)]
    df = spark.createDataFrame(rows, "k string, value double, in_a boolean")
    out = rt.mann_whitney(df, ["k"])
    p = pvalues.mann_whitney_p(F.col("n_a").cast("double"), F.col("n_b").cast("double"), F.col("u_a"), F.col("tie_sum"), F.col("z"))
    got = {r.k: r for r in out.withColumn("p", p).collect()}
    for k, (a, b) in {"exact": (x, y), "tied": tied}.items():
        u = sum((v > w) + 0.5 * (v == w) for v in a for w in b)
        assert got[k].u_a == u and got[k].u_a + got[k].u_b == len(a) * len(b)
    assert got["exact"].p == pytest.approx(exact_p(x, y), abs=1e-12)
    assert got["tiny"].u_a is None and got["tiny"].p is None
    assert got["same"].p == 1.0
    z = got["tied"].z
    assert got["tied"].p == pytest.approx(min(1.0, math.erfc(z / math.sqrt(2))))
    # Limited and unlimited groups agree.
    again = {r.k: r for r in rt.mann_whitney(df, ["k"], limit=3).collect()}
    assert all(again[k].u_a == got[k].u_a and again[k].z == got[k].z for k in got)


def test_large_partner_sample_stays_close(spark):
    from cellweave.functions.pvalues import rank_sum_tail
    # One exact count at every size: every step of the large sample changes it a little, and by a little.
    tails = [rank_sum_tail(4, n, 4 * n * 0.9) for n in range(49_990, 50_010)]
    assert all(abs(a - b) < 1e-3 * a for a, b in zip(tails, tails[1:]))
    from itertools import combinations
    for small, large in ((1, 6), (3, 5), (4, 4), (5, 6)):
        sums = [sum(c) - small * (small + 1) / 2 for c in combinations(range(1, small + large + 1), small)]
        for u in range(small * large + 1):
            assert rank_sum_tail(small, large, u) == pytest.approx(sum(s >= u for s in sums) / len(sums))


@pytest.mark.parametrize("limit", [10**6, 20])
def test_survival_matches_hand_counts(spark, limit):
    rng = random.Random(9)
    rows = [("o", rng.choice("ab"), float(rng.randrange(1, 15)), int(rng.random() < 0.6)) for _ in range(80)]
    df = spark.createDataFrame(rows, "outcome string, grp string, duration double, event int")
    for g in "ab":
        curve = sv.kaplan_meier(df, limit).where(F.col("grp") == g).orderBy("time").collect()
        s = 1.0
        assert curve[0].time == 0 and curve[0].survival == 1.0
        for r in curve[1:]:
            n = sum(x[1] == g and x[2] >= r.time for x in rows)
            d = sum(x[1] == g and x[2] == r.time and x[3] for x in rows)
            s *= 1 - d / n
            assert (r.at_risk, r.n_events) == (n, d) and r.survival == pytest.approx(s)
            assert 0 <= r.lower <= r.survival <= r.upper <= 1
    o = e = v = 0.0
    for t in sorted({x[2] for x in rows if x[3]}):
        n, n1 = sum(x[2] >= t for x in rows), sum(x[2] >= t and x[1] == "a" for x in rows)
        d, d1 = sum(x[2] == t and x[3] for x in rows), sum(x[2] == t and x[3] and x[1] == "a" for x in rows)
        o, e = o + d1, e + n1 * d / n
        v += n1 * (n - n1) * d * (n - d) / (n * n * (n - 1)) if n > 1 else 0
    row = sv.log_rank_results(df, "median", 1.0, limit).first()
    assert row.chi2 == pytest.approx((o - e) ** 2 / v)
    assert row.logrank_p == pytest.approx(math.erfc(math.sqrt(row.chi2 / 2)))


def test_one_group_has_no_curve(spark):
    df = spark.createDataFrame([("o", "a", 1.0, 1)], "outcome string, grp string, duration double, event int")
    assert sv.kaplan_meier(df).count() == 0 and sv.log_rank(df).count() == 0


def test_both_groups_are_read_once(spark):
    rng = np.random.default_rng(4)
    rows = [("r", "t", "m", bool(rng.random() < 0.4), float(v)) for v in rng.integers(0, 6, 500)] + [("r", "t", "m", True, None), ("r", "t", "m", False, 2.5)]
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch
    df = spark.createDataFrame(rows, "role string, cell_type string, marker string, in_a boolean, value double").repartition(3)
    got = rt.in_versus_out(df.mapInPandas(seen, df.schema), limit=2).first()
    a, b = (np.array([v for *_, g, v in rows if g == side and v is not None]) for side in (True, False))
    u = sum((x > y) + (x == y) / 2 for x in a for y in b)
    assert (got.n_A, got.n_B, got.u_a, got.u_b) == (len(a), len(b), u, len(a) * len(b) - u)
    assert (got.mean_A, got.median_A, got.median_B) == (pytest.approx(a.mean()), np.median(a), np.median(b))
    assert reads.value == len(rows)
