"""Enrichment, dense structures, hazards, and unknown values before principal components, against plain versions."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellweave.operators import embedding, enrichment, hazards, structures
from cellweave.streaming import arrivals


def cells_of(seed, n=400, images=5, spread=100):
    rng = random.Random(seed)
    rows = [(f"i{0 if rng.random() < 0.35 else rng.randrange(images)}", f"c{k}", rng.randrange(spread), rng.randrange(spread), rng.choice("ABBC")) for k in range(n)]
    return [(*r[:1], "x" if r[0] < "i2" else "y", *r[1:]) for r in rows]


def frame(spark, rows):
    return spark.createDataFrame(rows, "image_id string, condition string, cell_id string, x int, y int, cell_type string")


@pytest.mark.parametrize("size", [1, 2, 3, 5, 16, 17, 1000])
def test_permutations(size):
    number, sizes = np.arange(size), np.full(size, size)
    seen = set()
    for key in range(40):
        out = enrichment.permuted(number, sizes, np.full(size, key, dtype=np.uint64))
        assert sorted(out) == list(number)
        seen.add(tuple(out))
    assert len(seen) >= min(math.factorial(min(size, 6)), 30) * 0.5
    if size == 1000:  # each number goes everywhere
        places = np.array([enrichment.permuted(number[:1], sizes[:1], np.full(1, k * 7919, dtype=np.uint64))[0] for k in range(3000)])
        assert abs(places.mean() - 499.5) < 25 and abs(places.std() - 288.7) < 15


def test_enrichment_equals_brute_force(spark):
    rows = cells_of(1) + [("i0", "x", "c900", 5, 5, None), (None, "x", "c901", 5, 5, "A"), ("lone", "y", "c902", 0, 0, "A")]
    turns, radius = 25, 12
    numbered = enrichment.numbered(frame(spark, rows))
    kinds = ["A", "B", "C"]
    codes = {(r.image_id, r.cell_id): np.frombuffer(r.codes, dtype=np.uint16) for r in enrichment.shuffled(numbered, kinds, turns, 1).collect()}
    known = [r for r in rows if r[0] and r[5]]
    # Every shuffle keeps an image's types, and its numbers are dense and by type.
    for image in {r[0] for r in known}:
        mine = [r for r in known if r[0] == image]
        for p in range(turns + 1):
            assert Counter(kinds[codes[image, r[2]][p]] for r in mine) == Counter(r[5] for r in mine)
    assert all(kinds[codes[r[0], r[2]][0]] == r[5] for r in known)
    assert len({tuple(c) for c in codes.values()}) > 200
    count = defaultdict(lambda: np.zeros(turns + 1, dtype=int))
    for a in known:
        for b in known:
            if a[0] == b[0] and a[2] != b[2] and (a[3] - b[3]) ** 2 + (a[4] - b[4]) ** 2 <= radius ** 2:
                for p in range(turns + 1):
                    count[a[1], kinds[codes[a[0], a[2]][p]], kinds[codes[b[0], b[2]][p]]][p] += 1
    got = {(r.condition, r.anchor_type, r.neighbor_type): r for r in enrichment.neighbour_enrichment(frame(spark, rows), radius, turns).collect()}
    assert got.keys() == count.keys()
    for k, c in count.items():
        r, null = got[k], c[1:]
        assert r.observed == c[0] and r.expected == pytest.approx(null.mean()) and r.spread == pytest.approx(null.std(), abs=1e-6)
        assert r.p_more == pytest.approx((1 + (null >= c[0]).sum()) / (turns + 1)) and r.p_less == pytest.approx((1 + (null <= c[0]).sum()) / (turns + 1))
    assert enrichment.neighbour_enrichment(frame(spark, []), radius, 5).count() == 0


@pytest.mark.parametrize("n_kinds", [1, 2, 3, 16, 17, 300])
def test_codes_of_types_are_packed(n_kinds):
    codes = np.random.default_rng(n_kinds).integers(0, n_kinds, (50, 101)).astype(np.uint16)
    bits = enrichment.code_bits(n_kinds)
    rows = pd.Series(enrichment.packed(codes, bits))
    assert len(rows[0]) <= 2 * 101 and (n_kinds > 4 or len(rows[0]) <= 26)
    assert (enrichment.unpacked(rows, 101, bits) == codes).all()


def test_enrichment_finds_planted_neighbours(spark):
    rng = random.Random(3)
    rows = []
    for k in range(150):
        x, y = rng.randrange(1000), rng.randrange(1000)
        rows += [("i", "x", f"a{k}", x, y, "A"), ("i", "x", f"b{k}", x + 3, y, "B"), ("i", "x", f"c{k}", rng.randrange(1000), rng.randrange(1000), "C")]
    got = {(r.anchor_type, r.neighbor_type): r for r in enrichment.neighbour_enrichment(frame(spark, rows), 10, 60).collect()}
    assert got["A", "B"].z > 5 and got["A", "B"].p_more == pytest.approx(1 / 61) and got["A", "C"].z < 2


def plain_clusters(rows, radius, least):
    out = {}
    for image in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == image]
        near = {a[2]: [(math.dist(a[3:5], b[3:5]), b[2]) for b in mine if b[2] != a[2] and math.dist(a[3:5], b[3:5]) <= radius] for a in mine}
        core = {c for c, n in near.items() if len(n) + 1 >= least}
        label = {}
        for c in sorted(core):
            todo = [c]
            while todo:
                d = todo.pop()
                if d not in label:
                    label[d] = c
                    todo += [n for _, n in near[d] if n in core]
        for c, n in near.items():
            if c in core:
                out[image, c] = (label[c], True)
            elif found := [x for x in n if x[1] in core]:
                out[image, c] = (label[min(found)[1]], False)
    return out


@pytest.mark.parametrize("seed,least", [(1, 4), (2, 6), (3, 2)])
def test_structures_equal_plain_density_clusters(spark, seed, least):
    rows = cells_of(seed) + [("heap", "x", f"h{k}", 50, 50, "A") for k in range(60)] + [("heap", "x", "far", 90, 90, "A"), ("heap", "x", "edge", 59, 50, "B")]
    want = plain_clusters(rows, 9, least)
    got = {(r.image_id, r.cell_id): (r.structure, r.is_core) for r in structures.dense_cells(frame(spark, rows), 9.0, least).collect()}
    assert got == want
    cell = {(r[0], r[2]): r for r in rows}
    groups = defaultdict(list)
    for key, (s, core) in want.items():
        groups[key[0], s].append((cell[key], core))
    found = {(r.image_id, r.structure): r for r in structures.structures(frame(spark, rows), 9.0, least, 5, ("A", "B")).collect()}
    kept = {k: g for k, g in groups.items() if len(g) >= 5 and {"A", "B"} <= {c[5] for c, _ in g}}
    assert found.keys() == kept.keys()
    for k, g in kept.items():
        r = found[k]
        assert (r.n_cells, r.n_core, r.n_types) == (len(g), sum(c for _, c in g), len({c[5] for c, _ in g}))
        assert r.center_x == pytest.approx(np.mean([c[3] for c, _ in g]))
        # The hull holds every point, and its area is the sum of triangles around a corner.
        corners = structures._hull(np.array([c[3:5] for c, _ in g], dtype=float))
        assert r.n_corners == len(corners)
        for a, b in zip(corners, np.roll(corners, -1, axis=0), strict=True):
            assert all((b[0] - a[0]) * (c[4] - a[1]) - (b[1] - a[1]) * (c[3] - a[0]) >= 0 for c, _ in g)


def test_hulls_are_taken_of_kept_structures_only(spark):
    heap = lambda name, n, kinds: [("i", "x", f"{name}{k}", 100 * ord(name) + k % 3, k // 3, kinds[k % len(kinds)]) for k in range(n)]
    found = structures.structures(frame(spark, heap("a", 9, "A") + heap("b", 9, "AB") + heap("c", 4, "AB")), 3.0, 3, 5, ("A", "B"))
    assert [(r.structure, r.n_cells, r.hull_area, r.n_corners) for r in found.collect()] == [("b0", 9, 4.0, 4)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # No worker starts a frame per structure, and members meet the kept ones before their corners are sought.
    assert "FlatMapGroupsInPandas" not in plan and "LeftSemi" in plan[plan.index("MapInPandas"):]


def test_no_structures(spark):
    assert structures.structures(frame(spark, []), 5.0, 3).count() == 0
    assert structures.dense_cells(frame(spark, [("i", "x", "a", 0, 0, "A"), ("i", "x", "b", 50, 0, "A")]), 5.0, 2).count() == 0


def plain_cox(t, e, x):
    beta = np.zeros(x.shape[1])
    for _ in range(60):
        w = np.exp(x @ beta)
        g, h, loglik = np.zeros(len(beta)), np.zeros((len(beta), len(beta))), 0.0
        for time in np.unique(t[e == 1]):
            risk, dead = t >= time, (t == time) & (e == 1)
            loglik += (x[dead] @ beta).sum()
            g += x[dead].sum(axis=0)
            d = dead.sum()
            for k in range(d):
                v = np.where(dead, 1 - k / d, 1.0) * w * risk
                mean = v @ x / v.sum()
                loglik -= np.log(v.sum())
                g -= mean
                h += (x * v[:, None]).T @ x / v.sum() - np.outer(mean, mean)
        step = np.linalg.solve(h, g)
        beta = beta + step
        if np.abs(step).max() < 1e-12:
            break
    return beta, np.sqrt(np.diag(np.linalg.inv(h))), loglik


@pytest.mark.parametrize("limit", [10 ** 6, 15])
def test_cox_equals_numpy_with_ties(spark, limit):
    rng = np.random.default_rng(4)
    rows, want = [], {}
    for outcome, scale in (("OS", 8), ("DFS", 60)):
        x = np.stack([rng.integers(0, 2, 150), rng.normal(50, 3, 150), rng.exponential(1, 150)], axis=1).astype(float)
        t = np.ceil(rng.exponential(scale * np.exp(-0.8 * x[:, 0] + 0.1 * (x[:, 1] - 50)))).astype(float)
        e = (rng.random(150) < 0.7).astype(int)
        want[outcome] = plain_cox(t, e, x)
        rows += [(outcome, float(a), int(b), *map(float, c)) for a, b, c in zip(t, e, x, strict=True)]
    rows += [("OS", None, 1, 1.0, 2.0, 3.0), ("OS", 1.0, 1, None, 2.0, 3.0), ("OS", 1.0, 1, math.nan, 2.0, 3.0), ("none", 1.0, 0, 1.0, 2.0, 3.0)]
    got = hazards.cox(spark.createDataFrame(rows, "outcome string, duration double, event int, a double, b double, c double"), ["a", "b", "c"], limit).collect()
    assert len(got) == 6
    for r in got:
        beta, se, loglik = want[r.outcome]
        k = "abc".index(r.covariate)
        assert r.converged and r.n == 150
        assert r.coef == pytest.approx(beta[k], abs=1e-6) and r.se == pytest.approx(se[k], abs=1e-6) and r.loglik == pytest.approx(loglik, abs=1e-6)
        assert r.p == pytest.approx(math.erfc(abs(beta[k] / se[k]) / math.sqrt(2)), abs=1e-6)


def test_cox_without_events_rows_or_differences(spark):
    rows = spark.createDataFrame([("OS", 1.0, 1, 2.0), ("OS", 2.0, 1, 2.0), ("OS", 3.0, 0, 2.0)], "outcome string, duration double, event int, a double")
    assert hazards.cox(rows.where("event = 0"), ["a"]).count() == hazards.cox(rows.where("false"), ["a"]).count() == 0
    r = hazards.cox(rows, ["a"]).collect()[0]
    assert (r.coef, r.z, r.p) == (0.0, None, None)


def test_components_take_unknown_values(spark):
    rng = np.random.default_rng(6)
    rows = [tuple(map(float, r)) for r in rng.normal(size=(40, 3))]
    rows[3] = (None, *rows[3][1:])
    rows[7] = (rows[7][0], math.nan, rows[7][2])
    out = embedding.principal_components(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"], 3).collect()
    x = np.array([[math.nan if v is None else v for v in r] for r in rows])
    mean = np.nanmean(x, axis=0)
    centred = np.where(np.isnan(x), 0, x - mean)
    assert [sum(v * v for v in r.components) for r in out] == pytest.approx((centred ** 2).sum(axis=1))


def test_a_stream_stops_at_another_header(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("image_id,CD3,CD8\ni,3,8\n")
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType
    schema = StructType([StructField("image_id", StringType()), StructField("CD3", DoubleType()), StructField("CD8", DoubleType())])

    def work():
        arrivals.work_off(arrivals.arriving_files(spark, str(folder), schema, "*.csv"), lambda b: b.select("CD3", "CD8"), str(tmp_path / "out"), str(tmp_path / "cp"))
    work()
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("CD3", "CD8").collect()] == [(3.0, 8.0)]
    (folder / "b.csv").write_text("image_id,CD8,CD3\ni,8,3\n")
    with pytest.raises(Exception):
        work()
    assert spark.read.parquet(str(tmp_path / "out")).agg(F.max("CD3")).first()[0] == 3.0
