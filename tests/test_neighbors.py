from pathlib import Path
from collections import Counter
import time
import itertools
import math
import random

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from cellweave.operators import neighbors, triads as ops


def make(rng, n, images=2, spread=100.0, kinds="ANR", whole=False, hot=0):
    rows = []
    for i in range(n):
        x, y = rng.uniform(-spread, spread), rng.uniform(-spread, spread)
        if whole:
            # Multiples of five: many pairs lie exactly on the radius and on square edges.
            x, y = 5.0 * round(x / 5), 5.0 * round(y / 5)
        if i < hot:
            x, y = 10.0, -20.0
        rows.append((f"img{rng.randrange(images)}", "WT", f"c{i}", x, y, rng.choice(kinds) if rng.random() > 0.05 else None))
    return rows


SCHEMA = "image_id string, condition string, cell_id string, x double, y double, cell_type string"


def brute_pairs(rows, r):
    return {(a[0], a[2], b[2]) for a, b in itertools.permutations(rows, 2)
            if a[0] == b[0] and (a[3] - b[3]) ** 2 + (a[4] - b[4]) ** 2 <= r * r}


def brute_triads(rows, r, types=None):
    kind = {(x[0], x[2]): x[5] for x in rows}
    near = {}
    for image, a, b in brute_pairs(rows, r):
        near.setdefault((image, a), []).append(b)
    out = set()
    for (image, a), others in near.items():
        for p, q in itertools.permutations(others, 2):
            ks = kind[image, a], kind[image, p], kind[image, q]
            if types is None and (None in ks or len(set(ks)) < 3):
                continue
            if types is not None and ks != types:
                continue
            out.add((image, a, p, q))
    return out


def got_triads(df):
    rows = df.select("image_id", "anchor_cell_id", "partner1_cell_id", "partner2_cell_id").collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows}


@pytest.mark.parametrize("whole,hot,limit", [(False, 0, 4000), (True, 0, 4000), (True, 60, 7)])
def test_pairs_match_brute_force(spark, whole, hot, limit):
    rows = make(random.Random(3), 220, whole=whole, hot=hot)
    df = spark.createDataFrame(rows, SCHEMA)
    found = neighbors.radius_pairs(df, df, 25.0, limit=limit).collect()
    keys = [(r.image_id, r.anchor_cell_id, r.neighbor_cell_id) for r in found]
    assert len(keys) == len(set(keys))
    assert set(keys) == brute_pairs(rows, 25.0)


@pytest.mark.parametrize("limit", [4000, 5])
def test_typed_triads_and_flags_match_brute_force(spark, limit):
    rows = make(random.Random(5), 160, whole=True, hot=40)
    df = spark.createDataFrame(rows, SCHEMA)
    search = ops.TriadSearch(20.0, 1.0, "A", "N", "R", square_cells=limit)
    want = brute_triads(rows, 20.0, ("A", "N", "R"))
    triads = ops.find_triads(df, search)
    assert got_triads(triads) == want
    counts = {r.image_id: r.n_triads for r in ops.triad_counts(df, search).collect()}
    assert counts == {i: sum(t[0] == i for t in want) for i in {t[0] for t in want}}
    columns = ["image_id", "cell_id", *ops.ROLE_FLAGS.values(), "in_any_triad"]
    direct = {tuple(r) for r in ops.flag_cells(df, search).select(*columns).collect()}
    from_table = {tuple(r) for r in ops.flags_from_triads(df, triads).select(*columns).collect()}
    assert direct == from_table
    assert {(r[0], r[1]) for r in direct if r[2]} == {(t[0], t[1]) for t in want}


@pytest.mark.parametrize("limit", [4000, 5])
def test_all_type_triads_match_brute_force(spark, limit):
    rows = make(random.Random(7), 90, whole=True, hot=20)
    df = spark.createDataFrame(rows, SCHEMA)
    search = ops.TriadSearch(20.0, 1.0, square_cells=limit)
    want = brute_triads(rows, 20.0)
    triads = ops.find_triads(df, search)
    assert got_triads(triads) == want
    assert sum(r.n_triads for r in ops.triad_counts(df, search).collect()) == len(want)
    # The neighbour counts are those of each partner's type.
    kind = {(x[0], x[2]): x[5] for x in rows}
    near = {}
    for image, a, b in brute_pairs(rows, 20.0):
        near.setdefault((image, a, kind[image, b]), set()).add(b)
    for r in triads.limit(50).collect():
        assert r.n_p1_neighbors == len(near[r.image_id, r.anchor_cell_id, r.partner1_type])


def test_equal_partner_types_give_both_orders(spark):
    rows = [("i", "WT", "a", 0.0, 0.0, "A"), ("i", "WT", "b", 3.0, 4.0, "B"), ("i", "WT", "c", 0.0, 5.0, "B"),
            ("j", "WT", "a", 0.0, 0.0, "A"), ("j", "WT", "b", 3.0, 4.0, "B")]
    df = spark.createDataFrame(rows, SCHEMA)
    search = ops.TriadSearch(5.0, 1.0, "A", "B", "B")
    assert got_triads(ops.find_triads(df, search)) == {("i", "a", "b", "c"), ("i", "a", "c", "b")}
    assert [r.n_triads for r in ops.triad_counts(df, search).collect()] == [2]


def test_radius_grows_triads(spark):
    df = spark.createDataFrame(make(random.Random(11), 150), SCHEMA)
    sizes = [ops.find_triads(df, ops.TriadSearch(r, 1.0, "A", "N", "R"), False).count() for r in (10.0, 20.0, 30.0)]
    assert sizes == sorted(sizes) and sizes[-1] > 0


def test_report_radius_ignores_partner_distance(spark):
    rows = [("i", "WT", "a", 0.0, 0.0, "A"), ("i", "WT", "b", 10.0, 0.0, "N"), ("i", "WT", "c", -10.0, 0.0, "R")]
    search = ops.TriadSearch(20.0, 2.0, "A", "N", "R")
    triads = ops.find_triads(spark.createDataFrame(rows, SCHEMA), search)
    row = triads.first()
    assert math.isclose(row.dist_p1_p2_um, 40.0) and row.dist_anchor_p1_um == 20.0
    assert ops.report_radius_filter(triads, 20.0).count() == 1
    assert ops.report_radius_filter(triads, 19.9).count() == 0


def test_no_pairwise_plan(spark):
    df = spark.createDataFrame(make(random.Random(1), 50), SCHEMA)
    plan = ops.find_triads(df, ops.TriadSearch(20.0, 1.0, "A", "N", "R"), False)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.count("Exchange hashpartitioning") == 3


def test_trajectory_counts_every_threshold(spark):
    rows = [("WT", d, d) for d in (0.0, 5.0, 5.0, 10.0, 20.0)]
    triads = spark.createDataFrame(rows, "condition string, dist_anchor_p1_um double, dist_anchor_p2_um double")
    areas = spark.createDataFrame([("WT", 0.0)], "condition string, area_um2 double")
    out = ops.trajectory(triads, areas, ["WT"], 20.0, 0.0, 5).orderBy("point").collect()
    assert [(r.threshold_um, r.n_triads, r.triads_per_mm2) for r in out] == [
        (0.0, 1, 0.0), (5.0, 3, 0.0), (10.0, 4, 0.0), (15.0, 4, 0.0), (20.0, 5, 0.0)]


def test_labels_use_short_names_per_role(spark):
    search = ops.TriadSearch(5.0, 1.0, "A", "A", "B", {"A": "first"}, {}, {"B": "last"})
    df = spark.createDataFrame([("A", "A", "B")], "a string, b string, c string")
    assert df.select(search.label(F.col("a"), F.col("b"), F.col("c"))).first()[0] == "first__A__last"


def test_repeated_ids_count_alike_with_and_without_crowds(spark):
    rows = [("i", "a", 0.0, 0.0, "A"), ("i", "a", 0.0, 0.0, "A"), ("i", "a", 1.0, 0.0, "B"), ("i", "b", 1.0, 1.0, "A"),
            ("i", "c", 2.0, 0.0, "B"), ("i", "c", 2.0, 0.0, "B"), ("i", "d", 50.0, 50.0, "B"), ("j", "a", 0.0, 0.0, "A")]
    df = spark.createDataFrame(rows, "image_id string, cell_id string, x double, y double, cell_type string")
    want = Counter()
    for place, times in Counter((r[0], r[1], r[2], r[3]) for r in rows).items():
        near = Counter(r[4] for r in rows if r[0] == place[0] and r[1] != place[1] and math.dist(r[2:4], place[2:]) <= 5)
        want.update({(place[0], place[1], t, n * times): 1 for t, n in near.items()})
    for limit in (4000, 2, 1):
        got = Counter(tuple(r) for r in neighbors.type_counts(df, df, 5.0, limit).select("image_id", "anchor_cell_id", "neighbor_type", "n").collect())
        assert got == want, limit


def jobs_of(spark, work):
    group = f"count-{time.time_ns()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("name", ["zscore_norm", "triad_flags", "test_in_vs_out", "noise_filter", "logrank"])
def test_plans_are_built_with_few_jobs_beyond_stored_stages(spark, monkeypatch, name):
    from cellweave.operators import lineage
    from workload import REGISTRY
    stored = []
    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: stored.append(jobs_of(spark, lambda: write(self, path, *a, **k))))
    beyond = jobs_of(spark, lambda: REGISTRY[name].build(spark, "/root/testdata/sf0.001"))
    assert stored and beyond <= 5 + 2 * len(stored), (beyond, stored)
    lineage.drop_stages(spark)


def test_nothing_is_left_behind(spark):
    from cellweave.operators import lineage
    from workload import REGISTRY
    folder = Path(lineage.owned_folder(spark).removeprefix("file:"))
    assert REGISTRY["zscore_norm"].build(spark, "/root/testdata/sf0.001").count() and any(folder.iterdir())
    lineage.drop_stages(spark)
    assert not folder.exists()


def test_copies_of_partners_are_few_and_short(spark):
    # One cell on every spot of a field far wider than the radius.
    cells = spark.range(40_000).selectExpr("'i' as image_id", "cast(id as string) as cell_id", "id % 200 as x", "id div 200 as y")
    side = neighbors.Side(cells, "neighbor")
    copies = neighbors._touched_squares(side.renamed(), side, 5.0, 5.0 * neighbors.SIDE_IN_RADII)
    assert copies.count() <= 2.6 * 40_000
    assert dict(copies.dtypes)["square"] == "int"
