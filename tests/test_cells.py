import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.functions import geometry, names
from cellweave.operators import clusters, communities, markers as mk, patients as pt, quality, rules
from cellweave.operators.knn import _candidates, _distances, _nearest, knn, knn_edges
from cellweave.operators.lineage import materialize


def one(spark, value, build):
    return spark.createDataFrame([(value,)], "v string").select(build(F.col("v")).alias("out")).first().out


def test_name_hand_cases(spark):
    long = "WT_PirB_D14-2_3_Scan1_x16356_y1375_masked"
    assert one(spark, long, lambda c: names.tissue_id(c, ["WT", "KO"])) == "PirB_D14-2_3_Scan1_masked"
    assert one(spark, "CLR_reg001_A", names.reg_num) == 1
    for text, want in (("1,2", [1, 2]), ("1, ,2", [1, 2]), ("1,a", []), (None, []), ("1.0", [])):
        assert one(spark, text, names.spot_list) == want
    # A plain prefix needs no delimiter; detection does.
    assert one(spark, "KOala", lambda c: names.condition_prefix(c, ["KO"])) == "KO"
    assert one(spark, "KOWT", lambda c: names.detect_condition(c, ["WT", "KO"])) == "Unknown"
    assert one(spark, "a_ko", lambda c: names.detect_condition(c, ["WT", "KO"])) == "KO"
    assert one(spark, "/a/.hidden", names.file_stem) == ".hidden"
    assert one(spark, "/a/b.c.tif", names.file_stem) == "b.c"
    assert one(spark, "KO_s1_x5_y6.tif", lambda c: names.slide_id(c, ["KO"])) == "s1"
    assert one(spark, "KO_s1.tif", lambda c: names.slide_id(c, ["KO"])) == "KO_s1"


def test_radius_of_missing_area(spark):
    df = spark.createDataFrame([(None,), (1.0,), (400.0,)], "a double")
    got = [tuple(r) for r in df.select(geometry.equivalent_radius(F.col("a")), geometry.drawn_radius(F.col("a"))).collect()]
    assert got[0] == (None, 5.0) and got[1] == (3.0, 3.0) and got[2][0] == pytest.approx((400 / np.pi) ** 0.5)


def score(row, rule):
    """Score of one rule for one cell, rule by rule."""
    if not all(row.get(c, False) for c in rule.required) or any(row.get(c, False) for c in rule.excluded):
        return 0
    if rule.required_any and not any(row.get(c, False) for c in rule.required_any):
        return 0
    return 2 + sum(row.get(c, False) for c in rule.preferred) if rule.preferred else 1


def test_rules_match_rule_by_rule_scoring(spark):
    rng = random.Random(6)
    flags = [f"{m}_pos" for m in "abcde"]
    pick = lambda n: rng.sample([*flags, "absent_pos"], rng.randrange(n))
    cell_rules = rules.parse_rules({"cell_type_definitions": {
        f"t{i}": [{"required": pick(3), "required_any": pick(3), "preferred": pick(3), "excluded": pick(2)}
                  for _ in range(rng.randrange(1, 4))] for i in range(6)}})
    rows = [tuple(rng.random() < 0.5 for _ in flags) for _ in range(200)]
    df = spark.createDataFrame(rows, ", ".join(f"{f} boolean" for f in flags))
    for r in df.withColumn("got", rules.rule_type(df.columns, cell_rules)).collect():
        best, want = 0, "Unassigned"
        for rule in cell_rules:
            s = score(r.asDict(), rule)
            if s > best:
                best, want = s, rule.cell_type
        assert r.got == want


def test_single_rule_form_and_catch_all(spark):
    cell_rules = rules.parse_rules({"x": {"required": ["a_pos"]}, "rest": [{"required": [], "excluded": []}]})
    df = spark.createDataFrame([(True,), (False,), (None,)], "a_pos boolean")
    assert [r.t for r in df.select(rules.rule_type(df.columns, cell_rules).alias("t")).collect()] == ["x", "rest", "rest"]
    assert rules.rules_table(spark, cell_rules).count() == 2


def test_levels_need_more_than_three_positives(spark):
    df = spark.createDataFrame([(float(i), float(i)) for i in range(10)], "`a b:c` double, few double")
    out = mk.add_intensity_levels(df, {"a b:c": 1.0, "few": 6.0, "absent": 1.0}).orderBy("few").collect()
    positives = np.arange(2, 10)
    low, high = np.percentile(positives, 33), np.percentile(positives, 66)
    assert [r["a b:c_intensity"] for r in out] == [0 if v <= 1 else 1 if v <= low else 2 if v <= high else 3 for v in range(10)]
    assert all(r.few_intensity == 0 for r in out)


def test_cluster_profiles(spark):
    rows = [("1", 1.0, 5.0, 0.0), ("1", 3.0, 5.0, 0.0), ("2", 0.0, 9.0, 1.0), ("10", 8.0, 7.0, 1.0)]
    df = spark.createDataFrame(rows, "cluster string, a double, b double, c double").withColumn("a_pos", F.col("a") > 1)
    got = {r.cluster: r for r in clusters.cluster_profiles(df, ["a", "b", "c", "absent"], n_top=2, n_bottom=1).collect()}
    means = np.array([[2.0, 5.0, 0.0], [0.0, 9.0, 1.0], [8.0, 7.0, 1.0]])
    z = (means - means.mean(0)) / (means.std(0, ddof=1) + 1e-9)
    for i, k in enumerate(["1", "2", "10"]):
        order = sorted(range(3), key=lambda j: -z[i, j])
        assert [e.marker for e in got[k].high] == ["abc"[j] for j in order[:2]]
        assert [(e.marker, e.z) for e in got[k].low] == [("abc"[order[2]], round(z[i, order[2]], 2))]
    assert got["1"].n == 2 and got["1"].pct_pos == {"a": 50.0}


@pytest.mark.parametrize("method,pivots,block", [("exact", 256, 2000), ("exact", 5, 9), ("grouped", 5, 9)])
def test_knn_matches_brute_force_with_copies(spark, method, pivots, block):
    rng = np.random.default_rng(1)
    points = rng.normal(size=(150, 4)).round(2)
    points[:60] = points[0]
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id bigint, vector array<double>")
    got = {}
    # With every group asked, the grouped search is exact as well.
    for r in knn(df, 6, method, pivots, pivots, block).collect():
        got.setdefault(r.src, []).append((r["rank"], r.dst))
    d2 = ((points[:, None] - points[None]) ** 2).sum(-1)
    for i in range(len(points)):
        want = sorted((d2[i, j], j) for j in range(len(points)) if j != i)[:6]
        assert [round(d2[i, j], 9) for _, j in sorted(got[i])] == [round(d, 9) for d, _ in want]
        if i < 60:
            assert [j for _, j in sorted(got[i])] == [j for _, j in want]


@pytest.mark.parametrize("offset,scale", [(0.0, 1.0), (1e7, 1.0), (0.0, 1e-9), (0.0, 1e-200), (0.0, 1e200)])
def test_few_pairs_are_summed_for_the_nearest(offset, scale):
    rng = np.random.default_rng(2)
    points = rng.integers(-9, 9, (700, 64)) * scale + offset
    points[300:340] = points[7]
    with np.errstate(all="ignore"):
        d2 = _distances(points, points)
        row, place, found = _nearest(points, points, 16)
        summed = sum(len(r) for r, _ in _candidates(points, points, 16))
    want = np.argsort(d2, axis=1, kind="stable")[:, :16]
    assert (row.reshape(700, 16) == np.arange(700)[:, None]).all() and (place.reshape(700, 16) == want).all()
    assert (found.reshape(700, 16) == np.take_along_axis(d2, want, axis=1)).all()
    assert summed < 700 * 24 or scale in (1e-200, 1e200)


def test_grouped_neighbours_recall_and_reach(spark):
    points = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").selectExpr("vec_id AS id", "embedding AS vector")
    pairs = lambda **more: {(r.src, r.dst) for r in knn(points, 15, **more).collect()}
    exact, grouped = pairs(), pairs(method="grouped")
    assert len(exact & grouped) >= 0.95 * len(exact)
    with pytest.raises(ValueError):
        knn(points, 3, "nearest")


def test_communities_are_numbered_by_their_smallest_member(spark):
    cliques = [[9, 3, 30], [5, 4, 40, 41], [7, 8]]
    edges = [(a, b, 1.0) for c in cliques for a in c for b in c if a != b]
    found = communities.communities(spark.createDataFrame(edges, "src bigint, dst bigint, weight double"))
    assert {r.node: r.community for r in found.collect()} == {n: min(c) for c in cliques for n in c}


def test_communities_find_planted_groups(spark):
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(4, 5)) * 20
    points = np.concatenate([c + rng.normal(size=(25, 5)) for c in centers])
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id bigint, vector array<double>")
    edges = materialize(knn_edges(knn(df, 8)))
    member = materialize(communities.communities(edges, resolution=0.5))
    found = {r.node: r.community for r in member.collect()}
    assert len(found) == 100
    groups = [{found[i] for i in range(g * 25, g * 25 + 25)} for g in range(4)]
    assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 4
    assert communities.modularity(edges, member) > 0.8


def test_split_rules(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (3.0,)], "triads_per_mm2 double")
    assert sorted(r.density_group for r in pt.density_split(df).collect()) == sorted(["Triad−", "Triad−", "Triad+"])
    assert {r.density_group for r in pt.density_split(df, "bad").collect()} == {"High"}
    assert sorted(r.density_group for r in pt.density_split(df, "2").collect()) == ["High", "Low", "Low"]


def test_patient_images_ignore_condition_and_repeats(spark):
    counts = spark.createDataFrame([("CLR_reg001_A", 2), ("DII_reg001_A", 3), ("CLR_reg002_A", 0)], "image_id string, n_triads bigint")
    people = spark.createDataFrame([(1, 1, "1,1"), (2, 2, "2"), (3, 2, "9"), (None, 1, "1")],
                                   "Patient bigint, Group int, `TMA spot / region` string")
    got = {r.patient_id: (r.n_images, r.total_triads, r.triads_per_mm2) for r in pt.patient_density(people, counts, 1e6).collect()}
    assert got == {1: (2, 5, 2.5), 2: (1, 0, 0.0), 3: (0, 0, 0.0)}


def test_checks_fail_where_they_should(spark):
    cells = spark.createDataFrame([("WT", "Unassigned")] * 3 + [("WT", "a")], "condition string, cell_type string")
    got = {r.check: r.passed for r in quality.check_cell_typing(cells).collect()}
    assert got == {"columns_present": True, "has_cells": True, "two_types": True, "mostly_assigned": False}
    missing = quality.check_preprocessing(cells, ["WT"]).collect()
    assert [(r.passed, r.detail) for r in missing] == [(False, "image_id,tissue_id")]
    empty = quality.check_written(cells.where("false"), "survival").first()
    assert not empty.passed
