import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, ids array<string>, v int, query string, block string, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, ["clash"], 1, "clash", "clash", "clash") for i, e in rows], SCHEMA)


def brute(rows, k=10, step=100):
    vectors = set()
    for i, e in rows:
        if e is not None and all(x is not None and math.isfinite(x) for x in e):
            vectors.add((i, tuple(math.floor(1024 * float(np.float32(x))) for x in e)))
    out = []
    for i, q in vectors:
        if i is not None and i % step == 0:
            found = sorted(((-sum(a * b for a, b in zip(q, v)), j is None, j) for j, v in vectors if j != i))
            out += [(i, n + 1, j, -s) for n, (s, _, j) in enumerate(found[:k])]
    return sorted(out, key=str)


def got(spark, rows, **more):
    found = topk.top_k(frame(spark, rows), F.col("id") % 100 == 0, **more)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted([(r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()], key=str)


@pytest.mark.parametrize("block,queries", [(2048, 1024), (40, 2)])
def test_equals_brute_force(spark, monkeypatch, block, queries):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES", queries)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = [(int(i), [float(x) for x in centres[i % 6] + 0.3 * rng.normal(size=8)]) for i in range(900)]
    hot = [0.5, -0.25, 0.0, 1.0, -1.0, 0.125, 0.75, -0.5]
    rows += [(int(i), hot) for i in range(900, 1500)]  # a third are copies
    rows += [(1500 + i, [float(x) for x in rng.integers(-2, 3, 8) / 1024]) for i in range(200)]  # many ties
    rows += [(-100, [0.0] * 8), (2000, [1e-9] * 8), (2100, None), (2200, [1.0, None] + [0.0] * 6), (2300, [math.nan] * 8),
             (2400, [math.inf] + [0.0] * 7), (2500, []), (2600, [1.0, 2.0]), (None, hot), (None, [3.0] * 8), (None, [3.0] * 8),
             (1200, hot), (1300, [2.0] * 8), (10 ** 18, [4.0] * 8)]
    assert got(spark, rows) == brute(rows)


def test_few_no_and_huge_vectors(spark):
    assert got(spark, []) == []
    assert got(spark, [(0, [1.0])]) == []
    assert got(spark, [(0, [1.0, 2.0]), (7, [0.5, 0.5]), (100, [-1.0, 0.0])]) == brute([(0, [1.0, 2.0]), (7, [0.5, 0.5]), (100, [-1.0, 0.0])])
    big = got(spark, [(0, [1e30, 1.0]), (1, [1e30, 0.0]), (2, [-1e30, 0.0]), (3, [0.0, 2.0])])
    assert sorted(((r[2], r[3]) for r in big), key=lambda r: -r[1]) == [(1, 2 ** 63 - 1), (3, 2 * 1024 ** 2), (2, -2 ** 63)]


@pytest.mark.parametrize("kind", [float, object])
def test_the_threshold_ends_the_walk_early(kind):
    rng = np.random.default_rng(5)
    members = rng.integers(-50, 51, size=(5000, 4))
    members[:20] = 400 * np.array([1, -1, 1, 1]) + rng.integers(-5, 6, size=(20, 4))
    queries = np.array([[3, -2, 4, 1], [1, -1, 1, 2]])
    none, own = np.full(2, topk._LEAST, dtype=object).astype(kind), np.array([-1, 3])
    scores, wanted, scored = topk.threshold_top(members.astype(kind), queries.astype(kind), 10, none, own)
    exact = queries @ members.T
    assert scored < 200
    for q in range(2):
        want = sorted((s for i, s in enumerate(exact[q]) if i != own[q]), reverse=True)[:10]
        assert sorted((s for s in scores[q] if s >= wanted[q]), reverse=True)[:10] == want
    # A floor beyond everything lets a block answer at once, with nothing.
    scores, wanted, scored = topk.threshold_top(members.astype(kind), queries.astype(kind), 10, np.full(2, 10 ** 6).astype(kind), own)
    assert not (scores >= wanted[:, None]).any() and scored <= 2 * 4 * topk._STEP


def test_registered_query_on_the_given_table(spark):
    from cellweave.llm import queries
    found = sorted((tuple(r) for r in queries.QUERIES["op11_topk"](spark, "/root/testdata/sf0.01").collect()), key=str)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    assert found == brute(rows)
