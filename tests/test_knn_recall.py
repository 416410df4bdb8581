import numpy as np

from cellweave.operators import knn


def recall(spark, vectors, k=15):
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id bigint, vector array<double>")
    got = {(r.src, r.dst) for r in knn.knn(df, k, "grouped").select("src", "dst").collect()}
    square = (vectors ** 2).sum(1)
    d2 = square[:, None] + square[None] - 2 * vectors @ vectors.T
    np.fill_diagonal(d2, np.inf)
    want = np.argsort(d2, axis=1)[:, :k]
    return sum((i, int(j)) in got for i, row in enumerate(want) for j in row) / want.size


def watched(monkeypatch):
    """The numbers of pivots asked and there were."""
    seen, measure = [], knn._asked

    def asked(placed, pivots, keep):
        seen.append((measure(placed, pivots, keep), len(pivots)))
        return seen[-1][0]
    monkeypatch.setattr(knn, "_asked", asked)
    return seen


def test_recall_holds_where_groups_outnumber_a_fixed_number_of_probes(spark, monkeypatch):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("embedding").collect()
    seen = watched(monkeypatch)
    share = recall(spark, np.array([r.embedding for r in rows], dtype=float))
    print("recall", share, "asked, groups", seen)
    assert share >= 0.95


def test_recall_with_far_fewer_probes_than_groups(spark, monkeypatch):
    rng = np.random.default_rng(6)
    vectors = np.concatenate([c + rng.normal(size=(50, 3)) for c in rng.normal(size=(50, 3)) * 20])
    seen = watched(monkeypatch)
    share = recall(spark, vectors)
    ((asked, groups),) = seen
    print("recall", share, "asked, groups", seen)
    assert share >= 0.95 and groups == 50 and asked <= groups // 2
