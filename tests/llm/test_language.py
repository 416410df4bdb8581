import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.llm import language

SF = "/root/testdata/sf0.01"
PIECES = ["▁", "a", "b", "ab", "▁a", "ba", "▁ba", "abab", "c", "1", "x.y"]


def all_segmentations(text, ids):
    if not text:
        yield []
    for n in range(1, len(text) + 1):
        if text[:n] in ids:
            for rest in all_segmentations(text[n:], ids):
                yield [ids[text[:n]], *rest]


def test_forward_sums_all_segmentations():
    lattice = language.Lattice(PIECES)
    rng = np.random.default_rng(1)
    prob = rng.dirichlet(np.ones(lattice.size), size=3).T
    words = ["".join(w) for n in range(1, 6) for w in itertools.product("abc", repeat=n)]
    got = lattice.scores(words, prob)
    for word, row in zip(words, got, strict=True):
        want = sum(np.prod(prob[s], axis=0) for s in all_segmentations("▁" + word, lattice.ids))
        assert row == pytest.approx(np.log(want))


def test_unknown_letters_and_long_words():
    lattice = language.Lattice(PIECES)
    prob = np.full((lattice.size, 2), 1 / lattice.size)
    one, two = lattice.scores(["ż", "żż"], prob)
    assert np.isfinite(one).all() and (two < one).all()
    # Each place has a piece of one letter, so the log probability of a long word falls steadily and does not underflow.
    long = lattice.scores(["c" * n for n in (10, 200, 400)], prob)[:, 0]
    assert np.isfinite(long).all() and (long[2] - long[1]) / 200 == pytest.approx((long[1] - long[0]) / 190)


def test_long_words_are_whole():
    """One pass over the word in logarithms, place by place, against stretches."""
    lattice = language.Lattice([*PIECES, "cabca", "bcabcab"])
    rng = np.random.default_rng(3)
    prob = rng.dirichlet(np.ones(lattice.size) * 0.2, size=3).T + 1e-6
    singles = {p for p in lattice.ids if len(p) == 1}

    def one_pass(word):
        text = "▁" + word
        sums = np.full((len(text) + 1, 3), -np.inf)
        sums[0] = 0
        for end in range(1, len(text) + 1):
            for start in range(max(0, end - lattice.longest), end):
                piece = lattice.ids.get(text[start:end], lattice.unknown if end == start + 1 and text[start] not in singles else None)
                if piece is not None:
                    sums[end] = np.logaddexp(sums[end], sums[start] + np.log(prob[piece]))
        return sums[-1]

    for n in (1, 64, 65, 130, 300, 5000):
        word = "".join(rng.choice(list("abcż"), n, p=[0.4, 0.3, 0.25, 0.05]))
        want = one_pass(word)
        assert lattice.scores([word], prob)[0] == pytest.approx(want)
        for stretch in (3, 8, 50, 64, 2048):
            assert lattice.whole(word, prob, stretch) == pytest.approx(want)


def test_expectation_maximisation_raises_the_likelihood():
    from collections import Counter
    lattice = language.Lattice(PIECES)
    counts = Counter({"abab": 30, "ba": 10, "c": 3, "aab": 5})
    words = sorted(counts)
    weight = np.array([counts[w] for w in words])
    scores = [weight @ lattice.scores(words, lattice.fit(counts, n, 1e-9)[:, None])[:, 0] for n in (0, 1, 2, 4, 8)]
    assert all(b >= a - 1e-6 for a, b in itertools.pairwise(scores)) and scores[-1] > scores[0]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = language.held_out(F.col("doc_id"))
    found = language.predicted(docs, docs.where(~out)).where(language.held_out(F.col("doc.doc_id"))).select("doc.lang", "lang_pred", "score").collect()
    right = sum(r.lang == r.lang_pred for r in found if r.lang)
    assert len(found) > 250 and right >= 0.97 * sum(r.lang is not None for r in found)
    assert all(0 <= r.score <= 1 for r in found)


def test_defined_cases(spark):
    schema = "doc_id bigint, text string, lang string, lang_pred int, score string, doc int, place string, n int"
    rows = [(i, "the house and the garden of this town", "en") for i in range(20)] + [(i, "das haus und der garten dieser stadt", "de") for i in range(20, 40)]
    odd = [(50, None, "en"), (51, "", None), (52, "12 34 !?", None), (53, "THE TOWN", None), (None, "der garten", None), (54, "ß" * 5000, None),
           (54, "ß" * 5000, None), (55, "garten " * 20_000, None)]
    frame = lambda r: spark.createDataFrame([(*x, 1, "clash", 2, "clash", 3) for x in r], schema)
    found = language.predicted(frame(rows + odd), frame(rows + odd))
    assert found.columns == ["doc", "lang_pred", "score"]
    got = [(r.doc.doc_id, r.lang_pred, r.score) for r in found.collect()]
    assert len(got) == len(rows) + len(odd)
    pred = {i: p for i, p, _ in got}
    assert pred[50] == pred[51] == pred[52] == "und" and pred[53] == "en" and pred[None] == pred[55] == "de"
    kept = language.in_a_language(frame(rows + odd), frame(rows))
    assert kept.columns == frame(rows).columns
    assert {50, 51, 52}.isdisjoint(r.doc_id for r in kept.collect())
    none = language.predicted(frame(odd), frame([])).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    assert language.predicted(frame([]), frame(rows)).count() == 0


def test_the_sample_is_bounded_per_language(spark):
    rows = [(i, "x", "a" if i % 10 else "b") for i in range(3000)]
    fit = language.Fit(fit_documents=100)
    got = language.sample(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), fit).groupBy("lang").count().collect()
    assert {r.lang: r["count"] for r in got} == {"a": 100, "b": 100}
