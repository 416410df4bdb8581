import random
from collections import defaultdict

import pytest

import corpus_pipeline
from cellweave.llm import similar

SCHEMA = "doc_id bigint, text string, node int, root string, key string, size int, set string, row_hash string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "clash", "clash", 2, "clash", "clash") for i, t in rows], SCHEMA)


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def groups(texts):
    """The place of the first text each is tied to, by all pairs."""
    sets, label = [shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            common = len(a & b)
            if 5 * common >= 4 * (len(a) + len(b) - common):
                low, high = sorted((find(i), find(j)))
                label[high] = low
    return [find(i) for i in range(len(texts))]


def kept_ids(rows):
    found = defaultdict(list)
    for (i, _), g in zip(rows, groups([t for _, t in rows]), strict=True):
        found[g].append(i)
    return sorted(min(ids) for ids in found.values())


@pytest.mark.parametrize("rounds", [0, 2])
def test_one_of_similar_equals_all_pairs(spark, monkeypatch, rounds):
    monkeypatch.setattr(similar, "ROUNDS", rounds)
    rng = random.Random(4)
    words = [f"W{i}" for i in range(300)]
    rows = []
    for _ in range(30):
        text = [rng.choice(words) for _ in range(rng.randint(1, 150))]
        for _ in range(rng.choice([1, 2, 5])):
            copy = list(text)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(" ".join(copy))
    # One dense group, of which some members are only tied by a chain.
    text = [rng.choice(words) for _ in range(150)]
    for _ in range(60):
        text[rng.randrange(150)] = rng.choice(words)
        rows.append(" ".join(text))
    rows += ["", None, " \t", "one", "ONE", "a b c d e " * 10_000]
    rng.shuffle(rows)
    rows = list(enumerate(rows, start=5))
    out = similar.one_of_similar(frame(spark, rows))
    assert out.columns == frame(spark, rows).columns
    assert sorted(r.doc_id for r in out.collect()) == kept_ids(rows)
    assert similar.one_of_similar(frame(spark, [])).count() == 0


def test_pipeline_stage_on_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = dict(corpus_pipeline.STAGES)["near_copies"](spark, docs, "/root/testdata/sf0.01")
    assert sorted(r.doc_id for r in out.collect()) == kept_ids(rows)


def test_rows_are_merged_by_their_texts_and_not_their_ids(spark):
    a, b, c = ("alpha beta gamma delta epsilon zeta", "one two three four five six", "red green blue white black grey")
    rows = [(None, a), (5, a), (None, b), (None, b), (7, c), (7, b + " seven"), (7, c)]
    got = sorted(((r.doc_id, r.text) for r in similar.one_of_similar(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(5, a), (None, b), (7, c), (7, b + " seven")], key=str)
