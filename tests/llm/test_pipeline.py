import hashlib
import math
import re
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest

import corpus_pipeline
from cellweave.llm import language, mixing

SF = "/root/testdata/sf0.001"


def test_stages():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_copies", "decontamination", "mixing"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_run_equals_brute_force(spark, docs):
    rows = {r.doc_id: r for r in docs.collect()}
    # Language: the fitted model is the operator's; scores are taken anew, word by word.
    from pyspark.sql import functions as F
    names, prob, pieces = language.train(docs.where(~language.held_out(F.col("doc_id"))))
    lattice = language.Lattice(pieces)
    score = cache(lambda word: lattice.scores([word], prob)[0])
    kept = []
    for i, r in sorted(rows.items()):
        words = Counter(language.letters_of(r.text))
        if words:
            total = sum(n * score(w) for w, n in words.items())
            if (np.exp(total - total.max()) / np.exp(total - total.max()).sum()).max() >= 0.5:
                kept.append(i)
    # Near copies: sets of shingles of 5 words, all pairs, a Jaccard similarity of 0.8 or more.
    def shingles(text):
        w = (text or "").encode().lower().split()
        return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    sets = {i: shingles(rows[i].text) for i in kept}
    group = {i: i for i in kept}
    changed = True
    while changed:
        changed = False
        for a in kept:
            for b in kept:
                if group[a] > group[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                    group[a] = group[b]
                    changed = True
    kept = [i for i in kept if group[i] == i]
    # Benchmark windows.
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {tuple(w[s:s + 10]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() for w in [words(r.text)] for s in range(max(1, len(w) - 9)) if w}
    kept = [i for i in kept if not any(tuple(w[p:p + len(x)]) == x for w in [words(rows[i].text)] for x in windows for p in range(len(w) - len(x) + 1))]
    # Mixing.
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", rows[i].text or "")) for i in kept}
    total = defaultdict(int)
    for i in kept:
        total[rows[i].source] += size[i]
    order = sorted(total, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, open_, target = 1.5 * sum(total.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= 2 * total[s]}
        target |= {s: 2 * total[s] if full else level * weight[s] for s in (full or open_)}
        left -= sum(target[s] for s in full)
        open_ -= full or open_
    want = Counter()
    for s in order:
        u = int(hashlib.md5(f"mix:{s or ''}{'?' if s is None else ''}".encode()).hexdigest()[:8], 16) / 2 ** 32
        rate = target[s] / total[s] if total[s] else 0
        for k, i in enumerate(sorted((i for i in kept if rows[i].source == s), key=lambda i: (size[i], i % mixing.BLOCKS, i))):
            n = math.floor(rate * (k + 1) + u) - math.floor(rate * k + u)
            if n:
                want[i] = n
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == docs.columns
    got = Counter(r.doc_id for r in out.collect())
    assert got == want


def test_stages_take_odd_and_empty_documents(spark, docs):
    odd = spark.createDataFrame([(10_001, None, None, None, None), (10_002, "", "en", "s", 0), (None, "the house of the town", "en", "s", 9),
                                 (10_003, "words " * 50_000, "en", None, 1), (10_003, "words " * 50_000, "en", None, 1)], docs.schema)
    for table in (odd.union(docs.limit(30)), docs.where("false")):
        now = table
        for _, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, SF)
            assert now.columns == docs.columns
        assert (now.count() > 0) == (table.count() > 0)


def test_fingerprints_tie_what_shingle_sets_do_not(spark, docs):
    from cellweave.llm import simhash
    long = "the house of the town stands near old river " * 200
    tails = ["one two three four five six seven eight nine ten", "red green blue black white brown grey pink cyan gold"]
    prints = [simhash.fingerprint(long + t) for t in tails]
    assert (prints[0] ^ prints[1]).bit_count() <= simhash.MOST_BITS
    rows = [(1, "something else that is not like the others at all", "en", "s", 1), (2, long + tails[0], "en", "s", 1),
            (3, long + tails[1], "en", "s", 1), (4, tails[1] + " " + tails[0], "en", "s", 1), (None, "a row without an id", "en", "s", 1)]
    kept = corpus_pipeline.one_of_near_copies(spark, spark.createDataFrame(rows, docs.schema), SF)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 4]
