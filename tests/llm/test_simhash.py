import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from cellweave.llm import components, simhash

SCHEMA = "doc_id bigint, text string, fp int, root string, key string, u int, id string, doc string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "clash", "clash", 2, "clash", "clash") for i, t in rows], SCHEMA)


def plain(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps, near=3):
    label = list(range(len(fps)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= near:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def corpus():
    rng = random.Random(3)
    words = [f"w{i}É" if i % 9 == 0 else f"W{i}" for i in range(400)]
    rows = []
    for i in range(60):
        text = [rng.choice(words) for _ in range(rng.randint(1, 120))]
        for k in range(rng.choice([1, 1, 3])):
            copy = list(text)
            if k:
                copy[rng.randrange(len(copy))] = "other"
            rows.append(" ".join(copy))
    rows += ["", None, " \t\n", " ", "one", "one two", "one two", "tab\x0bseparated\x1cwords here", "a b c " * 20_000]
    return list(enumerate(rows, start=5))


def test_fingerprint_is_the_majority_of_the_hashes():
    for _, text in corpus()[:40] + corpus()[-9:-1]:
        assert simhash.fingerprint(text) == plain(text)
    assert simhash.fingerprint("x y z w " * 50_000) == simhash.fingerprint("x y z w " * 50_000 + " ")


@pytest.mark.parametrize("limit", [4096, 3])
def test_components_equal_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "LIST", limit)
    rows = corpus() + [(3, "one two"), (3, "one two")]
    fps = [simhash.fingerprint(t) for _, t in rows]
    group = groups(fps)
    lowest = defaultdict(lambda: 10 ** 9)
    for (i, _), g in zip(rows, group, strict=True):
        lowest[g] = min(lowest[g], i)
    want = sorted((i, f, lowest[g]) for (i, _), f, g in zip(rows, fps, group, strict=True))
    got = simhash.near_copies(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.fp % 2 ** 64, r.component_id) for r in got) == want


def test_links_of_dense_and_sparse_fingerprints(spark):
    rng = np.random.default_rng(5)
    near = [1234567890123456789 ^ sum(1 << int(b) for b in rng.choice(64, 2, replace=False)) for _ in range(200)]
    apart = [int(x) for x in rng.integers(0, 2 ** 63, 300, dtype=np.uint64)]
    chain = [0xF0F0F0F0F0F0F0F0 ^ (2 ** (3 * k) - 1) for k in range(15)]
    fps = sorted({*near, *apart, *chain})
    edges = simhash.links(spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp bigint"))
    root = {r.node: r.root for r in components.components(edges).collect()}
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    got = [root.get(f, f) for f in signed]
    want = groups(fps)
    assert len(set(got)) == len(set(want)) == len(set(zip(got, want, strict=True)))


def test_null_ids_and_empty_tables(spark):
    got = simhash.near_copies(frame(spark, [(None, "a b c"), (4, "a b c"), (None, "x")])).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == sorted([(None, 4), (4, 4), (None, None)], key=str)
    assert simhash.near_copies(frame(spark, [])).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, k) for k in range(200, 400)] + [(7, 7), (9, 8), (8, 9), (8, 9)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert {found[i] for i in range(100, 161)} == {100}
    assert {found[i] for i in range(200, 400)} == {1} and found[9] == found[8] == 8 and 7 not in found
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
