import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from cellweave.llm import prefixes

SCHEMA = "conv_id bigint, turn bigint, role string, text string, path string, lens int, n string, shard string, side int, turns int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, "clash", "clash", 2, 3) for r in rows], SCHEMA)


def digest(role, text):
    role, text = (role or "").encode(), (text or "").encode()
    return hashlib.sha256(str(len(role)).encode() + b":" + role + text).hexdigest()


def brute(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, digest(role, text), role or "", text or ""))
    turns = {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}
    members = defaultdict(list)
    full = defaultdict(list)
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        base = (abs(c) // 100 * 100) * (1 if c >= 0 else -1)
        seq = tuple(turns.get(base, [])[:h] + turns[c][h:])
        full[seq].append(c)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    saved, leaves = defaultdict(int), defaultdict(int)
    for node, ids in members.items():
        for e in range(len(node) + 1):
            saved[node[:e]] += (len(ids) - 1) * (len(node[-1][1]) if node else 0)
            leaves[node[:e]] += node not in children
    return sorted(((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), children.get(node, 0), leaves[node], saved[node],
                    hashlib.sha256(",".join(map(str, sorted(full.get(node, [])))).encode()).hexdigest()) for node, ids in members.items()), key=str)


def got(found):
    assert found.columns == COLUMNS
    return sorted((tuple(r) for r in found.collect()), key=str)


def conversations(rng, n, words, hot=0.0):
    rows = []
    for c in range(n):
        if rng.random() < hot:
            texts = ["the same", "conversation", "again"]
        else:
            texts = [rng.choice(words) for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 8]))]
        rows += [(c, t, rng.choice(["user", "assistant"]) if rng.random() < 0.1 else "user", x) for t, x in enumerate(texts)]
    return rows


@pytest.mark.parametrize("cells,hot", [(500_000, 0.4), (400, 0.0), (60, 0.4)])
def test_equals_brute_force(spark, cells, hot):
    rng = random.Random(cells)
    rows = conversations(rng, 700, ["a", "bb", "ccc", "é𝒳", ""], hot)
    rows += [(None, 1, "user", "no conversation"), (None, None, None, None), (801, None, None, None), (801, 3, "user", None), (802, 1, "user", "tie"),
             (802, 1, "user", "tie"), (802, 1, "user", "other tie"), (-5, 0, "user", "a"), (-100, 0, "user", "bb"), (-105, 7, "user", "a"), (10 ** 18 + 1, 0, "user", "a")]
    rows += [(900, t, "user", f"turn {t % 7}") for t in range(400)]  # a very long one
    rng.shuffle(rows)
    assert got(prefixes.conversation_trie(frame(spark, rows), cells)) == brute(rows)


def test_many_rounds_of_shards_recombine(spark):
    # Shards of very few rows in the worker: several rounds until one is left.
    rng = random.Random(9)
    rows = conversations(rng, 400, ["a", "bb", "c"], 0.2)
    found = prefixes.stored(prefixes.sequences(prefixes.rebuilt(prefixes.turns_of(frame(spark, rows)))))
    assert got(prefixes.trie(found, 70, 40)) == got(prefixes.trie(found, 2)) == brute(rows)


def test_turnless_single_and_empty(spark):
    # 3 has fewer turns than its family would share, and the family's first conversation is absent.
    short = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 == 5)
    rows = [(short, 0, "user", "gone")]
    assert got(prefixes.conversation_trie(frame(spark, rows))) == brute(rows) == [
        (short, 0, None, 1, 0, 1, 0, hashlib.sha256(str(short).encode()).hexdigest())]
    rows = [(100, 0, "user", "x" * 300_000), (100, 1, None, None)]
    assert got(prefixes.conversation_trie(frame(spark, rows))) == brute(rows)
    assert got(prefixes.conversation_trie(frame(spark, []))) == []


def test_registered_query_on_the_given_table(spark):
    from cellweave.llm import queries
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.QUERIES["op13_prefix_trie"](spark, "/root/testdata/sf0.01")) == brute(rows)
