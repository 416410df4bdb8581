import hashlib
import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cellweave.llm import mixing

SCHEMA = "doc_id bigint, text string, source string, size string, target int, nth string, doc string, n int"


def brute(rows, mix):
    sized = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, s in rows]
    total = defaultdict(int)
    for _, s, n in sized:
        total[s] += n
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mix.weights[k % len(mix.weights)] for k, s in enumerate(order)}
    left, open_, target = mix.share * sum(total.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= mix.most * total[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            target[s] = mix.most * total[s]
            left -= target[s]
        open_ -= full
    taken = []
    for s in order:
        mine = sorted((n, (-1 if i is None else i % mixing.BLOCKS), i if i is not None else -1) for i, of, n in sized if of == s)
        rate = min(target[s] / total[s], mix.most) if total[s] else 0.0
        u = int(hashlib.md5(f"{mix.seed}:{s or ''}{'?' if s is None else ''}".encode()).hexdigest()[:8], 16) / 2 ** 32
        taken += [(i if b >= 0 else None, s, n, math.floor(rate * (k + 1) + u) - math.floor(rate * k + u)) for k, (n, b, i) in enumerate(mine)]
    return target, taken


ROWS = ([(i, "w " * (i % 37), f"s{i % 7}") for i in range(300)] + [(i, None if i % 2 else "one two", None) for i in range(300, 330)]
        + [(7, "same row twice", "s1")] * 5 + [(None, "no id", "s2"), (None, "no id", "s2"), (900, " ", "empty"), (901, "", "none"), (902, "x " * 40_000, "s3")])


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "clash", 1, "clash", "clash", 2) for i, t, s in rows], SCHEMA)


@pytest.mark.parametrize("mix", [mixing.Mix(), mixing.Mix((1,), 0.3), mixing.Mix((9, 1, 1, 1), 1.9)])
def test_decisions_equal_brute_force(spark, mix):
    got = mixing.decide(frame(spark, ROWS), mix).collect()
    target, want = brute(ROWS, mix)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(((r.doc_id, r.source, r["size"], r.copies) for r in got), key=key) == sorted(want, key=key)
    for r in got:
        assert r.target == pytest.approx(target[r.source])
        assert 0 <= r.copies <= mix.most
    for s in target:
        largest = max(r["size"] for r in got if r.source == s)
        assert abs(sum(r.copies * r["size"] for r in got if r.source == s) - target[s]) <= 2 * largest


def test_rows_come_out_as_often_as_decided(spark):
    docs = frame(spark, ROWS)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    got = {(r.doc_id, r.source, r.n): r["count"] for r in out.groupBy("doc_id", "source", F.length("text").alias("n")).count().collect()}
    want = defaultdict(int)
    sizes = {(i, s): t for i, t, s in ROWS}
    for i, s, n, k in brute(ROWS, mixing.Mix())[1]:
        t = sizes[i, s]
        if k:
            want[i, s, None if t is None else len(t)] += k
    assert got == dict(want)


def test_rows_without_an_id_are_spread(spark):
    rows = [(None, f"word {n} " * (n % 3), "s") for n in range(600)] + [(n, "other words here", "s") for n in range(600)] + [(None, "same row", "t")] * 50
    docs = frame(spark, rows)
    out = mixing.mixed(docs)
    decided = mixing.decide(docs)
    counted = lambda df, n: {(r.source, r["size"]): r.n for r in df.groupBy("source", "size").agg(n.alias("n")).collect()}
    got = counted(out.withColumn("size", mixing.word_count(F.col("text"))), F.count(F.lit(1)))
    assert got == {k: n for k, n in counted(decided, F.sum("copies")).items() if n}
    of = out.where("doc_id is null and source = 's' and text <> ''").groupBy("text").count().agg(F.max("count")).first()[0]
    assert of <= 2
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(doc_id" not in plan and "hashpartitioning(doc_id" not in plan


def test_empty_table(spark):
    assert mixing.decide(frame(spark, [])).count() == 0
    assert mixing.mixed(frame(spark, [])).count() == 0
