import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

from cellweave.llm import weighted

SCHEMA = "doc_id bigint, text string, id string, n int, term string, part string, head string, next_id int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1, "clash", "clash", "clash", 2) for i, t in rows], SCHEMA)


def test_collision_rate_is_the_generalised_jaccard_similarity(spark):
    rows, want = [], {}
    for pair in range(60):
        a = {t: 1 + (t * 7 + pair) % 9 for t in range(pair % 5, 30)}
        b = {t: 1 + (t * 5 + pair) % 9 for t in range(10, 30 + pair % 11)}
        want[pair] = sum(min(a.get(t, 0), b.get(t, 0)) for t in {*a, *b}) / sum(max(a.get(t, 0), b.get(t, 0)) for t in {*a, *b})
        rows += [(pair, hash((pair, t)) % 2 ** 60, a.get(t, 0), b.get(t, 0)) for t in {*a, *b}]
    draws = weighted.drawn(spark.createDataFrame(rows, "id bigint, term bigint, a bigint, b bigint"), ["id"], ["a", "b"], 512)
    same = F.size(F.filter(F.arrays_zip("a_draws", "b_draws"), lambda z: z["a_draws"] == z["b_draws"])) / 512
    for r in draws.select("id", same.alias("rate")).collect():
        assert abs(r.rate - want[r.id]) < 0.1
    mean = sum(r.rate - want[r.id] for r in draws.select("id", same.alias("rate")).collect()) / 60
    assert abs(mean) < 0.01


def test_query_rows(spark):
    rows = [(i, f"Word{i % 3} and some MORE words of text {i}, again and again É {'x ' * (i % 5)}") for i in range(0, 40, 2)]
    rows += [(100, rows[0][1]), (101, ""), (102, None), (103, "a"), (104, "ab"), (105, "long text of words " * 20_000), (None, "no id"), (7, "twice"), (7, "twice")]
    every = weighted.fingerprinted(frame(spark, rows)).collect()
    assert len(every) == len(rows)
    got = {r.doc_id: r for r in every}
    texts = {i: t or "" for i, t in rows}
    order = sorted((i for i in texts if i is not None), reverse=True) + [None]
    after = dict(zip(order, order[1:] + order[:1], strict=True))
    assert got.keys() == texts.keys()
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    for i, r in got.items():
        t, other = texts[i], texts[after[i]]
        half = len(t) // 2
        edited = t[:len(t) - half] + other[:half]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.near_next == 1) == (r.fingerprint == got[after[i]].fingerprint)
        same = Counter(lower(edited).split()) == Counter(lower(t).split())
        assert same <= (r.fingerprint == r.edited_fingerprint) and 0 <= r.near_edited <= 1
    assert got[100].fingerprint == got[0].fingerprint != got[2].fingerprint
    assert got[101].fingerprint == got[102].fingerprint == "0" * 4 * weighted.SAMPLES
    assert got[102].near_edited == 1 and got[103].near_next == 0


def test_one_document_and_none(spark):
    (only,) = weighted.fingerprinted(frame(spark, [(1, "a b c d")])).collect()
    assert only.near_next == 1 and only.edited_sha256 == hashlib.sha256(b"a b a b"[:4] + b"a b").hexdigest()
    assert weighted.fingerprinted(frame(spark, [])).count() == 0


def test_neighbours_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(weighted, "_RANGE", 7)
    names = [(k * k // 90, k * 31 % 60 - 30) for k in range(60)]
    table = spark.createDataFrame(names, "id bigint, hash bigint")
    got = {(r.id, r.hash): (r.next_id, r.next_hash) for r in weighted.neighbours(table).collect()}
    down = sorted(names, reverse=True)
    assert got == dict(zip(down, down[1:] + down[:1], strict=True))


def test_rows_without_an_id_and_texts_under_one_id(spark):
    rows = [(None, f"text number {i}") for i in range(12)] + [(None, "text number 3"), (7, "one"), (7, "another text"), (-(1 << 63), "lowest id"), (8, "x y")]
    rows += [(i, f"plain {i}") for i in range(20, 40)]
    got = weighted.fingerprinted(frame(spark, rows)).collect()
    ids = Counter((r.doc_id, r.n_chars) for r in got)
    assert ids == Counter((i, len(t)) for i, t in rows)
    # Each distinct document is the neighbour of exactly one: the edited texts are those of some order that holds the contract's.
    heads = {(r.doc_id, r.edited_sha256) for r in got}
    want = lambda t, other: hashlib.sha256((t[:len(t) - len(t) // 2] + other[:len(t) // 2]).encode()).hexdigest()
    assert (20, want("plain 20", "x y")) in heads
    assert (8, want("x y", "one")) in heads or (8, want("x y", "another text")) in heads


def test_likeness_of_real_documents_at_the_number_in_use(spark):
    """Each likeness by itself against the exact generalised Jaccard similarity: mean error, and the share off by more than 0.1."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    down = sorted(texts, reverse=True)
    after = dict(zip(down, down[1:] + down[:1], strict=True))
    count = lambda t: Counter(w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) if w)
    words = {i: count(t) for i, t in texts.items()}
    edited, following = [], []
    for r in weighted.fingerprinted(docs).collect():
        t, half = texts[r.doc_id], len(texts[r.doc_id]) // 2
        a = words[r.doc_id]
        for off, b, near in ((edited, count(t[:len(t) - half] + texts[after[r.doc_id]][:half]), r.near_edited), (following, words[after[r.doc_id]], r.near_next)):
            both = sum((a | b).values())
            off.append(abs(near - (sum((a & b).values()) / both if both else 1.0)))
    for off, mean, share in ((edited, 0.06, 0.14), (following, 0.03, 0.04)):
        assert sum(off) / len(off) < mean and sum(o > 0.1 for o in off) < share * len(off)
