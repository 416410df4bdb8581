import hashlib
import random
import re

import pytest

from cellweave.llm import decontaminate

DOC = "doc_id bigint, text string, id string, hash int, at int, window string, long int, doc string, item_id string"
ITEM = "item_id bigint, text string, id string, window string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    out = []
    for i, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, of in items:
            v = words(of)
            n = min(len(v), 10)
            for s in range(len(v) - n + 1) if v else ():
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == v[s:s + n]:
                        hit |= set(range(p, p + n))
                        found.add(str(item))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found - {"None"})).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def frames(spark, docs, items):
    return (spark.createDataFrame([(i, t, "clash", 1, 2, "clash", 3, "clash", "clash") for i, t in docs], DOC),
            spark.createDataFrame([(i, t, "clash", "clash") for i, t in items], ITEM))


def corpus():
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(60)] + ["Éa", "éa", "x-y", "A1"]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(some(rng.choice([10, 11, 25, 40])))) for k in range(20)]
    items += [(100, "lonely"), (101, "Two words"), (102, " ".join(some(5))), (103, " ".join(some(9))), (104, ""), (105, None), (106, "-- !!"),
              (107, "same same " * 12), (3, items[3][1])]
    docs = []
    for k in range(60):
        text = some(rng.choice([0, 3, 9, 10, 30, 200]))
        for _ in range(rng.randint(0, 3)):
            source = words(rng.choice(items)[1])
            a = rng.randrange(len(source) + 1)
            at = rng.randrange(len(text) + 1)
            text[at:at] = [x.upper() if x.isascii() else x for x in source[a:a + rng.choice([4, 9, 10, 12, 40])]]
        docs.append((k, rng.choice([" ", ", ", "\n"]).join(text)))
    docs += [(200, None), (201, ""), (202, "…!?"), (203, "same " * 300), (204, "Lonely\x00lonely"), (205, "w1 w2 " * 3000)]
    return docs, items


def test_equals_brute_force(spark):
    docs, items = corpus()
    got = decontaminate.contamination(*frames(spark, docs, items)).collect()
    assert sorted(tuple(r) for r in got) == brute(docs, items)


@pytest.mark.parametrize("limit", [0])
def test_a_large_benchmark_is_joined_by_shuffling(spark, monkeypatch, limit):
    from cellweave.llm import common
    monkeypatch.setattr(decontaminate, "hinted", lambda small, rows, *_: common.hinted(small, rows, limit))
    docs, items = corpus()
    got = decontaminate.contamination(*frames(spark, docs[:20], items)).collect()
    assert sorted(tuple(r) for r in got) == brute(docs[:20], items)


def test_filter_keeps_clean_rows_with_their_columns(spark):
    docs, items = corpus()
    docs += [(300, "clean"), (300, "clean"), (None, "clean too"), (None, items[0][1])]
    table, bench = frames(spark, docs, items)
    out = decontaminate.decontaminated(table, bench)
    numbered = [(n, t) for n, (_, t) in enumerate(docs)]
    bad = {r[0] for r in brute(numbered, items) if r[-1]}
    assert out.columns == table.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted((d for n, d in enumerate(docs) if n not in bad), key=str)
    assert (None, "clean too") in docs and len(docs) - 1 not in set(range(len(docs))) - bad


def test_every_row_is_a_document(spark):
    # A third without an id, two texts under one id, and equal rows.
    docs, items = corpus()
    docs = [(None if n % 3 == 0 else i, t) for n, (i, t) in enumerate(docs)]
    docs += [(1, "a b c d e f g h i j k"), (1, "zz"), (1, "zz"), (2, "q r"), (None, "a b c d"), (None, "z z z z z z")]
    items = items + [(None, "zz"), (5, "b c d e f g h i j k")]
    got = decontaminate.contamination(*frames(spark, docs, items)).collect()
    want = [(docs[r[0]][0], *r[1:]) for r in brute([(n, t) for n, (_, t) in enumerate(docs)], items)]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_empty_tables(spark):
    docs, items = corpus()
    assert decontaminate.contamination(*frames(spark, [], items)).count() == 0
    got = decontaminate.contamination(*frames(spark, docs[:5], [])).collect()
    assert len(got) == 5 and not any(r.contaminated for r in got)
    assert decontaminate.decontaminated(*frames(spark, docs[:5], [])).count() == 5


def test_no_python_in_the_plan(spark):
    docs, items = corpus()
    plan = decontaminate.contamination(*frames(spark, docs, items))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
