import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cellweave.llm import collocations

SCHEMA = "doc_id bigint, text string, lang string, chunk string, n int, f int, phrase string, w string, starts string"


def frame(spark, rows):
    return spark.createDataFrame([(k, t, lang, "clash", 1, 2, "clash", "clash", "clash") for k, (t, lang) in enumerate(rows)], SCHEMA)


def brute(rows, least=10, best=2000):
    f, sizes = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall("[^ \t]+", piece)
            sizes[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        top = []
        for p, a in count.items():
            if len(p) > 1 and a >= least:
                score, _, l, r = min((10 ** 6 * a * a // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
                if not (len(p) == 2 and any(b >= least and len(q) == 3 and p in (q[:2], q[1:]) and 100 * b >= 50 * a for q, b in count.items())):
                    top.append((-score, -a, " ".join(p).encode(), l, r))
        for n, (score, a, p, l, r) in enumerate(sorted(top)[:best]):
            out.append((lang, n + 1, p.decode(), -a, l, r, sizes[lang], -score))
    return sorted(out)


def got(spark, rows, **more):
    return sorted(tuple(r) for r in collocations.collocations(frame(spark, rows), **more).collect())


@pytest.mark.parametrize("every,longest", [(12, 256), (2, 256), (10 ** 9, 5)])
def test_equals_brute_force_wherever_chunks_are_cut(spark, every, longest):
    rng = random.Random(every)
    vocabulary = [f"W{i}" for i in range(40)] + ["the", "Éa", "new", "York", "CITY", "𝒳x"]
    rows = [("", "en"), (None, "en"), (" \t ", None), ("x " * 3000, "fr"), ("one", "one-word"), ("a b", "und"), ("a\tb", None)]
    for k in range(120):
        words = []
        while len(words) < rng.randint(1, 120):
            words += rng.choice([["New", "york", "CITY"], ["new", "York"], [rng.choice(vocabulary)], [rng.choice(vocabulary)]])
            words[-1] += rng.choice(["", "", "", ".", ",", "\n", "!", "  ", "\t"])
        rows.append((" ".join(words), rng.choice(["en", "en", "de", None, "und"])))
    rows += rows[10:15] * 3
    assert got(spark, rows, every=every, longest=longest) == brute(rows)
    assert got(spark, rows, least=3, best=7, every=every, longest=longest) == brute(rows, 3, 7)


@pytest.mark.parametrize("every,longest", [(12, 256), (3, 7), (1, 256), (10 ** 9, 4)])
def test_every_start_belongs_to_one_chunk(every, longest):
    rng = random.Random(7)
    for n in [1, 2, 3, 4, 50, 500]:
        for words in ([rng.choice("abcde") for _ in range(n)], ["same"] * n):
            ends = sorted({n, *(rng.randint(1, n) for _ in range(n // 10))})
            found = Counter()
            for s, e, own in zip(*collocations.cuts(collocations._Hashes().of([x.encode() for x in words]), np.array(ends), every, longest), strict=True):
                assert own <= longest and e - s <= longest + 2
                for i in range(s, s + own):
                    found.update(tuple(words[i:i + k]) for k in (1, 2, 3) if i + k <= e)
            pieces = [words[a:b] for a, b in zip([0, *ends], ends)]
            assert found == Counter(tuple(w[i:i + k]) for w in pieces for k in (1, 2, 3) for i in range(len(w) - k + 1))


def test_a_repeated_passage_is_parsed_alike():
    rng = random.Random(2)
    words = [rng.choice("abcdefghij") * 2 for _ in range(300)]

    def cut(w):
        return {tuple(w[s:e]) for s, e, _ in zip(*collocations.cuts(collocations._Hashes().of([x.encode() for x in w]), np.array([len(w)]), 5), strict=True)}
    one, other = cut(["before"] + words), cut(["quite", "other"] + words + ["after"])
    assert len(one) > 20 and len(one & other) >= len(one) - 3


def test_buckets_only_leave_out_what_is_rare(spark):
    rows = [("a b c " * 3 + "d e " * 12, "en"), ("d e " * 5, "de")]
    parsed = collocations.stored(collocations.dictionary(frame(spark, rows)))
    assert {(r.lang, r.phrase): r.f for r in collocations.frequent_phrases(parsed, 10).collect()} == {
        ("en", "d"): 12, ("en", "e"): 12, ("en", "d e"): 12, ("en", "e d"): 11, ("en", "d e d"): 11, ("en", "e d e"): 11}


def test_large_counts_are_exact_and_empty_tables(spark):
    frequent = spark.createDataFrame([("en", "a", 3 * 10 ** 12 + 7), ("en", "b", 5 * 10 ** 12 + 1), ("en", "a b", 2 * 10 ** 12 + 9)], "lang string, phrase string, f bigint")
    sizes = spark.createDataFrame([("en", 10 ** 13)], "lang string, n bigint")
    r = collocations.scored(frequent, sizes).collect()[0]
    assert r.score == 10 ** 6 * (2 * 10 ** 12 + 9) ** 2 // ((3 * 10 ** 12 + 7) * (5 * 10 ** 12 + 1))
    assert got(spark, []) == []


def test_short_pieces_share_chunks_and_phrases_do_not_cross_marks(spark):
    rows = [(". ".join(f"a{i} b{i % 3}" for i in range(400)) + "...!? \n", "en"), ("...", "en"), ("b1.b1 a1 b1,,b1", "en"), ("w" * 300_000 + " a b " * 12, "a lang"),
            ("Ünï ſ x y " * 11, "de"), ("a b " * 12, "de")]
    chunks = collocations.dictionary(frame(spark, rows[:1])).collect()
    # 400 pieces; cut at triggers they were 400 chunks or more.
    assert len(chunks) < 250 and sum(r.n * r.own for r in chunks) == 800
    assert got(spark, rows) == brute(rows)


def test_buckets_are_shuffled_many_in_a_row(spark):
    rows = [(" ".join(f"w{i * k % 5003}" for i in range(20_000)), "en") for k in (1, 7)]
    parsed = collocations.dictionary(frame(spark, rows)).coalesce(1).toArrow().combine_chunks()
    sent = list(collocations._tallies(iter(parsed.to_batches()), 3, 4))
    assert sum(len(b) for b in sent) <= 1 << collocations._PART_BITS
    values = Counter((p, low) for b in sent for p, blob in zip(*b.to_pydict().values(), strict=True) for low in np.frombuffer(blob, dtype="<u4").tolist())
    assert len(values) > 25_000 and max(values.values()) == 4


def test_the_best_of_many_parts_are_ranked_as_one(spark):
    rows = [(" . ".join(f"x{i} y{i % 97}" for i in range(300)), "en")] * 10
    assert got(spark, rows, best=120) == brute(rows, best=120)
    plan = collocations.collocations(frame(spark, rows), best=120)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2
