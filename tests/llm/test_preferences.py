import random

from cellweave.llm import preferences as P

SCHEMA = "conv_id bigint, turn bigint, role string, text string, id string, turns int, pair string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, "clash", "clash") for r in rows], SCHEMA)


def safe(t):
    return t.replace(P.BEGIN, "< |im_start|>").replace(P.END, "< |im_end|>")


def render(turns):
    text, spans = "", []
    for role, said in turns:
        text += f"{P.BEGIN}{safe(role)}\n"
        start = len(text)
        text += safe(said) + P.END
        if role == "assistant":
            spans.append((start, len(text)))
        text += "\n"
    return text, spans


def brute(rows):
    conv = {}
    for c, n, role, text in {r for r in rows if r[0] is not None}:
        conv.setdefault(c, []).append((n, role, text))
    key = lambda t: tuple((x is not None, x) for x in t)
    conv = {c: [(r or "user", t or "") for _, r, t in sorted(v, key=key)] for c, v in conv.items()}
    last = {c: max((k for k, (r, _) in enumerate(v) if r == "assistant"), default=None) for c, v in conv.items()}
    out = []
    for c, v in conv.items():
        o = c ^ 1
        if last[c] is None or last.get(o) is None:
            continue
        good, bad = v[:last[c] + 1], v[:last[c]] + [conv[o][last[o]]]
        n = 0
        while n < len(good) and good[n] == bad[n]:
            n += 1
        out.append((c, n, render(good[:n])[0], *render(good[n:]), *render(bad[n:])))
    return sorted(out)


def corpus():
    rng = random.Random(4)
    rows = []
    for c in range(40):
        for n in range(rng.randint(1, 6)):
            rows.append((c, n, rng.choice(["user", "assistant", "assistant", "system", None]), rng.choice(["hi", "é𝄞 text", "", None, f"{P.BEGIN}user {P.END}"])))
    return rows + rows[:10] + [(None, 0, "user", "x"), (50, None, "assistant", "a"), (51, 0, "assistant", "b"), (51, 0, "assistant", "a"),
                               (60, 0, "assistant", "long " * 50_000), (61, 0, "assistant", "c"), (70, 0, "assistant", "same"), (71, 0, "assistant", "same"), (80, 0, "assistant", "alone")]


def collected(frame_):
    rows = P.formatted(P.last_answer_pairs(frame_)).collect()
    return sorted((r.pair.pair_id, r.prompt_turns, r.prompt, r.chosen, [tuple(s) for s in r.chosen_spans], r.rejected, [tuple(s) for s in r.rejected_spans]) for r in rows)


def test_equals_brute_force(spark):
    assert collected(frame(spark, corpus())) == brute(corpus())


def test_own_pairs_with_longer_shared_prefix(spark):
    a = [("user", "q"), ("assistant", "1"), ("user", "r"), ("assistant", "2")]
    b = [("user", "q"), ("assistant", "1"), ("assistant", "3"), ("user", "s")]
    pairs = spark.createDataFrame([(1, a, b, "x"), (2, a, a, "x"), (3, a, a[:2], "x"), (4, None, b, "x"), (5, [], [], "x")],
                                  "pair_id int, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>, n string")
    got = {r.pair.pair_id: r for r in P.formatted(pairs).collect()}
    assert [got[k].prompt_turns for k in range(1, 6)] == [2, 4, 2, 0, 0]
    for r in got.values():
        assert r.prompt + r.chosen == render([tuple(t) for t in r.pair.chosen or []])[0]
        assert r.prompt + r.rejected == render([tuple(t) for t in r.pair.rejected or []])[0]
    assert [got[1].rejected[s.start:s.end] for s in got[1].rejected_spans] == ["3" + P.END] and got[2].chosen == ""


def test_empty_table_and_no_python(spark):
    found = P.formatted(P.last_answer_pairs(frame(spark, [])))
    assert found.count() == 0 and "Python" not in found._jdf.queryExecution().executedPlan().toString()
