import pytest
from pyspark.sql import functions as F

from cellweave.llm import urls

SCHEMA = "page_id bigint, url string, html string, host string, path string, words string, rule string, label string, n int"


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", "clash", "clash", "clash", "clash", 1) for i, u, h in rows], SCHEMA)


URLS = [
    "https://a.Example.ORG/es/1?x=/en/1", "http://example.org/en/17", "http://notexample.org/en/17", "https://x.com/fr/", "https://x.com/fr",
    "https://x.com/de/a#b", "http://org/", "http://org", "ftp://h.net?q=://z.com/de/", "no scheme", "", None, "a://b://com/de/", "http://É.Example.org/es/É",
    "http://www.cheappills.example.net/en/1", "http://www.cheap-pills.example.net/buy", "http://thegardenhouse.example.net/en/9", "http://com/fr/x",
    "http://" + "q" * 5000 + ".net/" + "p/" * 5000, "http://.../x", "http://1.2.3.4:80/a", "://com/de/q", "http://x.com/de/\nzz",
]


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = next((k for k, c in enumerate(rest) if c in "/?#"), len(rest))
    tail = rest[n:]
    m = next((k for k, c in enumerate(tail) if c in "?#"), len(tail))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n]), tail[:m]


def rule_of(host, path):
    fits = [(r, v) for r, v in urls.RULES for h, _, p in [r.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fits, key=lambda f: len(f[0]), default=(None, None))


@pytest.fixture(scope="module")
def found(spark):
    text = "<p>the garden house is the house of a garden</p><script>cheappills</script>" * 5
    rows = [(i, u, text if i % 2 else None) for i, u in enumerate(URLS)] + [(1, URLS[1], text)]
    return urls.judged(frame(spark, rows)).collect()


def test_hosts_paths_and_rules(found):
    assert len(found) == len(URLS) + 1
    for r in found:
        host, path = split(URLS[r.page.page_id])
        rule, verdict = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.score > 0.5 else "allow")) and 0 <= r.score <= 1


def test_the_method_judges_run_together_names(found):
    by = {r.page.page_id: r for r in found}
    assert by[14].words[1:3] == ["cheap", "pills"] and by[14].verdict == by[15].verdict == "block"
    assert by[16].words[:3] == ["the", "garden", "house"] and by[16].verdict == "allow"
    assert by[18].words[0] == "q" * 5000 and by[9].verdict == "allow"


def test_viterbi_takes_the_most_probable_split():
    pieces = {(0, 3): 50, (3, 6): 40, (0, 6): 1, (0, 1): 500}
    assert urls.best_split("thecat", pieces, 1000) == ["the", "cat"]
    assert urls.best_split("thecat", {(0, 6): 900}, 1000) == ["thecat"]
    assert urls.best_split("zzzz", {}, 1000) == ["zzzz"] and urls.best_split("", {}, 10) == []


def test_counts_are_of_visible_words(spark):
    pages = frame(spark, [(1, None, "<p class='no'>Yes yes &amp; so</p><style>never</style><!-- nor -->"), (2, None, None)])
    got = {r.word: r.n for r in urls.word_counts(pages, extra=("so much",)).collect()}
    assert got == {"yes": 2, "so": 1001, "much": 1000}


def test_longest_rule_and_ties(spark):
    rules = (("a.org/x", "allow"), ("org/xyzw", "block"), ("org/", "allow"))
    got = urls.judged(frame(spark, [(1, "http://a.org/xyzw", ""), (2, "http://b.org/xyzw", ""), (3, "http://a.org/xy", "")]), rules).collect()
    assert {r.page.page_id: r.rule for r in got} == {1: "org/xyzw", 2: "org/xyzw", 3: "a.org/x"}


def test_empty_table(spark):
    assert urls.judged(frame(spark, [])).count() == 0


def test_host_words_of_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = urls.judged(pages).where(F.array_join("words", "") != F.regexp_replace("host", r"[^a-z]", ""))
    assert got.count() == 0
