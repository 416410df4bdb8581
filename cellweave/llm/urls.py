"""URL filter: rules first, else naive Bayes over the words of a segmented host and path.

Names in hosts are run together. A label of a host is split by the most probable sequence of words (Viterbi) under
unigram counts of the words of all pages and of the labelled names; its candidate pieces meet the counts in a join, so
that no word list is held in one place. Words of the host and tokens of the path are then scored by multinomial naive
Bayes: the allowed class is estimated from all paths and all distinct hosts with less than two words of labelled names, the blocked class from the labelled names
(``BLOCKED``, a parameter of fixed size) mixed with the allowed one. Tokens are hashed into ``BUCKETS`` places, so
the model has a fixed size whatever the corpus.

A rule is ``host`` + ``path``; it fits its host and all subdomains where the path begins with the rule's. The longest rule
that fits wins; of equally long ones a blocking one, then the smaller. Rules are grouped by host and meet the distinct
hosts; a page then carries the rules of its host, so a host with many rules or many pages multiplies no rows.

Defined cases: a null url or one without ``://`` has an empty host and path, and is judged by the method; a label of more than
63 letters (longer than a host name allows) is one word; numbers are one token; repeated rows are judged each; an empty
table gives an empty table.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from cellweave.llm.common import hinted, lower_ascii, packed, stored

RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))

# Labelled names of hosts to block, as words. The bounded sample the blocked class is fitted on.
BLOCKED = ("cheap pills", "pills online", "online pharmacy", "discount viagra", "buy cialis", "weight loss pills", "miracle diet",
           "spam farm", "link farm", "spam mail", "bulk mail", "buy links", "casino bonus", "free casino", "online poker", "slot casino",
           "sports betting", "bet now", "adult video", "free porn", "sex cams", "xxx video", "hot dating", "escort girls", "warez download",
           "free crack", "serial keys", "torrent warez", "fake watches", "replica watches", "fake id", "phishing login", "malware download",
           "free ringtones", "payday loan", "cheap loans", "quick loan", "crypto scam", "get rich", "click farm", "free bets", "live bets",
           "casino jackpot", "win jackpot", "win money", "adult x rated", "adult dating", "ad tracker", "ads server", "click track", "popup ads")

BUCKETS = 1 << 16
# Words of a host label are at most this long, and labels beyond the limit of host names are not split.
LONGEST_WORD, LONGEST_LABEL = 20, 63
# Share of pages to block, and of the tokens of their urls that come from the labelled names.
PRIOR_BLOCKED, NAMED_SHARE = 0.05, 0.3
# A token of the allowed class is taken to be at least this frequent.
RARE = 1e-4
_MARKUP = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>|&#?[a-z0-9]+;"


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(text: Column) -> Column:
    """Runs of letters and digits, numbers as ``0``."""
    parts = F.filter(F.split(lower_ascii(text), r"[^a-z0-9\x80-\x{10FFFF}]+"), lambda x: x != "")
    return F.transform(parts, lambda x: F.when(x.rlike(r"^[0-9]+$"), "0").otherwise(x))


def word_counts(pages: DataFrame, page: str = "html", extra: tuple[str, ...] = BLOCKED) -> DataFrame:
    """``word, n``: words of letters a-z in all pages; labelled names count as often as a word in a thousand pages."""
    words = pages.select(F.explode_outer(F.split(F.lower(F.regexp_replace(F.coalesce(F.col(f"`{page}`"), F.lit("")), _MARKUP, " ")),
                                                 "[^a-z]+")).alias("word"))
    given = pages.sparkSession.createDataFrame([(w, 1000) for name in extra for w in name.split()], "word string, n int")
    counted = words.where(F.col("word").isNotNull() & (F.col("word") != "") & (F.length("word") <= LONGEST_WORD)).select("word", F.lit(1).alias("n"))
    return counted.groupBy("word").agg(F.sum("n").alias("n")).union(given).groupBy("word").agg(F.sum("n").cast("bigint").alias("n"))


def best_split(label: str, pieces: dict[tuple[int, int], int], total: int) -> list[str]:
    """The most probable words of a label; a piece never seen costs tenfold per letter."""
    n = len(label)
    best, back = [0.0] + [-math.inf] * n, [0] * (n + 1)
    for j in range(1, n + 1):
        for i in range(max(0, j - LONGEST_WORD), j):
            seen = pieces.get((i, j), 0)
            score = best[i] + (math.log(seen / total) if seen else math.log(10.0 / total) - (j - i) * math.log(10.0))
            if score > best[j]:
                best[j], back[j] = score, i
    out, j = [], n
    while j:
        out.append(label[back[j]:j])
        j = back[j]
    return out[::-1]


def segmented(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """``label, words`` of the distinct labels of ``label``."""
    total = counts.agg(F.sum("n")).first()[0] or 1
    name = labels.select("label").where(F.length("label") <= LONGEST_LABEL)
    ends = F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("label") - F.col("i")))
    pieces = (name.select("label", F.explode(F.sequence(F.lit(0), F.length("label") - 1)).alias("i"))
              .select("label", "i", F.explode(ends).alias("long"))
              .select("label", "i", (F.col("i") + F.col("long")).alias("j"), F.expr("substring(label, i + 1, long)").alias("word")))
    known = pieces.join(counts, "word").groupBy("label").agg(
        F.collect_list("i").alias("i"), F.collect_list("j").alias("j"), F.collect_list("n").alias("n"))

    @F.pandas_udf(ArrayType(StringType()))
    def split(label: pd.Series, i: pd.Series, j: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([
            [text] if len(text) > LONGEST_LABEL or a is None else
            best_split(text, dict(zip(zip(map(int, a), map(int, b), strict=True), map(int, c), strict=True)), total)
            for text, a, b, c in zip(label, i, j, n, strict=True)])

    return labels.join(known, "label", "left").select("label", split("label", "i", "j", "n").alias("words"))


def bucket(kind: str, token: Column) -> Column:
    return (F.crc32(F.concat(F.lit(f"{kind} "), token)) % BUCKETS).cast("int")


def _place(kind: str, token: str) -> int:
    return zlib.crc32(f"{kind} {token}".encode()) % BUCKETS


def weights(seen: DataFrame, blocked: tuple[str, ...] = BLOCKED) -> np.ndarray:
    """Log odds of being blocked per bucket, from ``bucket, n`` of the allowed class and the labelled names."""
    allowed = np.zeros(BUCKETS)
    for r in seen.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        allowed[r["bucket"]] += r["n"]
    allowed = np.maximum(allowed / max(1.0, allowed.sum()), RARE)
    named = np.zeros(BUCKETS)
    for name in blocked:
        for word in name.split():
            for kind in ("host", "path"):
                named[_place(kind, word)] += 1
    return np.log(NAMED_SHARE * named / max(1.0, named.sum()) / allowed + (1 - NAMED_SHARE))


def judged(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, url: str = "url", page: str = "html",
           blocked: tuple[str, ...] = BLOCKED) -> DataFrame:
    """All columns of ``pages`` but the text packed as ``page``, with ``host, path, rule, verdict, score, words``.

    ``score`` is the method's probability of being blocked, whether or not a rule decides.
    """
    spark = pages.sparkSession
    kept = [c for c in pages.columns if c != page]
    rows = pages.select(packed(pages.select(*[f"`{c}`" for c in kept])).alias("page"), host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"))
    hosts = stored(rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages")))
    counts = word_counts(pages, page, blocked)

    each = hosts.select("host", F.posexplode(tokens(F.col("host"))).alias("at", "label"))
    split = segmented(each.select("label").distinct(), stored(counts))
    worded = stored(each.join(split, "label").groupBy("host").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "words"))), lambda x: x["words"])).alias("words")))

    lexicon = sorted({w for name in blocked for w in name.split()})
    plain = worded.where(F.size(F.array_intersect("words", F.array(*[F.lit(w) for w in lexicon]).cast("array<string>"))) < 2)
    in_hosts = plain.select(F.explode("words").alias("t")).groupBy(bucket("host", F.col("t")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    in_paths = (rows.select(F.explode(tokens(F.col("path"))).alias("t")).groupBy(bucket("path", F.col("t")).alias("bucket"))
                .agg(F.count(F.lit(1)).alias("n")))
    shared = spark.sparkContext.broadcast(weights(in_hosts.union(in_paths), blocked))
    prior = math.log(PRIOR_BLOCKED / (1 - PRIOR_BLOCKED))

    @F.pandas_udf(DoubleType())
    def odds(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for kinds, lists in batches:
            yield pd.Series([float(sum(shared.value[_place(k, t)] for t in (ts if ts is not None else ()))) for k, ts in zip(kinds, lists, strict=True)])

    given = spark.createDataFrame([(r.partition("/")[0], "/" + r.partition("/")[2], r, v) for r, v in rules],
                                  "rule_host string, path string, rule string, verdict string")
    by_host = given.groupBy("rule_host").agg(F.collect_list(F.struct("path", "rule", "verdict")).alias("rules"))
    # Suffixes of as many labels as a rule's host has; no other can meet one.
    longest = max((r.partition("/")[0].count(".") + 1 for r, _ in rules), default=1)
    named = hosts.select("host", F.split("host", r"\.").alias("labels"))
    suffixes = named.select("host", F.explode(F.transform(
        F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(longest))),
        lambda k: F.array_join(F.slice("labels", F.size("labels") - k + 1, k), "."))).alias("rule_host")).distinct()
    ruled = suffixes.join(by_host, "rule_host").groupBy("host").agg(F.flatten(F.collect_list("rules")).alias("rules"))
    about = stored(hosts.select("host").join(worded, "host", "left").join(ruled, "host", "left").select(
        "host", "words", "rules", odds(F.lit("host"), "words").alias("host_odds")))
    fits = F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"]))
    best = F.element_at(F.array_sort(F.transform(fits, lambda r: F.struct(
        (-F.length(r["rule"])).alias("long"), (r["verdict"] != "block").alias("mild"), r["rule"].alias("rule"), r["verdict"].alias("verdict")))), 1)
    chosen = F.when(F.size(fits) > 0, best)
    total = F.col("host_odds") + odds(F.lit("path"), tokens(F.col("path"))) + F.lit(prior)
    scored = (rows.join(hinted(about, about.count()), "host").withColumn("score", 1 / (1 + F.exp(-total))).withColumn("chosen", chosen))
    return scored.select("page", "host", "path", F.col("chosen.rule").alias("rule"),
                         F.coalesce("chosen.verdict", F.when(F.col("score") > 0.5, "block").otherwise("allow")).alias("verdict"), "score", "words")
