"""Benchmark decontamination by winnowing.

A text keeps, of every ``WINDOW`` consecutive hashes of ``K`` words, the smallest. Two texts that share ``SPAN`` = K + WINDOW - 1
words keep a common hash of the shared span, so joining the kept hashes of documents and benchmark misses no shared span.
Each kept hash of a document carries the words a span around it can reach; a hit is extended over them, comparing words.

An item with fewer words than a span is one window of its own length L, winnowed with single words: of every L
consecutive words the smallest hash is kept. Only lengths that occur in the benchmark are added.

The words of a document are counted by the same reading: a row with no hash carries the count through the join.

The benchmark is the small side. Its hashes are counted and broadcast up to ``BROADCAST_ROWS``; a larger benchmark is
joined by shuffling. Documents are read in place, and only hits are moved. Hit words are counted per document as the
length of a union of intervals, in one ordered pass.

Defined cases: a null or wordless text has no words, no hits and no windows; every row is a document of its own, whether its
id is null or stands twice, and equal rows are worked on once and returned as often as they stand; items without an id are one
item that hits words and counts, but is not in the list of ids; repeated item ids are one item.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.common import BROADCAST_ROWS, hinted, lower_ascii, packed, stored, unpacked

SPAN, K = 10, 5
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# A kept hash and its place in one number: 33 bits of hash above 30 bits of place.
_PLACE = 30
# Numbers below zero are no hashes: under them the number of words goes through the join, spread over so many keys.
COUNTS = 1024


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _minima(grams: Column, k: int, window: int) -> Column:
    """The kept numbers; the last windows would reach beyond the text and are cut off."""
    least = F.transform(grams, lambda x, i: F.least(x, *[F.get(grams, i + n) for n in range(1, window)]) if window > 1 else x)
    n = F.size(grams) - (k + window - 2)
    return F.array_distinct(F.when(n > 0, F.slice(least, F.lit(1), F.greatest(n, F.lit(0)))).otherwise(F.array().cast("array<bigint>")))


def _kept_rows(df: DataFrame, carry: list[str], k: int, window: int, around: bool) -> DataFrame:
    """``carry, hash, at`` of every kept hash of ``words``; with ``around`` also the words a span can reach, and its start.

    With ``around`` a text also gets a row with a hash below zero, whose ``at`` is the number of its words.
    """
    span = k + window - 1
    gram = lambda x, i: F.xxhash64(x, *[F.get(F.col("hashes"), i + n) for n in range(1, k)])
    grams = df.withColumn("grams", F.transform("hashes", lambda x, i: F.shiftleft(
        gram(x, i).bitwiseAND(F.lit((1 << 33) - 1)), _PLACE).bitwiseOR(i.cast("bigint"))))
    numbers = grams.withColumn("numbers", _minima(F.col("grams"), k, window))
    place = lambda x: x.bitwiseAND(F.lit((1 << _PLACE) - 1)).cast("int")
    first = lambda x: F.greatest(place(x) - (span - k), F.lit(0))
    fields = lambda x: [F.shiftrightunsigned(x, _PLACE).alias("hash"), place(x).alias("at")] + ([
        first(x).alias("start"), F.slice("words", first(x) + 1, place(x) + span - first(x)).alias("near")] if around else [])
    # The outer form, since before an inner one the optimizer computes the array once more to test its size.
    each = F.transform("numbers", lambda x: F.struct(*fields(x)))
    if around:
        count = F.struct((-1 - F.pmod(F.xxhash64(*carry), F.lit(COUNTS))).alias("hash"), F.size("words").alias("at"), F.lit(0).alias("start"), F.array().cast("array<string>").alias("near"))
        each = F.concat(F.array(count), each)
    each = F.explode_outer(each).alias("kept")
    return numbers.select(*carry, each).where("kept is not null").select(*carry, "kept.*")


def _hashed(df: DataFrame, key: str, text: str) -> DataFrame:
    split = df.select(F.col(f"`{key}`").alias("id"), words(F.col(f"`{text}`")).alias("words"))
    return split.withColumn("hashes", F.transform("words", lambda x: F.xxhash64(x)))


def windows_of(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """``id, long, window``: the windows of every item, as words joined by spaces."""
    split = benchmark.select(F.col(f"`{key}`").alias("id"), words(F.col(f"`{text}`")).alias("words")).where(F.size("words") > 0)
    long = F.least(F.size("words"), F.lit(SPAN))
    return (split.select("id", long.alias("long"), F.explode(F.transform(
        F.sequence(F.lit(1), F.size("words") - long + 1), lambda i: F.array_join(F.slice("words", i, long), " "))).alias("window"))
        .distinct())


def _anchors(docs: DataFrame, windows: DataFrame, long: int) -> DataFrame:
    """``id, hash, at, start, near``: kept hashes that documents share with windows of ``long`` words, and counts of words."""
    k, window = (K, SPAN - K + 1) if long == SPAN else (1, long)
    sides = windows.where(F.col("long") == long).withColumn("words", F.split("window", " "))
    sides = sides.withColumn("hashes", F.transform("words", lambda x: F.xxhash64(x)))
    marks = stored(_kept_rows(sides, [], k, window, False).select("hash").distinct().union(
        docs.sparkSession.range(-COUNTS, 0).toDF("hash")))
    return _kept_rows(_hashed(docs, "id", "text"), ["id"], k, window, True).join(hinted(marks, marks.count()), "hash")


def _extended(anchors: DataFrame, windows: DataFrame, long: int) -> DataFrame:
    """``id, start, long, window``: the windows that occur around anchors, word by word."""
    same = windows.where(F.col("long") == long).select("window", "long")
    reached = anchors.where("hash >= 0").select("id", F.explode(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("near") - long, F.lit(0))),
        lambda o: F.struct((F.col("start") + o).alias("start"), F.array_join(F.slice("near", o + 1, long), " ").alias("window")))).alias("w"))
    return reached.select("id", "w.*").join(hinted(same, same.count()), "window").select("id", "start", "long", "window").distinct()


def _name(key: str, text: str) -> Column:
    """What tells documents apart: the id and the text. Structs are equal where nulls meet nulls."""
    return F.struct(F.col(f"`{key}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("text_hash"))


def hits(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
         item_key: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``id, start, long, window``: every place of a document where a window of the benchmark occurs; and ``id, n_words, n_rows``.

    ``id`` is a struct that names the document, ``n_rows`` how many rows are that document.
    Documents are read once per length of windows, which is once unless the benchmark has items shorter than a span.
    """
    once = docs.select(_name(key, text).alias("id"), F.col(f"`{text}`").alias("text"))
    windows = stored(windows_of(benchmark, item_key, item_text).select("long", "window").distinct())
    lengths = sorted((r["long"] for r in windows.select("long").distinct().collect()), reverse=True) or [SPAN]
    anchors = [(long, stored(_anchors(once, windows, long))) for long in lengths]
    found = reduce(DataFrame.union, (_extended(rows, windows, long) for long, rows in anchors))
    sizes = anchors[0][1].where("hash < 0").groupBy("id").agg(
        F.max("at").cast("bigint").alias("n_words"), F.count(F.lit(1)).alias("n_rows"))
    return found, sizes


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                  item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``: one row per row."""
    places, sizes = hits(docs, benchmark, key, text, item_key, item_text)
    found = stored(places)
    far = Window.partitionBy("id").orderBy("start", "long").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("long")
    covered = found.select("id", "start", "long").distinct().withColumn(
        "fresh", F.greatest(F.lit(0), end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(far), F.lit(0)))))
    n_hit = covered.groupBy("id").agg(F.sum("fresh").cast("bigint").alias("n_hit"))
    owners = stored(windows_of(benchmark, item_key, item_text).select(F.col("id").alias("item"), "long", "window").distinct())
    items = (found.select("id", "long", "window").distinct().join(hinted(owners, owners.count()), ["long", "window"])
             .select("id", F.col("item").cast("string").alias("item")).distinct())
    listed = items.groupBy("id").agg(F.count(F.lit(1)).alias("n_items"),
                                     F.sha2(F.array_join(F.array_sort(F.collect_list("item")), ","), 256).alias("items_sha256"))
    # Both results have one row per document hit, so they are joined first.
    each = F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int")))
    return (sizes.join(n_hit.join(listed, "id"), "id", "left").withColumn("row", each)
            .select("id.doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
                    F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
                    F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
                    F.col("n_hit").isNotNull().alias("contaminated")))


def decontaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                   item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents without a hit word, with all their columns."""
    bad = stored(hits(docs, benchmark, key, text, item_key, item_text)[0].select("id").distinct())
    rows = docs.select(_name(key, text).alias("id"), packed(docs).alias("doc"))
    return unpacked(rows.join(hinted(bad, bad.count(), BROADCAST_ROWS), "id", "left_anti"), "doc")
