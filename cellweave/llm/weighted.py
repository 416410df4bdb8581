"""Document fingerprints by consistent weighted sampling.

A document is a set of terms (its words, A-Z in lower case) weighted by how often they occur. For every sample and term,
two gamma variates and a uniform one come from hashes of the term; they turn the weight into a position, and the term
with the lowest position is drawn. Two documents draw the same term and step with a probability equal to their
generalised Jaccard similarity, the sum of the smaller weights over the sum of the larger ones. The position names the
drawn term and step, so a signature is the lowest position of each sample, of which 16 bits are written.

Texts are moved once by id, and once more the part that a neighbour needs. Words are then counted and drawn from without
another shuffle, since all of it is grouped by id. Neighbours come from ranges of ids: inside a range by a window, and
from range to range by a table with one row per range.

Defined cases: a null text is empty; an empty text draws nothing, its fingerprint is all zeros, and it is like another
empty text only; every row is a document and has a row in the result, whatever its id: a document is named by its id and a
64-bit hash of its text, documents of one id follow in descending order of that hash, a null id comes below all others, and
rows equal in both are one document in the order; the only document is its own neighbour; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.common import lower_ascii, stored

SAMPLES = 64
# Samples drawn in one pass over a term: as many as one compiled method holds.
_AT_ONCE = 8
_DIGITS = 4
# Stands for a null id, so that ids can be compared with plain equality; the hash tells it from a real id of that value.
_NO_ID = -(1 << 63)
_NAME = ["id", "hash"]
# Ids in one range of neighbours.
_RANGE = 100_000


def _middle(bits: Column, shift: int, width: int) -> Column:
    """``width`` bits as a number inside (0, 2^width), to be scaled by a power of two."""
    cut = F.shiftrightunsigned(bits, shift) if shift + width == 64 else F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << width) - 1))
    return cut.cast("double") + F.lit(0.5)


def drawn(terms: DataFrame, key: list[str], weights: list[str], samples: int = SAMPLES) -> DataFrame:
    """The columns of ``key`` and an array ``<weight>_draws`` per weight column: the lowest position of every sample, null without terms.

    ``terms`` has ``key``, a 64-bit ``term`` and the weights, each term once per key; a weight of 0 is no term.
    """
    logs = terms.select(*key, "term", *[F.when(F.col(w) > 0, F.ln(F.col(w).cast("double"))).alias(w) for w in weights],
                        F.explode(F.array(*[F.lit(g) for g in range(samples // _AT_ONCE)])).alias("part"))
    seeds = logs.select(*key, "part", *weights, F.xxhash64("term", "part").alias("seed"))
    bits = seeds.select(*key, "part", *weights, *[F.xxhash64(F.col("seed").bitwiseXOR(F.lit(2 * s + half))).alias(f"bits_{s}_{half}")
                                                  for s in range(_AT_ONCE) for half in (0, 1)])

    def gamma(a: Column, b: Column, width: int) -> Column:
        return -F.ln(a * b * F.lit(0.5 ** width))

    spread = bits.select(*key, "part", *weights, *[c for s in range(_AT_ONCE) for c in (
        gamma(_middle(F.col(f"bits_{s}_0"), 0, 21), _middle(F.col(f"bits_{s}_0"), 21, 21), 42).alias(f"r_{s}"),
        F.ln(gamma(_middle(F.col(f"bits_{s}_0"), 42, 22), _middle(F.col(f"bits_{s}_1"), 0, 32), 54)).alias(f"c_{s}"),
        (_middle(F.col(f"bits_{s}_1"), 32, 32) * F.lit(0.5 ** 32)).alias(f"b_{s}"))])

    def position(weight: str, s: int) -> Column:
        r, c, b = F.col(f"r_{s}"), F.col(f"c_{s}"), F.col(f"b_{s}")
        return c - r * (F.floor(F.col(weight) / r + b) - b + F.lit(1.0))

    lowest = spread.groupBy(*key, "part").agg(*[F.min(position(w, s)).alias(f"{w}_{s}") for w in weights for s in range(_AT_ONCE)])
    in_order = lambda w: F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(
        "part", F.array(*[f"{w}_{s}" for s in range(_AT_ONCE)]).alias("draws")))), lambda x: x["draws"]))
    return lowest.groupBy(*key).agg(*[in_order(w).alias(f"{w}_draws") for w in weights])


def as_text(draws: Column, samples: int = SAMPLES) -> Column:
    """Four hex digits per sample; zeros where nothing was drawn."""
    digits = F.transform(draws, lambda x: F.when(x.isNull(), "0" * _DIGITS).otherwise(
        F.lower(F.lpad(F.hex(F.pmod(F.xxhash64(x), F.lit(16 ** _DIGITS - 1)) + 1), _DIGITS, "0"))))
    return F.coalesce(F.array_join(digits, ""), F.lit("0" * _DIGITS * samples))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of the samples in which two fingerprints agree."""
    part = lambda x, s: F.substring(x, s * _DIGITS + 1, _DIGITS)
    agree = [(part(a, s) == part(b, s)).cast("int") for s in range(samples)]
    return sum(agree[1:], agree[0]) / F.lit(float(samples))


def counted_words(texts: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """``key``, ``term`` and per text column how often the word occurs in it."""
    each = texts.select(*key, F.explode(F.array(*[F.struct(F.lit(n).alias("side"), F.col(c).alias("text"))
                                                 for n, c in enumerate(columns)])).alias("t"))
    split = each.select(*key, "t.side", F.explode_outer(F.split(lower_ascii(F.col("t.text")), r"[\x20\x09-\x0D]+")).alias("word"))
    return (split.where("word <> ''").select(*key, "side", F.xxhash64("word").alias("term")).groupBy(*key, "term")
            .agg(*[F.sum((F.col("side") == n).cast("int")).alias(c) for n, c in enumerate(columns)]))


def neighbours(names: DataFrame) -> DataFrame:
    """The columns of ``names`` with ``next_id, next_hash`` in descending order of its distinct ``id, hash``; after the last comes the first."""
    ranges = max(1, -(-names.count() // _RANGE))
    down = [F.col(c).desc() for c in _NAME]
    placed = stored(names.repartitionByRange(ranges, *down).withColumn("part", F.spark_partition_id()))
    name = F.struct(*_NAME)
    edges = placed.groupBy("part").agg(F.max(name).alias("first"))
    around = Window.orderBy("part")
    after = edges.select("part", F.coalesce(F.lead("first").over(around), F.first("first").over(around)).alias("after"))
    inside = placed.withColumn("next", F.lead(name).over(Window.partitionBy("part").orderBy(*down)))
    return inside.join(after, "part").withColumn("next", F.coalesce("next", "after")).select(
        *names.columns, F.col("next.id").alias("next_id"), F.col("next.hash").alias("next_hash"))


def fingerprinted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` per row.

    The edited text is the document's with its last half replaced by as much of the beginning of its neighbour.
    """
    words = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    raw = docs.select(F.coalesce(F.col(f"`{key}`").cast("bigint"), F.lit(_NO_ID)).alias("id"),
                      F.xxhash64(words, F.col(f"`{key}`").isNull()).alias("hash"), F.col(f"`{key}`").isNotNull().alias("has_id"), words.alias("text"))
    names = stored(raw.groupBy(*_NAME).agg(F.max(F.char_length("text")).alias("n"), F.count(F.lit(1)).alias("n_rows"), F.max("has_id").alias("has_id")))
    order = stored(neighbours(names))
    whole = raw.groupBy(*_NAME).agg(F.min("text").alias("text"))
    wanted = order.select(F.col("id").alias("to_id"), F.col("hash").alias("to_hash"), F.col("next_id").alias("id"), F.col("next_hash").alias("hash"), "n")
    sent = whole.join(wanted, _NAME).select(F.col("to_id").alias("id"), F.col("to_hash").alias("hash"),
                                            F.substring("text", F.lit(1), F.floor(F.col("n") / 2).cast("int")).alias("head"))
    n, half = F.char_length("text"), F.floor(F.char_length("text") / 2).cast("int")
    texts = whole.join(sent, _NAME).select(
        *_NAME, "text", F.concat(F.substring("text", F.lit(1), n - half), F.substring("head", F.lit(1), half)).alias("edited"))
    draws = drawn(counted_words(texts, _NAME, ["text", "edited"]), _NAME, ["text", "edited"])
    facts = texts.select(*_NAME, F.char_length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    done = stored(facts.join(draws, _NAME, "left").select(
        *_NAME, "n_chars", "edited_sha256", as_text(F.col("text_draws")).alias("fingerprint"),
        as_text(F.col("edited_draws")).alias("edited_fingerprint")))
    others = done.select(F.col("id").alias("next_id"), F.col("hash").alias("next_hash"), F.col("fingerprint").alias("next_fingerprint"))
    each = F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int")))
    return (done.join(order, _NAME).join(others, ["next_id", "next_hash"]).withColumn("row", each)
            .select(F.when(F.col("has_id"), F.col("id")).alias("doc_id"), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                    likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next")))
