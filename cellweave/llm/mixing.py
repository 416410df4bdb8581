"""Mixing sources to target weights by systematic sampling.

Every source gets a target of words. Its documents lie one after the other on a line, each as long as its expected
copies; a document is taken once for every whole number its stretch crosses, counted from one offset per source.

Documents lie in the order of their size, so that the taken words of a source follow its target closely. Places on the
line come from counts: per source and size, then per block of ids inside a size, then inside a block. No task holds a
source, and only ids, sources and sizes are moved.

Defined cases: a null text has size 0; null is a source of its own, after all others; repeated rows are documents of
their own; a source without words has target 0 and takes nothing; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.common import packed, row_hash, stored

# Blocks into which equal sizes of a source are cut by id.
BLOCKS = 1024


@dataclass(frozen=True)
class Mix:
    """Weights go round the sources in code point order; ``share`` of all words is dealt out."""

    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    most: float = 2.0
    seed: str = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def offset(source: Column, seed: str) -> Column:
    """A number in [0, 1) for every source, the same in every run."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("")), F.when(source.isNull(), "?").otherwise("")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """``source, source_size, target, rate``: words a source should give, and the expected copies of its documents.

    One row per source. Sources fill in the order of what they hold per weight: the level after the k smallest are full
    rises until the first source that is not full, so the largest level is the one all others share.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = (per_source
              .withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
              .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in mix.weights]),
                                                 (F.col("place") % len(mix.weights) + 1).cast("int")).cast("double"))
              .withColumn("room", F.col("source_size") * F.lit(float(mix.most))))
    by_room = Window.orderBy(F.col("room") / F.col("weight"), "place")
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(mix.share))
    full = F.coalesce(F.sum("room").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_room.rowsBetween(0, Window.unboundedFollowing))
    leveled = placed.withColumn("level", (total - full) / rest)
    target = F.least(F.col("room"), F.max("level").over(Window.partitionBy()) * F.col("weight"))
    return (leveled.withColumn("target", target)
            .withColumn("rate", F.when(F.col("source_size") > 0,
                                       F.least(F.col("target") / F.col("source_size"), F.lit(float(mix.most)))).otherwise(0.0))
            .select("source", "source_size", "target", "rate"))


def _block(known: Column, unknown: Column) -> Column:
    """Blocks of ids; rows without one come first, in blocks of ``unknown``."""
    return F.coalesce(F.pmod(known, F.lit(BLOCKS)), F.pmod(unknown, F.lit(BLOCKS)) - BLOCKS)


def _placed(sizes: DataFrame, names: list[str], unknown: Column, mix: Mix) -> DataFrame:
    """Per ``names``, source and size: ``n`` equal rows, their first ``place`` on the line, and the source's targets."""
    block = _block(F.col("doc_id"), unknown).alias("block")
    groups = sizes.groupBy("source", "size", block, *names).agg(F.count(F.lit(1)).alias("n"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per_block = groups.groupBy("source", "size", "block").agg(F.sum("n").alias("n"))
    per_size = per_block.groupBy("source", "size").agg(F.sum("n").alias("n"))
    size_start = per_size.select("source", "size", before(Window.partitionBy("source").orderBy("size")).alias("size_start"))
    block_start = per_block.select("source", "size", "block",
                                   before(Window.partitionBy("source", "size").orderBy("block")).alias("block_start"))
    same = lambda a, b, keys: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in keys]
    starts = (block_start.alias("b").join(size_start.alias("s"), same("b", "s", ["source", "size"]))
              .join(F.broadcast(targets(sizes, mix)).alias("t") if sizes.select("source").distinct().limit(10_001).count() <= 10_000
                    else targets(sizes, mix).alias("t"), same("b", "t", ["source"]))
              .select("b.source", "b.size", "b.block", (F.col("size_start") + F.col("block_start")).alias("start"),
                      "source_size", "target", "rate"))
    inside = groups.withColumn("inside", before(Window.partitionBy("source", "size", "block").orderBy(*names)))
    return (inside.alias("i").join(starts.alias("s"), same("i", "s", ["source", "size", "block"]))
            .select(*[f"i.{c}" for c in names], "i.source", "i.size", "n", (F.col("start") + F.col("inside")).alias("place"), "source_size", "target", "rate"))


def _crossed(place: Column, mix: Mix) -> Column:
    return F.floor(F.col("rate") * place + offset(F.col("source"), mix.seed))


def decide(docs: DataFrame, mix: Mix = Mix(), key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id, source, size, nth, source_size, target, copies``: one row per document; ``nth`` numbers rows equal in these."""
    sizes = stored(docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
                               word_count(F.col(f"`{text}`")).alias("size")))
    at = F.col("place") + F.col("nth")
    return (_placed(sizes, ["doc_id"], F.lit(0), mix).withColumn("nth", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
            .select("doc_id", "source", "size", "nth", "source_size", "target", (_crossed(at + 1, mix) - _crossed(at, mix)).cast("bigint").alias("copies")))


def mixed(docs: DataFrame, mix: Mix = Mix(), key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents, each as often as it is taken, with all their columns and no other.

    Rows go by id and row hash, so that rows without an id are spread; equal rows are fetched once and given all their copies.
    """
    sizes = stored(docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
                               word_count(F.col(f"`{text}`")).alias("size"), row_hash(docs)))
    copies = (_crossed(F.col("place") + F.col("n"), mix) - _crossed(F.col("place"), mix)).cast("bigint")
    name = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    taken = _placed(sizes, ["doc_id", "row_hash"], F.col("row_hash"), mix).select(
        name(F.col("doc_id")).alias("id"), "row_hash", copies.alias("copies")).where("copies > 0")
    rows = docs.select(name(F.col(f"`{key}`")).alias("id"), row_hash(docs), packed(docs).alias("doc"))
    once = rows.join(taken, ["id", "row_hash"]).groupBy("id", "row_hash", "copies").agg(F.min("doc").alias("doc"))
    return once.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")
