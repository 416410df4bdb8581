"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.operators.lineage import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Rows of a stored table that may be broadcast; a larger one is joined by shuffling.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is; the built-in ``lower`` where the text is plain ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def stored(df: DataFrame) -> DataFrame:
    """The table computed once, in the folder all executors share."""
    return materialize(df)


def hinted(small: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint for a table whose counted rows are within the bound; otherwise the table as it is."""
    return F.broadcast(small) if rows <= limit else small


def packed(df: DataFrame) -> Column:
    """All columns of a table as one, so that no name of theirs can clash with an operator's."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def unpacked(df: DataFrame, column: str) -> DataFrame:
    return df.select(f"{column}.*")


def row_hash(df: DataFrame) -> Column:
    """``row_hash``: with the id, it names a row among those of the table; equal rows share it."""
    return F.xxhash64(packed(df)).alias("row_hash")


def one_per_root(docs: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """One row of ``docs`` per ``root`` of ``members`` (``doc_id, row_hash, root``): smallest id, null last, then smallest hash.

    Only these narrow columns are compared; whole rows are fetched by the chosen id and hash, and equal rows are one.
    """
    first = members.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_hash")).alias("kept"))
    name = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    kept = first.select(name(F.col("kept.doc_id")).alias("id"), F.col("kept.row_hash").alias("row_hash")).distinct()
    rows = docs.select(name(F.col(f"`{key}`")).alias("id"), row_hash(docs), packed(docs).alias("doc"))
    return unpacked(rows.join(kept, ["id", "row_hash"], "left_semi").groupBy("id", "row_hash").agg(F.min("doc").alias("doc")), "doc")
