"""From raw documents to a training mix: language, near copies, benchmark leaks, mixing.

Each stage works on all its predecessor kept. Stages that only filter return the columns they got; the last returns a
document as often as the mix takes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm import decontaminate, language, mixing, similar, simhash
from cellweave.llm.common import one_per_root, stored, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in which no language reaches half of the posterior, go."""
    return language.in_a_language(docs, docs.where(~language.held_out(F.col("doc_id"))))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents tied by near copies, the one with the smallest id stays.

    Two are tied where their SimHash fingerprints differ in 3 bits or fewer, or their shingles of 5 words have a Jaccard
    similarity of 0.8 or more; fingerprints alone miss about half of the near copies.
    """
    return one_per_root(docs, simhash.tied_to(docs, similar.rooted(docs)), "doc_id")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


STAGES = [
    ("language", known_language),
    ("near_copies", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", to_target_weights),
]

# Neither fitted piece probabilities nor XXH64 can be written in DuckDB's SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
