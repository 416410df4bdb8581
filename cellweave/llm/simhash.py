"""Near copies by SimHash fingerprints and a byte-position inverted index.

Fingerprints of 64 bits that differ in at most 3 bits agree in at least 5 of their 8 bytes. The index posts a fingerprint
under the bytes at three positions of one half: of 5 agreeing bytes, one half holds 3, so every linked pair meets in one
of the 8 posting lists of a fingerprint. Inside a list the agreeing positional bytes of each pair are tallied, pairs below
5 are dropped, and the others are verified bit by bit.

Equal fingerprints are one node. A list longer than ``LIST`` is cut into blocks by hash, and each pair of blocks is a
list of its own, so no task holds more than two blocks. A list returns a spanning forest of its links, never all
pairs: the work follows the list, the output its members, and no link is lost for the components.

Defined cases: a null, empty or blank text has fingerprint 0 and is linked like any other; repeated rows are each returned;
rows with a null id are returned, and their component is the smallest id reachable, or null.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations, islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from cellweave.llm.common import row_hash, stored
from cellweave.llm.components import components

WORDS_PER_SHINGLE = 3
MOST_BITS = 3
LEAST_BYTES = 8 - MOST_BITS
TRIPLES = [t for half in (range(4), range(4, 8)) for t in combinations(half, 3)]

# Fingerprints of one posting list that a task compares at once, and rows of postings per task.
LIST = 4096
LOT = 100_000
_STEP = 1 << 16

_hash = partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: str | None) -> int:
    """Bit i is set where over half of the shingles' hashes have it. Unsigned."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - WORDS_PER_SHINGLE + 1)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(min(len(words), WORDS_PER_SHINGLE))), strict=False))
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, n, _STEP):
        hashes = np.fromiter(map(_hash, islice(shingles, _STEP)), dtype=np.uint64, count=min(_STEP, n - start))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


@F.pandas_udf(LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Ties the groups of i and j: each label is the lowest place of its group."""
    while True:
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            return
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            lower = label[label]
            if (lower == label).all():
                break
            label[:] = lower


def forest(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Edges (uint64 pairs) that tie what is linked between two blocks, or within one if they are the same."""
    both = np.unique(np.concatenate([left, right]))
    label = np.arange(len(both))
    at_left, at_right = np.searchsorted(both, left), np.searchsorted(both, right)
    bytes_left, bytes_right = left.view(np.uint8).reshape(-1, 8), right.view(np.uint8).reshape(-1, 8)
    strip = max(1, (1 << 22) // max(1, len(right)))
    for s in range(0, len(left), strip):
        tally = np.zeros((min(strip, len(left) - s), len(right)), dtype=np.uint8)
        for p in range(8):
            tally += bytes_left[s:s + strip, p, None] == bytes_right[None, :, p]
        i, j = np.nonzero(tally >= LEAST_BYTES)
        i += s
        close = np.bitwise_count(left[i] ^ right[j]) <= MOST_BITS
        _merge(label, at_left[i[close]], at_right[j[close]])
    tied = np.flatnonzero(label != np.arange(len(both)))
    return np.stack([both[tied], both[label[tied]]], axis=1)


def _links(rows: pd.DataFrame) -> pd.DataFrame:
    """One lot of posting lists: the forest of each."""
    rows = rows.sort_values(["key", "low", "high"], kind="stable")
    keys = rows[["key", "low", "high"]].to_numpy()
    starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]) if len(rows) else np.array([], dtype=int)
    fps, block = rows["fp"].to_numpy().view(np.uint64), rows["block"].to_numpy()
    found = [np.zeros((0, 2), dtype=np.uint64)]
    for s, e in zip(starts, np.r_[starts[1:], len(rows)], strict=True):
        if e - s > 1:
            low, high = keys[s, 1], keys[s, 2]
            left = fps[s:e][block[s:e] == low]
            found.append(forest(left, left if low == high else fps[s:e][block[s:e] == high]))
    edges = np.concatenate(found).view(np.int64)
    return pd.DataFrame({"u": edges[:, 0], "v": edges[:, 1]})


def links(fps: DataFrame) -> DataFrame:
    """Edges ``u, v`` that tie all fingerprints of ``fp`` (distinct) whose distance is at most 3 bits."""
    byte = lambda p: F.shiftrightunsigned(F.col("fp"), 8 * p).bitwiseAND(F.lit(255))
    keys = [F.lit(n << 24) + F.shiftleft(byte(a), 16) + F.shiftleft(byte(b), 8) + byte(c) for n, (a, b, c) in enumerate(TRIPLES)]
    postings = fps.select("fp", F.explode(F.array(*[k.cast("bigint") for k in keys])).alias("key"))
    lists = stored(postings.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                   .select("key", "n", F.ceil(F.col("n") / LIST).cast("int").alias("blocks")))
    rows = lists.agg(F.sum(F.col("n") * F.col("blocks"))).first()[0] or 0
    block = F.pmod(F.xxhash64(F.col("fp"), F.lit("block")), F.col("blocks")).cast("int")
    met = (postings.join(lists, "key").withColumn("block", block)
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select("key", "fp", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")))
    lots = max(8, -(-rows // LOT))
    lot = F.pmod(F.xxhash64("key", "low", "high"), F.lit(lots))
    return met.withColumn("lot", lot).groupBy("lot").applyInPandas(
        lambda pdf: _links(pdf), "u bigint, v bigint")


def _rooted(docs: DataFrame, key: str, text: str, *more: Column) -> DataFrame:
    """``doc_id, fp, root, component_id`` and ``more`` for every row; ``root`` is a fingerprint of the component."""
    marked = stored(docs.select(F.col(f"`{key}`").alias("doc_id"), fingerprints(F.col(f"`{text}`")).alias("fp"), *more))
    nodes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    member = components(links(nodes.select("fp")))
    rooted = nodes.join(member, nodes.fp == member.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("linked"))
    tied = rooted.where("linked")
    named = tied.join(tied.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("fp", "root", "component_id")
    alone = rooted.where("not linked").select("fp", "root", F.col("first").alias("component_id"))
    return marked.join(named.union(alone), "fp")


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp, component_id`` for every row: the fingerprint and the smallest id reachable over links."""
    return _rooted(docs, key, text).select("doc_id", "fp", "component_id")


def tied_to(docs: DataFrame, members: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``members`` (``doc_id, row_hash, root`` of each row of ``docs``) with the roots that near copies tie made one, the smallest.

    Only roots that meet in a component of fingerprints go through the search for components, so the edges are few.
    """
    fps = _rooted(docs, key, text, row_hash(docs)).select("row_hash", F.col("root").alias("heap")).distinct()
    met = stored(members.select("row_hash", "root").join(fps, "row_hash").select("heap", "root").distinct())
    several = met.groupBy("heap").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("heap", "low")
    edges = met.join(several, "heap").where("root > low").select(F.col("root").alias("u"), F.col("low").alias("v"))
    tied = components(edges).withColumnRenamed("root", "first")
    return (members.join(tied, members.root == tied.node, "left")
            .select("doc_id", "row_hash", F.coalesce("first", "root").alias("root")))
