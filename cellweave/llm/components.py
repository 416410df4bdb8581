"""Connected components of a graph given as an edge table.

Large and small stars in turn: every node is tied to the smallest node it sees, until nothing changes. Edges only ever
become fewer or point lower, and each round is written to the shared folder, so a lost executor costs one round. A hub
is never gathered: its smallest neighbour is an aggregate that is combined before the shuffle, and the join that hands
it back has one row per node on the other side, so that the adaptive skew join can split the hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import stored


def _sums(edges: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned(mark, 32))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for the nodes of ``u, v``: the smallest node reachable. Loops and repeated edges are allowed."""
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    seen = _sums(now)
    while seen[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = stored(small.select("e.u", "e.v").where("u <> v").distinct())
        sums = _sums(now)
        if sums == seen:
            break
        seen = sums
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
