"""Exact inner-product top-k by Fagin's threshold algorithm, block by block.

A block holds some distinct vectors and, for every dimension, the list of them in the order of that component. All queries
that meet a block walk its lists together, from both ends; a vector is scored when it is first met, and a query stops when
its threshold, the score a vector not met yet can reach at most, is below its kth best score. A query first asks one block; the kth score found there is a floor that lets the other blocks stop early, often at once. The best k of
all blocks are then the best k of the table: nothing is estimated.

Equal vectors are one member with its smallest ids, as many as an answer can hold, so a hot vector is one row. Members
are dealt to blocks and queries to query blocks, and each pair of them is a group of its own with bounded rows.

Defined cases: vectors that are null or hold a null or non-finite component take no part; components beyond a long are
the nearest long, and so are scores; an empty vector scores 0, a shorter one as if it ended in zeros; rows equal in id and
vector are one; of rows with one id and different vectors each is a candidate and, where asked, a query; a row without an
id is a candidate, last among ties, and never a query. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.common import stored

SCALE = 1024
# Members and queries of one group; tables of few members are dealt to FEW blocks all the same.
BLOCK, QUERIES, FEW = 2048, 1024, 16
# Parts in which the copies of one vector are first reduced to their smallest ids.
SALTS = 16
# Places of every list read at first; then as many as were read before.
_STEP = 8
# Less than any score.
_LEAST = -2 ** 200

_FOUND = "query bigint, query_id bigint, ids array<bigint>, nameless boolean, score bigint"


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component as a double; null where the vector can take no part."""
    doubles = vector.cast("array<double>")
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite, F.transform(doubles, lambda x: F.floor(x * F.lit(float(scale)))))


def members_of(points: DataFrame, k: int) -> DataFrame:
    """``v, ids, nameless``: every distinct vector of ``id, v`` with its smallest ids, null last, ``k + 1`` at most."""
    def least(df: DataFrame, *by: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.col("id").asc_nulls_last())
        return df.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1).drop("place")

    few = least(least(points.distinct().withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS))), "v", "salt"), "v")
    return few.groupBy("v").agg(F.collect_list("id").alias("ids"), F.max(F.col("id").isNull()).alias("nameless"))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def threshold_top(members: np.ndarray, queries: np.ndarray, keep: int, floors: np.ndarray, left_out: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Scores of queries (rows) by members, what a member has to reach to be among the best, and how many were scored.

    Every list is read from both ends, for all queries that are not done. Members that were not scored, or are a query's
    ``left_out``, have the least score there is. Scores below ``floors`` are not wanted.
    """
    n = len(members)
    least = -np.inf if members.dtype == float else _LEAST
    order = np.argsort(members, axis=0, kind="stable")
    for_high, for_low = np.maximum(queries, 0), np.minimum(queries, 0)
    scores = np.full((len(queries), n), least, dtype=members.dtype)
    best = np.full((len(queries), keep), least, dtype=members.dtype)
    wanted, at = floors.copy(), np.arange(members.shape[1])
    met, open_, start = np.zeros(n, dtype=bool), np.arange(len(queries)), 0
    while len(open_) and not met.all():
        step = max(_STEP, start)
        # Components that are all 0 have no lists to read; then everything scores 0.
        ends = np.concatenate([order[start:start + step], order[max(0, n - start - step):n - start]]) if len(at) else np.arange(n)
        here = np.unique(ends)
        here = here[~met[here]]
        met[here] = True
        found = queries[open_] @ members[here].T
        found[left_out[open_][:, None] == here] = least
        scores[np.ix_(open_, here)] = found
        best[open_] = _largest(np.concatenate([best[open_], found], axis=1), keep)
        wanted[open_] = np.maximum(wanted[open_], best[open_].min(axis=1))
        start += step
        if start >= n:
            break
        threshold = for_high[open_] @ members[order[n - 1 - start], at] + for_low[open_] @ members[order[start], at]
        open_ = open_[threshold >= wanted[open_]]
    return scores, wanted, int(met.sum())


def _largest(values: np.ndarray, keep: int) -> np.ndarray:
    return np.sort(values, axis=1)[:, -keep:] if values.dtype == object else np.partition(values, -keep, axis=1)[:, -keep:]


def _answers(k: int):
    def answer(queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(members):
            return pd.DataFrame([], columns=["query", "query_id", "ids", "nameless", "score"])
        width = max(queries["v"].map(len).max(), members["v"].map(len).max())
        m, q = _matrix(members["v"], width), _matrix(queries["v"], width)
        # Whole numbers below 2^53 are exact as doubles, in any order of summing; larger ones are taken as they are.
        bound = float(np.abs(m.astype(float)).max(initial=0)) * float(np.abs(q.astype(float)).sum(axis=1).max(initial=0))
        kind = float if bound < 2.0 ** 52 else object
        ids, nameless = members["ids"].to_numpy(), members["nameless"].to_numpy()
        alone = {e[0]: i for i, e in enumerate(ids) if len(e) == 1 and not nameless[i]}
        floors = np.array([f[0] if len(f) else _LEAST for f in queries["floor"]], dtype=object).astype(kind)
        scores, wanted, _ = threshold_top(m.astype(kind), q.astype(kind), k, floors, np.array([alone.get(i, -1) for i in queries["query_id"]]))
        r, c = np.nonzero((scores >= wanted[:, None]) & (scores > (-np.inf if kind is float else _LEAST)))
        return pd.DataFrame({"query": queries["query"].to_numpy()[r], "query_id": queries["query_id"].to_numpy()[r], "ids": ids[c], "nameless": nameless[c],
                             "score": [max(-2 ** 63, min(2 ** 63 - 1, int(s))) for s in scores[r, c]]})
    return answer


def _asked(asking: DataFrame, members: DataFrame, lots: int, k: int) -> DataFrame:
    """Answers of the blocks to ``block, lot, query, query_id, v, floor``."""
    copies = members.withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(lots - 1)))) if lots > 1 else members.withColumn("lot", F.lit(0))
    return (asking.groupBy("block", "lot").cogroup(copies.groupBy("block", "lot"))
            .applyInPandas(_answers(k), _FOUND))


def _best(found: DataFrame, k: int) -> DataFrame:
    """The best k ids per query, its own left out."""
    named = F.concat("ids", F.when(F.col("nameless"), F.array(F.lit(None).cast("bigint"))).otherwise(F.array().cast("array<bigint>")))
    each = (found.select("query", "query_id", "score", F.explode(named).alias("vec_id"))
            .where(~F.col("vec_id").eqNullSafe(F.col("query_id"))))
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(points: DataFrame, asks: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k other rows with the highest inner product for every row where ``asks`` holds.

    ``asks`` is a condition on the id, which it finds as ``id``. Ties go to the smaller id.
    """
    rows = points.select(F.col(f"`{key}`").cast("bigint").alias("id"), whole_numbers(F.col(f"`{vector}`"), scale).alias("v")).where("v is not null")
    members = stored(members_of(rows, k))
    blocks = max(FEW, -(-members.count() // BLOCK))
    members = members.withColumn("block", F.pmod(F.xxhash64("v"), F.lit(blocks)).cast("int"))
    queries = stored(rows.where(asks & F.col("id").isNotNull()).distinct().select(
        F.monotonically_increasing_id().alias("query"), F.col("id").alias("query_id"), "v"))
    lots = max(1, -(-queries.count() // QUERIES))
    queries = queries.select("query", "query_id", "v", F.pmod(F.xxhash64("query"), F.lit(lots)).cast("int").alias("lot"),
                             F.pmod(F.xxhash64("v"), F.lit(blocks)).cast("int").alias("first"))
    near = stored(_asked(queries.withColumn("floor", F.array().cast("array<bigint>")).withColumnRenamed("first", "block"), members, lots, k))
    floors = _best(near, k).where(F.col("rank") == k).select("query", F.array("score").alias("floor"))
    others = (queries.join(floors, "query", "left").withColumn("floor", F.coalesce("floor", F.array().cast("array<bigint>")))
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).where("block <> first").drop("first"))
    return _best(near.unionByName(_asked(others, members, lots, k)), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
