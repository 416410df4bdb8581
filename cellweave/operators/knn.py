"""k nearest neighbours: exact, or among the groups nearest to a vector.

``exact`` compares all vectors with all, in blocks that meet pairwise and each keep their own
best k per vector: quadratic work, for tables where that is wanted and as the measure of the
other. A product of matrices leaves few pairs of a block whose distance is summed term by term. ``grouped`` deals vectors to the nearest of a bounded number of pivots and compares a
vector with the members of the ``probes`` pivots nearest to it: its work grows with a vector's
share of the table, and its recall with ``probes``. Which one runs is the caller's choice and
never depends on the size. Where ``probes`` is not given, it is measured: a sample of vectors is compared with the whole
table, and as many pivots are asked as hold ``RECALL`` of the sample's true neighbours. Large groups are cut into blocks as well, and equal vectors are
collapsed to one first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.operators.lineage import materialize


MAX_PIVOTS = 1024
# Share of the true neighbours aimed at where probes are measured, and vectors they are measured on.
RECALL, MEASURED = 0.97, 256
BLOCK_ROWS = 32_000
# Vectors of a block whose rough distances are held at once.
ROUGH_ROWS = 256
# Others that give a first bound.
FIRST_LOOK = 2_000


def _distances(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Squared distances of a few hundred points to many, summed term by term."""
    out = np.empty((len(points), len(others)))
    for i, p in enumerate(points):
        gap = others - p
        out[i] = np.einsum("ij,ij->i", gap, gap)
    return out


def _candidates(points: np.ndarray, others: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places that hold the ``n`` nearest of ``others`` for each point, a few hundred points at a time.

    A product of matrices gives distances up to rounding; pairs that are further than the nth by more than rounding can
    make up are left out. Where there is no bound on rounding every pair is one.
    """
    with np.errstate(all="ignore"):
        middle = others.mean(axis=0)
        a, b = points - middle, others - middle
        largest = np.maximum(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
        # Nearest to one, in single precision, where squares neither leave the range of numbers nor vanish.
        known = n < len(others) and 1e-290 < 4 * others.shape[1] * largest * largest < np.inf
    if known:
        a, b = (np.ldexp(v, -int(np.frexp(largest)[1])).astype(np.float32) for v in (a, b))
        size = np.einsum("ij,ij->i", b, b)
        slack = 8 * (others.shape[1] + 8) * np.finfo(np.float32).eps * (np.einsum("ij,ij->i", a, a) + size.max())
    for start in range(0, len(points), ROUGH_ROWS):
        part = slice(start, start + ROUGH_ROWS)
        if known:
            # A point's own size is the same in all its distances.
            rough = a[part] @ b.T
            rough *= -2
            rough += size
            # The nth nearest of a few is no nearer than that of all; where it leaves much, all are asked.
            for step in sorted({max(1, len(b) // max(FIRST_LOOK, n)), 1}, reverse=True):
                near = rough <= (np.partition(rough[:, ::step], n - 1, axis=1)[:, n - 1] + slack[part])[:, None]
                if np.count_nonzero(near) <= 2 * n * step * len(rough):
                    break
            flat = np.flatnonzero(near)
            row, place = np.divmod(flat, len(b))
            found = rough.ravel()[flat]
            order = np.lexsort((found, row))
            nth = found[order][np.arange(len(row)) - np.searchsorted(row, row) == n - 1]
            left = found <= (nth + slack[part])[row]
            row, place = row[left], place[left]
        else:
            row, place = (found.ravel() for found in np.indices((len(a[part]), len(b))))
        yield row + start, place


def _nearest(points: np.ndarray, others: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the point, place of the other and squared distance of the ``n`` nearest, ties to the earlier other."""
    out = []
    for row, place in _candidates(points, others, n):
        d2 = np.empty(len(row))
        for at in range(0, len(row), 1 << 16):
            part = slice(at, at + (1 << 16))
            gap = points[row[part]] - others[place[part]]
            d2[part] = np.einsum("ij,ij->i", gap, gap)
        order = np.lexsort((place, d2, row))
        row, place, d2 = row[order], place[order], d2[order]
        first = np.arange(len(row)) - np.searchsorted(row, row) < n
        out.append((row[first], place[first], d2[first]))
    return tuple(np.concatenate(c) for c in zip(*out))


def _collapse(points: DataFrame, keep: int) -> DataFrame:
    """One site per distinct vector with the smallest ids that have it.

    A vector's own neighbours need at most ``keep`` of its copies, so ids beyond that are
    not carried; the window keeps only that many per task before the shuffle.
    """
    order = Window.partitionBy("vector").orderBy("id")
    few = points.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)
    return (few.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
            .withColumn("site", F.col("ids")[0]))


def knn(points: DataFrame, k: int = 15, method: str = "exact", max_pivots: int = MAX_PIVOTS, probes: int | None = None,
        block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(src, dst, rank, dist) for the k nearest other points of each; ties by id.

    ``points`` has a whole-number ``id`` and ``vector``, an array of numbers.
    """
    if method not in ("exact", "grouped"):
        raise ValueError("method is exact or grouped")
    keep = k + 1
    points = points.select(F.col("id").cast("bigint").alias("id"), F.col("vector").cast("array<double>").alias("vector"))
    sites = materialize(_collapse(points, keep))
    if method == "grouped":
        members, queries = _grouped(sites, keep, max_pivots, probes)
    else:
        members = sites.select("site", "ids", "vector", F.lit(0).alias("home"))
        queries = members.select("site", "vector", "home")
    sizes = materialize(members.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
                        .join(queries.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("query_blocks")), "home"))
    # At most one row per pivot.
    sizes = F.broadcast(sizes)
    key = ["home", "query_block", "block"]
    own = lambda n: F.pmod(F.xxhash64("site"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asking = (queries.join(sizes, "home").withColumn("query_block", own(F.col("query_blocks"))).withColumn("block", every("blocks"))
              .select(*key, "site", "vector"))
    asked = (members.join(sizes, "home").withColumn("block", own(F.col("blocks"))).withColumn("query_block", every("query_blocks"))
             .select(*[F.col(c).alias(c) for c in (*key, "site", "ids", "vector")]))

    def best(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(c):
            return pd.DataFrame({"site": [], "ids": [], "d2": []})
        c = c.sort_values("site")
        n = min(keep, len(c))
        # Ties go to the smaller id, as the others are sorted by site.
        row, place, d2 = _nearest(np.stack(q["vector"].to_numpy()), np.stack(c["vector"].to_numpy()), n)
        return pd.DataFrame({"site": q["site"].to_numpy()[row], "ids": c["ids"].to_numpy()[place], "d2": d2})

    partial = (asking.groupBy(*key).cogroup(asked.groupBy(*key))
               .applyInPandas(best, "site bigint, ids array<bigint>, d2 double"))
    # Blocks or probes times k rows per site, of which the window keeps k per task before the shuffle.
    merged = (partial.select("site", "d2", F.explode("ids").alias("dst"))
              .withColumn("place", F.row_number().over(Window.partitionBy("site").orderBy("d2", "dst")))
              .where(F.col("place") <= keep)
              .groupBy("site").agg(F.array_sort(F.collect_list(F.struct("d2", "dst"))).alias("near")))
    own_site = points.join(sites.select("vector", "site"), "vector").select("id", "site")
    others_only = F.slice(F.filter("near", lambda e: e["dst"] != F.col("id")), 1, k)
    return (own_site.join(merged, "site")
            .select(F.col("id").alias("src"), F.posexplode(others_only).alias("at", "e"))
            .select("src", F.col("e.dst").alias("dst"), (F.col("at") + 1).alias("rank"),
                    F.sqrt("e.d2").alias("dist")))


def _asked(placed: DataFrame, pivots: np.ndarray, keep: int) -> int:
    """The fewest nearest pivots that hold ``RECALL`` of the neighbours of the sampled vectors. One pass over the table."""
    sample = placed.select("site", "vector").orderBy(F.xxhash64("site", F.lit("measured")), "site").limit(MEASURED).collect()
    own, points = np.array([r["site"] for r in sample]), np.array([r["vector"] for r in sample], dtype=float)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                d2 = _distances(points, np.stack(batch["vector"].to_numpy()))
                d2[own[:, None] == batch["site"].to_numpy()[None]] = np.inf
                top = np.argsort(d2, axis=1, kind="stable")[:, :keep]
                found = pd.DataFrame({"query": np.repeat(np.arange(len(points)), top.shape[1]), "site": batch["site"].to_numpy()[top.ravel()],
                                      "home": batch["home"].to_numpy()[top.ravel()], "d2": np.take_along_axis(d2, top, axis=1).ravel()})
                yield found[np.isfinite(found["d2"])]

    near = (placed.select("site", "vector", F.col("near")[0].alias("home"))
            .mapInPandas(nearest, "query int, site bigint, home int, d2 double")
            .withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy("d2", "site"))).where(F.col("place") < keep)
            .select("query", "home").collect())
    if not near:
        return len(pivots)
    turn = np.argsort(np.argsort(_distances(points, pivots), axis=1, kind="stable"), axis=1)
    turns = np.sort([turn[r["query"], r["home"]] for r in near])
    return int(turns[int(np.ceil(RECALL * len(turns))) - 1]) + 1


def _grouped(sites: DataFrame, keep: int, max_pivots: int, probes: int | None) -> tuple[DataFrame, DataFrame]:
    """Members of every pivot's group, and the vectors that ask it."""
    n_pivots = max(1, min(max_pivots, int(sites.count() ** 0.5)))
    chosen = sites.select("site", "vector").orderBy(F.xxhash64("site"), "site").limit(n_pivots)
    pivots = np.array([r["vector"] for r in chosen.collect()], dtype=float)
    most = len(pivots) if probes is None else min(probes, len(pivots))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                d2 = _distances(np.stack(batch["vector"].to_numpy()), pivots)
                near = np.argsort(d2, axis=1, kind="stable")[:, :most].astype("int32")
                yield batch.assign(near=list(near))

    if not len(pivots):
        return sites.select("site", "ids", "vector", F.lit(0).alias("home")), sites.select("site", "vector", F.lit(0).alias("home"))
    placed = materialize(sites.select("site", "ids", "vector").mapInPandas(
        place, "site bigint, ids array<bigint>, vector array<double>, near array<int>"))
    members = placed.select("site", "ids", "vector", F.col("near")[0].alias("home"))
    asked = _asked(placed, pivots, keep) if probes is None else most
    return members, placed.select("site", "vector", F.explode(F.slice("near", 1, asked)).alias("home"))


def knn_edges(neighbors: DataFrame) -> DataFrame:
    """Undirected weighted graph of the neighbour table: each edge once each way."""
    weight = 1.0 / (1.0 + F.col("dist"))
    ways = F.explode(F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"))))
    return (neighbors.select(ways.alias("way"), weight.alias("weight"))
            .groupBy("way.src", "way.dst").agg(F.max("weight").alias("weight")))
