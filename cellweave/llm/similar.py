"""Near copies by the Jaccard similarity of word shingles, verified exactly.

A text is the set of its shingles of 5 words (A-Z in lower case; a shorter text is one shingle), and two texts are near
copies where their sets have a Jaccard similarity of 0.8 or more. Candidates share one of 40 bands of 7 least hashes, and
two bits of each least hash make a sketch whose agreement estimates the similarity with a deviation of 0.03: candidates
estimated under 0.68 are passed over. A pair of similarity 0.8 is missed with a probability under 2 in 10^4, one of 0.85
with under 10^-6; every link that is made was verified on the sets themselves, so no wrong pair is linked.

No pairs are shuffled. Equal sets are one node; bands with the same nodes are one list; a list is cut into blocks that meet
pairwise, and sketches are compared where the blocks meet. In each of ``ROUNDS`` a node names one partner of another
component, the same for all where many are alike, and these links, at most one a node, are verified. What is likely and
still in different components then comes together with its sets, block by block, is verified there in the order of the
estimate, and returns the links of a spanning forest. Pairs inside a component need no comparison.

Defined cases: a null, empty or blank text is the empty set, which is a copy of itself only; repeated rows and rows with a
null id are linked by their texts like any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructType

from cellweave.llm.common import hinted, one_per_root, row_hash, stored
from cellweave.llm.components import components

WORDS_PER_SHINGLE = 5
# The least similarity, as a fraction of whole numbers.
LEAST, OF = 4, 5
BANDS, PER_BAND = 40, 7
ROUNDS = 2
# Estimates from which a pair is looked into, and from which it is taken for a link until it is verified.
LIKELY, SURE = 0.68, 0.86
# Nodes and shingles of a block, and rows and shingles of the groups a task is given.
BLOCK, BLOCK_SHINGLES = 2048, 500_000
LOT, LOT_SHINGLES = 20_000, 2_000_000
_STEP = 4096

_hash = partial(xxhash.xxh64_intdigest, seed=42)
_draw = np.random.default_rng(20)
_TIMES, _PLUS, _MIX = (_draw.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
                       for n in (BANDS * PER_BAND, BANDS * PER_BAND, PER_BAND))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None) -> np.ndarray:
    """The distinct hashes of a text's shingles, sorted."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    runs = zip(*(words[i:] for i in range(min(len(words), WORDS_PER_SHINGLE))), strict=False)
    return np.unique(np.fromiter(map(_hash, map(b" ".join, runs)), dtype=np.uint64))


def least_hashes(hashes: np.ndarray) -> np.ndarray:
    least = np.full(BANDS * PER_BAND, ~np.uint64(0))
    for s in range(0, len(hashes), _STEP):
        each = np.multiply.outer(_TIMES, hashes[s:s + _STEP])
        each += _PLUS[:, None]
        np.minimum(least, each.min(axis=1), out=least)
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """One key per band."""
    return (least.reshape(BANDS, PER_BAND) * _MIX).sum(axis=1, dtype=np.uint64).view(np.int64)


def sketch(least: np.ndarray) -> bytes:
    """Two bits of each least hash."""
    two = ((least * _ODD) >> np.uint64(62)).astype(np.uint8)
    return np.packbits(np.stack([two >> 1, two & 1])).tobytes()


@F.pandas_udf(StructType().add("node", LongType()).add("size", IntegerType()).add("bands", ArrayType(LongType())).add("sketch", BinaryType()))
def _marks(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for t in texts:
        found = shingles(t)
        least = least_hashes(found)
        # The empty set is in no list.
        rows.append((np.uint64(xxhash.xxh64_intdigest(found.tobytes())).view(np.int64), len(found), bands(least) if len(found) else [], sketch(least)))
    return pd.DataFrame(rows, columns=["node", "size", "bands", "sketch"])


@F.pandas_udf(ArrayType(LongType()))
def _sets(texts: pd.Series) -> pd.Series:
    return pd.Series([shingles(t).view(np.int64) for t in texts], dtype=object)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``u, v`` whose sets are similar enough."""
    side = lambda n: sets.select(F.col("node").alias(n), F.col("set").alias(f"set_{n}"))
    common = F.size(F.array_intersect("set_u", "set_v"))
    return (pairs.join(side("u"), "u").join(side("v"), "v")
            .where(OF * common >= LEAST * (F.size("set_u") + F.size("set_v") - common)).select("u", "v"))


class _Members:
    """Rows of one block as arrays."""

    def __init__(self, rows: pd.DataFrame) -> None:
        self.rows = rows
        self.node, self.root, self.size = (rows[c].to_numpy() for c in ("node", "root", "size"))
        bits = np.unpackbits(np.frombuffer(b"".join(rows["sketch"]), dtype=np.uint8).reshape(len(rows), -1), axis=1)
        self.signs = bits.astype(np.float32) * 2 - 1

    def against(self, other: _Members) -> Iterator[tuple[int, np.ndarray]]:
        """Strips of estimates, -1 where a pair needs no look: the first row's place, and the estimates."""
        strip = max(1, (1 << 21) // max(1, len(other.node)))
        for s in range(0, len(self.node), strip):
            found = self.signs[s:s + strip] @ other.signs.T / self.signs.shape[1]
            small, large = np.minimum(self.size[s:s + strip, None], other.size), np.maximum(self.size[s:s + strip, None], other.size)
            # Sets of sizes so far apart cannot be similar enough.
            found[(found < LIKELY) | (self.root[s:s + strip, None] == other.root) | (OF * small < LEAST * large)] = -1
            yield s, found


def _meetings(rows: pd.DataFrame) -> Iterator[tuple[_Members, _Members, bool]]:
    """The block pairs of a lot, and whether both are the same block."""
    for (_, low, high), of in rows.groupby(["key", "low", "high"], sort=True):
        left = _Members(of[of["block"] == low])
        right = left if low == high else _Members(of[of["block"] == high])
        if len(left.node) and len(right.node):
            yield left, right, low == high


def _named(turn: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """One partner for every node that has a likely one in another component."""
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]

        def name(of: _Members, among: _Members) -> None:
            rank = ((among.node.view(np.uint64) ^ np.uint64(turn + 1)) * _ODD >> np.uint64(11)).astype(float) / 2 ** 53
            for s, found in of.against(among):
                cost = np.where(found >= SURE, rank, np.where(found < 0, 9, 2 - found))
                best = cost.argmin(axis=1)
                least = cost[np.arange(len(best)), best]
                has = least < 9
                out.append((of.node[s:s + len(best)][has], among.node[best[has]], least[has]))

        for left, right, same in _meetings(rows):
            name(left, right)
            if not same:
                name(right, left)
        u, v, cost = (np.concatenate(c) for c in zip(*out, strict=True))
        return pd.DataFrame({"u": u, "v": v, "cost": cost})
    return run


def _open(rows: pd.DataFrame) -> pd.DataFrame:
    """The members of a lot with a likely partner in another component."""
    out = [rows[["key", "low", "high", "block", "node"]].iloc[:0]]
    for left, right, same in _meetings(rows):
        of_left, of_right = np.zeros(len(left.node), dtype=bool), np.zeros(len(right.node), dtype=bool)
        for s, found in left.against(right):
            of_left[s:s + len(found)] = (found > 0).any(axis=1)
            of_right |= (found > 0).any(axis=0)
        out.append(left.rows[["key", "low", "high", "block", "node"]][of_left])
        if not same:
            out.append(right.rows[["key", "low", "high", "block", "node"]][of_right])
    return pd.concat(out, ignore_index=True)


def _tied(rows: pd.DataFrame) -> pd.DataFrame:
    """Verified links that tie all components of a lot that have a pair similar enough."""
    out = []
    for left, right, _ in _meetings(rows):
        label: dict[int, int] = {}

        def find(x: int) -> int:
            while label.get(x, x) != x:
                label[x] = x = label.get(label[x], label[x])
            return x

        sets_left, sets_right = left.rows["set"].to_numpy(), right.rows["set"].to_numpy()
        pairs = [(i + s, j, found[i, j]) for s, found in left.against(right) for i, j in np.argwhere(found > 0)]
        for i, j, _ in sorted(pairs, key=lambda p: -p[2]):
            a, b = find(left.root[i]), find(right.root[j])
            if a != b:
                common = len(np.intersect1d(sets_left[i], sets_right[j], assume_unique=True))
                if OF * common >= LEAST * (len(sets_left[i]) + len(sets_right[j]) - common):
                    label[a] = b
                    out.append((left.node[i], right.node[j]))
    return pd.DataFrame(out, columns=["u", "v"])


def _lots(met: DataFrame, total: int, each: int) -> DataFrame:
    return met.withColumn("lot", F.pmod(F.xxhash64("key", "low", "high"), F.lit(max(8, -(-total // each))))).groupBy("lot")


def rooted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, row_hash, root`` for every row: ``root`` is the smallest node of its component."""
    texts = docs.select(F.col(f"`{key}`").alias("doc_id"), row_hash(docs), F.col(f"`{text}`").alias("text"))
    marked = stored(texts.select("doc_id", "row_hash", _marks("text").alias("m")).select("doc_id", "row_hash", "m.*"))
    nodes = marked.dropDuplicates(["node"]).select("node", "size", "bands")
    each = stored(nodes.select("node", "size", F.explode("bands").alias("key")))
    # Bands with the same nodes are one list.
    sums = [F.sum(F.xxhash64("node", F.lit(salt)).cast("decimal(20,0)")).alias(f"sum_{salt}") for salt in (1, 2)]
    lists = (each.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles"), *sums).where("n > 1")
             .groupBy("n", "shingles", "sum_1", "sum_2").agg(F.min("key").alias("key")))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    postings = stored(each.join(lists.select("key", blocks.alias("blocks")), "key"))
    some = stored(marked.join(postings.select("node").distinct(), "node").groupBy("node").agg(F.min("row_hash").alias("row_hash"), F.first("sketch").alias("sketch")))
    sets = stored(texts.select("row_hash", "text").join(hinted(some.select("node", "row_hash"), some.count()), "row_hash")
                  .dropDuplicates(["node"]).select("node", _sets("text").alias("set")))
    edges, member = None, None

    def met() -> tuple[DataFrame, int]:
        """Members of lists that hold more than one component, once for each pair of blocks they are in."""
        here = postings.join(some.select("node", "sketch"), "node")
        if member is None:
            here = here.withColumn("root", F.col("node"))
        else:
            here = here.join(member, "node", "left").withColumn("root", F.coalesce("root", "node"))
            several = here.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
            here = here.join(several, "key", "left_semi")
        block = F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).cast("int")
        here = stored(here.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                      .select("key", "node", "root", "size", "sketch", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")))
        return here, here.count()

    def grown(found: DataFrame) -> tuple[DataFrame, DataFrame]:
        found = stored(found)
        now = found if edges is None else edges.union(found)
        return now, stored(components(now))

    for turn in range(ROUNDS):
        here, rows = met()
        named = (_lots(here, rows, LOT).applyInPandas(_named(turn), "u bigint, v bigint, cost double")
                 .groupBy("u").agg(F.min(F.struct("cost", "v"))["v"].alias("v")))
        edges, member = grown(_verified(named.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), sets))
    here, rows = met()
    left = stored(_lots(here, rows, LOT).applyInPandas(_open, "key bigint, low int, high int, block int, node bigint"))
    full = (here.join(left, ["key", "low", "high", "block", "node"], "left_semi").join(sets, "node"))
    shingle_rows = here.join(left, ["key", "low", "high", "block", "node"], "left_semi").agg(F.sum("size")).first()[0] or 0
    edges, member = grown(_lots(full, shingle_rows, LOT_SHINGLES).applyInPandas(_tied, "u bigint, v bigint"))
    return marked.select("doc_id", "row_hash", "node").join(member, "node", "left").select(
        "doc_id", "row_hash", F.coalesce("root", "node").alias("root"))


def one_of_similar(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Of documents tied by near copies, the one with the smallest id (null last), with all its columns."""
    return one_per_root(docs, rooted(docs, key, text), key)
