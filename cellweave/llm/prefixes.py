"""The prefix trie of conversations, from padded matrices of turn ids.

A conversation is its sequence of turns; a turn is named by 128 bits of a digest of role and text. Equal sequences are one
row with its number of conversations. Rows are dealt into ranges of sequences (shards). A shard is a matrix of turn ids, one
row per sequence, padded at the end: rows are sorted, a mask of the columns that differ from the row above is OR-accumulated
along the row, and each set place of a column starts a node of that depth. Everything a node needs is then a sum or a minimum
over the rows between two starts, taken by ``reduceat`` for every depth.

Only nodes on the path of a shard's first or last row can go on in another shard. A shard returns these two rows with what it
has found along them; they form a far smaller table (two rows of a shard), which is sharded in the same way until one shard is
left. Children of such a node learn its smallest conversation by its shard, so no key of that join is hot.

Defined cases: a null role or text is empty; turns are in the order of ``turn``, null first, ties by the digest of role and
text, and repeated rows are turns of their own; rows without a conversation id belong to no conversation and are left out; a
conversation without turns is a member of the root alone; no conversations give no nodes. A conversation is one row of 16
bytes a turn. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import stored

# Conversations of one block share their first turns with the block's first conversation.
FAMILY = 100
MOST_SHARED = 6
# Cells (rows times longest row) of one matrix, rows it has at least, and shards a table is dealt into at least.
CELLS, LEAST_ROWS, FEW = 500_000, 8, 16
# Ids of equal conversations are joined in parts of 2^8 consecutive numbers before they are digested.
_PART_BITS = 8

_NONE = hashlib.sha256(b"").hexdigest()
_FAR = np.iinfo(np.int64).max
_SUMS = ("n", "weight", "lens_in", "leaves_in", "children_in")

_OUT = ("kind int, shard bigint, side int, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
        "n_leaves bigint, saved_tokens bigint, ends_sha256 string, path binary, lens array<bigint>, "
        + ", ".join(f"{c} array<bigint>" for c in (*_SUMS, "least")) + ", ends array<string>, "
        "own_shard bigint, own_side int, with_first int, with_last int")
_NODE, _PATH, _ROW = range(3)


def turns_of(rows: DataFrame) -> DataFrame:
    """``conv_id, turns``: every conversation's turns in order, each its name (hex) and the code points of its text."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in ("role", "text"))
    name = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)
    each = rows.select(F.col("`conv_id`").cast("bigint").alias("conv_id"),
                       F.struct(F.col("`turn`").alias("turn"), name.alias("name"), F.char_length(text).cast("bigint").alias("len")).alias("t"))
    return each.where("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def shared_turns(conv_id: Column) -> Column:
    return F.pmod(F.crc32(conv_id.cast("string")), F.lit(MOST_SHARED)).cast("int")


def rebuilt(convs: DataFrame) -> DataFrame:
    """``conv_id, turns`` with a conversation's first turns taken from the first of its family."""
    none = F.array().cast(convs.schema["turns"].dataType)
    heads = convs.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("family"), F.slice("turns", 1, MOST_SHARED - 1).alias("head"))
    h = shared_turns(F.col("conv_id"))
    return (convs.withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, "family", "left")
            .select("conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), h),
                                        F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))).alias("turns")))


def _digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of one path follow each other, in the order of ids: one row of each, its ids digested as they pass."""
    now, sha, n, least, lens = None, None, 0, 0, None

    def row() -> tuple:
        return now, lens, n, least, sha.hexdigest()

    for batch in batches:
        out = []
        for path, length, count, low, ids in zip(batch["path"], batch["lens"], batch["n"], batch["conv_id"], batch["ids"], strict=True):
            if sha is None or path != now:
                if sha is not None:
                    out.append(row())
                now, sha, n, least, lens = path, hashlib.sha256(ids.encode()), count, low, length
            else:
                sha.update(b"," + ids.encode())
                n += count
        yield pd.DataFrame(out, columns=["path", "lens", "n", "conv_id", "ends"])
    if sha is not None:
        yield pd.DataFrame([row()], columns=["path", "lens", "n", "conv_id", "ends"])


def sequences(convs: DataFrame) -> DataFrame:
    """``path, lens, n, conv_id, ends``: distinct sequences, the conversations that have them, and the digest of their ids."""
    each = convs.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["name"]), "")).alias("path"),
                        F.transform("turns", lambda t: t["len"]).alias("lens"))
    parts = (each.groupBy("path", F.shiftright("conv_id", _PART_BITS).alias("part"))
             .agg(F.first("lens").alias("lens"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"),
                  F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")))
    return (parts.repartition("path").sortWithinPartitions("path", "part")
            .mapInPandas(_digested, "path binary, lens array<bigint>, n bigint, conv_id bigint, ends string"))


def turn_matrix(paths: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Turn ids, whole numbers in the order of the names, padded with -1, and the length of each row."""
    lengths = np.array([len(p) // 16 for p in paths], dtype=np.int64)
    names = np.frombuffer(b"".join(paths), dtype=">u8").reshape(-1, 2).astype(np.uint64)
    order = np.lexsort((names[:, 1], names[:, 0]))
    new = np.r_[False, (names[order[1:]] != names[order[:-1]]).any(axis=1)] if len(order) else np.zeros(0, dtype=bool)
    ids = np.empty(len(names), dtype=np.int64)
    ids[order] = np.cumsum(new)
    out = np.full((len(paths), int(lengths.max(initial=0))), -1, dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    out[np.repeat(np.arange(len(paths)), lengths), np.arange(len(ids)) - np.repeat(starts, lengths)] = ids
    return out, lengths


def _after(values: np.ndarray) -> np.ndarray:
    """Sums from each column to the last."""
    return np.cumsum(values[:, ::-1], axis=1)[:, ::-1]


def _shard(rows: pd.DataFrame, shard: int, top: bool) -> list[pd.DataFrame]:
    """Nodes of one shard, and its first and last row with what belongs to the nodes along them."""
    ids, lengths = turn_matrix(list(rows["path"]))
    order = np.lexsort(ids.T[::-1]) if ids.shape[1] else np.arange(len(ids))
    rows, ids, lengths = rows.iloc[order], ids[order], lengths[order]
    n_rows, width = len(ids), ids.shape[1] + 1
    at = np.arange(width)
    valid = at <= lengths[:, None]
    filled = np.arange(width - 1) < lengths[:, None]

    def matrix(arrays: pd.Series, mask: np.ndarray, dtype: type = np.int64) -> np.ndarray:
        out = np.full(mask.shape, None if dtype is object else 0, dtype=dtype)
        out[mask] = np.concatenate([np.asarray(a) for a in arrays]) if len(arrays) else []
        return out

    lens = np.zeros((n_rows, width), dtype=np.int64)
    lens[:, 1:] = matrix(rows["lens"], filled)
    if "conv_id" in rows and rows["conv_id"].notna().all():  # sequences; else rows that shards returned
        n = rows["n"].to_numpy(dtype=np.int64)[:, None]
        sums = {c: np.zeros((n_rows, width), dtype=np.int64) for c in _SUMS}
        sums["n"], sums["weight"] = n * valid, n * _after(lens)
        least = np.where(valid, rows["conv_id"].to_numpy(dtype=np.int64)[:, None], _FAR)
        ends = np.full((n_rows, width), None, dtype=object)
        ends[np.arange(n_rows), lengths] = rows["ends"].to_numpy()
    else:
        sums = {c: matrix(rows[c], valid) for c in _SUMS}
        least = np.where(valid, matrix(rows["least"], valid), _FAR)
        ends = matrix(rows["ends"], valid, object)
    # Masks of changes against the row above, accumulated along the row: a set place starts a node.
    start = np.zeros((n_rows, width), dtype=bool)
    start[1:, 1:] = ids[1:] != ids[:-1]
    start[0] = True
    start = np.logical_or.accumulate(start, axis=1)
    with_first, with_last = (np.cumprod((ids == ids[k]) & filled, axis=1).sum(axis=1) for k in (0, -1))
    own = start & valid
    border = np.zeros_like(valid) if top else valid & ((at <= with_first[:, None]) | (at <= with_last[:, None]))
    inner = own & ~border

    def per_node(values: np.ndarray, add: np.ufunc = np.add) -> np.ndarray:
        """At the start of each node, ``values`` of its depth over its rows."""
        out = np.zeros((n_rows, width), dtype=np.int64)
        for d in range(width):
            first = np.flatnonzero(start[:, d])
            out[first, d] = add.reduceat(values[:, d], first)
        return out

    n_convs, smallest = per_node(sums["n"]), per_node(least, np.minimum)
    born = np.zeros((n_rows, width), dtype=np.int64)
    born[:, :-1] = inner[:, 1:]
    n_children = per_node(sums["children_in"] + born)
    n_leaves = per_node(sums["leaves_in"] + _after(inner & (n_children == 0)))
    weight, lens_in = per_node(sums["weight"]), per_node(sums["lens_in"] + _after(lens * inner))
    # The row at which the node of each place starts.
    head = np.maximum.accumulate(np.where(start, np.arange(n_rows)[:, None], 0), axis=0)
    digest = np.full((n_rows, width), None, dtype=object)
    r, d = np.nonzero(ends != None)  # noqa: E711
    digest[head[r, d], d] = ends[r, d]

    r, d = np.nonzero(inner)
    up = np.maximum(d - 1, 0)
    top_row = head[r, up]
    parent_known = (d > 0) & ~border[r, up]
    out = [pd.DataFrame({
        "kind": _NODE, "shard": shard, "side": np.where(up <= with_first[r], 0, 1).astype(np.int32),
        "conv_id": smallest[r, d], "depth": d, "parent_conv_id": pd.array(smallest[top_row, up], dtype="Int64"), "n_convs": n_convs[r, d],
        "n_children": n_children[r, d], "n_leaves": n_leaves[r, d], "saved_tokens": weight[r, d] - lens_in[r, d],
        "ends_sha256": np.where(digest[r, d] == None, _NONE, digest[r, d])})]  # noqa: E711
    out[0].loc[~parent_known, "parent_conv_id"] = pd.NA
    if top:
        out[0]["side"] = np.int32(-1)
    else:
        paths, parts = list(rows["path"]), {"n": n_convs, "weight": weight, "lens_in": lens_in, "leaves_in": n_leaves, "children_in": n_children}
        both = int(with_first[-1])  # nodes the two rows share belong to the first
        for side, k in ((0, 0), (1, n_rows - 1))[:2 if n_rows > 1 else 1]:
            here = np.arange(lengths[k] + 1)
            mine = here > (both if side else -1)
            row = {"kind": _PATH, "shard": shard, "side": np.int32(side), "path": paths[k], "lens": lens[k, 1:lengths[k] + 1],
                   "least": np.where(mine, smallest[head[k, here], here], _FAR),
                   "ends": np.where(mine, digest[head[k, here], here], None)}
            row |= {c: np.where(mine, v[head[k, here], here], 0) for c, v in parts.items()}
            out.append(pd.DataFrame([row]))
    if "side" in rows:  # rows that shards returned learn the smallest conversation along their path
        found = np.where(border, _FAR, smallest[head, at])
        out.append(pd.DataFrame({
            "kind": _ROW, "shard": shard, "own_shard": rows["shard"].to_numpy(), "own_side": rows["side"].to_numpy(dtype=np.int32),
            "least": [found[k, :lengths[k] + 1] for k in range(n_rows)],
            "with_first": np.where(top, -1, with_first).astype(np.int32), "with_last": np.where(top, -1, with_last).astype(np.int32)}))
    return [f.assign(**{c: pd.Series([None] * len(f), dtype=object) for c in _NAMES if c not in f}) for f in out]


_NAMES = [c.split()[0] for c in _OUT.split(", ")]


def _shards(top: bool, most_cells: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, pending = TaskContext.get().partitionId() << 32, None

        def done(rows: pd.DataFrame) -> list[pd.DataFrame]:
            nonlocal number
            number += 1
            return _shard(rows, number, top)

        for batch in batches:
            pending = batch if pending is None else pd.concat([pending, batch], ignore_index=True)
            while not top:
                longest = np.maximum.accumulate(pending["lens"].map(len).to_numpy(dtype=np.int64, na_value=0))
                over = np.flatnonzero((longest + 1) * np.arange(1, len(pending) + 1) > most_cells)
                cut = max(LEAST_ROWS, over[0]) if len(over) else len(pending)
                if cut >= len(pending):
                    break
                yield from done(pending.iloc[:cut])
                pending = pending.iloc[cut:].reset_index(drop=True)
        if pending is not None and len(pending):
            yield from done(pending)
    return run


def _pass(rows: DataFrame, least_shards: int, most_cells: int) -> tuple[DataFrame, bool]:
    """One round over all rows, and whether it was the last: one shard that holds everything.

    A shard has ``LEAST_ROWS`` rows or more on average and returns two, so the rounds end.
    """
    n, cells = rows.agg(F.count(F.lit(1)), F.sum(F.size("lens") + 1)).first()
    shards = min(max(least_shards, -(-2 * (cells or 0) // most_cells)), n // LEAST_ROWS)
    if shards <= 1:
        return stored(rows.repartition(1).mapInPandas(_shards(True, most_cells), _OUT)), True
    dealt = rows.repartitionByRange(shards, "path").sortWithinPartitions("path")
    return stored(dealt.mapInPandas(_shards(False, most_cells), _OUT)), False


def _learned(rows: DataFrame, above: DataFrame | None) -> DataFrame:
    """``shard, side, least``: the smallest conversation of every node along the rows of a round."""
    own = rows.where(F.col("kind") == _ROW).select("shard", F.col("own_shard").alias("o_shard"), F.col("own_side").alias("o_side"), "least", "with_first", "with_last")
    if above is None:
        return own.select(F.col("o_shard").alias("shard"), F.col("o_side").alias("side"), "least")
    first = above.where("side = 0").select("shard", F.col("least").alias("first"))
    last = above.where("side = 1").select("shard", F.col("least").alias("last"))
    found = F.transform("least", lambda x, i: F.when(i <= F.col("with_first"), F.col("first")[i]).when(i <= F.col("with_last"), F.col("last")[i]).otherwise(x))
    return own.join(first, "shard").join(last, "shard", "left").select(F.col("o_shard").alias("shard"), F.col("o_side").alias("side"), found.alias("least"))


def trie(found: DataFrame, few: int = FEW, most_cells: int = CELLS) -> DataFrame:
    """Nodes of the trie over ``sequences``: one row per distinct prefix."""
    rounds, rows, last, turn = [], stored(found), False, 0
    while not last:
        out, last = _pass(rows, few if turn == 0 else 1, most_cells)
        rounds.append(out)
        rows = out.where(F.col("kind") == _PATH).select("shard", "side", "path", "lens", *_SUMS, "least", "ends")
        turn += 1
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    nodes, above = None, None
    for out in reversed(rounds):
        here = out.where(F.col("kind") == _NODE)
        if above is not None:
            unknown = F.col("parent_conv_id").isNull()
            joined = here.where(unknown).join(above, ["shard", "side"]).withColumn("parent_conv_id", F.col("least_up")[(F.col("depth") - 1).cast("int")])
            here = here.where(~unknown).select(columns).unionByName(joined.select(columns))
        else:
            here = here.select(columns)
        nodes = here if nodes is None else nodes.unionByName(here)
        if out is not rounds[0]:
            learned = _learned(out, None if above is None else above.withColumnRenamed("least_up", "least"))
            above = stored(learned.withColumnRenamed("least", "least_up"))
    return nodes


def conversation_trie(rows: DataFrame, most_cells: int = CELLS) -> DataFrame:
    """The trie of all rebuilt conversations of ``conv_id, turn, role, text``."""
    return trie(sequences(rebuilt(stored(turns_of(rows)))), most_cells=most_cells)
