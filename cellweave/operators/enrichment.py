"""Which cell types lie next to each other more often than chance: seeded shuffles of the types inside each image.

A shuffle of an image's types is a permutation of its cells' numbers: cells are numbered by type, so that the type at a number
follows from the counts of types, and the permutation is a keyed one that is computed for each number by itself.

Cells are dealt out by image, and that is all that is shuffled of them: a task takes its images as they come, some thousand cells
at once, numbers and shuffles them, finds their neighbours and adds up all shuffles. No image over a bound is gathered, nor one with a
crowded square: there, numbers come from one sort of all cells, types under all shuffles are a few bits each per cell, and
neighbour pairs are found once and carry the two arrays, so that all shuffles are tallied in one pass over the pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.operators.lineage import materialize
from cellweave.operators.neighbors import SIDE_IN_RADII, SQUARE_CELLS, radius_pairs

_ROUNDS = 6
# Tallies a worker keeps as a plain table; with more types they are sorted instead.
_TABLE = 1 << 22
_ROW_BITS = 33
# Cells of an image that one task takes whole, unless a square is crowded.
IMAGE_CELLS = 100_000
# Cells a task sorts: enough to be worth one, and as many as it sorts in memory.
_TASK_CELLS = 50_000, 1_200_000
# Cells of whole images a task works on at once, and pairs it compares at once.
_AT_ONCE = 40_000
_CANDIDATES = 1 << 20
_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _mix(x: np.ndarray, key: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ key) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def _half_bits(size: np.ndarray) -> np.ndarray:
    return np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2).astype(float))).astype(np.int64) + 1) // 2)


def permuted(number: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The place of each ``number`` (below its ``size``) under the permutation of its ``key``.

    A balanced Feistel network over the next power of 4, walked on until the place is below the size.
    """
    half = _half_bits(size).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    size, out = size.astype(np.uint64), number.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        keys, low, bits = key[todo], mask[todo], half[todo]
        left, right = out[todo] >> bits, out[todo] & low
        for turn in range(_ROUNDS):
            left, right = right, left ^ (_mix(right, keys + np.uint64(turn)) & low)
        placed = (left << bits) | right
        out[todo] = placed
        todo = todo[placed >= size[todo]]
    return out.astype(np.int64)


def permuted_images(size: np.ndarray, key: np.ndarray, seeds: Iterable[int]) -> Iterator[np.ndarray]:
    """Under each seed, the places ``permuted`` gives to all numbers of whole images that lie one behind the other.

    A round hangs on the right half alone, so that an image needs a table of its halves and not the round of every number.
    """
    half = _half_bits(size)
    width = np.int64(1) << half
    # Wider tables come first: each begins at a multiple of its width, so that a half with the beginning added is still one number.
    order = np.argsort(-half, kind="stable")
    begin = np.empty(len(size), dtype=np.int64)
    begin[order] = np.cumsum(width[order]) - width[order]
    owner = np.repeat(order, width[order])
    entry, entry_mask = (np.arange(len(owner)) - begin[owner]).astype(np.uint64), (width - 1).astype(np.uint64)[owner]
    first = np.cumsum(size) - size
    image = np.repeat(np.arange(len(size)), size)
    number = np.arange(len(image)) - first[image]
    bits, mask, start, end = half[image], (width - 1)[image], first[image], size[image]
    halves = begin[image] + (number >> bits), begin[image] + (number & mask)
    for seed in seeds:
        keys = _mix(key, np.uint64(seed))[owner]
        rounds = [(_mix(entry, keys + np.uint64(turn)) & entry_mask).astype(np.int64) for turn in range(_ROUNDS)]
        (left, right), out, todo = halves, np.empty(len(image), dtype=np.int64), slice(None)
        while True:
            for table in rounds:
                left, right = right, left ^ table.take(right)
            placed = ((left & mask[todo]) << bits[todo]) | (right & mask[todo])
            out[todo] = placed
            over = np.flatnonzero(placed >= end[todo])
            if not len(over):
                break
            todo = over if isinstance(todo, slice) else todo[over]
            left, right = left[over], right[over]
        yield out + start


def numbered(cells: DataFrame) -> DataFrame:
    """Cells with ``number``, their place in the image by type, and ``n``, ``starts``: cells, and the first number per type.

    One sort over all cells; a cell's number is its place in the sorted table less the first place of its image.
    """
    # The number holds the part of the sorted table and the place in it, so equal images and types follow each other in a part.
    placed = materialize(cells.select("image_id", "condition", "cell_id", "x", "y", "cell_type")
                         .where("image_id is not null and cell_type is not null")
                         .orderBy("image_id", "cell_type", "cell_id", "x", "y").withColumn("place", F.monotonically_increasing_id()))
    part, row = F.shiftright("place", _ROW_BITS), F.col("place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    counts = materialize(placed.groupBy("image_id", "cell_type", part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min(row).alias("low")))
    per_type = counts.groupBy("image_id", "cell_type").agg(F.sum("n").alias("n"))
    of_image = (per_type.groupBy("image_id").agg(F.sum("n").alias("n_cells"), F.array_sort(F.collect_list(F.struct("cell_type", "n"))).alias("types")))
    before = F.transform("types", lambda t, i: F.aggregate(F.slice("types", F.lit(1), i), F.lit(0).cast("bigint"), lambda acc, e: acc + e["n"]))
    of_image = of_image.select("image_id", "n_cells", F.transform("types", lambda t: t["cell_type"]).alias("kinds"), before.alias("starts"))
    # Parts of one type and image, and where each begins: few rows per image, but for an image spread over many parts.
    others = counts.select("image_id", "cell_type", F.col("part").alias("o_part"), F.col("n").alias("o_n"))
    shift = (counts.join(others, ["image_id", "cell_type"]).where("o_part < part")
             .groupBy("image_id", "cell_type", "part").agg(F.sum("o_n").alias("shift")))
    starts = (counts.join(shift, ["image_id", "cell_type", "part"], "left").join(of_image, "image_id")
              .select("image_id", "cell_type", "part", "low", "n_cells", "kinds", "starts",
                      (F.coalesce("shift", F.lit(0)) + F.col("starts")[F.array_position("kinds", F.col("cell_type")).cast("int") - 1]).alias("first")))
    return (placed.withColumns({"part": part, "row": row}).join(starts, ["image_id", "cell_type", "part"])
            .select("image_id", "condition", "cell_id", "x", "y", "cell_type", (F.col("first") + F.col("row") - F.col("low")).alias("number"),
                    "n_cells", "kinds", "starts"))


def code_bits(n_kinds: int) -> int:
    """Bits of one type's number: 1, 2, 4, 8 or 16."""
    return next(b for b in (1, 2, 4, 8, 16) if n_kinds <= 1 << b)


def packed(codes: np.ndarray, bits: int) -> list[bytes]:
    """Each row of type numbers as bytes, ``bits`` a number."""
    if bits == 16:
        return [r.tobytes() for r in codes.astype(np.uint16)]
    each = 8 // bits
    rows = np.zeros((len(codes), -(-codes.shape[1] // each) * each), dtype=np.uint8)
    rows[:, :codes.shape[1]] = codes
    out = np.zeros((len(rows), rows.shape[1] // each), dtype=np.uint8)
    for i in range(each):
        out |= rows[:, i::each] << np.uint8(i * bits)
    return [r.tobytes() for r in out]


def unpacked(rows: pd.Series, width: int, bits: int) -> np.ndarray:
    """The type numbers of ``packed`` rows."""
    if bits == 16:
        return np.frombuffer(b"".join(rows), dtype=np.uint16).reshape(len(rows), width).astype(np.int64)
    each = 8 // bits
    read = np.frombuffer(b"".join(rows), dtype=np.uint8).reshape(len(rows), -(-width // each))
    out = np.empty((len(rows), read.shape[1] * each), dtype=np.int64)
    for i in range(each):
        out[:, i::each] = (read >> np.uint8(i * bits)) & np.uint8((1 << bits) - 1)
    return out[:, :width]


def shuffled(cells: DataFrame, kinds: list[str], permutations: int, seed: int, bits: int = 16) -> DataFrame:
    """Cells with ``codes``: their type as a number in ``kinds`` (``bits`` each), first as it is, then under each shuffle."""
    code = {k: i for i, k in enumerate(kinds)}

    @F.pandas_udf("binary")
    def codes(image: pd.Series, number: pd.Series, n: pd.Series, own: pd.Series, types: pd.Series, starts: pd.Series) -> pd.Series:
        out = np.empty((len(number), permutations + 1), dtype=np.uint16)
        out[:, 0] = own.map(code)
        key, number, n = image.to_numpy().view(np.uint64), number.to_numpy(), n.to_numpy()
        # The images of the batch lie one behind the other, so that one sorted list holds the first numbers of all their types.
        _, first, place = np.unique(key, return_index=True, return_inverse=True)
        base = np.cumsum(n[first]) - n[first]
        begin = np.concatenate([np.asarray(starts.iloc[i]) + b for i, b in zip(first, base, strict=True)])
        named = np.array([code[t] for i in first for t in types.iloc[i]], dtype=np.uint16)
        base = base[place]
        for p in range(permutations):
            at = permuted(number, n, _mix(key, np.full(len(key), np.uint64(seed * 1_000_003 + p))))
            out[:, p + 1] = named[np.searchsorted(begin, at + base, side="right") - 1]
        return pd.Series(packed(out, bits))

    return cells.withColumn("codes", codes(F.xxhash64("image_id"), "number", "n_cells", "cell_type", "kinds", "starts"))


def _tallied(batches: Iterator[pd.DataFrame], n_kinds: int, width: int) -> Iterator[pd.DataFrame]:
    held: dict[str | None, dict] = {}
    bits = code_bits(n_kinds)
    cells = width * n_kinds * n_kinds
    for batch in batches:
        for group, of in batch.groupby("grp", dropna=False, sort=False):
            a, b = (unpacked(of[c], width, bits) for c in ("a", "b"))
            code = ((np.arange(width) * n_kinds + a) * n_kinds + b).ravel()
            group = None if pd.isna(group) else group
            if cells <= _TABLE:
                held[group] = held.get(group, 0) + np.bincount(code, minlength=cells)
            else:
                found, n = np.unique(code, return_counts=True)
                yield pd.DataFrame({"grp": group, "code": found, "n": n})
    for group, table in held.items():
        found = np.flatnonzero(table)
        yield pd.DataFrame({"grp": group, "code": found, "n": table[found]})


def _whole_images(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by image, in tables of whole images."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= _AT_ONCE:
            found = pa.Table.from_batches(held)
            image = _encoded(found["image_id"])[0]
            last = np.flatnonzero(image != image[-1])
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                yield found.slice(0, cut)
            held = found.slice(cut).combine_chunks().to_batches()
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


def _encoded(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """Values as numbers, and what they stand for; null is a value like others."""
    found = column.combine_chunks().dictionary_encode(null_encoding="encode")
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary


def _near(image: np.ndarray, x: np.ndarray, y: np.ndarray, radius: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of two cells of one image within the radius, each two once, some at a time."""
    # A hair over the radius, so rounding never loses a pair at exactly the radius.
    side = radius * (1 + 1e-6) or 1.0
    sx, sy = np.floor(x / side), np.floor(y / side)
    order = np.lexsort((sy, sx, image))
    image, sx, sy, x, y = image[order], sx[order], sy[order], x[order], y[order]
    # Cells by strip and by step of y in it: a cell's partners lie behind it in its strip, or around its step in the next one.
    new = np.ones(len(order), dtype=bool)
    new[1:] = (image[1:] != image[:-1]) | (sx[1:] != sx[:-1])
    strip, opening = np.cumsum(new) - 1, np.flatnonzero(new)
    beside = np.zeros(len(opening), dtype=bool)
    beside[:-1] = (image[opening[1:]] == image[opening[:-1]]) & (sx[opening[1:]] == sx[opening[:-1]] + 1)
    steps, step = np.unique(sy, return_inverse=True)
    below, above = np.searchsorted(steps, steps - 1)[step], np.searchsorted(steps, steps + 1, "right")[step]
    many = len(steps) + 1
    at = strip * many + step
    own, following = np.arange(len(order)) + 1, beside[strip]
    ranges = [(own, np.searchsorted(at, strip * many + above)),
              (np.searchsorted(at, (strip + 1) * many + below), np.searchsorted(at, (strip + 1) * many + above))]
    for low, high in ranges:
        n = high - low if low is own else np.where(following, high - low, 0)
        total = np.cumsum(n)
        done = 0
        while done < len(n):
            # One cell at least, and no more candidates than the bound for the others.
            until = max(done + 1, np.searchsorted(total, (total[done - 1] if done else 0) + _CANDIDATES, "right"))
            some = n[done:until]
            a = np.repeat(np.arange(done, until), some)
            b = np.arange(len(a)) - np.repeat(np.cumsum(some) - some, some) + np.repeat(low[done:until], some)
            dx, dy = x[a] - x[b], y[a] - y[b]
            near = (dx * dx + dy * dy).astype(float) <= radius * radius
            done = until
            yield order[a[near]], order[b[near]]


def _tallied_images(batches: Iterable[pa.RecordBatch], kinds: list[str], permutations: int, seed: int, radius: float) -> Iterator[pa.RecordBatch]:
    """Tallies of ``_tallied`` from cells sorted by image, type and id, with ``key``, the hash of the image."""
    code, n_kinds, width = {k: i for i, k in enumerate(kinds)}, len(kinds), permutations + 1
    square = n_kinds * n_kinds
    held: dict[str | None, np.ndarray] = {}

    def rows(group: list, found: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(group, pa.string()), pa.array(found, pa.int64()), pa.array(n, pa.int64())], ["grp", "code", "n"])

    def emptied() -> Iterator[pa.RecordBatch]:
        while held:
            group, table = held.popitem()
            found = np.flatnonzero(table)
            yield rows([group] * len(found), found, table[found])

    for cells in _whole_images(batches):
        image = _encoded(cells["image_id"])[0]
        first = np.flatnonzero(np.diff(image, prepend=-1))
        types, named = _encoded(cells["cell_type"])
        own = np.array([code[t] for t in named.to_pylist()], dtype=np.uint16)[types]
        codes = np.empty((width, len(own)), dtype=np.uint16)
        codes[0] = own
        key = cells["key"].to_numpy()[first].view(np.uint64)
        places = permuted_images(np.diff(first, append=len(image)), key, (seed * 1_000_003 + p for p in range(permutations)))
        for p, place in enumerate(places):
            codes[p + 1] = own.take(place)
        group, groups = _encoded(cells["condition"])
        groups, ids = groups.to_pylist(), _encoded(cells["cell_id"])[0]
        x, y = (at.astype(np.int64) if at.dtype.kind == "i" else at for at in (cells["x"].to_numpy(), cells["y"].to_numpy()))
        known = np.isfinite(x) & np.isfinite(y) & cells["cell_id"].is_valid().to_numpy()
        some = np.flatnonzero(known)
        dense = len(groups) * width * square <= 4 * _TABLE
        table = np.zeros((width, len(groups) * square) if dense else (0, 0), dtype=np.int64)
        for a, b in _near(image[some], x[some], y[some], radius):
            a, b = some[a], some[b]
            other = ids[a] != ids[b]
            a, b = np.concatenate([a[other], b[other]]), np.concatenate([b[other], a[other]])
            base = group[a] * square
            for p in range(width):
                of = codes[p].astype(np.int64)
                pair = (of * n_kinds).take(a) + of.take(b) + base
                if dense:
                    table[p] += np.bincount(pair, minlength=table.shape[1])
                else:
                    found, n = np.unique(pair, return_counts=True)
                    yield rows([groups[g] for g in found // square], p * square + found % square, n)
        if dense:
            for g, name in enumerate(groups):
                held[name] = held.get(name, 0) + table[:, g * square:(g + 1) * square].ravel()
            if len(held) * width * square > 4 * _TABLE:
                yield from emptied()
    yield from emptied()


def spread_images(cells: DataFrame, sizes: DataFrame, radius: float, whole: int, limit: int) -> DataFrame | None:
    """Images of more than ``whole`` cells or with a square of more than ``limit``, which no task takes whole; None without any.

    ``sizes`` holds the cells of each image, ``n``. Squares are only counted in images that have as many cells.
    """
    over = materialize(sizes.where(F.col("n") > min(whole, limit)))
    if over.isEmpty():
        return None
    edge = float(radius) * SIDE_IN_RADII
    crowded = (cells.join(over.where(F.col("n") <= whole).select("image_id"), "image_id", "left_semi")
               .groupBy("image_id", F.floor(F.col("x") / edge), F.floor(F.col("y") / edge)).agg(F.count(F.lit(1)).alias("n"))
               .where(F.col("n") > limit))
    found = materialize(over.where(F.col("n") > whole).select("image_id").union(crowded.select("image_id")).distinct())
    return None if found.isEmpty() else found


def _counted_whole(cells: DataFrame, n_cells: int, kinds: list[str], radius: float, permutations: int, seed: int) -> DataFrame:
    """Tallies of cells whose images a task takes whole."""
    conf = cells.sparkSession.conf
    # Up to so many parts a task writes side by side as rows come; for more it sorts its rows first, and spills.
    unsorted = int(conf.get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    most, least = (-(-n_cells // n) for n in _TASK_CELLS)
    parts = max(1, least, min(most, int(conf.get("spark.sql.shuffle.partitions")), unsorted))
    dealt = cells.repartition(parts, "image_id").sortWithinPartitions("image_id", "cell_type", "cell_id", "x", "y")
    kind = dict(cells.dtypes)
    numbers = {c: F.col(c).cast("double") for c in ("x", "y") if kind[c] not in _NUMBERS}
    # The hash follows from the image, so it is not shuffled.
    rows = dealt.withColumns({**numbers, "key": F.xxhash64("image_id")})
    return rows.mapInArrow(lambda batches: _tallied_images(batches, kinds, permutations, seed, radius), "grp string, code bigint, n bigint")


def _counted_spread(cells: DataFrame, kinds: list[str], radius: float, permutations: int, seed: int) -> DataFrame:
    """Tallies of cells whose images are dealt out over the tasks."""
    n_kinds, width = len(kinds), permutations + 1
    marked = materialize(shuffled(numbered(cells), kinds, permutations, seed, code_bits(n_kinds))
                         .select("image_id", "condition", "cell_id", "x", "y", "codes"))
    pairs = radius_pairs(marked, marked, radius, ("condition", "codes"), ("codes",)).select(
        F.col("anchor_condition").alias("grp"), F.col("anchor_codes").alias("a"), F.col("neighbor_codes").alias("b"))
    return pairs.mapInPandas(lambda batches: _tallied(batches, n_kinds, width), "grp string, code bigint, n bigint")


def neighbour_enrichment(cells: DataFrame, radius: float, permutations: int = 100, seed: int = 1, by: str = "condition",
                         whole: int = IMAGE_CELLS, limit: int = SQUARE_CELLS) -> DataFrame:
    """``by, anchor_type, neighbor_type, observed, expected, spread, z, p_more, p_less`` of ordered neighbour pairs.

    ``expected`` and ``spread`` (population deviation) are over the shuffles; the p-values count the unshuffled table as one more
    shuffle. Cells without image or type are left out. Type pairs that are neighbours in no shuffle have no row; ``z`` is null
    where the shuffles do not differ. Pairs follow the ids: cells that share an image and an id are not neighbours.
    """
    known = cells.select("image_id", F.col(by).cast("string").alias("condition"), "cell_id", "x", "y", "cell_type").where(
        "image_id is not null and cell_type is not null")
    sizes = materialize(known.groupBy("image_id", "cell_type").agg(F.count(F.lit(1)).alias("n")))
    of_kind = {r["cell_type"]: r["n"] for r in sizes.groupBy("cell_type").agg(F.sum("n").alias("n")).collect()}
    kinds, n_cells = sorted(of_kind), sum(of_kind.values())
    if len(kinds) >= 1 << 16:
        raise ValueError("more cell types than two bytes number")
    n_kinds = len(kinds)
    square = n_kinds * n_kinds
    apart = spread_images(known, sizes.groupBy("image_id").agg(F.sum("n").alias("n")), radius, whole, limit)
    gathered = known if apart is None else known.join(apart, "image_id", "left_anti")
    tallies = _counted_whole(gathered, n_cells, kinds, radius, permutations, seed)
    if apart is not None:
        tallies = tallies.union(_counted_spread(known.join(apart, "image_id", "left_semi"), kinds, radius, permutations, seed))
    counts = tallies.groupBy("grp", "code").agg(F.sum("n").alias("n"))
    split = counts.select("grp", F.floor(F.col("code") / max(1, square)).alias("turn"), F.pmod("code", F.lit(max(1, square))).alias("pair"), "n")
    observed = F.coalesce(F.sum(F.when(F.col("turn") == 0, F.col("n"))), F.lit(0))
    # Shuffles without the pair have no row: they are 0, which is never more than what was observed.
    each = split.groupBy("grp", "pair").agg(
        observed.alias("observed"), F.array_agg(F.when(F.col("turn") > 0, F.col("n"))).alias("shuffles"))
    total = F.aggregate("shuffles", F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    squares = F.aggregate("shuffles", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x)
    missing = F.lit(permutations) - F.size("shuffles")
    more = F.size(F.filter("shuffles", lambda x: x >= F.col("observed"))) + F.when(F.col("observed") == 0, missing).otherwise(0)
    less = F.size(F.filter("shuffles", lambda x: x <= F.col("observed"))) + missing
    table = F.array(*[F.lit(k) for k in kinds]) if kinds else F.array().cast("array<string>")
    found = each.withColumn("expected", total / F.lit(float(permutations))).withColumn(
        "spread", F.sqrt(F.greatest(squares / F.lit(float(permutations)) - F.col("expected") * F.col("expected"), F.lit(0.0))))
    return found.select(
        F.col("grp").alias(by), table[F.floor(F.col("pair") / max(1, n_kinds)).cast("int")].alias("anchor_type"),
        table[F.pmod("pair", F.lit(max(1, n_kinds))).cast("int")].alias("neighbor_type"), "observed", "expected", "spread",
        F.when(F.col("spread") > 0, (F.col("observed") - F.col("expected")) / F.col("spread")).alias("z"),
        ((more + 1) / F.lit(permutations + 1.0)).alias("p_more"), ((less + 1) / F.lit(permutations + 1.0)).alias("p_less"))
