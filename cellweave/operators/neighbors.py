"""Cells within a radius of each other, as grid-bucketed equi-joins.

The plane of every image is cut into squares. An anchor stays in its own square; a partner
is copied to each square its disc touches, so each pair meets exactly once and the anchor's
square is the only join key. A second partner joins on the same key and needs no further
shuffle. Crowded squares are counted once, first; their anchors and partners are cut into blocks
that meet pairwise, so no task has to hold one crowded square alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions.geometry import squared_distance
from cellweave.operators.lineage import materialize
from cellweave.operators.skew import SMALL_ROWS
from cellweave.schema import col

# Square side in radii. At 1 a partner is copied to 9 squares, at 2 to 4, at 4 to 2.25; candidate pairs go
# from 9 over 16 to 36 squared radii. Copies are shuffled and sorted, candidates only compared.
SIDE_IN_RADII = 4.0
# Cells of one role in one square before the square is cut into blocks.
SQUARE_CELLS = 4_000

_SQUARE = ["image_id", "bx", "by"]
# One number per square, short enough to add little to a shuffled row, leads the join key: sorting by it is far
# cheaper than by the image's name. The square itself stays in the key, so equal hashes of two squares do no harm.
_KEY = ["square", *_SQUARE]
SQUARE_KEY = tuple(_KEY)


@dataclass(frozen=True)
class Side:
    """One input of a radius join: a cell table and the prefix of its output columns.

    ``base`` and ``kinds`` tell that the cells are (some of) those types of a larger table.
    """

    cells: DataFrame
    prefix: str
    extra: tuple[str, ...] = ()
    base: DataFrame | None = None
    kinds: tuple[str, ...] = ()

    def columns(self) -> list[str]:
        return ["cell_id", "x", "y", *self.extra]

    def renamed(self) -> DataFrame:
        return self.cells.select(
            "image_id", *[col(c).alias(f"{self.prefix}_{c}") for c in self.columns()])

    def x(self) -> Column:
        return F.col(f"{self.prefix}_x")

    def y(self) -> Column:
        return F.col(f"{self.prefix}_y")

    def id(self) -> Column:
        return F.col(f"{self.prefix}_cell_id")


def _home_square(df: DataFrame, side: Side, edge: float) -> DataFrame:
    return df.withColumns({
        "bx": F.floor(side.x() / edge),
        "by": F.floor(side.y() / edge),
    }).withColumn("square", F.hash(*_SQUARE))


def _touched_squares(df: DataFrame, side: Side, radius: float, edge: float) -> DataFrame:
    # A hair over the radius, so rounding never loses a pair at exactly the radius.
    wide = radius * (1 + 1e-6)

    def reach(v: Column) -> Column:
        return F.explode(F.sequence(F.floor((v - wide) / edge), F.floor((v + wide) / edge)))
    return (df.withColumn("bx", reach(side.x()))
            .withColumn("by", reach(side.y()))
            .withColumn("square", F.hash(*_SQUARE)))


def _crowded(sides: list[Side], edge: float, limit: int) -> DataFrame | None:
    """Crowded squares per role, counted in one pass and stored; None without any.

    Sides taken from one table by type are counted in one pass over that table.
    """
    base = sides[0].base
    if base is not None and all(s.base is base and s.kinds for s in sides):
        kinds = sorted({k for s in sides for k in s.kinds})
        rows = base.where(F.col("cell_type").isin(*kinds)).withColumn("group_kind", F.col("cell_type"))
        roles_of = F.filter(F.array(*[
            F.when(F.col("group_kind").isin(*s.kinds), F.lit(role)) for role, s in enumerate(sides)]),
            lambda r: r.isNotNull())
    elif all(s.cells is sides[0].cells for s in sides):
        rows = sides[0].cells.withColumn("group_kind", F.lit("all"))
        roles_of = F.sequence(F.lit(0), F.lit(len(sides) - 1))
    else:
        parts = [s.cells.select("image_id", "x", "y", F.lit(str(role)).alias("group_kind"))
                 for role, s in enumerate(sides)]
        rows = reduce(DataFrame.unionByName, parts)
        roles_of = F.array(F.col("group_kind").cast("int"))
    squares = rows.select("image_id", F.floor(F.col("x") / edge).alias("bx"), F.floor(F.col("y") / edge).alias("by"), "group_kind")
    crowded = (squares.groupBy(*_SQUARE, "group_kind").agg(F.count(F.lit(1)).alias("group_rows"))
               .where(F.col("group_rows") > limit).select(*_SQUARE, F.explode(roles_of).alias("role"), "group_rows"))
    stored = materialize(crowded)
    return None if stored.isEmpty() else stored


def crowded_blocks(anchor: Side, partners: list[Side], radius: float, edge: float,
                   limit: int) -> tuple[DataFrame, bool] | None:
    """Blocks per crowded square and role, and whether that table is small; None without any.

    Column ``blocks_0`` is for anchors, ``blocks_1`` on for each partner side in turn.
    """
    crowded = _crowded([anchor, *partners], edge, limit)
    if crowded is None:
        return None
    # Partner copies reach the squares around: cut each by all the cells that reach it.
    around = F.lit(int(radius // edge) + 1)
    step = F.when(F.col("role") == 0, F.sequence(F.lit(0), F.lit(0))).otherwise(F.sequence(-around, around))
    reached = (crowded.withColumn("sx", F.explode(step)).withColumn("sy", F.explode(step))
               .select("image_id", (F.col("bx") + F.col("sx")).alias("bx"),
                       (F.col("by") + F.col("sy")).alias("by"), "role", "group_rows"))
    blocks = reached.groupBy(*_SQUARE).agg(*[
        F.greatest(F.ceil(F.coalesce(F.sum(F.when(F.col("role") == role, F.col("group_rows"))), F.lit(0))
                          / F.lit(limit)), F.lit(1)).cast("int").alias(f"blocks_{role}")
        for role in range(len(partners) + 1)])
    stored = materialize(blocks)
    return stored, stored.count() <= SMALL_ROWS


def _blocked(df: DataFrame, role: int, id_col: Column, blocks: DataFrame, n_roles: int) -> DataFrame:
    """Give a row its own role's block and copy it to every block of the other roles."""
    df = df.join(blocks, _SQUARE, "left")
    for other in range(n_roles):
        n = F.coalesce(F.col(f"blocks_{other}"), F.lit(1))
        if other == role:
            place = F.pmod(F.xxhash64(id_col), n).cast("int")
        else:
            place = F.explode(F.sequence(F.lit(0), n - 1))
        df = df.withColumn(f"block_{other}", place)
    return df.drop(*[f"blocks_{other}" for other in range(n_roles)])


def _meet(anchor: Side, partners: list[Side], radius: float, edge: float,
          crowded: tuple[DataFrame, bool] | None, also: list[Column | None]) -> DataFrame:
    keys = list(_KEY)
    anchors = _home_square(anchor.renamed(), anchor, edge)
    copies = [_touched_squares(p.renamed(), p, radius, edge) for p in partners]
    if crowded is not None:
        blocks, small = crowded
        blocks = F.broadcast(blocks) if small else blocks
        n_roles = len(partners) + 1
        anchors = _blocked(anchors, 0, anchor.id(), blocks, n_roles)
        copies = [_blocked(c, i + 1, p.id(), blocks, n_roles)
                  for i, (c, p) in enumerate(zip(copies, partners))]
        keys += [f"block_{role}" for role in range(n_roles)]
    met = anchors
    for i, (side, copy) in enumerate(zip(partners, copies)):
        condition = squared_distance(anchor.x(), anchor.y(), side.x(), side.y()) <= radius * radius
        for earlier in [anchor, *partners[:i]]:
            condition = condition & (earlier.id() != side.id())
        if also[i] is not None:
            condition = condition & also[i]
        right = copy.select(*[F.col(k).alias("r_" + k) for k in keys],
                            *[F.col(f"{side.prefix}_{c}") for c in side.columns()])
        for k in keys:
            condition = condition & (F.col(k) == F.col("r_" + k))
        # The size of the copies is not known to the planner; a broadcast of them never is safe.
        met = met.join(right.hint("merge"), condition).drop(*["r_" + k for k in keys])
    return met.drop(*[k for k in keys if k.startswith("block_")])


def meet(anchor: Side, partners: list[Side], radius: float, also: list[Column | None] | None = None,
         edge_in_radii: float = SIDE_IN_RADII, limit: int = SQUARE_CELLS) -> DataFrame:
    """Every anchor with one cell of each partner side inside the radius, inclusive.

    All sides share one join key, so there is one shuffle per side. No cell appears twice in
    a row. ``also`` holds a further condition per partner. Columns are the sides' prefixed
    columns, ``image_id`` and the anchor's square.
    """
    radius = float(radius)
    edge = radius * edge_in_radii
    crowded = crowded_blocks(anchor, partners, radius, edge, limit)
    return _meet(anchor, partners, radius, edge, crowded, also or [None] * len(partners))


def pairs_on_squares(anchor: Side, neighbor: Side, radius: float, edge: float) -> DataFrame:
    """Pairs within the radius, still dealt out by the anchor's square; for tables without crowded squares."""
    return _meet(anchor, [neighbor], radius, edge, None, [None])


def radius_pairs(anchors: DataFrame, partners: DataFrame, radius: float,
                 anchor_extra: tuple[str, ...] = (), partner_extra: tuple[str, ...] = (),
                 limit: int = SQUARE_CELLS) -> DataFrame:
    """All ordered pairs (anchor, neighbor) of different cells within the radius, per image."""
    a, n = Side(anchors, "anchor", anchor_extra), Side(partners, "neighbor", partner_extra)
    pairs = meet(a, [n], radius, limit=limit)
    return pairs.drop("bx", "by", "square").withColumn(
        "dist_px", F.sqrt(squared_distance(a.x(), a.y(), n.x(), n.y())))


def type_counts(anchors: DataFrame, partners: DataFrame, radius: float, limit: int = SQUARE_CELLS,
                base: DataFrame | None = None, anchor_kinds: tuple[str, ...] = (),
                partner_kinds: tuple[str, ...] = ()) -> DataFrame:
    """Partners inside the radius per anchor and partner type: one row where there are any.

    An anchor is an id and a place; every cell with its id is left out of its counts, and
    rows that repeat an anchor add up. Where squares are crowded, cells on the same spot are
    added up before they are joined, and what has the anchor's id is taken away afterwards.
    ``base`` and the kinds say which types of one table the two sides are.
    """
    radius = float(radius)
    edge = radius * SIDE_IN_RADII
    typed = partners.where(F.col("cell_type").isNotNull())
    anchor = Side(anchors, "anchor", (), base, anchor_kinds)
    neighbor = Side(typed, "neighbor", ("cell_type",), base, partner_kinds)
    keys = ["image_id", "anchor_cell_id", "neighbor_type"]
    crowded = crowded_blocks(anchor, [neighbor], radius, edge, limit)
    if crowded is None:
        met = _meet(anchor, [neighbor], radius, edge, None, [None])
        return (met.groupBy(*_KEY, "anchor_cell_id", "anchor_x", "anchor_y",
                            F.col("neighbor_cell_type").alias("neighbor_type"))
                .agg(F.count(F.lit(1)).alias("n")).select(*keys, "n"))
    place = F.concat_ws(",", F.col("x").cast("string"), F.col("y").cast("string"))
    spots = anchors.select("image_id", "x", "y").distinct().withColumn("cell_id", place)
    # The mark keeps a spot's name apart from its neighbours', so a spot may meet itself.
    stacked = (typed.groupBy("image_id", "x", "y", "cell_type").agg(F.count(F.lit(1)).alias("n"))
               .withColumn("cell_id", F.concat(F.lit("@"), place)))
    met = meet(Side(spots, "spot"), [Side(stacked, "neighbor", ("cell_type", "n"))], radius, limit=limit)
    per_spot = (met.groupBy("image_id", F.col("spot_x").alias("x"), F.col("spot_y").alias("y"),
                            F.col("neighbor_cell_type").alias("neighbor_type"))
                .agg(F.sum("neighbor_n").alias("n")))
    once = anchors.groupBy("image_id", "cell_id", "x", "y").agg(F.count(F.lit(1)).alias("times"))
    same_id = typed.select("image_id", "cell_id", F.col("x").alias("own_x"), F.col("y").alias("own_y"), F.col("cell_type").alias("neighbor_type"))
    near = squared_distance(F.col("x"), F.col("y"), F.col("own_x"), F.col("own_y")) <= radius * radius
    own = (once.join(same_id, ["image_id", "cell_id"]).where(near)
           .groupBy("image_id", "cell_id", "x", "y", "neighbor_type").agg(F.count(F.lit(1)).alias("n_own")))
    return (once.join(per_spot, ["image_id", "x", "y"])
            .join(own, ["image_id", "cell_id", "x", "y", "neighbor_type"], "left")
            .withColumn("n", F.col("times") * (F.col("n") - F.coalesce("n_own", F.lit(0))))
            .where("n > 0")
            .select("image_id", F.col("cell_id").alias("anchor_cell_id"), "neighbor_type", "n"))


def neighbor_counts(anchors: DataFrame, partners: DataFrame, radius: float,
                    types: dict[str, str], limit: int = SQUARE_CELLS, base: DataFrame | None = None,
                    anchor_kinds: tuple[str, ...] = ()) -> DataFrame:
    """Per anchor, the partners of each wanted type inside the radius: {column: cell type}.

    Anchors with none of them are absent.
    """
    kinds = tuple(dict.fromkeys(types.values()))
    wanted = partners.where(F.col("cell_type").isin(*kinds))
    counts = type_counts(anchors, wanted, radius, limit, base, anchor_kinds, kinds)
    return counts.groupBy("image_id", "anchor_cell_id").agg(*[
        F.sum(F.when(F.col("neighbor_type") == t, F.col("n")).otherwise(0)).alias(name)
        for name, t in types.items()])
