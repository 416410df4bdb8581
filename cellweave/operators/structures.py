"""Structures of cells that lie dense (lymphoid structures): density clustering on the radius join.

A cell with enough cells around it is a core cell. Core cells within the radius of each other are of one structure, another
cell belongs to its nearest core cell. Squares small enough that all cells in one are within the radius of each other stand
for their core cells, so that components are found over squares and not over cells, and a dense heap is one node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from cellweave.operators.lineage import materialize
from cellweave.operators.neighbors import radius_pairs


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` for the nodes of ``a, b``: the smallest node reachable. Nodes are of any type that can be ordered.

    Every node is tied to the smallest one it sees, first its larger neighbours, then itself, until nothing changes. Both
    are combined aggregates and joins with one row per node on one side.
    """
    def state(of: DataFrame) -> tuple:
        mark = F.xxhash64("a", "b")
        return tuple(of.agg(F.count(F.lit(1)), F.sum(mark.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned(mark, 32))).first())

    now = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    seen = state(now)
    while seen[0]:
        ways = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = ways.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        outer = ways.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = outer.groupBy("a").agg(F.min("b").alias("low"))
        inner = outer.join(low, "a").select(F.explode(F.array(
            F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")).select("e.*")
        now = materialize(inner.where("a <> b").distinct())
        after = state(now)
        if after == seen:
            break
        seen = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def dense_cells(cells: DataFrame, radius: float, min_cells: int) -> DataFrame:
    """``image_id, cell_id, structure, is_core``: the cells of every structure, which has the id of its smallest core cell.

    A core cell has ``min_cells`` cells within the radius, itself counted. Cells of one structure and id are one cell.
    """
    places = cells.select("image_id", "cell_id", "x", "y").where("x is not null and y is not null")
    pairs = materialize(radius_pairs(places, places, radius).select(
        "image_id", F.col("anchor_cell_id").alias("cell_id"), F.col("anchor_x").alias("x"), F.col("anchor_y").alias("y"),
        "neighbor_cell_id", "neighbor_x", "neighbor_y", "dist_px"))
    around = pairs.groupBy("image_id", "cell_id").agg(F.count(F.lit(1)).alias("n"))
    if min_cells <= 1:
        core = places.select("image_id", "cell_id").distinct()
    else:
        core = around.where(F.col("n") >= min_cells - 1).select("image_id", "cell_id")
    core = materialize(core)
    # A hair under the side at which a square's diagonal is the radius.
    side = radius / np.sqrt(2.0) * (1 - 1e-9)
    square = lambda v: F.floor(F.col(v) / side)
    met = materialize(pairs.join(core.withColumnRenamed("cell_id", "neighbor_cell_id"), ["image_id", "neighbor_cell_id"]))
    homes = materialize(places.join(core, ["image_id", "cell_id"]).select("image_id", "cell_id", square("x").alias("sx"), square("y").alias("sy")).distinct())
    numbers = materialize(homes.select("image_id", "sx", "sy").distinct().withColumn("node", F.monotonically_increasing_id()))
    both = (met.join(core, ["image_id", "cell_id"])
            .select("image_id", square("x").alias("sx"), square("y").alias("sy"), square("neighbor_x").alias("tx"), square("neighbor_y").alias("ty"))
            .where("(sx, sy) < (tx, ty)").distinct())
    edges = (both.join(numbers.withColumnRenamed("node", "a"), ["image_id", "sx", "sy"]).select("image_id", "a", F.col("tx").alias("sx"), F.col("ty").alias("sy"))
             .join(numbers.withColumnRenamed("node", "b"), ["image_id", "sx", "sy"]).select("a", "b"))
    roots = connected(edges)
    homes = materialize(homes.join(numbers, ["image_id", "sx", "sy"]).join(roots, "node", "left").select("image_id", "cell_id", F.coalesce("root", "node").alias("root")))
    named = homes.join(homes.groupBy("root").agg(F.min("cell_id").alias("structure")), "root").select("image_id", "cell_id", "structure")
    named = materialize(named.groupBy("image_id", "cell_id").agg(F.min("structure").alias("structure")))
    nearest = (met.join(core, ["image_id", "cell_id"], "left_anti").groupBy("image_id", "cell_id")
               .agg(F.min(F.struct("dist_px", "neighbor_cell_id"))["neighbor_cell_id"].alias("core_id")))
    border = nearest.join(named.withColumnRenamed("cell_id", "core_id"), ["image_id", "core_id"]).select("image_id", "cell_id", "structure", F.lit(False).alias("is_core"))
    return named.withColumn("is_core", F.lit(True)).unionByName(border)


def _hull(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull, by one pass over the points in order for each side."""
    points = np.unique(points, axis=0)
    if len(points) < 3:
        return points

    def chain(ordered: np.ndarray) -> list:
        out: list = []
        for p in ordered:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out[:-1]
    return np.array(chain(points) + chain(points[::-1]))


def _corners(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        places = batch[["x", "y"]].to_numpy(dtype=float)
        found = [(key, _hull(places[rows])) for key, rows in batch.groupby(["image_id", "structure"], sort=False).indices.items()]
        if found:
            n = [len(corners) for _, corners in found]
            x, y = np.concatenate([corners for _, corners in found]).T
            image, structure = (np.repeat(np.array([key[i] for key, _ in found], dtype=object), n) for i in (0, 1))
            yield pd.DataFrame({"image_id": image, "structure": structure, "x": x, "y": y})


@F.pandas_udf(StructType().add("hull_area", DoubleType()).add("n_corners", IntegerType()))
def _hulls(xs: pd.Series, ys: pd.Series) -> pd.DataFrame:
    out = []
    for x, y in zip(xs, ys, strict=True):
        c = _hull(np.stack([x, y], axis=1).astype(float))
        x, y = (c - c[0]).T
        out.append((abs(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))) / 2 if len(c) > 2 else 0.0, len(c)))
    return pd.DataFrame(out, columns=["hull_area", "n_corners"])


def structures(cells: DataFrame, radius: float, min_cells: int, min_size: int = 1, required: tuple[str, ...] = ()) -> DataFrame:
    """``image_id, structure, n_cells, n_core, n_types, center_x, center_y, hull_area, n_corners`` of structures that hold every required type.

    Hulls are taken of these structures alone. They are reduced where the cells are and only corners are brought together.
    """
    members = materialize(cells.select("image_id", "cell_id", "x", "y", "cell_type").join(dense_cells(cells, radius, min_cells), ["image_id", "cell_id"]))
    has = [F.max((F.col("cell_type") == t).cast("int")) for t in required]
    facts = members.groupBy("image_id", "structure").agg(
        F.count(F.lit(1)).alias("n_cells"), F.count_if(F.col("is_core")).alias("n_core"), F.count_distinct("cell_type").alias("n_types"),
        F.avg("x").alias("center_x"), F.avg("y").alias("center_y"), *[h.alias(f"has_{i}") for i, h in enumerate(has)])
    for i in range(len(has)):
        facts = facts.where(F.col(f"has_{i}") == 1).drop(f"has_{i}")
    facts = materialize(facts.where(F.col("n_cells") >= min_size))
    schema = f"image_id {members.schema['image_id'].dataType.simpleString()}, structure {members.schema['structure'].dataType.simpleString()}"
    places = members.join(facts.select("image_id", "structure"), ["image_id", "structure"], "left_semi").select(
        "image_id", "structure", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    cores = cells.sparkSession.sparkContext.defaultParallelism
    corners = places.repartition(cores, "image_id", "structure").mapInPandas(_corners, schema + ", x double, y double")
    hulls = (corners.groupBy("image_id", "structure").agg(F.collect_list(F.struct("x", "y")).alias("c"))
             .select("image_id", "structure", _hulls("c.x", "c.y").alias("h")).select("image_id", "structure", "h.*"))
    return facts.join(hulls, ["image_id", "structure"])
