"""Masks met as tables: runs of mask pixels, scaled to the place they cover, and the rows that lie on them.

A mask is a table of runs ``image_id, mask, row, start, end`` (``end`` is not part of the run) in its own pixels. A frame
``image_id, mask, x, y, w, h, mask_width, mask_height`` says which box of the image it covers and how large it is itself; a
mask of another size than its box is scaled to the nearest pixel. Runs without a frame, and frames without an extent, cover
nothing; runs of one row may touch, overlap or repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.operators.lineage import materialize
from cellweave.operators.regions import TILE, assign_to_rois


def _first(pixel: Column, size: Column, mask_size: Column) -> Column:
    """First pixel of a box whose centre falls on this mask pixel or a later one; whole numbers only."""
    above, below = 2 * pixel * size - mask_size, 2 * mask_size
    rest = F.pmod(above, below)
    return F.try_divide(above - rest, below).cast("bigint") + F.when(rest > 0, 1).otherwise(0)


def _merged(runs: DataFrame) -> DataFrame:
    """Runs of a mask's row joined where they touch or overlap."""
    row = Window.partitionBy("image_id", "mask", "row")
    before = row.orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    upto = row.orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    marked = _filled(runs).withColumn("opens", F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True)).cast("int"))
    return (marked.withColumn("island", F.sum("opens").over(upto)).groupBy("image_id", "mask", "row", "island")
            .agg(F.min("start").alias("start"), F.max("end").alias("end")))


def _filled(runs: DataFrame) -> DataFrame:
    return runs.select("image_id", "mask", *[F.col(c).cast("bigint").alias(c) for c in ("row", "start", "end")]).where("start < end")


def _whole(frames: DataFrame) -> DataFrame:
    sizes = ("x", "y", "w", "h", "mask_width", "mask_height")
    return (frames.select("image_id", "mask", *[F.col(c).cast("bigint").alias(c) for c in sizes])
            .where("w > 0 and h > 0 and mask_width > 0 and mask_height > 0"))


def image_runs(runs: DataFrame, frames: DataFrame, tile: int = TILE) -> DataFrame:
    """``image_id, mask, py, tx, x_start, x_end``: runs in image pixels, disjoint, one row per image row and square touched.

    Runs are merged in the mask's own rows first, so a mask row is the largest group; only then is a row that covers
    several image rows repeated, and a run cut at the squares' borders.
    """
    merged, whole = _merged(runs), _whole(frames)
    scaled = (merged.join(whole, ["image_id", "mask"])
              .where("row >= 0 and row < mask_height and end > 0 and start < mask_width")
              .select("image_id", "mask",
                      (F.col("x") + _first(F.greatest("start", F.lit(0)), F.col("w"), F.col("mask_width"))).alias("x_start"),
                      (F.col("x") + _first(F.least("end", "mask_width"), F.col("w"), F.col("mask_width"))).alias("x_end"),
                      (F.col("y") + _first(F.col("row"), F.col("h"), F.col("mask_height"))).alias("y_start"),
                      (F.col("y") + _first(F.col("row") + 1, F.col("h"), F.col("mask_height"))).alias("y_end"))
              # A mask larger than its box has rows and runs that no pixel centre falls on.
              .where("x_start < x_end and y_start < y_end"))
    rows = scaled.withColumn("py", F.explode(F.sequence("y_start", F.col("y_end") - 1)))
    return (rows.withColumn("tx", F.explode(F.sequence(F.floor(F.col("x_start") / tile), F.floor((F.col("x_end") - 1) / tile))))
            .select("image_id", "mask", "py", "tx", F.greatest("x_start", F.col("tx") * tile).alias("x_start"),
                    F.least("x_end", (F.col("tx") + 1) * tile).alias("x_end")))


def _mask_pixel(pixel: Column, start: str, size: str, mask_size: str) -> Column:
    """Mask pixel under the centre of an image pixel; whole numbers only."""
    above, below = (2 * (pixel - F.col(start)) + 1) * F.col(mask_size), 2 * F.col(size)
    return F.try_divide(above - F.pmod(above, below), below).cast("bigint")


def _pixels(rows: DataFrame) -> DataFrame:
    """``r, image_id, px, py``: the rows and the pixel they fall into. A floor makes a pixel of NaN, which no row lies on."""
    here = rows.where(~(F.isnan(F.col("x").cast("double")) | F.isnan(F.col("y").cast("double"))))
    r = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("r")
    return here.select(r, "image_id", F.floor("x").alias("px"), F.floor("y").alias("py"))


def _met(pixels: DataFrame, carried: list[str], runs: DataFrame, frames: DataFrame, tile: int, how: str, named: bool = False) -> DataFrame:
    """Pixels ``image_id, px, py`` (and ``mask``, if ``named``) joined to the runs under them, as ``h`` and ``f``.

    Pixels are taken to the mask's own, so no mask is drawn in the image's: they meet frames by image and square, then runs
    by mask, row and stretch of ``tile`` mask pixels.
    """
    whole = _whole(frames)
    touched = lambda at, size: F.explode(F.sequence(F.floor(F.col(at) / tile), F.floor((F.col(at) + F.col(size) - 1) / tile)))
    listed = whole.withColumn("tx", touched("x", "w")).withColumn("ty", touched("y", "h"))
    placed = pixels.withColumns({"tx": F.floor(F.col("px") / tile), "ty": F.floor(F.col("py") / tile)})
    keys = ["image_id", "tx", "ty", *(["mask"] if named else [])]
    inside = (F.col("px") >= F.col("x")) & (F.col("px") < F.col("x") + F.col("w")) & (F.col("py") >= F.col("y")) & (F.col("py") < F.col("y") + F.col("h"))
    held = (placed.join(listed, keys).where(inside)
            .select(*carried, "image_id", "mask", _mask_pixel(F.col("px"), "x", "w", "mask_width").alias("column"),
                    _mask_pixel(F.col("py"), "y", "h", "mask_height").alias("row"))
            .withColumn("stretch", F.floor(F.col("column") / tile)).alias("h"))
    widths = whole.groupBy("image_id", "mask").agg(F.max("mask_width").alias("width"))
    cut = (runs.join(widths, ["image_id", "mask"]).where("end > 0 and start < width")
           .withColumn("stretch", F.explode(F.sequence(F.floor(F.greatest("start", F.lit(0)) / tile), F.floor((F.least("end", "width") - 1) / tile))))
           .select("image_id", "mask", "row", "stretch", F.greatest("start", F.col("stretch") * tile).alias("start"),
                   F.least("end", (F.col("stretch") + 1) * tile).alias("end")).alias("f"))
    # Runs are many rows of few bytes when compressed, by which the planner would take them for a table to broadcast.
    under = [F.col(f"h.{k}") == F.col(f"f.{k}") for k in ("image_id", "mask", "row", "stretch")]
    return held.join(cut.hint("merge"), [*under, F.col("h.column") >= F.col("f.start"), F.col("h.column") < F.col("f.end")], how)


def in_masks(rows: DataFrame, runs: DataFrame, frames: DataFrame, name: str | None = None, tile: int = TILE) -> DataFrame:
    """Rows whose pixel lies on a mask, once per mask, with the mask's name as ``mask``.

    A row's pixel is the one its x and y fall into; one without a place has none. With ``name`` a row meets only the mask
    its own column names. A row is compared with the frames of its own square and the runs of 256 pixels of one mask row.
    """
    pixels = _pixels(rows)
    if name:
        pixels = pixels.withColumn("mask", F.col(f"r.`{name}`"))
    met = _met(pixels, ["r"], _merged(runs), frames, tile, "inner", bool(name))
    return met.select(*[F.col(f"h.r.`{c}`") for c in rows.columns], "f.mask")


def on_any_mask(rows: DataFrame, runs: DataFrame, frames: DataFrame, tile: int = TILE) -> DataFrame:
    """Rows whose pixel lies on at least one mask of their image, as they are."""
    pixels = _pixels(rows)
    key = ["image_id", "px", "py"]
    # A pixel may lie on several masks, and equal rows stay as many as they are.
    covered = _met(pixels.drop("r"), ["px", "py"], _filled(runs), frames, tile, "left_semi").select(*key).distinct()
    return pixels.join(covered.hint("merge"), key, "left_semi").select(*[F.col(f"r.`{c}`") for c in rows.columns])


def assign_through_masks(cells: DataFrame, rois: DataFrame, tissue: tuple[DataFrame, DataFrame],
                         own: tuple[DataFrame, DataFrame] | None = None, name: str = "roi_name") -> DataFrame:
    """Cells of each region that lie on a tissue mask of their image and on the region's own mask.

    Masks are pairs of runs and frames; an own mask has the region's name. Regions without a frame of their own are held to
    the tissue mask alone. A row on several tissue masks counts once.
    """
    placed = assign_to_rois(on_any_mask(cells, *tissue), rois)
    if own is None:
        return placed
    placed = materialize(placed)
    runs, frames = own
    framed = frames.select("image_id", F.col("mask").alias(name)).distinct()
    free = placed.join(framed, ["image_id", name], "left_anti").select(*placed.columns)
    return in_masks(placed, runs, frames, name).drop("mask").unionByName(free)
