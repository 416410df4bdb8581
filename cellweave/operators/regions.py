"""Regions of interest, and features of labelled pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.functions.geometry import clip_box
from cellweave.functions.names import roi_box, roi_condition
from cellweave.schema import col

# Side of the squares boxes are looked up by.
TILE = 256

_BOX = ("x", "y", "w", "h")


def canonical_labels(labels: DataFrame) -> DataFrame | None:
    """Region label table as Name, x, y, w, h; columns are found whatever their case."""
    def find(test) -> str | None:
        return next((c for c in labels.columns if test(c.lower())), None)

    found = {"x": find(lambda c: c == "x"), "y": find(lambda c: c == "y"),
             "w": find(lambda c: "width" in c), "h": find(lambda c: "height" in c)}
    if None in found.values():
        return None
    return labels.select(col("Name").alias("Name"),
                         *[col(c).cast("bigint").alias("label_" + k) for k, c in found.items()])


def locate_rois(rois: DataFrame, labels: DataFrame | None, name: str = "roi_name") -> DataFrame:
    """Box of each region: parsed from its name, else from the label table; unplaced dropped."""
    boxed = rois.withColumn("parsed", roi_box(F.regexp_replace(col(name), r"\.png", "")))
    table = None if labels is None else canonical_labels(labels)
    if table is None:
        chosen = {k: F.col(f"parsed.{k}") for k in _BOX}
    else:
        # Names repeat in hand-made tables: the first row counts, here the smallest box corner.
        first = table.groupBy("Name").agg(F.min(F.struct("label_x", "label_y", "label_w", "label_h")).alias("from_table"))
        boxed = boxed.withColumn("Name", F.regexp_replace(col(name), r"\.png", "")).join(
            first, "Name", "left").drop("Name")
        parses = F.col("parsed.x").isNotNull()
        chosen = {k: F.when(parses, F.col(f"parsed.{k}")).otherwise(F.col(f"from_table.label_{k}")) for k in _BOX}
    return boxed.withColumns(chosen).drop("parsed", "from_table").where("x is not null")


def clip_rois(rois: DataFrame) -> DataFrame:
    """Boxes held inside their image (image_width, image_height)."""
    return rois.withColumns(clip_box(*[F.col(c) for c in _BOX], F.col("image_width"), F.col("image_height")))


def assign_to_rois(cells: DataFrame, rois: DataFrame, mask: str | None = None, tile: int = TILE) -> DataFrame:
    """Rows inside each region's clipped box, and inside the mask where one is given.

    A row has one square; a box is listed at every square it touches. The join is on image
    and square, so a big image is spread over many keys; only the box ends are compared.
    """
    boxes = (clip_rois(rois).where("x_end > x and y_end > y")
             .select("image_id", "roi_name", F.col("x").alias("x_start"), F.col("y").alias("y_start"), "x_end", "y_end"))

    def touched(start: str, end: str):
        return F.explode(F.sequence(F.floor(F.col(start) / tile), F.ceil(F.col(end) / tile) - 1))

    listed = boxes.withColumn("tx", touched("x_start", "x_end")).withColumn("ty", touched("y_start", "y_end"))
    rows = cells if mask is None else cells.where(col(mask))
    placed = rows.withColumns({"tx": F.floor(F.col("x") / tile), "ty": F.floor(F.col("y") / tile)})
    inside = ((F.col("x") >= F.col("x_start")) & (F.col("x") < F.col("x_end"))
              & (F.col("y") >= F.col("y_start")) & (F.col("y") < F.col("y_end")))
    return (placed.join(listed, ["image_id", "tx", "ty"])
            .where(inside).drop("tx", "ty", "x_start", "y_start", "x_end", "y_end"))


def roi_condition_counts(rois: DataFrame, conditions: list[str], name: str = "roi_name") -> DataFrame:
    """Regions per configured condition, zero included."""
    counts = (rois.groupBy(roi_condition(col(name), conditions).alias("condition"))
              .agg(F.count(F.lit(1)).alias("n")))
    every = rois.sparkSession.createDataFrame([(c,) for c in conditions], "condition string")
    return every.join(counts, "condition", "left").select("condition", F.coalesce("n", F.lit(0)).alias("n_rois"))


def roi_summary(rois: DataFrame, channels: DataFrame, conditions: list[str], name: str = "roi_name") -> DataFrame:
    """One row per region: slide, condition, box, and the slide's channels in order.

    ``channels`` has one row per slide and channel: slide_id, channel_index, channel_name.
    """
    listed = channels.groupBy("slide_id").agg(F.array_sort(F.collect_list(
        F.struct("channel_index", "channel_name"))).alias("entries"))
    names = F.array_join(F.transform("entries", lambda e: e["channel_name"]), ",")
    return (rois.join(listed, "slide_id", "left")
            .select("slide_id", roi_condition(col(name), conditions).alias("roi_condition"),
                    "x", "y", F.col("w").alias("width"), F.col("h").alias("height"),
                    F.coalesce(names, F.lit("")).alias("channel_names")))


def region_features(pixels: DataFrame, channels: list[str]) -> DataFrame:
    """Shape and mean intensity of each label: a pixel table (image_id, label, x, y, channel, value).

    A pixel has one row per channel it was measured in. Shape counts each pixel once; axes
    and eccentricity come from the covariance of the pixel positions.
    """
    spots = (pixels.groupBy("image_id", "label", "x", "y")
             .agg(*[F.avg(F.when(F.col("channel") == c, F.col("value"))).alias(f"v_{i}")
                    for i, c in enumerate(channels)]))
    a, b, c = F.col("var_x"), F.col("var_y"), F.col("cov_xy")
    spread = F.sqrt(F.pow((a - b) / 2, 2) + c * c)
    big, small = (a + b) / 2 + spread, F.greatest((a + b) / 2 - spread, F.lit(0.0))
    shapes = spots.groupBy("image_id", "label").agg(
        F.count(F.lit(1)).alias("area"), F.avg("x").alias("x"), F.avg("y").alias("y"),
        F.var_pop("x").alias("var_x"), F.var_pop("y").alias("var_y"), F.covar_pop("x", "y").alias("cov_xy"),
        *[F.avg(f"v_{i}").alias(f"mean_{ch}") for i, ch in enumerate(channels)])
    return shapes.select(
        "image_id", "label", "area", "x", "y",
        (4 * F.sqrt(big)).alias("axis_major_length"), (4 * F.sqrt(small)).alias("axis_minor_length"),
        F.when(big > 0, F.sqrt(1 - small / big)).otherwise(0.0).alias("eccentricity"),
        *[col(f"mean_{ch}") for ch in channels])
