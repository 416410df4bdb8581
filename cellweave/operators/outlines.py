"""Outlines of labelled pixels: border pixels, perimeter and convex area.

A pixel table has ``image_id, label, x, y`` in whole numbers; repeated rows, as one per channel, are one pixel. Rows without
a place or a label are left out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from cellweave.operators.structures import _hull

_PIXEL = ("image_id", "label", "x", "y")

# What a border pixel counts in its own and its neighbours' sums, and the length a sum stands for (published
# neighbour configurations of the 4-connected perimeter). Other sums have no length.
SELF, BESIDE, ACROSS = 1, 2, 10
STRAIGHT = (5, 7, 15, 17, 25, 27)
DIAGONAL = (21, 33)
CORNER = (13, 23)


def _around(pixels: DataFrame, marks: dict[tuple[int, int], int]) -> DataFrame:
    """Each pixel's sum of the marks it and its neighbours in the label give it.

    Every pixel is sent to the places it marks and places are added up: one shuffle with partial sums by pixel, no join, so
    a label of any size is spread. Places that are no pixel themselves are left out.
    """
    steps = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"), F.lit(m).alias("m")) for (dx, dy), m in marks.items()])
    sent = pixels.select(*_PIXEL, F.explode(steps).alias("s")).select(
        "image_id", "label", (F.col("x") + F.col("s.dx")).alias("x"), (F.col("y") + F.col("s.dy")).alias("y"), "s.m",
        ((F.col("s.dx") == 0) & (F.col("s.dy") == 0)).alias("own"))
    return sent.groupBy(*_PIXEL).agg(F.sum("m").alias("marks"), F.bool_or("own").alias("own")).where("own").drop("own")


def _spots(pixels: DataFrame) -> DataFrame:
    return pixels.select(*_PIXEL).where("label is not null and x is not null and y is not null").distinct()


def border_pixels(pixels: DataFrame) -> DataFrame:
    """Pixels of which one of the four beside them is not of their label."""
    beside = {(0, 0): 0, (1, 0): 1, (-1, 0): 1, (0, 1): 1, (0, -1): 1}
    return _around(_spots(pixels), beside).where("marks < 4").drop("marks")


def region_outlines(pixels: DataFrame) -> DataFrame:
    """``image_id, label, n_border, perimeter``: border pixels, and the line through their centres."""
    marks = {(dx, dy): (SELF, BESIDE, ACROSS)[abs(dx) + abs(dy)] for dx in (-1, 0, 1) for dy in (-1, 0, 1)}
    found = F.col("marks")
    length = (F.when(found.isin(*STRAIGHT), 1.0).when(found.isin(*DIAGONAL), F.lit(float(np.sqrt(2))))
              .when(found.isin(*CORNER), F.lit(float((1 + np.sqrt(2)) / 2))).otherwise(0.0))
    return (_around(border_pixels(pixels), marks).groupBy("image_id", "label")
            .agg(F.count(F.lit(1)).alias("n_border"), F.sum(length).alias("perimeter")))


def _pixels_in_hull(y: np.ndarray, low: np.ndarray, high: np.ndarray) -> int:
    """Pixel centres in the hull of the middles of all pixel sides, row by row."""
    points = np.concatenate([np.column_stack(p) for p in (
        (y, low - 0.5), (y, high + 0.5), (y - 0.5, low), (y + 0.5, low), (y - 0.5, high), (y + 0.5, high))])
    corners = _hull(points)
    inside = np.arange(y.min(), y.max() + 1)
    left, right = np.full(len(inside), np.inf), np.full(len(inside), -np.inf)
    for (y1, x1), (y2, x2) in zip(corners, np.roll(corners, -1, axis=0)):
        if y1 != y2:
            on = (inside >= min(y1, y2)) & (inside <= max(y1, y2))
            x = x1 + (inside[on] - y1) * (x2 - x1) / (y2 - y1)
            left[on], right[on] = np.minimum(left[on], x), np.maximum(right[on], x)
    return int((np.floor(right + 1e-9) - np.ceil(left - 1e-9) + 1).sum())


@F.pandas_udf(LongType())
def _convex_area(ys: pd.Series, lows: pd.Series, highs: pd.Series) -> pd.Series:
    return pd.Series([_pixels_in_hull(*(np.asarray(v, dtype=float) for v in ends)) for ends in zip(ys, lows, highs, strict=True)], dtype="int64")


def convex_areas(pixels: DataFrame) -> DataFrame:
    """``image_id, label, area, convex_area``: pixels, and pixels of the smallest convex shape around them.

    Spark reduces a label to the two ends of each of its rows; only these, at most an image's height, meet in one row. Labels
    come to Python many in one batch.
    """
    ends = (_spots(pixels).groupBy("image_id", "label", "y")
            .agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count(F.lit(1)).alias("n")))
    labels = ends.groupBy("image_id", "label").agg(F.sum("n").alias("area"), F.collect_list(F.struct("y", "low", "high")).alias("ends"))
    return labels.select("image_id", "label", "area", _convex_area("ends.y", "ends.low", "ends.high").alias("convex_area"))
