"""Masks as runs against a pixelwise reading."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.operators import masks

FRAME = "image_id string, mask string, x int, y int, w int, h int, mask_width int, mask_height int"
RUN = "image_id string, mask string, row int, start int, end int"


def runs_of(image, name, pixels):
    rows = []
    for r, line in enumerate(pixels):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], line.astype(int), [0]])))
        rows += [(image, name, r, int(a), int(b)) for a, b in zip(edges[::2], edges[1::2])]
    return rows


def on_mask(pixels, frame, x, y):
    """The mask pixel nearest to an image pixel's centre."""
    bx, by, w, h = frame
    px, py = int(np.floor(x)) - bx, int(np.floor(y)) - by
    if not (0 <= px < w and 0 <= py < h):
        return False
    rows, columns = pixels.shape
    return bool(pixels[(2 * py + 1) * rows // (2 * h), (2 * px + 1) * columns // (2 * w)])


@pytest.mark.parametrize("size", [(40, 600), (13, 211), (90, 1300)])
def test_masks_equal_pixels(spark, size):
    rng = np.random.default_rng(size[0])
    pixels = rng.random(size) < 0.6
    frame = (-5, 7, 600, 40)
    spots = [("i", n, float(x), float(y)) for n, (x, y) in enumerate(zip(rng.uniform(-10, 610, 800), rng.uniform(0, 50, 800)))]
    spots += [("i", 900, None, 3.0), ("i", 901, 3.0, float("nan"))]
    spots += [("i", n, float("nan"), float(n - 900)) for n in range(907, 947)] + [("j", 902, 3.0, 10.0)]
    cells = spark.createDataFrame(spots, "image_id string, cell_id int, x double, y double")
    runs = runs_of("i", "m", pixels)
    # Repeated and overlapping runs, an empty one, one of no frame.
    runs += runs[:20] + [(i, m, r, s, min(s + 1, e)) for i, m, r, s, e in runs[20:30]] + [("i", "m", 1, 9, 9), ("i", "none", 1, 0, 99)]
    found = masks.in_masks(cells, spark.createDataFrame(runs, RUN), spark.createDataFrame([("i", "m", *frame, size[1], size[0])], FRAME), tile=64)
    assert found.columns == ["image_id", "cell_id", "x", "y", "mask"]
    assert sorted(r.cell_id for r in found.collect()) == [n for _, n, x, y in spots[:800] if on_mask(pixels, frame, x, y)]


def test_long_runs_are_split_and_disjoint(spark):
    runs = spark.createDataFrame([("i", "m", 0, 0, 1000), ("i", "m", 0, 500, 2000), ("i", "m", 0, 2000, 2100)], RUN)
    found = masks.image_runs(runs, spark.createDataFrame([("i", "m", 0, 0, 2100, 2, 2100, 1)], FRAME)).collect()
    assert all(r.x_end - r.x_start <= 256 and r.x_start // 256 == (r.x_end - 1) // 256 for r in found)
    for py in (0, 1):
        ends = sorted((r.x_start, r.x_end) for r in found if r.py == py)
        assert ends[0][0] == 0 and ends[-1][1] == 2100 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))


def test_regions_through_tissue_and_own_masks(spark):
    cells = spark.createDataFrame([("i", n, n + 0.5, 2.5) for n in range(20)] + [("i", 3, 3.5, 2.5)], "image_id string, cell_id int, x double, y double")
    rois = spark.createDataFrame([("i", "a", 0, 0, 10, 5, 20, 20), ("i", "b", 5, 0, 40, 5, 20, 20)],
                                 "image_id string, roi_name string, x int, y int, w int, h int, image_width int, image_height int")
    tissue = (spark.createDataFrame([("i", "t", r, 1, 15) for r in range(20)] + [("i", "u", 2, 0, 4)], RUN),
              spark.createDataFrame([("i", "t", 0, 0, 20, 20, 20, 20), ("i", "u", 0, 0, 20, 20, 20, 20)], FRAME))
    own = (spark.createDataFrame([("i", "a", 0, 0, 1)], RUN), spark.createDataFrame([("i", "a", 0, 0, 10, 5, 2, 1)], FRAME))
    got = lambda df: sorted((r.roi_name, r.cell_id) for r in df.collect())
    b = [("b", n) for n in range(5, 15)]
    assert got(masks.assign_through_masks(cells, rois, tissue)) == sorted([("a", n) for n in [0, 1, 2, 3, 3, 4, 5, 6, 7, 8, 9]] + b)
    assert got(masks.assign_through_masks(cells, rois, tissue, own)) == sorted([("a", n) for n in [0, 1, 2, 3, 3, 4]] + b)
    nothing = tissue[0].where(F.lit(False)), tissue[1]
    assert got(masks.assign_through_masks(cells, rois, nothing)) == []


def test_masks_are_not_drawn_in_image_pixels(spark):
    cells = spark.createDataFrame([("i", 1, 5e8, 2.5), ("i", 2, 5e8 + 5e8, 2.5), ("i", 3, float("inf"), 2.5), ("i", 4, None, 1.0)],
                                  "image_id string, cell_id int, x double, y double")
    # One mask pixel stands for 10^8 rows; two frames of one mask, of which only one covers the first cell.
    runs = spark.createDataFrame([("i", "m", 0, 0, 1_000_000_000), ("i", "m", 0, 0, 1)], RUN)
    frames = spark.createDataFrame([("i", "m", 499_999_999, 0, 500, 100_000, 2, 1), ("i", "m", 0, 0, 5, 5, 9, 9)], FRAME)
    assert [r.cell_id for r in masks.in_masks(cells, runs, frames, tile=1 << 20).collect()] == [1]
    assert [r.cell_id for r in masks.on_any_mask(cells.union(cells.limit(1)), runs, frames, tile=1 << 20).collect()] == [1, 1]
    # Neither are runs broadcast, whatever size they seem to have.
    runs_joined = [line for line in masks.in_masks(cells, runs, frames)._jdf.queryExecution().executedPlan().toString().splitlines() if "stretch" in line and "Join" in line]
    assert runs_joined and all("SortMergeJoin" in line for line in runs_joined)
