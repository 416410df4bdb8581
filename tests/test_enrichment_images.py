"""Enrichment of images that one task takes whole, against permutations number by number and against images dealt out."""

import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellweave.operators import enrichment
from cellweave.operators.lineage import owned_folder

CELL = "image_id string, condition string, cell_id string, x {0}, y {0}, cell_type string"


def cells_of(seed, n, images, spread, whole_numbers=True):
    """Cells of images of unequal size, some ids and places twice, and nothing known of some."""
    rng = random.Random(seed)
    at = rng.randrange if whole_numbers else lambda most: rng.random() * most - most / 2
    rows = []
    for k in range(n):
        image = f"i{0 if rng.random() < 0.4 else rng.randrange(images)}"
        rows.append((image, rng.choice("xy") if image == "i1" else None if image == "i2" else "x", f"c{k}", at(spread), at(spread), rng.choice("ABBC")))
    rows += [(*r[:2], r[2] if k % 2 else f"d{k}", *r[3:5], rng.choice("ABC")) for k, r in enumerate(rows[:60])]
    rows += rows[100:105] + [("i0", "x", None, rows[0][3], rows[0][4], "A"), ("i0", "x", "n", None, rows[0][4], "A"), ("i1", "x", "m", rows[0][3], None, "C")]
    return rows + [(None, "x", "u", rows[0][3], rows[0][4], "A"), ("i0", "x", "v", rows[0][3], rows[0][4], None), ("lone", "y", "w", rows[0][3], rows[0][4], "A")]


def test_permutations_of_images_are_those_of_their_numbers():
    sizes = np.array([1, 600, 2, 3, 17, 16, 5, 1000, 64, 65, 4, 257])
    keys = np.random.default_rng(1).integers(0, 1 << 63, len(sizes), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    number, size = np.concatenate([np.arange(n) for n in sizes]), np.repeat(sizes, sizes)
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    for seed, places in zip((0, 1, 1_000_003), enrichment.permuted_images(sizes, keys, (0, 1, 1_000_003)), strict=True):
        own = enrichment.permuted(number, size, enrichment._mix(np.repeat(keys, sizes), np.full(len(size), np.uint64(seed))))
        assert (places == own + first).all()


@pytest.mark.parametrize("radius,spread,bound", [(12.0, 100, 1 << 20), (12.0, 100, 7), (5, 40, 50), (300, 100, 1000)])
def test_near_cells(monkeypatch, radius, spread, bound):
    monkeypatch.setattr(enrichment, "_CANDIDATES", bound)
    rng = np.random.default_rng(int(radius))
    image = np.sort(rng.integers(0, 4, 200)) * 3
    for x, y in ((rng.integers(-spread, spread, 200), rng.integers(0, spread, 200)), (rng.normal(0, spread, 200), rng.normal(0, spread, 200))):
        found = [tuple(sorted(p)) for a, b in enrichment._near(image, x, y, radius) for p in zip(a.tolist(), b.tolist(), strict=True)]
        assert len(found) == len(set(found))
        assert set(found) == {(i, j) for j in range(200) for i in range(j) if image[i] == image[j] and (x[i] - x[j]) ** 2 + (y[i] - y[j]) ** 2 <= radius ** 2}


def test_tables_hold_whole_images(monkeypatch):
    monkeypatch.setattr(enrichment, "_AT_ONCE", 10)
    images = np.repeat(["a", "b", "c", "d", "e"], [3, 30, 1, 9, 2])
    batches = pa.table({"image_id": images, "row": np.arange(len(images))}).to_batches(4)
    tables = list(enrichment._whole_images(batches))
    assert len(tables) > 2 and [r for t in tables for r in t["row"].to_pylist()] == list(range(len(images)))
    assert sum(len(set(t["image_id"].to_pylist())) for t in tables) == 5


@pytest.mark.parametrize("kind", ["int", "double"])
def test_images_taken_whole_equal_images_dealt_out(spark, monkeypatch, kind):
    monkeypatch.setattr(enrichment, "_AT_ONCE", 150)
    cells = spark.createDataFrame(cells_of(4, 600, 7, 90, kind == "int"), CELL.format(kind))

    def rows(table=1 << 22, **bounds):
        monkeypatch.setattr(enrichment, "_TABLE", table)
        return sorted(map(str, enrichment.neighbour_enrichment(cells, 11.5, 20, **bounds).collect()))
    apart = rows(whole=0)
    assert len(apart) > 20
    # All whole; one image over the bound; one with a crowded square; tallies sorted, or let go with each table.
    assert rows() == apart and rows(whole=200) == apart and rows(limit=60) == apart and rows(table=1) == apart and rows(table=160) == apart


def test_images_over_the_bounds_are_dealt_out(spark):
    rows = [(f"i{i}", "x", f"c{k}", k % 7 if i == 1 else 60 * k, 0, "A") for i, n in enumerate((9, 9, 30, 4)) for k in range(n)]
    cells = spark.createDataFrame(rows, CELL.format("int"))
    sizes = cells.groupBy("image_id").agg(F.count(F.lit(1)).alias("n"))

    def apart(whole, limit):
        found = enrichment.spread_images(cells, sizes, 10.0, whole, limit)
        return found and {r["image_id"] for r in found.collect()}
    assert apart(20, 5) == {"i1", "i2"} and apart(20, 10) == {"i2"} and apart(30, 5) == {"i1"} and apart(30, 10) is None and apart(30, 30) is None


def test_disk_of_a_cell(spark):
    """Cells are written once, when they are dealt out by image: no shuffled types, no copies of neighbours, no stored table."""
    n = 40_000
    cells = spark.range(n).select(
        F.concat(F.lit("image"), (F.col("id") % 80).cast("string")).alias("image_id"), F.lit("x").alias("condition"),
        F.concat_ws("-", "id", F.xxhash64("id") % 1000).alias("cell_id"), (F.abs(F.xxhash64("id", F.lit(1))) % 1000).alias("x"),
        (F.abs(F.xxhash64("id", F.lit(2))) % 1000).alias("y"), F.element_at(F.array(*map(F.lit, "ABC")), (F.abs(F.xxhash64("id", F.lit(3))) % 3 + 1).cast("int")).alias("cell_type"))

    def files():
        held = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        shuffles = [Path(held.apply(i).getPath()) for i in range(held.size())]
        kept = Path(owned_folder(spark).removeprefix("file:")).rglob("*.parquet")
        return {p: p.stat().st_size for p in [*(p for p in shuffles if p.suffix == ".data"), *kept] if p.exists()}
    before = files()
    found = enrichment.neighbour_enrichment(cells, 30.0, 99)
    assert len(found.collect()) == 9
    assert sum(size for p, size in files().items() if p not in before) < 100 * n
