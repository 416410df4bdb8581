"""Border, perimeter and convex area against shapes by hand and plain pixel walks."""

import itertools
import math

import numpy as np
import pytest

from cellweave.operators import outlines

SCHEMA = "image_id string, label int, x int, y int"


def shapes():
    rng = np.random.default_rng(3)
    disc = [(x, y) for x in range(-6, 7) for y in range(-6, 7) if x * x + y * y <= 30]
    ell = [(x, y) for x in range(8) for y in range(8) if x < 2 or y < 2]
    some = [(x, y) for x in range(9) for y in range(7) if rng.random() < 0.6]
    return {1: [(4, 5)], 2: [(x, y) for x in range(5) for y in range(3)], 3: disc, 4: ell, 5: some, 6: [(0, 0), (1, 0), (2, 0)], 7: [(0, 0), (5, 4)]}


def border(spots):
    return {(x, y) for x, y in spots if any((x + a, y + b) not in spots for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1)))}


def perimeter(spots):
    edge, total = border(spots), 0.0
    for x, y in edge:
        marks = 1 + sum({1: 2, 2: 10}[abs(a) + abs(b)] for a in (-1, 0, 1) for b in (-1, 0, 1) if (a or b) and (x + a, y + b) in edge)
        total += 1.0 if marks in (5, 7, 15, 17, 25, 27) else math.sqrt(2) if marks in (21, 33) else (1 + math.sqrt(2)) / 2 if marks in (13, 23) else 0.0
    return total


def hull_pixels(spots):
    """Centres on no outer side of any line that has all points on one side."""
    points = [(2 * x + a, 2 * y + b) for x, y in spots for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1))]
    cross = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    sides = [(p, q) for p, q in itertools.permutations(set(points), 2) if all(cross(p, q, r) >= 0 for r in points)]
    xs, ys = zip(*spots)
    grid = itertools.product(range(min(xs), max(xs) + 1), range(min(ys), max(ys) + 1))
    return sum(all(cross(p, q, (2 * x, 2 * y)) >= 0 for p, q in sides) for x, y in grid)


def test_outlines_of_shapes(spark):
    rows = [("i", k, x, y) for k, spots in shapes().items() for x, y in spots]
    pixels = spark.createDataFrame(rows + rows[:9] + [("i", None, 1, 1), ("i", 2, None, 9), ("j", 1, 4, 5)], SCHEMA)
    edges = {(r.image_id, r.label): (r.n_border, r.perimeter) for r in outlines.region_outlines(pixels).collect()}
    areas = {(r.image_id, r.label): (r.area, r.convex_area) for r in outlines.convex_areas(pixels).collect()}
    assert set(edges) == set(areas) == {("i", k) for k in shapes()} | {("j", 1)}
    for k, spots in shapes().items():
        assert edges["i", k] == (len(border(set(spots))), pytest.approx(perimeter(set(spots))))
        assert areas["i", k] == (len(spots), hull_pixels(spots))
    # By hand: five by three pixels have a border of 12 with sides of 4 and 2.
    assert edges["i", 2] == (12, 12.0) and areas["i", 2] == (15, 15)
    empty = pixels.where("false")
    assert outlines.region_outlines(empty).count() == outlines.convex_areas(empty).count() == 0


def test_labels_come_to_python_in_batches(spark):
    pixels = spark.range(3000).selectExpr("'i' AS image_id", "CAST(id DIV 3 AS INT) AS label", "CAST(id % 3 AS INT) AS x", "CAST(id % 3 AS INT) AS y")
    found = outlines.convex_areas(pixels)
    # A group of its own for every label costs more than its hull.
    assert "FlatMapGroupsInPandas" not in found._jdf.queryExecution().executedPlan().toString()
    assert {(r.area, r.convex_area) for r in found.collect()} == {(3, 3)} and found.count() == 1000
