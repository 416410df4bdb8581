"""Distances, radii and boxes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Smallest drawn radius, and the radius of a cell with no area.
SMALLEST_RADIUS = 3.0
RADIUS_WITHOUT_AREA = 5.0


def squared_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    dx, dy = x1 - x2, y1 - y2
    return dx * dx + dy * dy


def distance_um(x1: Column, y1: Column, x2: Column, y2: Column, um_per_px: float) -> Column:
    """Euclidean pixel distance in micrometres."""
    return F.sqrt(squared_distance(x1, y1, x2, y2)) * F.lit(float(um_per_px))


def max_anchor_distance(d1: Column, d2: Column) -> Column:
    """The larger of an anchor's two partner distances; decides the report radius."""
    return F.greatest(d1, d2)


def equivalent_radius(area: Column) -> Column:
    """Radius of the disc of that area, never under the smallest; null area stays null."""
    return F.when(area.isNotNull(), F.greatest(F.sqrt(area / F.pi()), F.lit(SMALLEST_RADIUS)))


def drawn_radius(area: Column) -> Column:
    """The same with a stand-in radius where the area is missing."""
    return F.coalesce(equivalent_radius(area), F.lit(RADIUS_WITHOUT_AREA))


def bounding_box(x: Column, y: Column, radius: Column) -> dict[str, Column]:
    """Square around a centre, as named columns."""
    return {
        "roi_x": x - radius,
        "roi_y": y - radius,
        "roi_width": 2 * radius,
        "roi_height": 2 * radius,
    }


def clip_box(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> dict[str, Column]:
    """Box ends held inside the image, and the sizes that leaves."""
    x_end, y_end = F.least(x + w, width), F.least(y + h, height)
    return {"x_end": x_end, "y_end": y_end, "clipped_w": x_end - x, "clipped_h": y_end - y}
