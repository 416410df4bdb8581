"""Canonical cell-table columns and the split between markers and everything else."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "Unknown"
UNASSIGNED = "Unassigned"

# Columns of a raw cell table that are not markers.
RAW_METADATA = (
    "label", "area", "x", "y", "slide_folder", "image_ID", "condition",
    "eccentricity", "perimeter", "convex_area",
    "axis_major_length", "axis_minor_length", "DAPI",
)

# Shape columns dropped when a cell table is normalised.
SHAPE_COLUMNS = (
    "eccentricity", "perimeter", "convex_area",
    "axis_major_length", "axis_minor_length", "label",
)

# Where the readers keep a line that does not fit the schema.
CORRUPT = "corrupt_record"

# Columns of our own canonical cell table that are not markers.
CELL_COLUMNS = (
    CORRUPT, "z_count", "z_sum",
    "image_id", "condition", "tissue_id", "cell_id", "x", "y",
    "area", "dapi", "cell_type", "slide_folder", "matched",
)

RAW_CELL_SCHEMA = T.StructType([
    T.StructField("label", T.LongType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
    T.StructField("area", T.DoubleType()),
    T.StructField("eccentricity", T.DoubleType()),
    T.StructField("perimeter", T.DoubleType()),
    T.StructField("axis_major_length", T.DoubleType()),
    T.StructField("axis_minor_length", T.DoubleType()),
    T.StructField("DAPI", T.DoubleType()),
])


def col(name: str) -> Column:
    """A column by its literal name; marker names may hold dots, spaces and colons."""
    return F.col("`" + name.replace("`", "``") + "`")


def marker_columns(df: DataFrame, last_marker: str | None = None) -> list[str]:
    """Marker columns in file order.

    With ``last_marker`` present the markers are the non-metadata columns up to and
    including it, else every non-metadata column.
    """
    metadata = set(RAW_METADATA) | set(CELL_COLUMNS)
    columns = df.columns
    if last_marker and last_marker in columns:
        columns = columns[: columns.index(last_marker) + 1]
    return [c for c in columns if c not in metadata]


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Required columns the table lacks, in the order asked for."""
    present = set(df.columns)
    return [c for c in required if c not in present]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into null in every floating column, so comparisons behave as in SQL."""
    floating = {f.name for f in df.schema.fields
                if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[
        F.when(~F.isnan(col(c)), col(c)).alias(c) if c in floating else col(c)
        for c in df.columns
    ])


def drop_shape_columns(df: DataFrame) -> DataFrame:
    """Drop the six shape columns; the kept metadata and all markers stay."""
    return df.drop(*SHAPE_COLUMNS)
