"""Marker matrix steps before clustering: normalise, scale, principal components."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.schema import col

# Fixed value: every cell's markers are brought to this total.
TARGET_TOTAL = 1e4


def normalize_total(cells: DataFrame, markers: list[str], target: float = TARGET_TOTAL) -> DataFrame:
    """Scale each cell's markers to one total and take log(1 + x); an all-zero cell stays zero."""
    total = reduce(lambda a, b: a + b, [F.coalesce(col(m), F.lit(0.0)) for m in markers])
    factor = F.lit(float(target)) / F.when(total == 0, 1.0).otherwise(total)
    out = {m: F.log1p(col(m) * factor) for m in markers}
    return cells.select(*[out[c].alias(c) if c in out else col(c) for c in cells.columns])


def scale_features(cells: DataFrame, markers: list[str]) -> DataFrame:
    """Zero mean and unit sample deviation per marker; a constant marker becomes zero.

    The moments are one row, so they enter the plan as numbers and no row is moved.
    """
    moments = cells.agg(*[F.avg(col(m)).alias(f"mean_{i}") for i, m in enumerate(markers)],
                        *[F.stddev_samp(col(m)).alias(f"std_{i}") for i, m in enumerate(markers)]).first()
    number = {m: i for i, m in enumerate(markers)}

    def scaled(m: str):
        mean, std = moments[f"mean_{number[m]}"], moments[f"std_{number[m]}"]
        return (col(m) - F.lit(mean)) / F.lit(std if std else 1.0)

    return cells.select(*[scaled(c).alias(c) if c in number else col(c) for c in cells.columns])


def normalize_scale(cells: DataFrame, markers: list[str], target: float = TARGET_TOTAL) -> DataFrame:
    return scale_features(normalize_total(cells, markers, target), markers)


def principal_components(cells: DataFrame, markers: list[str], n_components: int = 50) -> DataFrame:
    """Add ``components``: coordinates on the leading axes of the centred markers.

    Only the marker by marker covariance is brought together; cells stay where they are. An unknown value (null or NaN)
    counts as its marker's mean, a marker without any value as 0.
    """
    n = min(n_components, len(markers))
    known = lambda m: F.when(~F.isnan(col(m).cast("double")), col(m))
    means = cells.agg(*[F.avg(known(m)).alias(f"m_{i}") for i, m in enumerate(markers)]).first()
    centred = cells.withColumns({f"centred_{i}": F.coalesce(known(m) - F.lit(means[f"m_{i}"]), F.lit(0.0)) for i, m in enumerate(markers)})
    names = [f"centred_{i}" for i in range(len(markers))]
    assembled = VectorAssembler(inputCols=names, outputCol="centred").transform(centred)
    fitted = PCA(k=n, inputCol="centred", outputCol="projected").fit(assembled)
    return (fitted.transform(assembled)
            .withColumn("components", vector_to_array("projected"))
            .drop("centred", "projected", *names))
