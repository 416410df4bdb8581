"""Rolling image counts up to patients."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.functions.names import reg_num, spot_list
from cellweave.operators.ordered import percentiles
from cellweave.operators.skew import GROUP_ROWS

# Default tissue area of one image, and the clinical columns carried along.
AREA_PER_IMAGE_UM2 = 1_168_128.0
CLINICAL = ("Group", "OS", "OS_Censor", "DFS", "DFS_Censor", "MSI_IHC", "pT", "pN", "pM", "Sex", "Age")
SPOTS = "TMA spot / region"

# Names of the two groups, by density and by presence.
HIGH, LOW = "High", "Low"
PRESENT, ABSENT = "Triad+", "Triad−"


def image_universe(images: DataFrame | None, summary: DataFrame) -> DataFrame:
    """Every processed image once; those of the summary where none are listed."""
    source = summary if images is None else images
    return source.select("image_id").distinct()


def image_triads(summary: DataFrame) -> DataFrame:
    """Triads per image over all combinations."""
    return summary.groupBy("image_id").agg(F.sum("n_triads").alias("n_triads"))


def reindex_zero(counts: DataFrame, universe: DataFrame) -> DataFrame:
    """Counts of exactly the images of the universe, zero where there is none."""
    return (universe.join(counts, "image_id", "left")
            .select("image_id", F.coalesce("n_triads", F.lit(0)).alias("n_triads")))


def region_totals(image_counts: DataFrame) -> DataFrame:
    """Images and triads per region number; images of all conditions count."""
    return (image_counts.withColumn("reg_num", reg_num(F.col("image_id")))
            .where("reg_num is not null").groupBy("reg_num")
            .agg(F.count(F.lit(1)).alias("n_images"), F.sum("n_triads").alias("n_triads")))


def patient_images(patients: DataFrame, image_counts: DataFrame) -> DataFrame:
    """Images of each patient through the patient's spot list."""
    regions = image_counts.select("image_id", "n_triads", reg_num(F.col("image_id")).alias("reg_num"))
    spots = (patients.where(F.col("Patient").isNotNull())
             .select(F.col("Patient").alias("patient_id"),
                     F.explode(F.array_distinct(spot_list(F.col(SPOTS)))).alias("reg_num")))
    return spots.join(regions, "reg_num").select("patient_id", "reg_num", "image_id", "n_triads")


def patient_density(patients: DataFrame, image_counts: DataFrame,
                    area_per_image_um2: float = AREA_PER_IMAGE_UM2) -> DataFrame:
    """Images, triads, area and triads per mm2 of every patient row.

    Regions are added up before they meet the spot lists, so a region shared by many
    patients or images stays one row.
    """
    rows = patients.where(F.col("Patient").isNotNull()).select(
        F.col("Patient").cast("bigint").alias("patient_id"), F.col("Group").cast("int").alias("group"),
        F.col(SPOTS).alias("spots"))
    lists = rows.select("spots").distinct()
    totals = region_totals(image_counts)
    per_list = (lists.select("spots", F.explode(F.array_distinct(spot_list(F.col("spots")))).alias("reg_num"))
                .join(totals, "reg_num")
                .groupBy("spots").agg(F.sum("n_images").alias("n_images"), F.sum("n_triads").alias("total_triads")))
    area = F.col("n_images") * F.lit(float(area_per_image_um2)) / F.lit(1e6)
    return (rows.join(per_list, "spots", "left")
            .withColumns({"n_images": F.coalesce("n_images", F.lit(0)),
                          "total_triads": F.coalesce("total_triads", F.lit(0))})
            .select("patient_id", "group", "n_images", "total_triads",
                    F.round(area, 4).alias("total_area_mm2"),
                    F.coalesce(F.round(F.try_divide(F.col("total_triads"), area), 4), F.lit(0.0))
                    .alias("triads_per_mm2")))


def merge_clinical(density: DataFrame, patients: DataFrame) -> DataFrame:
    """Left join of the clinical columns on the patient; repeated patients fan out."""
    present = [c for c in CLINICAL if c in patients.columns]
    # ``Group`` differs from the density's ``group`` only by case, which Spark does not tell apart.
    clinical = patients.select(
        F.col("Patient").cast("bigint").alias("patient_id"),
        *[F.col(c).alias("clinical_group" if c == "Group" else c) for c in present])
    return density.join(clinical, "patient_id", "left")


def patient_presence(density: DataFrame) -> DataFrame:
    """Patients with survival data, and patients with any triad."""
    return density.agg(F.count("OS").alias("n_with_os"),
                       F.count_if(F.col("total_triads") > 0).alias("n_with_triads"))


def split_threshold(density: DataFrame, split_by: str | float = "median", limit: int = GROUP_ROWS) -> DataFrame:
    """One row: the threshold, and whether the zero rule may apply."""
    number = None
    if split_by != "median":
        try:
            number = float(split_by)
        except (TypeError, ValueError):
            number = None
    spark = density.sparkSession
    if number is not None:
        return spark.createDataFrame([(0, number, False)], "all_rows int, threshold double, by_presence boolean")
    middle = percentiles(density.withColumn("all_rows", F.lit(0)), ["all_rows"],
                         {"threshold": ("triads_per_mm2", 0.5)}, limit)
    return middle.withColumn("by_presence", (F.col("threshold") == 0) & F.lit(split_by == "median"))


def density_split(density: DataFrame, split_by: str | float = "median", limit: int = GROUP_ROWS) -> DataFrame:
    """High or low density per patient; presence against absence where the median is zero."""
    value = F.col("triads_per_mm2")
    label = (F.when(F.col("by_presence"), F.when(value > 0, PRESENT).otherwise(ABSENT))
             .when(value >= F.col("threshold"), HIGH).otherwise(LOW))
    # One row on the right.
    return (density.withColumn("all_rows", F.lit(0))
            .join(F.broadcast(split_threshold(density, split_by, limit)), "all_rows")
            .withColumn("density_group", label).drop("all_rows", "by_presence"))
