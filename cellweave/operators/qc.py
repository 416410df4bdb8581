"""Quality control of raw cells: size and stain filter, normalisation, noise removal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.functions.geometry import bounding_box, equivalent_radius
from cellweave.operators.ordered import percentiles
from cellweave.operators.skew import GROUP_ROWS, join_group_stats
from cellweave.schema import col

# Classes of raw cells.
INCLUDED = "Included"
SMALL_LOW = "Excl_SmallArea_LowDAPI"
SMALL = "Excl_SmallArea"
LOW = "Excl_LowDAPI"
NOISE = "Excl_Noise"
CLASSES = (INCLUDED, SMALL, LOW, SMALL_LOW, NOISE)

# Histogram bins, floors of the cutoffs and the share that replaces them.
HISTOGRAM_BINS = 50
LOWEST_COUNT_CUTOFF = 10
LOWEST_SUM_CUTOFF = 20
FLOOR_SHARE = 0.99


def percentile_thresholds(cells: DataFrame, size_percentile: float = 1, dapi_percentile: float = 1,
                          limit: int = GROUP_ROWS) -> DataFrame:
    """Area and nuclear stain percentile of every image."""
    return percentiles(cells, ["image_id"], {
        "area_threshold": ("area", size_percentile / 100),
        "dapi_threshold": ("dapi", dapi_percentile / 100)}, limit)


def qc_filter(cells: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Cells over both thresholds of their image."""
    return (join_group_stats(cells, thresholds, ["image_id"])
            .where((F.col("area") > F.col("area_threshold")) & (F.col("dapi") > F.col("dapi_threshold")))
            .drop("area_threshold", "dapi_threshold"))


def zscore(cells: DataFrame, markers: list[str]) -> DataFrame:
    """Each marker per image as (x - mean) / population deviation; null where that is 0."""
    stats = cells.groupBy("image_id").agg(
        *[F.avg(col(m)).alias(f"mean_{i}") for i, m in enumerate(markers)],
        *[F.stddev_pop(col(m)).alias(f"std_{i}") for i, m in enumerate(markers)])
    number = {m: i for i, m in enumerate(markers)}
    out = [
        F.try_divide(col(c) - F.col(f"mean_{number[c]}"), F.col(f"std_{number[c]}")).alias(c)
        if c in number else col(c) for c in cells.columns]
    return join_group_stats(cells, stats, ["image_id"]).select(*out)


def add_scores(normalised: DataFrame, markers: list[str]) -> DataFrame:
    """Add ``z_count``, the markers above their mean, and ``z_sum``, the sum of all z-scores."""
    values = [col(m) for m in markers]
    count = reduce(lambda a, b: a + b, [F.coalesce((v > 0).cast("int"), F.lit(0)) for v in values])
    total = reduce(lambda a, b: a + b, [F.coalesce(v, F.lit(0.0)) for v in values])
    return normalised.withColumns({"z_count": count.cast("double"), "z_sum": total})


def score_rows(scored: DataFrame) -> DataFrame:
    """Both scores of every cell in long form: (image_id, score, value)."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(s).alias("score"), F.col(s).alias("value")) for s in ("z_count", "z_sum")]))
    return scored.select("image_id", pairs.alias("s")).select("image_id", "s.score", "s.value")


def histogram(rows: DataFrame, keys: list[str], value: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width histogram per group, empty bins included and the last bin closed.

    A group with a single value is widened by half a unit on both sides.
    """
    known = rows.where(col(value).isNotNull())
    flat = F.col("low") == F.col("high")
    edges = (known.groupBy(*keys).agg(F.min(col(value)).cast("double").alias("low"),
                                      F.max(col(value)).cast("double").alias("high"))
             .select(*keys, F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
                     F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high")))
    # Bins are counted before the shuffle, so a hot group arrives as one row per bin and task.
    place = F.least(F.floor((col(value) - F.col("low")) * F.lit(bins) / (F.col("high") - F.col("low"))),
                    F.lit(bins - 1))
    counts = (join_group_stats(known.select(*keys, col(value)), edges, keys)
              .groupBy(*keys, place.alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    width = (F.col("high") - F.col("low")) / F.lit(bins)
    every = edges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)).cast("array<bigint>")))
    return (every.join(counts, [*keys, "bin"], "left")
            .select(*keys, "bin", F.coalesce("n", F.lit(0)).alias("n"),
                    (F.col("low") + F.col("bin") * width).alias("bin_low"),
                    (F.col("low") + (F.col("bin") + 1) * width).alias("bin_high"),
                    (F.col("low") + (F.col("bin") + 0.5) * width).alias("center")))


def knee(hist: DataFrame, keys: list[str], sensitivity: float = 1.0) -> DataFrame:
    """Knee of a convex decreasing curve (center, n) of bins of one width per group; null where there is none.

    The published Kneedle rule: scale both axes to 0..1, turn the curve over, and take the
    first local maximum of (y - x) whose following points fall under its threshold. At a
    local minimum the threshold is reset to zero. Groups are at most one row per bin.
    """
    whole = Window.partitionBy(*keys)
    line = whole.orderBy("bin")
    # Bins are of one width, so both axes are whole numbers over the same denominator: ties are ties on every run.
    last = F.count(F.lit(1)).over(whole) - 1
    height = F.max("n").over(whole) - F.min("n").over(whole)
    place = F.row_number().over(line) - 1
    curve = (hist.withColumn("height", height)
             .withColumn("gap", F.when(height > 0, (F.max("n").over(whole) - F.col("n")) * last - place * height))
             .withColumn("left", F.coalesce(F.lag("gap").over(line), F.col("gap")))
             .withColumn("right", F.coalesce(F.lead("gap").over(line), F.col("gap")))
             .withColumn("next_gap", F.lead("gap").over(line)))
    top = (F.col("gap") >= F.col("left")) & (F.col("gap") >= F.col("right"))
    bottom = (F.col("gap") <= F.col("left")) & (F.col("gap") <= F.col("right"))
    # One mean step along x is 1 / last, so ``height`` in these units.
    threshold = F.when(bottom, F.lit(0.0)).when(top, F.col("gap") - F.lit(float(sensitivity)) * F.col("height"))
    traced = (curve.withColumn("top_at", F.last(F.when(top, F.col("center")), ignorenulls=True).over(line))
              .withColumn("threshold", F.last(threshold, ignorenulls=True).over(line)))
    falls = F.col("top_at").isNotNull() & (F.col("next_gap") < F.col("threshold"))
    return traced.groupBy(*keys).agg(
        F.min_by("top_at", F.when(falls, F.col("bin"))).alias("at"),
        F.count_if(falls).alias("n_falls")).select(
            *keys, F.when(F.col("n_falls") > 0, F.col("at")).alias("knee"))


def noise_cutoffs(scored: DataFrame, cut_off: float = 0.01, bins: int = HISTOGRAM_BINS,
                  limit: int = GROUP_ROWS) -> DataFrame:
    """Per image the largest believable z_count and z_sum.

    The knee of each histogram, or the upper percentile where there is none or it is 0;
    cutoffs under their floor are replaced by the 99th percentile. Reads ``scored`` several
    times: pass a written table.
    """
    values = score_rows(scored)
    by = ["image_id", "score"]
    knees = knee(histogram(values, by, "value", bins), by)
    # Both scores of a cell in one row: as rows of their own they would be twice as many to sort.
    scores = ("z_count", "z_sum")
    wide = percentiles(scored, ["image_id"], {f"{n}_{s}": (s, share) for s in scores for n, share in (("fallback", 1 - cut_off), ("floor", FLOOR_SHARE))}, limit)
    tails = wide.select("image_id", F.inline(F.array(*[
        F.struct(F.lit(s).alias("score"), F.col(f"fallback_{s}").alias("fallback"), F.col(f"floor_{s}").alias("floor")) for s in scores])))
    found = F.when(F.col("knee") != 0, F.col("knee"))
    lowest = F.when(F.col("score") == "z_count", LOWEST_COUNT_CUTOFF).otherwise(LOWEST_SUM_CUTOFF)
    raw = F.coalesce(found, F.col("fallback"))
    chosen = knees.join(tails, by).select(
        "image_id", "score", F.when(raw < lowest, F.col("floor")).otherwise(raw).alias("cutoff"))
    return chosen.groupBy("image_id").agg(
        F.max(F.when(F.col("score") == "z_count", F.col("cutoff"))).alias("z_count_cutoff"),
        F.max(F.when(F.col("score") == "z_sum", F.col("cutoff"))).alias("z_sum_cutoff"))


def noise_filter(scored: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Cells over neither cutoff of their image, without the scores."""
    over = (F.col("z_count") > F.col("z_count_cutoff")) | (F.col("z_sum") > F.col("z_sum_cutoff"))
    return (join_group_stats(scored, cutoffs, ["image_id"])
            .where(~over).drop("z_count_cutoff", "z_sum_cutoff", "z_count", "z_sum"))


def coordinate_key(cells: DataFrame) -> tuple[Column, Column]:
    """Coordinates in hundredths, the key cells are matched by where ids are missing."""
    return F.round(F.col("x") * 100).cast("bigint"), F.round(F.col("y") * 100).cast("bigint")


def classify(raw: DataFrame, included: DataFrame, thresholds: DataFrame, by_coordinates: bool = False) -> DataFrame:
    """Class of every raw cell: kept, or the first reason it was not.

    Cells are matched to the kept ones by id within the image, or by rounded coordinates.
    """
    if by_coordinates:
        key = ["key_x", "key_y", "image_id"]
        kx, ky = coordinate_key(raw)
        raw, included = (d.withColumn("key_x", kx).withColumn("key_y", ky) for d in (raw, included))
    else:
        # Ids first: they differ early, so sorting by them rarely has to compare whole names.
        key = ["cell_id", "image_id"]
    columns = [col(c) for c in raw.columns]
    kept = included.select(*key).distinct().withColumn("is_kept", F.lit(True))
    small = F.col("area") < F.col("area_threshold")
    low = F.col("dapi") < F.col("dapi_threshold")
    label = (F.when(F.col("is_kept"), INCLUDED).when(small & low, SMALL_LOW)
             .when(small, SMALL).when(low, LOW).otherwise(NOISE))
    # The unique cell key spreads the join evenly; images are only joined to thresholds.
    return (join_group_stats(raw.join(kept, key, "left").select(*columns, "is_kept"), thresholds, ["image_id"], "left")
            .withColumn("classification", label).drop("is_kept", "key_x", "key_y"))


def class_counts(classified: DataFrame) -> DataFrame:
    """Raw cells of every image by class, one column each, and in total."""
    return classified.groupBy("image_id").agg(
        F.count(F.lit(1)).alias("total_raw"),
        *[F.count_if(F.col("classification") == c).alias(c) for c in CLASSES])


def export_columns(classified: DataFrame) -> DataFrame:
    """The 14 columns of the per-cell QC export."""
    radius = equivalent_radius(F.col("area"))
    return classified.select(
        F.col("x").alias("centroid_x"), F.col("y").alias("centroid_y"),
        *[c.alias(n) for n, c in bounding_box(F.col("x"), F.col("y"), radius).items()],
        "area", F.col("dapi").alias("DAPI"), "condition", F.col("image_id").alias("image_ID"),
        "tissue_id", "classification", "area_threshold", "dapi_threshold")


def processing_stats(raw: DataFrame, filtered: DataFrame, cleaned: DataFrame, cutoffs: DataFrame,
                     thresholds: DataFrame, done: DataFrame | None = None, unread: DataFrame | None = None) -> DataFrame:
    """Counts, shares removed, cutoffs and status of every image.

    Images listed in ``done`` (image_id) are SKIPPED; images without a usable area or stain
    value cannot get a threshold and are an ERROR, as are those of ``unread`` (image_id), whose
    file could not be read; the rest are PROCESSED.
    """
    sizes = raw.groupBy("image_id").agg(F.count(F.lit(1)).alias("original_cells"))
    if unread is not None:
        lost = unread.select("image_id").distinct().join(sizes, "image_id", "left_anti")
        sizes = sizes.unionByName(lost.withColumn("original_cells", F.lit(0).cast("bigint")))
    after = filtered.groupBy("image_id").agg(F.count(F.lit(1)).alias("cells_after_size_dapi_filter"))
    final = cleaned.groupBy("image_id").agg(F.count(F.lit(1)).alias("final_cells"))
    table = (sizes.join(after, "image_id", "left").join(final, "image_id", "left")
             .join(thresholds, "image_id", "left").join(cutoffs, "image_id", "left"))
    if done is not None:
        table = table.join(done.select("image_id", F.lit(True).alias("was_done")).distinct(), "image_id", "left")
    else:
        table = table.withColumn("was_done", F.lit(None).cast("boolean"))
    n, n_filtered, n_final = (F.col("original_cells"), F.coalesce("cells_after_size_dapi_filter", F.lit(0)),
                              F.coalesce("final_cells", F.lit(0)))
    status = (F.when(F.col("was_done"), "SKIPPED")
              .when(F.col("area_threshold").isNull() | F.col("dapi_threshold").isNull(), "ERROR")
              .otherwise("PROCESSED"))

    def percent(part: Column, of: Column) -> Column:
        return F.try_divide(part * 100.0, of)

    return table.select(
        "image_id", n.alias("original_cells"),
        "area_threshold", "dapi_threshold", "z_count_cutoff", "z_sum_cutoff",
        n_filtered.alias("cells_after_size_dapi_filter"),
        (n - n_filtered).alias("cells_removed_by_filter"),
        percent(n - n_filtered, n).alias("percent_removed_by_filter"),
        n_final.alias("cells_after_noise_removal"),
        (n_filtered - n_final).alias("cells_removed_by_noise"),
        percent(n_filtered - n_final, n_filtered).alias("percent_removed_by_noise"),
        (n - n_final).alias("total_cells_removed"),
        percent(n - n_final, n).alias("total_percent_removed"),
        n_final.alias("final_cells"), status.alias("status"))


def stats_rollup(stats: DataFrame) -> DataFrame:
    """Images by status, and the mean removal of the processed ones."""
    is_done = F.col("status") == "PROCESSED"
    return stats.agg(
        F.count_if(is_done).alias("processed"),
        F.count_if(F.col("status").contains("SKIPPED")).alias("skipped"),
        F.count_if(F.col("status").contains("ERROR")).alias("errors"),
        F.avg(F.when(is_done, F.col("total_percent_removed"))).alias("avg_total_removal"))
