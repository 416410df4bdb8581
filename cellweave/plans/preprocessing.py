"""From raw cells to normalised, denoised cells with their statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from cellweave.operators import qc
from cellweave.operators.lineage import materialize
from cellweave.schema import drop_shape_columns, marker_columns
from cellweave.sources.tables import not_yet_done


@dataclass(frozen=True)
class Preprocessing:
    size_percentile: float = 1
    dapi_percentile: float = 1
    noise_cut_off: float = 0.01
    noise_bins: int = qc.HISTOGRAM_BINS
    last_marker: str | None = None


@dataclass(frozen=True)
class Preprocessed:
    cells: DataFrame
    classified: DataFrame
    thresholds: DataFrame
    cutoffs: DataFrame
    stats: DataFrame


def preprocess(raw: DataFrame, options: Preprocessing = Preprocessing(),
               manifest: DataFrame | None = None) -> Preprocessed:
    """Filter, normalise and denoise every image; nothing is done twice.

    ``manifest`` (tissue_id, condition) lists what is finished: those cells are skipped.
    Thresholds and cutoffs are one row per image and written before they are joined back;
    the scored cells are written once, since cutoffs and filter both read them.
    """
    todo = raw if manifest is None else not_yet_done(raw, manifest)
    markers = marker_columns(raw, options.last_marker)
    thresholds = materialize(qc.percentile_thresholds(todo, options.size_percentile, options.dapi_percentile))
    filtered = qc.qc_filter(todo, thresholds)
    scored = materialize(qc.add_scores(qc.zscore(drop_shape_columns(filtered), markers), markers))
    cutoffs = materialize(qc.noise_cutoffs(scored, options.noise_cut_off, options.noise_bins))
    cleaned = qc.noise_filter(scored, cutoffs)
    done = None
    if manifest is not None:
        done = raw.join(manifest.select("tissue_id", "condition").distinct(), ["tissue_id", "condition"],
                        "left_semi").select("image_id")
    return Preprocessed(
        cells=cleaned,
        classified=qc.classify(todo, cleaned, thresholds),
        thresholds=thresholds, cutoffs=cutoffs,
        stats=qc.processing_stats(raw, filtered, cleaned, cutoffs, thresholds, done))
