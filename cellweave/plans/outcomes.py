"""From triads to marker tests and patient survival."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.functions.labels import group_label
from cellweave.operators import patients as pt, ranktests as rt, survival as sv, triads as ops
from cellweave.operators.lineage import materialize

# Outcomes with their duration and censor columns.
OUTCOMES = {
    "Overall Survival (OS)": ("OS", "OS_Censor"),
    "Disease-Free Survival (DFS)": ("DFS", "DFS_Censor"),
}


def test_markers(cells: DataFrame, triads: DataFrame, search: ops.TriadSearch, markers: dict[str, str],
                 conditions: list[str], report_radius_um: float = 20.0) -> DataFrame:
    """Marker tests of the cells of images with triads, flagged at the report radius."""
    roles = search.role_types()
    shown = {"anchor": search.anchor_names, "partner1": search.partner1_names, "partner2": search.partner2_names}
    names = {role: shown[role].get(kind, kind) for role, kind in roles.items()}
    images = triads.select("image_id").distinct()
    inside = cells.join(images, "image_id", "left_semi")
    reported = ops.report_radius_filter(triads, report_radius_um)
    flagged = materialize(ops.flags_from_triads(inside, reported, include_zero_images=True))
    return rt.functional_summary(flagged, roles, names, markers, conditions)


test_markers.__test__ = False


@dataclass(frozen=True)
class SurvivalAnalysis:
    patients: DataFrame
    curves: DataFrame
    log_rank: DataFrame
    condition_curves: DataFrame
    condition_log_rank: DataFrame


def analyse_survival(summary: DataFrame, patients: DataFrame, images: DataFrame | None = None,
                     area_per_image_um2: float = pt.AREA_PER_IMAGE_UM2, split_by: str | float = "median",
                     censor_is_one: bool = True) -> SurvivalAnalysis:
    """Patient densities, curves and log-rank tests by density and by clinical group."""
    counts = pt.reindex_zero(pt.image_triads(summary), pt.image_universe(images, summary))
    merged = materialize(pt.merge_clinical(pt.patient_density(patients, counts, area_per_image_um2), patients))
    split = pt.density_split(merged, split_by)
    threshold = pt.split_threshold(merged, split_by).first()["threshold"]
    clinical = "clinical_group" if "clinical_group" in merged.columns else "group"
    labelled = split.withColumn("condition_label", group_label(F.col(clinical)))
    by_density = sv.survival_rows(labelled, OUTCOMES, "density_group", censor_is_one)
    by_condition = sv.survival_rows(labelled, OUTCOMES, "condition_label", censor_is_one)
    return SurvivalAnalysis(
        patients=split, curves=sv.kaplan_meier(by_density),
        log_rank=sv.log_rank_results(by_density, str(split_by), threshold),
        condition_curves=sv.kaplan_meier(by_condition),
        condition_log_rank=sv.log_rank_results(by_condition, "condition", None))
