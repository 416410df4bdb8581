"""From typed cells to triads and everything counted from them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from cellweave.operators import triads as ops
from cellweave.operators.lineage import materialize


@dataclass(frozen=True)
class TriadAnalysis:
    triads: DataFrame
    flagged: DataFrame
    summary: DataFrame
    top_combos: DataFrame
    top_per_image: DataFrame
    density: DataFrame
    distances: DataFrame
    trajectory: DataFrame


def analyse_triads(cells: DataFrame, search: ops.TriadSearch, areas: DataFrame, conditions: list[str],
                   trajectory_min_um: float = 0.0) -> TriadAnalysis:
    """Triads are found and written once; every table after that is read from them.

    ``areas`` has condition and area_um2, with one row per time point where there are any.
    """
    found = materialize(ops.find_triads(cells, search))
    summary = materialize(ops.triad_summary(found, search))
    known = ops.condition_areas(areas)
    return TriadAnalysis(
        triads=found, flagged=ops.flags_from_triads(cells, found), summary=summary,
        top_combos=ops.top_combos(summary), top_per_image=ops.top_combo_per_image(summary),
        density=ops.condition_density(summary, known, conditions),
        distances=ops.distance_summary(found, conditions),
        trajectory=ops.trajectory(found, known, conditions, search.radius_um, trajectory_min_um))
