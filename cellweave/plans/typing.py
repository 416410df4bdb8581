"""From normalised cells to typed cells, by rules or by labelled clusters."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from cellweave.operators import composition, embedding, markers as mk, mixture, rules
from cellweave.operators.communities import RESOLUTION, communities
from cellweave.operators.knn import knn, knn_edges
from cellweave.operators.lineage import materialize


@dataclass(frozen=True)
class Typing:
    panel: list[str]
    gating_only: list[str] = field(default_factory=lambda: ["CD45"])
    gate_multiplier: float = 3.0
    default_multiplier: float = 2.0
    overrides: dict[str, float] = field(default_factory=dict)
    skip_gate: bool = False
    n_components: int = 2
    max_cells: int | None = None
    seed: int = 42


@dataclass(frozen=True)
class Typed:
    cells: DataFrame
    thresholds: DataFrame
    counts: DataFrame | None = None
    composition: DataFrame | None = None


def with_positivity(cells: DataFrame, options: Typing) -> tuple[DataFrame, DataFrame]:
    """Gate, fit all panel thresholds at once, add positivity and intensity columns."""
    by_marker = mixture.multipliers(options.panel, options.default_multiplier, options.overrides,
                                    options.gating_only, options.gate_multiplier)
    fit = {"n_components": options.n_components, "max_cells": options.max_cells, "seed": options.seed}
    if options.gating_only and not options.skip_gate:
        for marker in options.gating_only:
            gate = mixture.as_dict(mixture.marker_thresholds(cells, [marker], by_marker, **fit))
            if marker in gate:
                cells = mk.gate(cells, marker, gate[marker])
    present, _ = mk.panel_markers(cells.columns, options.panel, options.gating_only)
    thresholds = mixture.marker_thresholds(cells, present, by_marker, **fit)
    numbers = mixture.as_dict(thresholds)
    return mk.add_intensity_levels(mk.add_positivity(cells, numbers), numbers), thresholds


def _finished(cells: DataFrame, thresholds: DataFrame) -> Typed:
    return Typed(cells, thresholds, composition.celltype_counts(cells),
                 composition.composition_percent(cells) if "condition" in cells.columns else None)


def type_by_rules(cells: DataFrame, options: Typing, cell_rules: list[rules.Rule]) -> Typed:
    positive, thresholds = with_positivity(cells, options)
    return _finished(rules.assign_types(positive, cell_rules), thresholds)


def cluster_cells(cells: DataFrame, markers: list[str], n_neighbors: int = 15, resolution: float = RESOLUTION,
                  n_components: int = 50) -> DataFrame:
    """First half of the labelled way: every cell with its community as ``cluster``.

    ``cells`` needs a whole-number ``id``. The table this returns is what labels are made for.
    """
    scaled = embedding.normalize_scale(cells, markers)
    points = embedding.principal_components(scaled, markers, n_components).selectExpr("id", "components AS vector")
    found = communities(knn_edges(knn(materialize(points), n_neighbors, "grouped")), resolution)
    return cells.join(found.withColumnsRenamed({"node": "id", "community": "cluster"}), "id", "left")


def type_by_labels(clustered: DataFrame, labels: DataFrame, thresholds: DataFrame) -> Typed:
    """Second half: the labels of the clusters as cell types."""
    return _finished(composition.label_clusters(clustered, labels), thresholds)
