"""Triads: an anchor cell with two partner cells inside one radius."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.functions.geometry import distance_um, max_anchor_distance
from cellweave.functions.labels import combo_label
from cellweave.operators.lineage import materialize
from cellweave.operators.neighbors import (
    SIDE_IN_RADII, SQUARE_CELLS, SQUARE_KEY, Side, crowded_blocks, meet, neighbor_counts, pairs_on_squares, type_counts)
from cellweave.operators.ordered import percentiles

# Fixed value: points of a distance trajectory.
TRAJECTORY_POINTS = 300

TYPES = ["anchor_type", "partner1_type", "partner2_type"]
DISTANCES = ["dist_anchor_p1_um", "dist_anchor_p2_um", "dist_p1_p2_um"]
ROLE_FLAGS = {"anchor": "is_triad_anchor", "partner1": "is_triad_partner1", "partner2": "is_triad_partner2"}


@dataclass(frozen=True)
class TriadSearch:
    """What to look for. Without all three types, every ordered trio of distinct types."""

    radius_um: float
    um_per_px: float = 1.0
    anchor: str | None = None
    partner1: str | None = None
    partner2: str | None = None
    anchor_names: dict[str, str] = field(default_factory=dict)
    partner1_names: dict[str, str] = field(default_factory=dict)
    partner2_names: dict[str, str] = field(default_factory=dict)
    min_triads: int = 1
    square_cells: int = SQUARE_CELLS

    @property
    def radius_px(self) -> float:
        return self.radius_um / self.um_per_px

    @property
    def typed(self) -> bool:
        return bool(self.anchor and self.partner1 and self.partner2)

    def label(self, a: Column, p1: Column, p2: Column) -> Column:
        return combo_label(a, p1, p2, self.anchor_names, self.partner1_names, self.partner2_names)

    def role_types(self) -> dict[str, str]:
        return {"anchor": self.anchor, "partner1": self.partner1, "partner2": self.partner2}


def _of_type(cells: DataFrame, cell_type: str | None) -> DataFrame:
    kind = F.col("cell_type")
    return cells.where(kind.isNotNull() if cell_type is None else kind == cell_type)


def anchor_counts(cells: DataFrame, search: TriadSearch) -> DataFrame:
    """n_p1_neighbors and n_p2_neighbors of every anchor that has both, at the search radius."""
    counts = neighbor_counts(
        _of_type(cells, search.anchor), cells, search.radius_px,
        {"n_p1_neighbors": search.partner1, "n_p2_neighbors": search.partner2}, search.square_cells,
        cells, (search.anchor,))
    # Two partners of one type have to be two cells.
    enough = 1 if search.partner1 != search.partner2 else 2
    return counts.where((F.col("n_p1_neighbors") >= enough) & (F.col("n_p2_neighbors") >= enough))


def _per_image(per_anchor: DataFrame, search: TriadSearch) -> DataFrame:
    pairs = F.col("n_p1_neighbors") * (
        F.col("n_p2_neighbors") if search.partner1 != search.partner2 else F.col("n_p2_neighbors") - 1)
    return (per_anchor.groupBy("image_id").agg(F.sum(pairs).alias("n_triads"))
            .select("image_id", F.lit(search.anchor).alias("anchor_type"),
                    F.lit(search.partner1).alias("partner1_type"),
                    F.lit(search.partner2).alias("partner2_type"), "n_triads"))


def triad_counts(cells: DataFrame, search: TriadSearch) -> DataFrame:
    """Triads per image and trio of types, from neighbour counts alone: no triad is built."""
    if search.typed:
        counts = _per_image(anchor_counts(cells, search), search)
    else:
        known = _of_type(cells, None)
        own = known.select("image_id", F.col("cell_id").alias("anchor_cell_id"),
                           F.col("cell_type").alias("anchor_type"))
        per_type = (type_counts(known, known, search.radius_px, search.square_cells)
                    .join(own, ["image_id", "anchor_cell_id"])
                    .where("neighbor_type <> anchor_type"))
        # Few rows per anchor: one for each type it can see.
        seen = (per_type.groupBy("image_id", "anchor_cell_id", "anchor_type")
                .agg(F.collect_list(F.struct("neighbor_type", "n")).alias("seen")))
        first = seen.select("image_id", "anchor_type", "seen", F.explode("seen").alias("p1"))
        both = first.select("image_id", "anchor_type", "p1", F.explode("seen").alias("p2"))
        counts = (both.where("p1.neighbor_type <> p2.neighbor_type")
                  .groupBy("image_id", "anchor_type", F.col("p1.neighbor_type").alias("partner1_type"),
                           F.col("p2.neighbor_type").alias("partner2_type"))
                  .agg(F.sum(F.col("p1.n") * F.col("p2.n")).alias("n_triads")))
    return counts.where(F.col("n_triads") >= search.min_triads)


def find_triads(cells: DataFrame, search: TriadSearch, with_counts: bool = True) -> DataFrame:
    """One row per triad. Partners differ in role, so equal types give both orders.

    ``with_counts`` adds the neighbour counts; it also drops anchors that lack a partner
    before the triads are built.
    """
    def side(prefix: str, cell_type: str | None, more: tuple[str, ...] = ()) -> Side:
        return Side(_of_type(cells, cell_type), prefix, ("cell_type", *more), cells, (cell_type,) if cell_type else ())

    a = side("anchor", search.anchor, ("condition",))
    p1, p2 = side("partner1", search.partner1), side("partner2", search.partner2)
    also = [None, None]
    counted = with_counts and search.typed
    if counted:
        per_anchor = anchor_counts(cells, search).withColumnRenamed("anchor_cell_id", "cell_id")
        a = Side(a.cells.join(per_anchor, ["image_id", "cell_id"]), "anchor",
                 (*a.extra, "n_p1_neighbors", "n_p2_neighbors"), cells, (search.anchor,))
    if not search.typed:
        types = [F.col(f"{s}_cell_type") for s in ("anchor", "partner1", "partner2")]
        also = [types[1] != types[0], (types[2] != types[0]) & (types[2] != types[1])]
    met = meet(a, [p1, p2], search.radius_px, also, limit=search.square_cells)
    if with_counts and not search.typed:
        counts = type_counts(a.cells, a.cells, search.radius_px, search.square_cells)
        for n, role in ((1, "partner1"), (2, "partner2")):
            met = met.join(counts.select("image_id", "anchor_cell_id",
                                         F.col("neighbor_type").alias(f"{role}_cell_type"),
                                         F.col("n").alias(f"anchor_n_p{n}_neighbors")),
                           ["image_id", "anchor_cell_id", f"{role}_cell_type"])

    def between(s: str, t: str) -> Column:
        return distance_um(F.col(s + "_x"), F.col(s + "_y"), F.col(t + "_x"), F.col(t + "_y"), search.um_per_px)

    kinds = [F.col(f"{s}_cell_type") for s in ("anchor", "partner1", "partner2")]
    counts_out = [F.col(f"anchor_n_p{n}_neighbors").alias(f"n_p{n}_neighbors") for n in (1, 2)] if with_counts else []
    triads = met.select(
        "image_id", F.col("anchor_condition").alias("condition"),
        "anchor_cell_id", "anchor_x", "anchor_y", kinds[0].alias("anchor_type"),
        "partner1_cell_id", "partner1_x", "partner1_y", kinds[1].alias("partner1_type"),
        "partner2_cell_id", "partner2_x", "partner2_y", kinds[2].alias("partner2_type"),
        between("anchor", "partner1").alias("dist_anchor_p1_um"),
        between("anchor", "partner2").alias("dist_anchor_p2_um"),
        between("partner1", "partner2").alias("dist_p1_p2_um"),
        search.label(*kinds).alias("triad_combo_label"), *counts_out)
    if search.min_triads > 1:
        kept = materialize(triad_counts(cells, search).select("image_id", *TYPES))
        triads = triads.join(kept, ["image_id", *TYPES], "left_semi")
    return triads


def report_radius_filter(triads: DataFrame, report_radius_um: float) -> DataFrame:
    """Triads whose two anchor distances are within the report radius."""
    return triads.where(max_anchor_distance(F.col("dist_anchor_p1_um"), F.col("dist_anchor_p2_um"))
                        <= report_radius_um)


def triad_summary(triads: DataFrame, search: TriadSearch) -> DataFrame:
    """One row per image and trio of types: triads and mean distances."""
    return (triads.groupBy("image_id", "condition", *TYPES, F.col("triad_combo_label").alias("combo_label"))
            .agg(F.count(F.lit(1)).alias("n_triads"),
                 *[F.round(F.avg(d), 3).alias("mean_" + d) for d in DISTANCES])
            .withColumns({"radius_um": F.lit(float(search.radius_um)),
                          "radius_px": F.lit(round(search.radius_px, 3))}))


def _roles(triads: DataFrame) -> DataFrame:
    members = F.explode(F.array(*[
        F.struct(F.lit(role).alias("role"), F.col(f"{role}_cell_id").alias("cell_id")) for role in ROLE_FLAGS]))
    return triads.select("image_id", members.alias("m")).select("image_id", "m.role", "m.cell_id")


def triad_members(triads: DataFrame) -> DataFrame:
    """Distinct cells that take part in any triad."""
    return _roles(triads).select("image_id", "cell_id").distinct()


def _flagged(cells: DataFrame, roles: DataFrame, include_zero_images: bool) -> DataFrame:
    # Written once: the images and the flags are both read from it.
    per_cell = materialize(roles.groupBy("image_id", "cell_id").agg(*[
        F.bool_or(F.col("role") == role).alias(flag) for role, flag in ROLE_FLAGS.items()]))
    flags = [F.coalesce(F.col(f), F.lit(False)) for f in ROLE_FLAGS.values()]
    if not include_zero_images:
        images = per_cell.select("image_id").distinct()
        cells = cells.join(images, "image_id", "left_semi")
    return (cells.join(per_cell, ["image_id", "cell_id"], "left")
            .withColumns(dict(zip(ROLE_FLAGS.values(), flags)))
            .withColumn("in_any_triad", F.col("is_triad_anchor") | F.col("is_triad_partner1")
                        | F.col("is_triad_partner2")))


def flags_from_triads(cells: DataFrame, triads: DataFrame, include_zero_images: bool = False) -> DataFrame:
    """Role flags of every cell, from a triad table. Images without triads are left out."""
    return _flagged(cells, _roles(triads), include_zero_images)


def flag_cells(cells: DataFrame, search: TriadSearch, include_zero_images: bool = False) -> DataFrame:
    """The same flags straight from neighbour pairs: cells in triads, without building any.

    An anchor with both kinds of partner is in a triad, and so is each partner near it.
    """
    if not search.typed:
        return flags_from_triads(cells, find_triads(cells, search, with_counts=False), include_zero_images)
    kinds = tuple({search.partner1: None, search.partner2: None})
    partners = cells.where(F.col("cell_type").isin(*kinds))
    anchor = Side(_of_type(cells, search.anchor), "anchor", (), cells, (search.anchor,))
    neighbor = Side(partners, "neighbor", ("cell_type",), cells, kinds)
    edge = search.radius_px * SIDE_IN_RADII
    crowded = crowded_blocks(anchor, [neighbor], search.radius_px, edge, search.square_cells)
    if crowded is None and search.min_triads <= 1 and search.partner1 != search.partner2:
        return _flagged(cells, _roles_of_pairs(anchor, neighbor, search, edge), include_zero_images)
    counted = materialize(anchor_counts(cells, search))
    valid = counted.select("image_id", F.col("anchor_cell_id").alias("cell_id"))
    if search.min_triads > 1:
        kept = _per_image(counted, search).where(F.col("n_triads") >= search.min_triads).select("image_id")
        valid = valid.join(kept, "image_id", "left_semi")
    anchors = anchor.cells.join(valid, ["image_id", "cell_id"], "left_semi")
    near = meet(Side(anchors, "anchor", (), cells, (search.anchor,)), [neighbor], search.radius_px, limit=search.square_cells)
    roles = valid.select("image_id", F.lit("anchor").alias("role"), "cell_id")
    for role in ("partner1", "partner2"):
        roles = roles.unionByName(
            near.where(F.col("neighbor_cell_type") == search.role_types()[role])
            .select("image_id", F.lit(role).alias("role"), F.col("neighbor_cell_id").alias("cell_id")))
    return _flagged(cells, roles, include_zero_images)


def _roles_of_pairs(anchor: Side, neighbor: Side, search: TriadSearch, edge: float) -> DataFrame:
    """(image_id, role, cell_id) of all cells in triads, from one search for neighbours.

    Without crowded squares an anchor has a bounded number of neighbours. They are gathered
    on the join's own key, and given out again where both kinds of partner are there.
    """
    pairs = pairs_on_squares(anchor, neighbor, search.radius_px, edge)
    near = {role: F.collect_set(F.when(F.col("neighbor_cell_type") == search.role_types()[role], F.col("neighbor_cell_id")))
            for role in ("partner1", "partner2")}
    met = (pairs.groupBy(*SQUARE_KEY, "anchor_cell_id").agg(near["partner1"].alias("partner1"), near["partner2"].alias("partner2"))
           .where((F.size("partner1") > 0) & (F.size("partner2") > 0)))

    def named(role: str, ids: Column) -> Column:
        return F.transform(ids, lambda i: F.struct(F.lit(role).alias("role"), i.alias("cell_id")))

    members = F.concat(named("anchor", F.array("anchor_cell_id")), named("partner1", F.col("partner1")), named("partner2", F.col("partner2")))
    return met.select("image_id", F.explode(members).alias("m")).select("image_id", "m.role", "m.cell_id")


def outside_triads(cells: DataFrame, triads: DataFrame) -> DataFrame:
    """Background cells: those in no triad."""
    return cells.join(triad_members(triads), ["image_id", "cell_id"], "left_anti")


def condition_areas(areas: DataFrame) -> DataFrame:
    """Area per condition, summed over time points where there are several."""
    return areas.groupBy("condition").agg(F.sum("area_um2").alias("area_um2"))


def condition_density(summary: DataFrame, areas: DataFrame, conditions: list[str]) -> DataFrame:
    """Triads and triads per mm2 by condition and combination; null without an area.

    ``areas`` has one row per configured condition, as ``conditions`` does.
    """
    totals = (summary.where(F.col("condition").isin(*conditions))
              .groupBy("condition", "combo_label").agg(F.sum("n_triads").alias("n_triads")))
    known = areas.where(F.col("condition").isin(*conditions))
    return (totals.join(known, "condition", "left")
            .select("condition", "combo_label", "n_triads", (F.col("area_um2") / 1e6).alias("area_mm2"))
            .withColumn("triads_per_mm2", F.try_divide(F.col("n_triads"), F.col("area_mm2"))))


def fill_conditions(density: DataFrame, conditions: list[str]) -> DataFrame:
    """Every configured condition for every combination seen, zero where there is no triad."""
    every = (density.select("combo_label").distinct()
             .withColumn("condition", F.explode(F.array(*[F.lit(c) for c in conditions]))))
    return (every.join(density, ["condition", "combo_label"], "left")
            .select("condition", "combo_label",
                    F.coalesce("n_triads", F.lit(0)).alias("n_triads"),
                    F.coalesce("triads_per_mm2", F.lit(0.0)).alias("triads_per_mm2")))


def distance_summary(triads: DataFrame, conditions: list[str]) -> DataFrame:
    """Mean, sample deviation, standard error and count of each distance per condition."""
    stats = []
    for d in DISTANCES:
        deviation = F.stddev_samp(d)
        stats += [F.round(F.avg(d), 3).alias(d + "__mean"),
                  F.round(deviation, 3).alias(d + "__std"),
                  F.round(deviation / F.sqrt(F.count(d)), 3).alias(d + "__sem"),
                  F.count(d).alias(d + "__count")]
    return triads.where(F.col("condition").isin(*conditions)).groupBy("condition").agg(*stats)


def top_combos(summary: DataFrame, n: int = 20) -> DataFrame:
    """Combinations by total triads, label order on ties."""
    return (summary.groupBy("combo_label").agg(F.sum("n_triads").alias("n_triads"))
            .orderBy(F.desc("n_triads"), "combo_label").limit(n))


def top_combo_per_image(summary: DataFrame) -> DataFrame:
    """The combination with most triads in each image, first by types on ties."""
    best = F.min(F.struct((-F.col("n_triads")).alias("order"), *TYPES, "combo_label"))
    return (summary.groupBy("image_id").agg(best.alias("best"))
            .select("image_id", "best.combo_label", (-F.col("best.order")).alias("n_triads")))


def trajectory(triads: DataFrame, areas: DataFrame, conditions: list[str], radius_um: float,
               min_um: float = 0.0, points: int = TRAJECTORY_POINTS) -> DataFrame:
    """Cumulative triads and triads per mm2 at evenly spaced distance thresholds.

    Each triad is put at its first threshold, so one grouped count and a running total over
    the points replace a pass per threshold.
    """
    span = float(radius_um) - float(min_um)
    step = span / (points - 1)

    def at(i: Column) -> Column:
        return F.when(i >= points - 1, F.lit(float(radius_um))).otherwise(F.lit(float(min_um)) + i * F.lit(step))

    distance = max_anchor_distance(F.col("dist_anchor_p1_um"), F.col("dist_anchor_p2_um"))
    guess = F.greatest(F.ceil((F.col("d") - F.lit(float(min_um))) / F.lit(step)), F.lit(0))
    first = (F.when((F.col("g") > 0) & (F.col("d") <= at(F.col("g") - 1)), F.col("g") - 1)
             .when(F.col("d") > at(F.col("g")), F.col("g") + 1).otherwise(F.col("g")))
    placed = (triads.where(F.col("condition").isin(*conditions))
              .select("condition", distance.alias("d")).withColumn("g", guess)
              .groupBy("condition", first.alias("point")).agg(F.count(F.lit(1)).alias("here")))
    every = (placed.select("condition").distinct()
             .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))))
    so_far = Window.partitionBy("condition").orderBy("point")
    known = areas.where(F.col("condition").isin(*conditions))
    area = F.col("area_um2") / 1e6
    return (every.join(placed, ["condition", "point"], "left")
            .withColumn("n_triads", F.sum(F.coalesce("here", F.lit(0))).over(so_far))
            .join(known, "condition", "left")
            .select("condition", "point", at(F.col("point")).alias("threshold_um"), "n_triads",
                    F.when(area > 0, F.col("n_triads") / area).otherwise(0.0).alias("triads_per_mm2")))


def distinct_types(cells: DataFrame) -> DataFrame:
    """Known cell types of each image, in name order."""
    return (cells.where("cell_type is not null").select("image_id", "cell_type").distinct()
            .groupBy("image_id")
            .agg(F.array_sort(F.collect_list("cell_type")).alias("cell_types"),
                 F.count(F.lit(1)).alias("n_types")))


def core_bbox_area(cells: DataFrame, um_per_px: float) -> DataFrame:
    """Box around each image's cells in um2: an estimate of its area."""
    return cells.groupBy("image_id").agg(
        ((F.max("x") - F.min("x")) * (F.max("y") - F.min("y")) * F.lit(um_per_px ** 2)).alias("bbox_um2"))


def condition_area_estimate(cells: DataFrame, um_per_px: float) -> DataFrame:
    """Median core area over all images times the images of each condition."""
    boxes = core_bbox_area(cells, um_per_px).withColumn("all_images", F.lit(0))
    typical = percentiles(boxes, ["all_images"], {"median_um2": ("bbox_um2", 0.5)})
    images = (cells.select("image_id", "condition").distinct()
              .groupBy("condition").agg(F.count(F.lit(1)).alias("n_images")))
    return (images.withColumn("all_images", F.lit(0)).join(F.broadcast(typical), "all_images")
            .select("condition", "n_images", "median_um2",
                    (F.col("n_images") * F.col("median_um2")).alias("area_um2")))
