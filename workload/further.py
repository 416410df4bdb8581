"""Queries on neighbouring types, dense structures and hazards."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.operators import enrichment, hazards, structures, survival as sv
from workload.patients import OUTCOMES
from workload.registry import query
from workload.views import RADIUS, cells, patients, table

PERMUTATIONS = 99
MIN_CELLS = 6


# The three have no SQL: keyed permutations, density clusters and Newton steps are held against brute force in the tests.
@query("neighbour_enrichment")
def neighbour_enrichment(spark, sf):
    found = enrichment.neighbour_enrichment(cells(spark, sf), RADIUS, PERMUTATIONS)
    return found.select("condition", "anchor_type", "neighbor_type", "observed", *[F.round(c, 6).alias(c) for c in ("expected", "spread", "z", "p_more", "p_less")])


@query("dense_structures")
def dense_structures(spark, sf):
    found = structures.structures(cells(spark, sf), RADIUS, MIN_CELLS, min_size=10, required=("A", "N"))
    return found.select("image_id", "structure", "n_cells", "n_core", "n_types", *[F.round(c, 4).alias(c) for c in ("center_x", "center_y", "hull_area")])


@query("cox_regression")
def cox_regression(spark, sf):
    balance = table(spark, sf, "customer").select(F.col("c_custkey").alias("Patient"), (F.col("c_acctbal").cast("double") / 1000).alias("balance"))
    known = patients(spark, sf).join(balance, "Patient").withColumn("second_group", (F.col("Group") == 2).cast("int"))
    entries = sv.survival_rows(known.withColumn("as_group", F.to_json(F.struct("second_group", "balance"))), OUTCOMES, "as_group")
    rows = entries.select("outcome", "duration", "event", F.from_json("grp", "second_group int, balance double").alias("c")).select("outcome", "duration", "event", "c.*")
    found = hazards.cox(rows, ["second_group", "balance"])
    return found.select("outcome", "covariate", *[F.round(c, 6).alias(c) for c in ("coef", "hazard_ratio", "se", "z", "p", "loglik")], "n", "n_events", "converged")
