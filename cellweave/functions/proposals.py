"""Reading cluster label proposals out of free reply text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROPOSAL_TYPE = "map<string, struct<label: string, confidence: string, reason: string>>"


def json_block(text: Column) -> Column:
    """Text from the first opening to the last closing brace; null if there is none."""
    return F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))


def parse_proposals(replies: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """One row per proposed cluster: label, confidence and reason."""
    parsed = F.from_json(json_block(F.col(text)), PROPOSAL_TYPE)
    return (replies
            .select(*keys, F.explode(parsed).alias("cluster", "call"))
            .select(*keys, "cluster", "call.label", "call.confidence", "call.reason"))


def count_low_confidence(proposals: DataFrame, keys: list[str]) -> DataFrame:
    """Proposals and low-confidence ones per reply."""
    return proposals.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_clusters"),
        F.count_if(F.coalesce(F.col("confidence") == "low", F.lit(False))).alias("n_low"))
