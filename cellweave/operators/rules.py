"""Cell types from declarative rules over positivity columns."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.schema import UNASSIGNED, col


@dataclass(frozen=True)
class Rule:
    """One way to be of a cell type; lists hold names of boolean columns."""

    cell_type: str
    required: tuple[str, ...] = ()
    required_any: tuple[str, ...] = ()
    preferred: tuple[str, ...] = ()
    excluded: tuple[str, ...] = ()


def parse_rules(definitions: dict) -> list[Rule]:
    """Rules in file order from {cell type: rule or list of rules}."""
    definitions = definitions.get("cell_type_definitions", definitions)
    parts = ("required", "required_any", "preferred", "excluded")
    return [
        Rule(cell_type, **{p: tuple(rule.get(p) or ()) for p in parts})
        for cell_type, rules in definitions.items()
        for rule in ([rules] if isinstance(rules, dict) else rules)]


def load_document(path: str) -> dict:
    """A small JSON or YAML file; YAML only where its reader is installed."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        return json.loads(text) or {}
    try:
        import yaml
    except ImportError as e:
        raise ImportError("reading YAML needs the yaml package; JSON works without it") from e
    return yaml.safe_load(text) or {}


def load_rules(path: str) -> list[Rule]:
    return parse_rules(load_document(path))


def load_cluster_labels(path: str) -> dict[str, str] | None:
    """Labels by cluster id as text; None where the file holds none."""
    labels = load_document(path).get("cluster_labels") or {}
    return {str(k): v for k, v in labels.items()} or None


def _score(rule: Rule, has) -> tuple[Column, Column]:
    """Whether the rule passes, and its score if so."""
    tests = [has(c) for c in rule.required] + [~has(c) for c in rule.excluded]
    if rule.required_any:
        tests.append(reduce(lambda a, b: a | b, [has(c) for c in rule.required_any]))
    passes = reduce(lambda a, b: a & b, tests, F.lit(True))
    if not rule.preferred:
        return passes, F.lit(1)
    return passes, reduce(lambda a, b: a + b, [has(c).cast("int") for c in rule.preferred], F.lit(2))


def rule_type(columns: list[str], rules: list[Rule]) -> Column:
    """Type of the best scoring rule; the earlier rule on ties, Unassigned without any.

    Score and file order are packed into one number, so the whole rule set is a single
    ``greatest`` over integers and one lookup of the winner's name.
    """
    present = set(columns)

    def has(name: str) -> Column:
        return F.coalesce(col(name).cast("boolean"), F.lit(False)) if name in present else F.lit(False)

    n = len(rules)
    if not n:
        return F.lit(UNASSIGNED)
    packed = [F.lit(-1)]
    for place, rule in enumerate(rules):
        passes, score = _score(rule, has)
        packed.append(F.when(passes, score * n + (n - 1 - place)).otherwise(-1))
    best = F.greatest(*packed)
    names = F.array(*[F.lit(r.cell_type) for r in rules])
    return F.when(best < 0, UNASSIGNED).otherwise(F.element_at(names, (n - best % n).cast("int")))


def assign_types(cells: DataFrame, rules: list[Rule]) -> DataFrame:
    return cells.withColumn("cell_type", rule_type(cells.columns, rules))


def rules_table(spark, rules: list[Rule]) -> DataFrame:
    """The rules as rows, in file order."""
    return spark.createDataFrame(
        [(i, r.cell_type, list(r.required), list(r.required_any), list(r.preferred), list(r.excluded))
         for i, r in enumerate(rules)],
        "place int, cell_type string, required array<string>, required_any array<string>, "
        "preferred array<string>, excluded array<string>")


def label_agreement(cells: DataFrame, expert: str, automatic: str) -> DataFrame:
    """Crosstab of two labelings in long form, with each expert type's recall of a label."""
    known = cells.where(col(expert).isNotNull())
    counts = known.groupBy(col(expert).alias("expert"), col(automatic).alias("automatic")).agg(
        F.count(F.lit(1)).alias("n"))
    # One row per pair of types from here on.
    totals = counts.groupBy("expert").agg(F.sum("n").alias("n_expert"))
    return (counts.join(totals, "expert")
            .withColumn("share", F.col("n") / F.col("n_expert"))
            .withColumn("agrees", F.col("expert") == F.col("automatic")))
