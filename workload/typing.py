"""Queries over marker thresholds, positivity and cell types."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from cellweave.operators import composition, markers as mk, mixture, rules
from cellweave.sources.tables import filter_matched
from workload.registry import query
from workload.views import CELLS, MARKERS, cells, table

THRESHOLDS = {"l_quantity": 25.0, "l_extendedprice": 40000.0, "l_discount": 0.05, "l_tax": 0.04}

RULES = rules.parse_rules({
    "big": [{"required": ["l_quantity_pos", "l_extendedprice_pos"], "excluded": ["l_tax_pos"]},
            {"required": ["l_quantity_pos"], "preferred": ["l_extendedprice_pos", "l_discount_pos"],
             "excluded": ["l_tax_pos"]}],
    "cheap": {"required_any": ["l_discount_pos", "l_tax_pos"], "excluded": ["l_extendedprice_pos"],
              "preferred": ["absent_pos"]},
    "taxed": {"required": ["l_tax_pos"], "preferred": ["l_quantity_pos"]},
    "rich": {"required": ["l_extendedprice_pos"]},
})

POSITIVE = f"""pos AS (SELECT *, {", ".join(f"{m} > {t} AS {m}_pos" for m, t in THRESHOLDS.items())} FROM cells)"""


def positive(spark, sf):
    return mk.add_positivity(cells(spark, sf), THRESHOLDS)


@query("filter_matched", f"WITH {CELLS} SELECT image_id, cell_id FROM cells WHERE matched")
def matched(spark, sf):
    return filter_matched(cells(spark, sf)).select("image_id", "cell_id")


@query("positivity", f"""WITH {CELLS}, {POSITIVE}
SELECT image_id, cell_id, {", ".join(f"{m}_pos" for m in THRESHOLDS)} FROM pos""")
def positivity(spark, sf):
    return positive(spark, sf).select("image_id", "cell_id", *[f"{m}_pos" for m in THRESHOLDS])


_CUTS = ", ".join(
    f"quantile_cont({m}, 0.33) FILTER (WHERE {m} > {t}) AS lo_{m}, quantile_cont({m}, 0.66) FILTER (WHERE {m} > {t}) AS hi_{m}"
    for m, t in THRESHOLDS.items())
_LEVELS = ", ".join(
    f"CAST(CASE WHEN {m} <= {t} THEN 0 WHEN {m} <= lo_{m} THEN 1 WHEN {m} <= hi_{m} THEN 2 ELSE 3 END AS TINYINT) AS {m}_intensity"
    for m, t in THRESHOLDS.items())


@query("intensity_level", f"""WITH {CELLS}, cuts AS (SELECT {_CUTS} FROM cells)
SELECT image_id, cell_id, {_LEVELS} FROM cells CROSS JOIN cuts""")
def intensity_level(spark, sf):
    return mk.add_intensity_levels(cells(spark, sf), THRESHOLDS).select(
        "image_id", "cell_id", *[f"{m}_intensity" for m in THRESHOLDS])


@query("gate_positive", f"WITH {CELLS} SELECT image_id, cell_id FROM cells WHERE l_quantity > 25.0")
def gate_positive(spark, sf):
    gated = mk.gate(cells(spark, sf), "l_quantity", THRESHOLDS["l_quantity"])
    return mk.gate(gated, "absent", 1.0).select("image_id", "cell_id")


@query("gate_pass_rate", f"""WITH {CELLS}
SELECT CAST(count_if(l_quantity > 25.0) AS BIGINT) AS n_pass, CAST(count(*) AS BIGINT) AS n_total,
       round(count_if(l_quantity > 25.0) * 100.0 / count(*), 6) AS percent_pass FROM cells""")
def gate_pass_rate(spark, sf):
    return mk.gate_pass_rate(cells(spark, sf), "l_quantity", 25.0).withColumn("percent_pass", F.round("percent_pass", 6))


@query("marker_subset", f"WITH {CELLS} SELECT image_id, cell_id, l_discount, l_tax FROM cells")
def marker_subset(spark, sf):
    c = cells(spark, sf)
    present, missing = mk.panel_markers(c.columns, ["l_discount", "absent", "l_quantity", "l_tax"], ["l_quantity"])
    assert missing == ["absent"]
    return c.select("image_id", "cell_id", *present)


# Scores written out rule by rule; the earlier rule wins on ties.
_SCORES = """CASE WHEN l_quantity_pos AND l_extendedprice_pos AND NOT l_tax_pos THEN 1 ELSE 0 END AS s0,
CASE WHEN l_quantity_pos AND NOT l_tax_pos THEN 2 + CAST(l_extendedprice_pos AS INT) + CAST(l_discount_pos AS INT) ELSE 0 END AS s1,
CASE WHEN (l_discount_pos OR l_tax_pos) AND NOT l_extendedprice_pos THEN 2 ELSE 0 END AS s2,
CASE WHEN l_tax_pos THEN 2 + CAST(l_quantity_pos AS INT) ELSE 0 END AS s3,
CASE WHEN l_extendedprice_pos THEN 1 ELSE 0 END AS s4"""
TYPED = f"""{POSITIVE}, scores AS (SELECT *, {_SCORES} FROM pos),
best AS (SELECT *, greatest(s0, s1, s2, s3, s4) AS top FROM scores),
typed AS (SELECT *, CASE WHEN top = 0 THEN 'Unassigned' WHEN s0 = top THEN 'big' WHEN s1 = top THEN 'big'
  WHEN s2 = top THEN 'cheap' WHEN s3 = top THEN 'taxed' ELSE 'rich' END AS assigned FROM best)"""


def typed(spark, sf):
    p = positive(spark, sf)
    return p.withColumnRenamed("cell_type", "expert").withColumn("cell_type", rules.rule_type(p.columns, RULES))


@query("rule_typing", f"WITH {CELLS}, {TYPED} SELECT image_id, cell_id, assigned AS cell_type FROM typed")
def rule_typing(spark, sf):
    return typed(spark, sf).select("image_id", "cell_id", "cell_type")


_RULE_ROWS = ", ".join(
    f"({i}, '{r.cell_type}', '{m}')" for i, r in enumerate(RULES) for m in r.required)


@query("scan_rules", f"""WITH {CELLS}, {POSITIVE}, need(place, cell_type, needs) AS (VALUES {_RULE_ROWS}),
n AS (SELECT {", ".join(f"count_if({m}_pos) AS {m}_pos" for m in THRESHOLDS)} FROM pos),
long AS (UNPIVOT n ON {", ".join(f"{m}_pos" for m in THRESHOLDS)} INTO NAME needs VALUE n_positive)
SELECT CAST(place AS INTEGER) AS place, cell_type, needs, CAST(n_positive AS BIGINT) AS n_positive FROM need JOIN long USING (needs)""")
def scan_rules(spark, sf):
    """How many cells meet each required marker of each rule."""
    needs = rules.rules_table(spark, RULES).select("place", "cell_type", F.explode("required").alias("needs"))
    flags = positive(spark, sf).select(*[F.col(f"{m}_pos").cast("int").alias(f"{m}_pos") for m in THRESHOLDS])
    n = (mk.unpivot_markers(flags, [], flags.columns).groupBy(F.col("marker").alias("needs"))
         .agg(F.sum("value").cast("bigint").alias("n_positive")))
    return needs.join(n, "needs").select("place", "cell_type", "needs", "n_positive")


@query("label_agreement", f"""WITH {CELLS}, {TYPED}, n AS (SELECT cell_type AS expert, assigned AS automatic, count(*) AS n FROM typed GROUP BY ALL)
SELECT expert, automatic, CAST(n AS BIGINT) AS n, CAST(sum(n) OVER (PARTITION BY expert) AS BIGINT) AS n_expert,
       round(n / sum(n) OVER (PARTITION BY expert), 6) AS share, expert = automatic AS agrees FROM n""")
def label_agreement(spark, sf):
    return rules.label_agreement(typed(spark, sf), "expert", "cell_type").withColumn("share", F.round("share", 6))


@query("celltype_counts", f"""WITH {CELLS}, {TYPED}
SELECT assigned AS cell_type, CAST(count(*) AS BIGINT) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent
FROM typed GROUP BY assigned ORDER BY n DESC, cell_type""")
def celltype_counts(spark, sf):
    return composition.celltype_counts(typed(spark, sf)).withColumn("percent", F.round("percent", 6))


@query("composition_pct", f"""WITH {CELLS}, {TYPED},
n AS (SELECT condition, assigned AS cell_type, count(*) AS n FROM typed GROUP BY ALL),
dims AS (SELECT DISTINCT a.condition, b.cell_type FROM n a CROSS JOIN n b),
f AS (SELECT d.condition, d.cell_type, coalesce(n.n, 0) AS n FROM dims d LEFT JOIN n USING (condition, cell_type))
SELECT condition, cell_type, CAST(n AS BIGINT) AS n, round(n * 100.0 / sum(n) OVER (PARTITION BY condition), 6) AS percent FROM f""")
def composition_pct(spark, sf):
    return composition.composition_percent(typed(spark, sf)).withColumn("percent", F.round("percent", 6))


@query("pivot_composition", f"""WITH {CELLS}
SELECT condition, {", ".join(f'round(count_if(cell_type = {chr(39)}{t}{chr(39)}) * 100.0 / count(*), 6) AS "{t}"' for t in "ANR")}
FROM cells GROUP BY condition""")
def pivot_composition(spark, sf):
    out = composition.composition_table(cells(spark, sf), ["A", "N", "R"])
    return out.select("condition", *[F.round(t, 6).alias(t) for t in "ANR"])


def mixture_sql(tally: str, rounds: int, tolerance: float) -> str:
    """The fit unrolled: each round is one query; a marker that has converged keeps its fit."""
    parts = [f"""tally AS ({tally}),
whole AS (SELECT marker, sum(n) AS total FROM tally GROUP BY marker),
mid AS (SELECT marker, quantile_cont(value, 0.5) AS m FROM long GROUP BY marker),
halves AS (SELECT marker, value > m AS hi, count(*) AS n, avg(value) AS mu, var_pop(value) AS va
           FROM long JOIN mid USING (marker) GROUP BY ALL),
fit_0 AS (SELECT marker, max(n / total) FILTER (WHERE NOT hi) AS w0, max(mu) FILTER (WHERE NOT hi) AS m0,
                 greatest(max(va) FILTER (WHERE NOT hi), 1e-6) AS v0, max(n / total) FILTER (WHERE hi) AS w1,
                 max(mu) FILTER (WHERE hi) AS m1, greatest(max(va) FILTER (WHERE hi), 1e-6) AS v1,
                 CAST(NULL AS DOUBLE) AS ll, FALSE AS done
          FROM halves JOIN whole USING (marker) GROUP BY marker)"""]
    for i in range(1, rounds + 1):
        p = i - 1
        parts.append(f"""d_{i} AS (SELECT t.marker, t.n, t.value - m0 AS o0, t.value - m1 AS o1,
  ln(w0) - ln({2 * math.pi!r} * v0) / 2 - (t.value - m0) * (t.value - m0) / (2 * v0) AS l0,
  ln(w1) - ln({2 * math.pi!r} * v1) / 2 - (t.value - m1) * (t.value - m1) / (2 * v1) AS l1
  FROM tally t JOIN fit_{p} f ON t.marker = f.marker AND NOT f.done),
e_{i} AS (SELECT *, greatest(l0, l1) + ln(exp(l0 - greatest(l0, l1)) + exp(l1 - greatest(l0, l1))) AS ld FROM d_{i}),
s_{i} AS (SELECT marker, sum(n) AS n, sum(n * ld) AS ll, sum(n * exp(l0 - ld)) AS a0, sum(n * exp(l0 - ld) * o0) AS b0,
  sum(n * exp(l0 - ld) * o0 * o0) AS c0, sum(n * exp(l1 - ld)) AS a1, sum(n * exp(l1 - ld) * o1) AS b1,
  sum(n * exp(l1 - ld) * o1 * o1) AS c1 FROM e_{i} GROUP BY marker),
fit_{i} AS MATERIALIZED (SELECT f.marker, CASE WHEN done THEN w0 ELSE a0 / n END AS w0, CASE WHEN done THEN m0 ELSE m0 + b0 / a0 END AS m0,
  CASE WHEN done THEN v0 ELSE greatest(c0 / a0 - (b0 / a0) * (b0 / a0), 1e-6) END AS v0,
  CASE WHEN done THEN w1 ELSE a1 / n END AS w1, CASE WHEN done THEN m1 ELSE m1 + b1 / a1 END AS m1,
  CASE WHEN done THEN v1 ELSE greatest(c1 / a1 - (b1 / a1) * (b1 / a1), 1e-6) END AS v1,
  CASE WHEN done THEN f.ll ELSE s.ll / n END AS ll,
  done OR coalesce(abs(s.ll / n - f.ll) < {tolerance}, FALSE) AS done
  FROM fit_{p} f LEFT JOIN s_{i} s ON f.marker = s.marker)""")
    return ",\n".join(parts)


def bimodal(spark, sf):
    """Event values with every third event raised, so the two peaks lie far apart."""
    raised = F.when(F.col("event_id") % 3 == 0, 1000.0).otherwise(0.0)
    return table(spark, sf, "events").select(
        F.col("event_type").alias("marker"), (F.col("value") + raised).alias("value"))


BIMODAL = """long AS (SELECT event_type AS marker, value + 1000 * CAST(event_id % 3 = 0 AS INT) AS value FROM events)"""
_TALLY = "SELECT marker, value, CAST(count(*) AS DOUBLE) AS n FROM long GROUP BY marker, value"
_LONG = " UNION ALL ".join(f"SELECT image_id, cell_id, '{m}' AS marker, {m} AS value FROM cells" for m in MARKERS)
ROUNDS = 12


@query("gmm_threshold", f"""WITH {BIMODAL}, {mixture_sql(_TALLY, ROUNDS, mixture.TOLERANCE)}
SELECT marker, round(least(m0, m1) + 2.0 * sqrt(CASE WHEN m0 <= m1 THEN v0 ELSE v1 END), 4) AS threshold,
       'mixture' AS method FROM fit_{ROUNDS}""")
def gmm_threshold(spark, sf):
    found = mixture.thresholds_from_long(bimodal(spark, sf), {}, 2.0)
    return found.select("marker", F.round("threshold", 4).alias("threshold"), "method")


BY_MARKER = mixture.multipliers(MARKERS, 2.0, {"l_tax": 1.5}, ["l_quantity"], 3.0)


@query("marker_thresholds", f"""WITH {CELLS}, long AS ({_LONG}), {mixture_sql(_TALLY, ROUNDS, mixture.TOLERANCE)}
SELECT marker, round(least(m0, m1) + CASE marker {" ".join(f"WHEN '{m}' THEN {k}" for m, k in BY_MARKER.items())} END
         * sqrt(CASE WHEN m0 <= m1 THEN v0 ELSE v1 END), 3) AS threshold FROM fit_{ROUNDS}""")
def marker_thresholds(spark, sf):
    found = mixture.marker_thresholds(cells(spark, sf), MARKERS, BY_MARKER)
    return found.select("marker", F.round("threshold", 3).alias("threshold"))


@query("threshold_qc", f"""WITH {CELLS}, long AS ({_LONG}),
cut(marker, t) AS (VALUES ('l_quantity', 25.0), ('l_extendedprice', 1e9), ('l_discount', -1.0), ('l_tax', 0.04)),
s AS (SELECT marker, avg(CAST(value > t AS INT)) AS p FROM long JOIN cut USING (marker) GROUP BY marker)
SELECT marker, round(p, 6) AS positive_share,
       CASE WHEN p < 0.01 THEN 'suspect_high' WHEN p > 0.95 THEN 'suspect_low' ELSE 'ok' END AS verdict FROM s""")
def threshold_qc(spark, sf):
    cuts = {"l_quantity": 25.0, "l_extendedprice": 1e9, "l_discount": -1.0, "l_tax": 0.04}
    return mk.threshold_check(cells(spark, sf), cuts).withColumn("positive_share", F.round("positive_share", 6))


@query("sample_cap", f"""WITH {CELLS}, long AS ({_LONG})
SELECT image_id, cell_id, marker, value FROM long
QUALIFY row_number() OVER (PARTITION BY marker ORDER BY md5(concat_ws('|', image_id, cell_id, '42')), image_id, cell_id) <= 5000""")
def sample_cap(spark, sf):
    long = mk.unpivot_markers(cells(spark, sf), ["image_id", "cell_id"], MARKERS)
    return mixture.sample_cells(long, ["image_id", "cell_id"], 5000)
