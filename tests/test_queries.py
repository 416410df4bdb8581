"""Registered queries against their SQL. All of them with CELLWEAVE_ALL_QUERIES=1."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from workload import REGISTRY

SF_DIR = "/root/testdata/sf0.01"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
QUICK = [
    "detect_condition", "tissue_id", "slide_id", "spot_list", "radius_join", "triad_summary", "triad_counts_all",
    "triad_trajectory", "distance_summary", "qc_filter", "noise_cutoffs", "qc_counts", "marker_range", "intensity_level",
    "rule_typing", "composition_pct", "gmm_threshold", "sample_cap", "mann_whitney", "test_between_conditions",
    "patient_density", "km_curve", "logrank", "cluster_profile", "knn_graph", "scan_cells", "scan_channel_meta",
    "roi_assign", "roi_mask_assign", "region_features", "region_outlines", "dq_report",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def plain(value):
    if value is None or isinstance(value, (str, bool)):
        return value
    return "nan" if math.isnan(value) else float(value) + 0.0


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", [n for n in REGISTRY if REGISTRY[n].sql] if os.environ.get("CELLWEAVE_ALL_QUERIES") else QUICK)
def test_query_matches_sql(spark, duck, name):
    got = REGISTRY[name].build(spark, SF_DIR)
    want = duck.execute(REGISTRY[name].sql)
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows_of(got.columns, got.collect()) == rows_of(columns, want.fetchall())


def test_entry_functions(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


def test_the_report_counts_triads_once(spark, monkeypatch):
    from workload import quality
    count, asked = quality.short_summary, []
    monkeypatch.setattr(quality, "short_summary", lambda *a: asked.append(1) or count(*a))
    stored = []
    monkeypatch.setattr(quality.dq, "check_triads", lambda summary, *more, check=quality.dq.check_triads: stored.append(summary) or check(summary, *more))
    rows = quality.dq_report(spark, "/root/testdata/sf0.001").collect()
    assert len(asked) == 1 and all(s.is_stage for s in stored) and len(rows) == 5
