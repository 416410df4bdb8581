"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from workload import REGISTRY  # noqa: E402

HEADLINE = [
    "triad_summary", "radius_join", "triad_counts_all", "triad_flags", "triad_trajectory",
    "qc_filter", "zscore_norm", "noise_filter", "rule_typing", "marker_thresholds",
    "test_in_vs_out", "logrank", "region_features", "roi_assign", "knn_graph",
    "neighbour_enrichment", "dense_structures", "cox_regression", "region_outlines",
    "roi_mask_assign", "graph_clusters",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.driver.memory", "12g")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    # Start the workers and the code generator outside the timed part.
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in names:
        begin = time.perf_counter()
        REGISTRY[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
