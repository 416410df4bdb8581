"""Steps of quality control whose work is to grow no faster than the cells and images."""

from pyspark.sql import functions as F

from cellweave.functions.names import numbered
from cellweave.operators import qc
from cellweave.operators.skew import join_group_stats
from workload import views


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_names_of_numbers_are_those_of_the_format(spark):
    keys = [-1234, -5, 0, 7, 99, 100, 999, 1000, 12345678901, None]
    rows = spark.createDataFrame([(k,) for k in keys], "k bigint")
    assert [tuple(r) for r in rows.select(numbered("reg", F.col("k")), F.format_string("reg%03d", "k")).collect()] == [
        (x, x) for x in ("reg-1234", "reg-05", "reg000", "reg007", "reg099", "reg100", "reg999", "reg1000", "reg12345678901", "regnull")]
    assert "lpad" in plan(views.cells(spark, "/root/testdata/sf0.001")).lower()


def test_values_of_many_images_are_brought_to_their_cells_without_moving_these(spark):
    images = spark.range(25_000).selectExpr("concat('reg', id) AS image_id", "id * 1.5D AS t")
    joined = join_group_stats(spark.range(50_000).selectExpr("concat('reg', id % 25000) AS image_id", "id"), images, ["image_id"])
    assert "strategy=broadcast" in plan(joined)
    assert joined.count() == 50_000


def test_percentiles_of_both_scores_read_a_cell_once(spark, monkeypatch):
    sizes = []
    exact = qc.percentiles
    monkeypatch.setattr(qc, "percentiles", lambda rows, keys, *more: (sizes.append((rows.count(), keys)), exact(rows, keys, *more))[1])
    rows = [(f"reg{k % 3}", float(k % 5), None if k % 3 == 2 and k % 7 else k * k % 101 / 10) for k in range(300)] + [("empty", None, None)]
    cells = spark.createDataFrame(rows, "image_id string, z_count double, z_sum double")
    got = {r.image_id: (r.z_count_cutoff, r.z_sum_cutoff) for r in qc.noise_cutoffs(cells).collect()}
    assert sizes == [(301, ["image_id"])]
    tails = {(r.image_id, r.score): r.p for r in qc.score_rows(cells).groupBy("image_id", "score").agg(F.percentile("value", F.lit(0.99)).alias("p")).collect()}
    # Every knee is under its floor here, so cutoffs are the tails.
    assert got == {i: (tails[i, "z_count"], tails[i, "z_sum"]) for i in ("reg0", "reg1", "reg2")}
