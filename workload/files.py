"""Queries that write files from the given tables to the shared folder, and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.operators import clusters as cl
from cellweave.operators.lineage import owned_folder
from cellweave.sources import tables
from workload.clustering import PANEL, profiles_input
from workload.registry import query
from workload.views import CELLS, CONDITIONS, PATIENTS, cells, patients, table

C = F.col


def folder(spark) -> str:
    return f"{owned_folder(spark)}/files-{uuid.uuid4().hex}"


# Three kinds of files: by column order and panel.
_KINDS = "CASE l_suppkey % 3 WHEN 0 THEN {} WHEN 1 THEN {} ELSE {} END"


@query("scan_cells_files", f"""SELECT printf('%s_reg%03d', CASE WHEN l_suppkey % 2 = 0 THEN 'CLR' ELSE 'DII' END, l_suppkey) AS image_id,
  CASE WHEN l_suppkey % 2 = 0 THEN 'CLR' ELSE 'DII' END AS condition, concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS cell_id,
  CAST(l_partkey AS DOUBLE) AS x, CAST(l_orderkey AS DOUBLE) AS y, l_extendedprice AS area, l_quantity AS dapi,
  {_KINDS.format("l_tax", "l_tax", "NULL")} AS "CD3", {_KINDS.format("l_discount", "l_discount", "NULL")} AS "CD8",
  {_KINDS.format("NULL", "NULL", "l_tax")} AS "CD20" FROM lineitem""")
def scan_cells_files(spark, sf):
    path = folder(spark)
    key = C("l_suppkey")
    base = [F.concat(F.when(key % 2 == 0, "CLR").otherwise("DII"), F.format_string("_reg%03d", key)).alias("image"),
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("cell"), C("l_partkey").alias("x"), C("l_orderkey").alias("y"),
            C("l_extendedprice").alias("area"), C("l_quantity").alias("DAPI")]
    more = ([C("l_tax").alias("CD3"), C("l_discount").alias("CD8")], [C("l_discount").alias("CD8"), C("l_tax").alias("CD3")], [C("l_tax").alias("CD20")])
    lines = table(spark, sf, "lineitem")
    for kind, markers in enumerate(more):
        # The label is a number; the key of the line goes along as a marker of three parts.
        rows = lines.where(key % 3 == kind).select(*base, *markers, *[C(c).alias(f"k_{c}") for c in ("l_orderkey", "l_linenumber", "l_partkey")])
        tables.write_files(rows.withColumn("label", F.lit(1)).drop("cell"), f"{path}/slide {kind}", "image", "_mesmer_result.csv")
    found = tables.scan_cells(spark, path, CONDITIONS)
    parts = [C(f"k_{c}").cast("bigint").cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey")]
    return found.select("image_id", "condition", F.concat_ws("-", *parts).alias("cell_id"), "x", "y", "area", "dapi", "CD3", "CD8", "CD20")


@query("scan_matched_files", """SELECT printf('reg%03d', l_suppkey) AS image_id, CAST(count(*) AS BIGINT) AS n_rows,
  CAST(count(*) AS BIGINT) AS n_ids, CAST(sum(l_partkey) AS DOUBLE) AS sum_x, round(sum(CASE WHEN l_suppkey % 2 = 0 THEN l_tax ELSE l_discount END), 4) AS total
FROM lineitem GROUP BY l_suppkey""")
def scan_matched_files(spark, sf):
    path = folder(spark)
    lines = table(spark, sf, "lineitem")
    base = [F.format_string("reg%03d", "l_suppkey").alias("image"), C("l_partkey").alias("centroid_x"), C("l_suppkey").alias("centroid_y"),
            C("l_returnflag").alias("cell_type")]
    # Without ids, and with a column order and a panel of their own.
    tables.write_files(lines.where("l_suppkey % 2 = 0").select(*base, C("l_tax").alias("taxed")), path, "image", tables.MATCHED_SUFFIX)
    tables.write_files(lines.where("l_suppkey % 2 = 1").select(C("l_discount").alias("discounted"), *reversed(base)), path, "image", tables.MATCHED_SUFFIX)
    found = tables.scan_matched(spark, path, CONDITIONS)
    return found.groupBy("image_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("cell_id").alias("n_ids"), F.sum("x").alias("sum_x"),
        F.round(F.sum(F.coalesce("taxed", "discounted")), 4).alias("total"))


@query("scan_patients_files", f"""WITH {PATIENTS}
SELECT CAST(patient AS BIGINT) AS "Patient", CAST(grp AS INTEGER) AS "Group", CAST(os_censor AS INTEGER) AS "OS_Censor", round(os, 6) AS "OS" FROM patients""")
def scan_patients_files(spark, sf):
    path = folder(spark)
    p = patients(spark, sf)
    numbers = ("Patient", "Group", "OS_Censor", "DFS_Censor")
    p.select(*[C(c).cast("double").alias(c) if c in numbers else C(f"`{c}`") for c in p.columns]).write.option("header", True).csv(path)
    return tables.scan_patients(spark, path).select("Patient", "Group", "OS_Censor", F.round("OS", 6).alias("OS"))


@query("scan_encodings", """SELECT c_custkey, 'é' || c_name || 'ß' AS cell_type, CAST(c_custkey % 1000 AS DOUBLE) AS x, c_nationkey % 2 = 0 AS utf8 FROM customer""")
def scan_encodings(spark, sf):
    # Customers as cells of one image per nation; every other image is written as Latin-1.
    path = folder(spark)
    rows = table(spark, sf, "customer").select(
        "c_nationkey", F.concat(F.lit("n"), C("c_nationkey").cast("string")).alias("image"), C("c_custkey").cast("string").alias("cell_id"),
        (C("c_custkey") % 1000).alias("centroid_x"), F.lit(2).alias("centroid_y"), F.concat(F.lit("é"), "c_name", F.lit("ß")).alias("cell_type"))
    for key, encoding in ((0, "UTF-8"), (1, "ISO-8859-1")):
        tables.write_files(rows.where(C("c_nationkey") % 2 == key).drop("c_nationkey"), path, "image", tables.MATCHED_SUFFIX, encoding)
    status = tables.file_status(spark, path, "*" + tables.MATCHED_SUFFIX).select(
        F.regexp_extract("file_path", r"(n\d+)_matched", 1).alias("image_id"), (C("encoding") == "UTF-8").alias("utf8"))
    found = tables.scan_matched(spark, path, []).select("image_id", C("cell_id").cast("bigint").alias("c_custkey"), "cell_type", "x")
    return found.join(status, "image_id").select("c_custkey", "cell_type", "x", "utf8")


@query("sink_per_key", f"""WITH {CELLS} SELECT tissue_id, condition, CAST(count(*) AS BIGINT) AS n, round(sum(area), 2) AS area FROM cells GROUP BY ALL""")
def sink_per_key(spark, sf):
    path = folder(spark)
    tables.write_per_key(cells(spark, sf).select("tissue_id", "condition", "cell_id", "area"), path, ["tissue_id", "condition"])
    back = spark.read.parquet(path)
    return back.groupBy("tissue_id", "condition").agg(F.count("cell_id").alias("n"), F.round(F.sum("area"), 2).alias("area"))


@query("sink_tsv", f"WITH {CELLS} SELECT image_id, cell_id, round(area, 2) AS area, cell_type FROM cells")
def sink_tsv(spark, sf):
    path = folder(spark)
    tables.write_tsv(cells(spark, sf).select("image_id", "cell_id", F.round("area", 2).alias("area"), "cell_type"), path)
    return spark.read.schema("image_id string, cell_id string, area double, cell_type string").option("header", True).option("sep", "\t").csv(path)


@query("sink_summary", f"WITH {CELLS} SELECT image_id, CAST(count(*) AS BIGINT) AS n_cells, round(avg(dapi), 4) AS dapi FROM cells GROUP BY image_id")
def sink_summary(spark, sf):
    path = folder(spark)
    out = cells(spark, sf).groupBy("image_id").agg(F.count(F.lit(1)).alias("n_cells"), F.round(F.avg("dapi"), 4).alias("dapi"))
    tables.write_summary(out, path)
    return spark.read.schema(out.schema).option("header", True).csv(path)


@query("sink_audit_json", """SELECT CAST(label AS VARCHAR) AS cluster, CAST(count(*) AS BIGINT) AS n, 'type ' || CAST(label AS VARCHAR) AS label FROM embeddings GROUP BY label
UNION ALL SELECT 'none', NULL, 'type none'""")
def sink_audit_json(spark, sf):
    path = folder(spark)
    points = profiles_input(spark, sf)
    profiles = cl.cluster_profiles(points, PANEL)
    names = profiles.select("cluster").union(spark.createDataFrame([("none",)], "cluster string"))
    calls = names.select("cluster", F.concat(F.lit("type "), "cluster").alias("label"), F.lit("low").alias("confidence"), F.lit("").alias("reason"))
    tables.write_audit_json(profiles, calls, path)
    shape = "profiles array<struct<cluster:string,n:bigint>>, calls array<struct<cluster:string,label:string>>"
    doc = spark.read.text(path).select(F.from_json("value", shape).alias("d"))
    known = doc.select(F.explode("d.profiles").alias("p")).select("p.cluster", "p.n")
    return doc.select(F.explode("d.calls").alias("c")).select("c.cluster", "c.label").join(known, "cluster", "left").select("cluster", "n", "label")
