"""The given tables seen as cells, patients, regions and documents.

Every view comes as a DataFrame and as SQL; both use the same whole-number arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.functions.names import numbered
from cellweave.sources.tables import spread

CONDITIONS = ["CLR", "DII"]
MARKERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
RADIUS = 30.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as cells: a supplier is an image, the return flag a cell type."""
    c = F.col
    return spread(table(spark, sf_dir, "lineitem")).select(
        numbered("reg", c("l_suppkey")).alias("image_id"),
        F.when(c("l_suppkey") % 2 == 0, "CLR").otherwise("DII").alias("condition"),
        F.concat(F.lit("core"), (c("l_suppkey") % 7).cast("string")).alias("tissue_id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("cell_id"),
        ((c("l_orderkey") * 37 + c("l_linenumber") * 11) % 1000).alias("x"),
        ((c("l_partkey") * 53 + c("l_orderkey") * 7) % 1000).alias("y"),
        c("l_extendedprice").alias("area"), c("l_quantity").alias("dapi"),
        c("l_returnflag").alias("cell_type"), (c("l_linestatus") == "O").alias("matched"),
        *MARKERS)


CELLS = """cells AS (
  SELECT printf('reg%03d', l_suppkey) AS image_id,
         CASE WHEN l_suppkey % 2 = 0 THEN 'CLR' ELSE 'DII' END AS condition,
         'core' || CAST(l_suppkey % 7 AS VARCHAR) AS tissue_id,
         concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS cell_id,
         (l_orderkey * 37 + l_linenumber * 11) % 1000 AS x,
         (l_partkey * 53 + l_orderkey * 7) % 1000 AS y,
         l_extendedprice AS area, l_quantity AS dapi,
         l_returnflag AS cell_type, l_linestatus = 'O' AS matched,
         l_quantity, l_extendedprice, l_discount, l_tax
  FROM lineitem)"""


def pairs_sql(radius: float = RADIUS, name: str = "pairs", where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT a.image_id, a.condition, a.cell_id AS anchor_id, a.cell_type AS anchor_type, a.x AS ax, a.y AS ay,
         b.cell_id AS other_id, b.cell_type AS other_type, b.x AS ox, b.y AS oy,
         sqrt(CAST((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS DOUBLE)) AS dist
  FROM cells a JOIN cells b ON a.image_id = b.image_id AND a.cell_id <> b.cell_id
   AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {radius * radius}
  WHERE {where})"""


def triads_sql(radius: float = RADIUS, name: str = "triads") -> str:
    return pairs_sql(radius, name + "_pairs", "a.cell_type = 'A'") + f""",
{name} AS (
  SELECT p.image_id, p.condition, p.anchor_id, p.other_id AS p1_id, q.other_id AS p2_id,
         p.dist AS d1, q.dist AS d2,
         sqrt(CAST((p.ox - q.ox) * (p.ox - q.ox) + (p.oy - q.oy) * (p.oy - q.oy) AS DOUBLE)) AS d12
  FROM {name}_pairs p JOIN {name}_pairs q ON p.image_id = q.image_id AND p.anchor_id = q.anchor_id
  WHERE p.other_type = 'N' AND q.other_type = 'R')"""


def summary_sql(radius: float = RADIUS) -> str:
    return triads_sql(radius) + """,
summary AS (
  SELECT image_id, condition, 'A__N__R' AS combo_label, CAST(count(*) AS BIGINT) AS n_triads
  FROM triads GROUP BY ALL)"""


def erfc_sql(x: str) -> str:
    """Complement of the error function by numerical integration: Simpson's rule on [x, x + 8], 400 steps."""
    return (f"(CASE WHEN {x} > 20 THEN 0.0 ELSE 2 / sqrt(pi()) * (8.0 / 1200) * list_sum(list_transform(range(0, 401), lambda i: "
            f"(CASE WHEN i = 0 OR i = 400 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * exp(-pow({x} + i * 0.02, 2)))) END)")


def stars_sql(p: str) -> str:
    return f"CASE WHEN {p} < 0.001 THEN '***' WHEN {p} < 0.01 THEN '**' WHEN {p} < 0.05 THEN '*' ELSE 'ns' END"


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Condition areas by time point: the suppliers' balance digits stand in for areas."""
    s = table(spark, sf_dir, "supplier")
    return s.groupBy(F.when(F.col("s_suppkey") % 2 == 0, "CLR").otherwise("DII").alias("condition"),
                     (F.col("s_suppkey") % 3).alias("timepoint")).agg(
        (F.count(F.lit(1)) * 1168128).cast("double").alias("area_um2"))


AREAS = """areas AS (
  SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'CLR' ELSE 'DII' END AS condition, s_suppkey % 3 AS timepoint,
         CAST(count(*) * 1168128 AS DOUBLE) AS area_um2
  FROM supplier GROUP BY ALL),
flat_areas AS (SELECT condition, sum(area_um2) AS area_um2 FROM areas GROUP BY condition)"""


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as patients with spot lists, and the first order as their follow-up."""
    c = F.col
    n = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1)).alias("n_spots")).withColumn("k", F.lit(0))
    first = (table(spark, sf_dir, "orders").groupBy("o_custkey")
             .agg(F.min_by(F.struct("o_orderdate", "o_orderstatus"), "o_orderkey").alias("o")))
    os_months = F.datediff(F.lit("2002-01-01").cast("date"), c("o.o_orderdate").cast("date")) / F.lit(30.0)
    censor = F.when(c("o.o_orderstatus") == "F", 0).otherwise(1)
    return (table(spark, sf_dir, "customer").withColumn("k", F.lit(0)).join(F.broadcast(n), "k")
            .join(first, c("c_custkey") == c("o_custkey"), "left")
            .select(c("c_custkey").alias("Patient"), (c("c_nationkey") % 2 + 1).alias("Group"),
                    F.concat((c("c_custkey") % c("n_spots")).cast("string"), F.lit(" , "),
                             ((c("c_custkey") * 7 + 3) % c("n_spots")).cast("string")).alias("TMA spot / region"),
                    F.when(c("o").isNotNull(), os_months).alias("OS"),
                    F.when(c("o").isNotNull(), censor).alias("OS_Censor"),
                    F.when(c("o").isNotNull(), os_months * (c("c_custkey") % 3 + 1) / F.lit(4.0)).alias("DFS"),
                    F.when(c("o").isNotNull(), censor).alias("DFS_Censor")))


PATIENTS = """first_orders AS (
  SELECT o_custkey, arg_min(o_orderdate, o_orderkey) AS od, arg_min(o_orderstatus, o_orderkey) AS st
  FROM orders GROUP BY o_custkey),
spot_count AS (SELECT count(*) AS n_spots FROM supplier),
patients AS (
  SELECT c_custkey AS patient, c_nationkey % 2 + 1 AS grp,
         c_custkey % n_spots AS spot_1, (c_custkey * 7 + 3) % n_spots AS spot_2,
         date_diff('day', CAST(od AS DATE), DATE '2002-01-01') / CAST(30 AS DOUBLE) AS os,
         CASE WHEN st IS NULL THEN NULL WHEN st = 'F' THEN 0 ELSE 1 END AS os_censor,
         date_diff('day', CAST(od AS DATE), DATE '2002-01-01') / CAST(30 AS DOUBLE)
           * (c_custkey % 3 + 1) / CAST(4 AS DOUBLE) AS dfs,
         CASE WHEN st IS NULL THEN NULL WHEN st = 'F' THEN 0 ELSE 1 END AS dfs_censor
  FROM customer CROSS JOIN spot_count LEFT JOIN first_orders ON c_custkey = o_custkey),
patient_spots AS (
  SELECT patient, spot_1 AS spot FROM patients UNION SELECT patient, spot_2 FROM patients)"""


def image_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as image names, in every form conditions and coordinates are written in."""
    key, tail = F.col("c_custkey"), F.concat(F.lit("S"), F.col("c_custkey").cast("string"))
    forms = [
        F.concat(F.lit("KO_"), tail, F.lit("_x12_y34_masked")),
        F.concat(tail, F.lit("_ko")),
        F.concat(F.lit("a_WT_"), tail),
        F.concat(F.lit("wt "), tail, F.lit("  b")),
        F.concat(F.lit("xKOx"), tail),
        F.concat(F.lit("KOWT"), tail),
        tail,
        F.concat(F.lit(" WT_"), tail, F.lit("__ ")),
        F.concat(F.lit("reg007_A_KO_"), tail, F.lit("_x1_y2_w3_h4")),
        F.concat(F.lit("WT_PirB_"), tail, F.lit("_2_3_Scan1_x16356_y1375_masked")),
    ]
    name = F.element_at(F.array(*forms), (key % 10 + 1).cast("int"))
    return table(spark, sf_dir, "customer").select(key, name.alias("name"))


IMAGE_NAMES = """names AS (
  SELECT c_custkey, CASE c_custkey % 10
    WHEN 0 THEN 'KO_S' || c_custkey || '_x12_y34_masked'
    WHEN 1 THEN 'S' || c_custkey || '_ko'
    WHEN 2 THEN 'a_WT_S' || c_custkey
    WHEN 3 THEN 'wt S' || c_custkey || '  b'
    WHEN 4 THEN 'xKOxS' || c_custkey
    WHEN 5 THEN 'KOWTS' || c_custkey
    WHEN 6 THEN 'S' || c_custkey
    WHEN 7 THEN ' WT_S' || c_custkey || '__ '
    WHEN 8 THEN 'reg007_A_KO_S' || c_custkey || '_x1_y2_w3_h4'
    ELSE 'WT_PirB_S' || c_custkey || '_2_3_Scan1_x16356_y1375_masked' END AS name
  FROM customer)"""


def rois(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as regions of images; two of three names carry their box, the rest are labelled."""
    c = F.col
    n = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1)).alias("n")).withColumn("k", F.lit(0))
    box = {"bx": c("c_custkey") * 13 % 900, "by": c("c_custkey") * 29 % 900,
           "bw": c("c_custkey") % 200 + 20, "bh": c("c_custkey") % 150 + 30}
    rows = (table(spark, sf_dir, "customer").withColumn("k", F.lit(0)).join(F.broadcast(n), "k")
            .withColumns(box))
    condition = F.element_at(F.array(F.lit("CLR_"), F.lit("DII_"), F.lit("clr_")), (c("c_custkey") % 3 + 1).cast("int"))
    named = F.concat(condition, F.format_string("roi%d_x%d_y%d_w%d_h%d", "c_custkey", "bx", "by", "bw", "bh"))
    plain = F.concat(condition, F.format_string("roi%d", "c_custkey"))
    return rows.select(
        "c_custkey", F.format_string("reg%03d", c("c_custkey") % c("n")).alias("image_id"),
        F.concat(F.when(c("c_custkey") % 4 != 0, named).otherwise(plain), F.lit(".png")).alias("roi_name"),
        "bx", "by", "bw", "bh", F.lit(1000).alias("image_width"), F.lit(1000).alias("image_height"))


def roi_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label table of the regions whose name has no box (and of some that have)."""
    c = F.col
    return (rois(spark, sf_dir).where(c("c_custkey") % 8 != 4)
            .select(F.regexp_replace("roi_name", r"\.png$", "").alias("Name"), c("bx").alias("X"), c("by").alias("Y"),
                    c("bw").alias("ROI Width"), c("bh").alias("ROI Height")))


ROIS = """rois AS (
  SELECT c_custkey, printf('reg%03d', c_custkey % (SELECT count(*) FROM supplier)) AS image_id,
         CASE c_custkey % 3 WHEN 0 THEN 'CLR_' WHEN 1 THEN 'DII_' ELSE 'clr_' END AS cond,
         c_custkey * 13 % 900 AS bx, c_custkey * 29 % 900 AS by_,
         c_custkey % 200 + 20 AS bw, c_custkey % 150 + 30 AS bh,
         c_custkey % 4 <> 0 AS in_name, c_custkey % 8 <> 4 AS labelled
  FROM customer),
placed AS (
  SELECT *, cond || 'roi' || c_custkey
           || CASE WHEN in_name THEN '_x' || bx || '_y' || by_ || '_w' || bw || '_h' || bh ELSE '' END
           || '.png' AS roi_name
  FROM rois WHERE in_name OR labelled)"""
