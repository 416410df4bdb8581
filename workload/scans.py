"""Queries over scans, annotations, metadata documents and regions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.functions.names import slide_id
from cellweave.operators import masks, outlines, regions, triads as ops
from cellweave.sources import metadata, tables
from workload.registry import query
from workload.triads import SEARCH
from workload.views import CELLS, ROIS, cells, roi_labels, rois, summary_sql, table

C = F.col


@query("scan_cells", """SELECT printf('%s_reg%03d_A_x%d_y%d', CASE WHEN l_suppkey % 2 = 0 THEN 'CLR' ELSE 'DII' END, l_suppkey, l_suppkey, l_suppkey * 2)
    AS image_id, 'slide ' || (l_suppkey % 10) AS slide_folder, CASE WHEN l_suppkey % 2 = 0 THEN 'CLR' ELSE 'DII' END AS condition,
  printf('reg%03d_A', l_suppkey) AS tissue_id, CAST(l_orderkey AS VARCHAR) AS cell_id, l_partkey AS x, l_orderkey AS y,
  l_extendedprice AS area, CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity END AS dapi, l_tax AS marker FROM lineitem""")
def scan_cells(spark, sf):
    key = C("l_suppkey")
    name = F.format_string("%s_reg%03d_A_x%d_y%d", F.when(key % 2 == 0, "CLR").otherwise("DII"), key, key, key * 2)
    raw = table(spark, sf, "lineitem").select(
        F.concat(F.lit("file:/seg/slide%20"), (key % 10).cast("string"), F.lit("/"), name, F.lit("_mesmer_result.csv")).alias("file_path"),
        C("l_orderkey").alias("label"), C("l_partkey").alias("x"), C("l_orderkey").alias("y"), C("l_extendedprice").alias("area"),
        F.when(C("l_linenumber") == 1, F.lit(float("nan"))).otherwise(C("l_quantity")).alias("DAPI"), C("l_tax").alias("marker"))
    return tables.canonical_cells(raw, ["CLR", "DII"]).select(
        "image_id", "slide_folder", "condition", "tissue_id", "cell_id", "x", "y", "area", "dapi", "marker")


@query("scan_matched", """SELECT printf('%sreg%03d', CASE l_suppkey % 3 WHEN 0 THEN 'CLR_' WHEN 1 THEN 'dii_' ELSE 'x_' END, l_suppkey) AS image_id,
  CASE l_suppkey % 3 WHEN 0 THEN 'CLR' WHEN 1 THEN 'DII' ELSE 'Unknown' END AS condition, CAST(l_orderkey AS VARCHAR) AS cell_id,
  l_partkey AS x, l_orderkey AS y, l_returnflag AS cell_type FROM lineitem WHERE l_linestatus = 'O'""")
def scan_matched(spark, sf):
    key = C("l_suppkey")
    prefix = F.when(key % 3 == 0, "CLR_").when(key % 3 == 1, "dii_").otherwise("x_")
    raw = table(spark, sf, "lineitem").select(
        F.concat(F.lit("/in/"), prefix, F.format_string("reg%03d", key), F.lit(tables.MATCHED_SUFFIX)).alias("file_path"),
        C("l_orderkey").cast("string").alias("cell_id"), C("l_partkey").alias("centroid_x"), C("l_orderkey").alias("centroid_y"),
        C("l_returnflag").alias("cell_type"), (C("l_linestatus") == "O").alias("matched"))
    return tables.canonical_matched(raw, ["CLR", "DII"]).select("image_id", "condition", "cell_id", "x", "y", "cell_type")


@query("scan_flagged", f"""WITH {CELLS}, {summary_sql()}
SELECT c.image_id, CAST(count(*) AS BIGINT) AS n_cells, CAST(coalesce(any_value(n_triads), 0) AS BIGINT) AS n_triads
FROM cells c LEFT JOIN summary s USING (image_id) GROUP BY c.image_id""")
def scan_flagged(spark, sf):
    slim = cells(spark, sf).select("image_id", "condition", "cell_id", "x", "y", "cell_type")
    flagged, pairs = tables.scan_flagged(slim, ops.find_triads(slim, SEARCH, with_counts=False))
    n = pairs.groupBy("image_id").agg(F.count(F.lit(1)).alias("n_triads"))
    return (flagged.groupBy("image_id").agg(F.count(F.lit(1)).alias("n_cells")).join(n, "image_id", "left")
            .withColumn("n_triads", F.coalesce("n_triads", F.lit(0))))


@query("scan_incremental", f"""WITH {CELLS}, done AS (
  SELECT DISTINCT 'core' || CAST(s_suppkey % 7 AS VARCHAR) AS tissue_id, CASE WHEN s_suppkey % 2 = 0 THEN 'CLR' ELSE 'DII' END AS condition
  FROM supplier WHERE s_acctbal > 9000)
SELECT image_id, cell_id FROM cells c ANTI JOIN done d ON c.tissue_id = d.tissue_id AND c.condition = d.condition""")
def scan_incremental(spark, sf):
    done = table(spark, sf, "supplier").where("s_acctbal > 9000").select(
        F.concat(F.lit("core"), (C("s_suppkey") % 7).cast("string")).alias("tissue_id"),
        F.when(C("s_suppkey") % 2 == 0, "CLR").otherwise("DII").alias("condition"))
    return tables.not_yet_done(cells(spark, sf), done).select("image_id", "cell_id")


@query("scan_roi_labels", f"""WITH {ROIS}
SELECT replace(roi_name, '.png', '') AS "Name", bx AS label_x, by_ AS label_y, bw AS label_w, bh AS label_h
FROM (SELECT *, cond || 'roi' || c_custkey || CASE WHEN in_name THEN '_x' || bx || '_y' || by_ || '_w' || bw || '_h' || bh ELSE '' END
        || '.png' AS roi_name FROM rois WHERE labelled)""")
def scan_roi_labels(spark, sf):
    return regions.canonical_labels(roi_labels(spark, sf))


def documents(spark, sf):
    """Parts as metadata documents, one of nine shapes each; the part's words are its channels."""
    words = F.split("p_name", " ")
    named = F.transform(words, lambda w: F.struct(w.alias("name")))
    # Upper-case field, and an object without a name.
    mixed = F.concat(F.transform(words, lambda w: F.create_map(F.lit("Name"), w)), F.array(F.create_map(F.lit("id"), F.lit("7"))))
    xml = F.concat(F.lit('<OME xmlns="http://www.openmicroscopy.org/Schemas/OME/2016-06"><Image><Pixels SizeX="'), C("p_size").cast("string"),
                   F.lit('">'), F.array_join(F.transform(words, lambda w: F.concat(F.lit('<Channel Name="'), w, F.lit('"/>'))), ""),
                   F.lit("<Channel/></Pixels></Image></OME>"))
    shapes = [
        F.to_json(F.struct(words.alias("channel_names"), F.array(F.lit("no")).alias("markers"))),
        F.to_json(F.struct(named.alias("channels"))),
        F.to_json(F.struct(F.struct(mixed.alias("channels")).alias("image"))),
        F.to_json(F.struct(F.struct(F.struct(F.struct(mixed.alias("Channel")).alias("Pixels")).alias("Image")).alias("ome"))),
        F.to_json(F.struct(words.alias("panel"))),
        F.to_json(F.struct(F.struct(words.alias("targets")).alias("panel"))),
        F.to_json(F.struct(F.lit("x").alias("channels"), words.alias("markers"))),
        F.to_json(F.struct(xml.alias("ome_xml"))),
        F.lit('{"other": 1}'),
    ]
    return table(spark, sf, "part").select(
        "p_partkey", F.element_at(F.array(*shapes), (C("p_partkey") % 9 + 1).cast("int")).alias("text"),
        F.when(C("p_partkey") % 5 != 0, xml).otherwise(F.concat(xml, F.lit("<"))).alias("xml"), F.size(words).alias("n_words"))


@query("scan_channel_meta", """WITH w AS (SELECT p_partkey, p_partkey % 9 AS shape, str_split(p_name, ' ') AS ws FROM part),
n AS (SELECT p_partkey, CASE WHEN shape IN (2, 3, 7) THEN list_concat(ws, ['Channel_' || len(ws)]) WHEN shape = 8 THEN [] ELSE ws END AS ns FROM w)
SELECT p_partkey, CAST(i AS INTEGER) AS channel_index, ns[i + 1] AS channel_name FROM n, range(20) r(i) WHERE i < len(ns)""")
def scan_channel_meta(spark, sf):
    return metadata.scan_channel_meta(documents(spark, sf), "text", ["p_partkey"])


@query("ome_summary", """SELECT p_partkey, CASE WHEN p_partkey % 5 <> 0 THEN CAST(1 AS BIGINT) END AS n_images,
  CASE WHEN p_partkey % 5 <> 0 THEN CAST(len(str_split(p_name, ' ')) + 1 AS BIGINT) END AS n_channels,
  CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_size AS VARCHAR) END AS size_x, p_partkey % 5 = 0 AS has_error FROM part""")
def ome_summary(spark, sf):
    return metadata.ome_summary(documents(spark, sf), "xml", ["p_partkey"]).select(
        "p_partkey", "n_images", "n_channels", F.try_element_at("pixels_attributes", F.lit("SizeX")).alias("size_x"),
        C("error").isNotNull().alias("has_error"))


@query("roi_label_join", f"WITH {ROIS} SELECT c_custkey, bx AS x, by_ AS y, bw AS w, bh AS h FROM placed")
def roi_label_join(spark, sf):
    return regions.locate_rois(rois(spark, sf), roi_labels(spark, sf)).select("c_custkey", "x", "y", "w", "h")


def located(spark, sf):
    return regions.locate_rois(rois(spark, sf), roi_labels(spark, sf))


@query("roi_assign", f"""WITH {CELLS}, {ROIS}
SELECT c.image_id, roi_name, cell_id FROM cells c JOIN placed p ON c.image_id = p.image_id
WHERE matched AND c.x >= bx AND c.x < least(bx + bw, 1000) AND c.y >= by_ AND c.y < least(by_ + bh, 1000)""")
def roi_assign(spark, sf):
    slim = cells(spark, sf).select("image_id", "cell_id", "x", "y", "matched")
    return regions.assign_to_rois(slim, located(spark, sf), "matched").select("image_id", "roi_name", "cell_id")


def tissue_masks(spark, sf):
    """A tissue mask of 250 rows for every image that has regions, two runs a row, and its frame of 1000 by 1000 pixels."""
    images = located(spark, sf).select("image_id").distinct().withColumn("mask", F.lit("tissue"))
    rows = images.withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(249))))
    ends = F.array(F.struct(F.lit(0).alias("start"), (100 + C("row") % 7).alias("end")), F.struct(F.lit(150).alias("start"), F.lit(250).alias("end")))
    frames = images.select("*", F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(1000).alias("w"), F.lit(1000).alias("h"),
                           F.lit(250).alias("mask_width"), F.lit(250).alias("mask_height"))
    return rows.select("*", F.explode(ends).alias("run")).select("image_id", "mask", "row", "run.*"), frames


def own_masks(spark, sf):
    """Masks of 64 by 48 pixels for the regions of four in five customers, one run a row that starts further right row by row."""
    of = regions.clip_rois(located(spark, sf)).where(C("c_custkey") % 5 != 0).withColumn("mask", C("roi_name"))
    frames = of.select("image_id", "mask", "x", "y", (C("x_end") - C("x")).alias("w"), (C("y_end") - C("y")).alias("h"),
                       F.lit(64).alias("mask_width"), F.lit(48).alias("mask_height"))
    rows = of.withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(47))))
    start = (C("row") + C("c_custkey")) % 30
    return rows.select("image_id", "mask", "row", start.alias("start"), (start + 31).alias("end")), frames


@query("roi_mask_assign", f"""WITH {CELLS}, {ROIS},
hit AS (SELECT c.image_id, roi_name, cell_id, c_custkey, CAST(floor(c.x) AS BIGINT) AS px, CAST(floor(c.y) AS BIGINT) AS py, bx, by_,
               least(bx + bw, 1000) - bx AS w, least(by_ + bh, 1000) - by_ AS h
        FROM cells c JOIN placed p ON c.image_id = p.image_id WHERE c.x >= bx AND c.x < least(bx + bw, 1000) AND c.y >= by_ AND c.y < least(by_ + bh, 1000)),
pixel AS (SELECT *, (2 * px + 1) * 250 // 2000 AS tx, (2 * py + 1) * 250 // 2000 AS ty,
                 (2 * (px - bx) + 1) * 64 // (2 * w) AS mx, (2 * (py - by_) + 1) * 48 // (2 * h) AS my FROM hit)
SELECT image_id, roi_name, cell_id FROM pixel
WHERE (tx < 100 + ty % 7 OR tx >= 150)
  AND (c_custkey % 5 = 0 OR (mx >= (my + c_custkey) % 30 AND mx < (my + c_custkey) % 30 + 31))""")
def roi_mask_assign(spark, sf):
    slim = cells(spark, sf).select("image_id", "cell_id", "x", "y")
    found = masks.assign_through_masks(slim, located(spark, sf), tissue_masks(spark, sf), own_masks(spark, sf))
    return found.select("image_id", "roi_name", "cell_id")


@query("roi_condition_counts", f"""WITH {ROIS}, dims(condition, pre) AS (VALUES ('CLR', 'CLR_'), ('DII', 'DII_'), ('CTL', 'CTL_'))
SELECT condition, CAST(count(c_custkey) AS BIGINT) AS n_rois FROM dims LEFT JOIN placed ON cond = pre GROUP BY condition""")
def roi_condition_counts(spark, sf):
    return regions.roi_condition_counts(located(spark, sf), ["CLR", "DII", "CTL"])


@query("roi_summary", f"""WITH {ROIS},
ch AS (SELECT p_partkey AS slide, replace(p_name, ' ', ',') AS channels FROM part)
SELECT CAST(c_custkey AS VARCHAR) AS slide_id, CASE cond WHEN 'CLR_' THEN 'CLR' WHEN 'DII_' THEN 'DII' ELSE 'Unknown' END AS roi_condition,
       bx AS x, by_ AS y, bw AS width, bh AS height, coalesce(channels, '') AS channel_names
FROM placed LEFT JOIN ch ON slide = c_custkey""")
def roi_summary(spark, sf):
    channels = table(spark, sf, "part").select(
        C("p_partkey").cast("string").alias("slide_id"), F.posexplode(F.split("p_name", " ")).alias("channel_index", "channel_name"))
    path = F.concat(F.lit("/raw/"), C("c_custkey").cast("string"), F.lit("_x1_y2.tif"))
    placed = located(spark, sf).withColumn("slide_id", slide_id(path, []))
    return regions.roi_summary(placed, channels, ["CLR", "DII"])


@query("region_features", """WITH px AS (SELECT l_suppkey, l_partkey % 50 AS label, l_orderkey % 200 AS x, l_partkey % 150 AS y, l_linenumber AS ch, l_quantity AS v FROM lineitem),
spots AS (SELECT l_suppkey, label, x, y, avg(v) FILTER (WHERE ch = 1) AS v1, avg(v) FILTER (WHERE ch = 2) AS v2 FROM px GROUP BY ALL),
m AS (SELECT l_suppkey, label, count(*) AS area, avg(x) AS cx, avg(y) AS cy, var_pop(x) AS a, var_pop(y) AS b, covar_pop(x, y) AS c,
             avg(v1) AS m1, avg(v2) AS m2 FROM spots GROUP BY ALL),
e AS (SELECT *, (a + b) / 2 + sqrt(pow((a - b) / 2, 2) + c * c) AS l1, greatest((a + b) / 2 - sqrt(pow((a - b) / 2, 2) + c * c), 0) AS l2 FROM m)
SELECT l_suppkey AS image_id, label, CAST(area AS BIGINT) AS area, round(cx, 5) AS x, round(cy, 5) AS y,
       round(4 * sqrt(l1), 4) AS axis_major_length, round(4 * sqrt(l2), 4) AS axis_minor_length,
       round(CASE WHEN l1 > 0 THEN sqrt(1 - l2 / l1) ELSE 0 END, 4) AS eccentricity, round(m1, 5) AS mean_1, round(m2, 5) AS mean_2 FROM e""")
def region_features(spark, sf):
    pixels = table(spark, sf, "lineitem").select(
        C("l_suppkey").alias("image_id"), (C("l_partkey") % 50).alias("label"), (C("l_orderkey") % 200).alias("x"),
        (C("l_partkey") % 150).alias("y"), C("l_linenumber").cast("string").alias("channel"), C("l_quantity").alias("value"))
    digits = {"x": 5, "y": 5, "axis_major_length": 4, "axis_minor_length": 4, "eccentricity": 4, "mean_1": 5, "mean_2": 5}
    out = regions.region_features(pixels, ["1", "2"])
    return out.select(*[F.round(c, digits[c]).alias(c) if c in digits else c for c in out.columns])


def labelled_pixels(spark, sf):
    """Line items as pixels of three labels that lie dense in small images."""
    return table(spark, sf, "lineitem").select(
        C("l_suppkey").alias("image_id"), (C("l_linenumber") % 3).alias("label"), (C("l_orderkey") % 12).alias("x"), (C("l_partkey") % 10).alias("y"))


PIXELS = "px AS (SELECT DISTINCT l_suppkey AS image_id, l_linenumber % 3 AS label, l_orderkey % 12 AS x, l_partkey % 10 AS y FROM lineitem)"


@query("region_outlines", f"""WITH {PIXELS},
edge AS (SELECT p.image_id, p.label, p.x, p.y FROM px p LEFT JOIN px q ON p.image_id = q.image_id AND p.label = q.label AND abs(p.x - q.x) + abs(p.y - q.y) = 1
         GROUP BY ALL HAVING count(q.x) < 4),
code AS (SELECT p.image_id, p.label, p.x, p.y, sum(CASE abs(p.x - q.x) + abs(p.y - q.y) WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 10 END) AS m
         FROM edge p JOIN edge q ON p.image_id = q.image_id AND p.label = q.label AND abs(p.x - q.x) <= 1 AND abs(p.y - q.y) <= 1 GROUP BY ALL)
SELECT image_id, label, CAST(count(*) AS BIGINT) AS n_border,
       round(sum(CASE WHEN m IN (5, 7, 15, 17, 25, 27) THEN 1 WHEN m IN (21, 33) THEN sqrt(2) WHEN m IN (13, 23) THEN (1 + sqrt(2)) / 2 ELSE 0 END), 5) AS perimeter
FROM code GROUP BY ALL""")
def region_outlines(spark, sf):
    return outlines.region_outlines(labelled_pixels(spark, sf)).withColumn("perimeter", F.round("perimeter", 5))


# No SQL: hulls are held against a plain test of every pixel in tests/test_outlines.py.
@query("region_hulls")
def region_hulls(spark, sf):
    return outlines.convex_areas(labelled_pixels(spark, sf))
