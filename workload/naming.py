"""Queries over names, boxes and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.functions import geometry, labels, names
from cellweave.functions.proposals import count_low_confidence, parse_proposals
from cellweave.operators.qc import coordinate_key
from workload.registry import query
from workload.views import CELLS, IMAGE_NAMES, ROIS, cells, image_names, rois, table

TWO = ["WT", "KO"]

DETECT = """CASE
  WHEN upper(name) LIKE 'WT\\_%' ESCAPE '\\' OR upper(name) LIKE 'WT %' THEN 'WT'
  WHEN upper(name) LIKE 'KO\\_%' ESCAPE '\\' OR upper(name) LIKE 'KO %' THEN 'KO'
  WHEN upper(name) LIKE '%\\_WT' ESCAPE '\\' OR upper(name) LIKE '% WT' THEN 'WT'
  WHEN upper(name) LIKE '%\\_KO' ESCAPE '\\' OR upper(name) LIKE '% KO' THEN 'KO'
  WHEN contains(upper(name), 'WT') AND contains(upper(name), 'KO') THEN 'Unknown'
  WHEN contains(upper(name), 'WT') THEN 'WT'
  WHEN contains(upper(name), 'KO') THEN 'KO'
  ELSE 'Unknown' END"""


@query("detect_condition", f"WITH {IMAGE_NAMES} SELECT c_custkey, {DETECT} AS condition FROM names")
def detect_condition(spark, sf):
    return image_names(spark, sf).select("c_custkey", names.detect_condition(F.col("name"), TWO).alias("condition"))


@query("condition_prefix", f"""WITH {IMAGE_NAMES}
SELECT c_custkey, CASE WHEN starts_with(upper(name), 'WT') THEN 'WT' WHEN starts_with(upper(name), 'KO') THEN 'KO'
  ELSE 'Unknown' END AS condition FROM names""")
def condition_prefix(spark, sf):
    return image_names(spark, sf).select("c_custkey", names.condition_prefix(F.col("name"), TWO).alias("condition"))


TISSUE = r"""parts AS (SELECT c_custkey, list_filter(regexp_split_to_array(name, '[_\s]+'), lambda t: t <> '') AS every,
  list_filter(regexp_split_to_array(name, '[_\s]+'), lambda t: t <> '' AND upper(t) NOT IN ('WT', 'KO')) AS others FROM names),
kept AS (SELECT c_custkey, CASE WHEN len(others) = 0 THEN every ELSE others END AS p FROM parts),
boxes AS (SELECT c_custkey, p, list_filter(range(2, len(p)), lambda i: regexp_full_match(p[i], 'x\d+') AND regexp_full_match(p[i + 1], 'y\d+')) AS starts
  FROM kept),
dropped AS (SELECT c_custkey, p, list_concat(list_concat(starts, list_transform(starts, lambda i: i + 1)), flatten(list_transform(list_filter(starts,
  lambda i: i + 3 <= len(p) AND regexp_full_match(p[i + 2], 'w\d+') AND regexp_full_match(p[i + 3], 'h\d+')), lambda i: [i + 2, i + 3]))) AS gone
  FROM boxes)"""


@query("tissue_id", f"""WITH {IMAGE_NAMES}, {TISSUE} SELECT c_custkey,
  array_to_string(list_transform(list_filter(range(1, len(p) + 1), lambda i: NOT list_contains(gone, i)), lambda i: p[i]), '_') AS tissue_id
FROM dropped""")
def tissue_id(spark, sf):
    return image_names(spark, sf).select("c_custkey", names.tissue_id(F.col("name"), TWO).alias("tissue_id"))


@query("strip_suffix", f"""WITH {IMAGE_NAMES} SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN name WHEN 1 THEN name || '_a' ELSE name END AS image_id
FROM names""")
def strip_suffix(spark, sf):
    # The ending as it is, inside a name, and in its short form.
    ending = F.element_at(F.array(F.lit("_mesmer_result.csv"), F.lit("_mesmer_result.csv_a"), F.lit("mesmer_result.csv")),
                          (F.col("c_custkey") % 3 + 1).cast("int"))
    stored = F.concat(F.col("name"), ending)
    return image_names(spark, sf).select(
        "c_custkey", names.strip_suffix(stored, "_" + names.RAW_SUFFIX, names.RAW_SUFFIX).alias("image_id"))


@query("slide_id", f"""WITH {IMAGE_NAMES},
parts AS (SELECT *, str_split(name, '_') AS p FROM names),
found AS (SELECT *, list_filter(p[2:], lambda s: regexp_full_match(s, '[xy][0-9]+'))[1] AS coord FROM parts)
SELECT c_custkey, CASE
  WHEN (starts_with(name, 'WT_') OR starts_with(name, 'KO_')) AND coord IS NOT NULL
    THEN substr(name, len(p[1]) + 2, instr(name, '_' || coord) - len(p[1]) - 2)
  WHEN regexp_matches(name, '_x\\d+_y\\d+') THEN regexp_extract(name, '^(.*?)_x\\d+_y\\d+', 1)
  ELSE name END AS slide_id
FROM found""")
def slide_id(spark, sf):
    path = F.concat(F.lit("/raw/day.1/"), F.col("name"), F.lit(".tif"))
    return image_names(spark, sf).select("c_custkey", names.slide_id(path, TWO).alias("slide_id"))


@query("roi_coords", f"""WITH {ROIS}
SELECT c_custkey, CASE WHEN in_name THEN bx END AS x, CASE WHEN in_name THEN by_ END AS y,
       CASE WHEN in_name THEN bw END AS w, CASE WHEN in_name THEN bh END AS h FROM rois""")
def roi_coords(spark, sf):
    return (rois(spark, sf).select("c_custkey", names.roi_box(F.col("roi_name")).alias("b"))
            .select("c_custkey", "b.x", "b.y", "b.w", "b.h"))


@query("roi_clip", f"""WITH {ROIS}
SELECT c_custkey, least(bx + bw, 1000) AS x_end, least(by_ + bh, 1000) AS y_end,
       least(bx + bw, 1000) - bx AS clipped_w, least(by_ + bh, 1000) - by_ AS clipped_h FROM rois""")
def roi_clip(spark, sf):
    box = [F.col(c) for c in ("bx", "by", "bw", "bh", "image_width", "image_height")]
    return rois(spark, sf).select("c_custkey", *[c.alias(n) for n, c in geometry.clip_box(*box).items()])


@query("roi_condition", f"""WITH {ROIS}
SELECT c_custkey, CASE cond WHEN 'CLR_' THEN 'CLR' WHEN 'DII_' THEN 'DII' ELSE 'Unknown' END AS condition
FROM rois""")
def roi_condition(spark, sf):
    return rois(spark, sf).select(
        "c_custkey", names.roi_condition(F.col("roi_name"), ["CLR", "DII"]).alias("condition"))


@query("reg_num", f"""WITH {IMAGE_NAMES},
more AS (SELECT c_custkey, name FROM names
         UNION ALL SELECT s_suppkey, printf('CLR_reg%03d_A', s_suppkey) FROM supplier)
SELECT c_custkey, name, TRY_CAST(NULLIF(regexp_extract(name, 'reg(\\d+)', 1), '') AS BIGINT) AS reg_num FROM more""")
def reg_num(spark, sf):
    regions = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("c_custkey"),
        F.concat(F.lit("CLR_"), names.reg_prefix(F.col("s_suppkey")), F.lit("_A")).alias("name"))
    return (image_names(spark, sf).unionByName(regions)
            .withColumn("reg_num", names.reg_num(F.col("name"))))


@query("spot_list", """SELECT c_custkey, CASE c_custkey % 4
    WHEN 0 THEN c_custkey || ',' || (c_custkey + 1)
    WHEN 1 THEN CAST(c_custkey AS VARCHAR)
    WHEN 2 THEN '' ELSE '' END AS spots,
  CASE c_custkey % 4 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS n_spots FROM customer""")
def spot_list(spark, sf):
    key = F.col("c_custkey")
    text = (F.when(key % 4 == 0, F.concat(key.cast("string"), F.lit(", ,"), (key + 1).cast("string")))
            .when(key % 4 == 1, F.concat(F.lit(" "), key.cast("string"), F.lit(" ")))
            .when(key % 4 == 2, F.concat(key.cast("string"), F.lit(",a"))))
    return table(spark, sf, "customer").select(key, names.spot_list(text).alias("list")).select(
        "c_custkey", F.array_join(F.col("list").cast("array<string>"), ",").alias("spots"),
        F.size("list").alias("n_spots"))


@query("equiv_radius", f"""WITH {CELLS}
SELECT cell_id, round(greatest(sqrt(area / pi()), 3.0), 6) AS radius,
       round(CASE WHEN matched THEN greatest(sqrt(area / pi()), 3.0) ELSE 5.0 END, 6) AS drawn FROM cells""")
def equiv_radius(spark, sf):
    known = F.when(F.col("matched"), F.col("area"))
    return cells(spark, sf).select(
        "cell_id", F.round(geometry.equivalent_radius(F.col("area")), 6).alias("radius"),
        F.round(geometry.drawn_radius(known), 6).alias("drawn"))


@query("bbox_cols", f"""WITH {CELLS}, r AS (SELECT *, greatest(sqrt(area / pi()), 3.0) AS radius FROM cells)
SELECT cell_id, round(x - radius, 6) AS roi_x, round(y - radius, 6) AS roi_y,
       round(2 * radius, 6) AS roi_width, round(2 * radius, 6) AS roi_height FROM r""")
def bbox_cols(spark, sf):
    radius = geometry.equivalent_radius(F.col("area"))
    box = geometry.bounding_box(F.col("x"), F.col("y"), radius)
    return cells(spark, sf).select("cell_id", *[F.round(c, 6).alias(n) for n, c in box.items()])


@query("dist_um", f"""WITH {CELLS}
SELECT cell_id, round(sqrt(CAST((x - 500) * (x - 500) + (y - 500) * (y - 500) AS DOUBLE)) * 0.65, 6) AS dist_um,
       round(20.0 / 0.65, 6) AS radius_px FROM cells""")
def dist_um(spark, sf):
    center = F.lit(500)
    return cells(spark, sf).select(
        "cell_id", F.round(geometry.distance_um(F.col("x"), F.col("y"), center, center, 0.65), 6).alias("dist_um"),
        F.round(F.lit(20.0) / F.lit(0.65), 6).alias("radius_px"))


@query("combo_label", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_returnflag = 'A' THEN 'anchor' ELSE l_returnflag END || '__' || l_linestatus || '__'
  || CASE WHEN l_returnflag = 'R' THEN 'second' ELSE l_returnflag END AS combo FROM lineitem""")
def combo_label(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        labels.combo_label(F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_returnflag"),
                           {"A": "anchor"}, None, {"R": "second"}).alias("combo"))


@query("sig_stars", """SELECT event_id, CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**'
  WHEN p < 0.05 THEN '*' ELSE 'ns' END AS stars
FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value / 500 END AS p FROM events)""")
def sig_stars(spark, sf):
    p = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value") / 500)
    return table(spark, sf, "events").select("event_id", labels.significance_stars(p).alias("stars"))


@query("bonferroni", """SELECT n_nationkey, round(0.05 / count(*) OVER (), 8) AS bonferroni_alpha,
  coalesce(CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_nationkey / 2000.0 END < 0.05 / count(*) OVER (), FALSE)
    AS sig_bonferroni FROM nation""")
def bonferroni(spark, sf):
    key = F.col("n_nationkey")
    tests = table(spark, sf, "nation").select(key, F.when(key % 5 != 0, key / 2000.0).alias("p_value"))
    return labels.with_bonferroni(tests).select("n_nationkey", "bonferroni_alpha", "sig_bonferroni")


@query("round_key", f"""WITH {CELLS}
SELECT cell_id, CAST(round(x * 100) AS BIGINT) AS key_x, CAST(round(y * 100) AS BIGINT) AS key_y FROM cells""")
def round_key(spark, sf):
    near = cells(spark, sf).withColumns({"x": F.col("x") + 0.001, "y": F.col("y") - 0.002})
    kx, ky = coordinate_key(near)
    return near.select("cell_id", kx.alias("key_x"), ky.alias("key_y"))


@query("proposals_parse", """SELECT event_id, CAST(user_id % 9 AS VARCHAR) AS cluster, event_type AS label,
  CASE WHEN value < 20 THEN 'low' ELSE 'high' END AS confidence, 'k is ' || json_extract_string(props, '$.k') AS reason
FROM events""")
def proposals_parse(spark, sf):
    return parse_proposals(_replies(spark, sf), "reply", ["event_id"])


def _replies(spark, sf):
    """Events as free reply text with one proposal in it."""
    c = F.col
    call = F.to_json(F.map_from_arrays(
        F.array((c("user_id") % 9).cast("string")),
        F.array(F.struct(c("event_type").alias("label"),
                         F.when(c("value") < 20, "low").otherwise("high").alias("confidence"),
                         F.concat(F.lit("k is "), F.get_json_object("props", "$.k")).alias("reason")))))
    return table(spark, sf, "events").select(
        "event_id", F.concat(F.lit("Here is the answer:\n"), call, F.lit("\nDone.")).alias("reply"))


@query("proposals_low", """SELECT event_id, CAST(1 AS BIGINT) AS n_clusters,
  CAST(CASE WHEN value < 20 THEN 1 ELSE 0 END AS BIGINT) AS n_low FROM events""")
def proposals_low(spark, sf):
    return count_low_confidence(parse_proposals(_replies(spark, sf), "reply", ["event_id"]), ["event_id"])


@query("event_flag", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS event,
  CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS event_inverted FROM orders""")
def event_flag(spark, sf):
    censor = F.when(F.col("o_orderstatus") == "F", 0).otherwise(1)
    return table(spark, sf, "orders").select(
        "o_orderkey", labels.event_flag(censor).alias("event"),
        labels.event_flag(censor, censor_is_one=False).alias("event_inverted"))


@query("group_label_map", """SELECT c_custkey, CASE c_nationkey % 4 WHEN 1 THEN 'CLR' WHEN 2 THEN 'DII'
  ELSE 'Unknown' END AS label FROM customer""")
def group_label_map(spark, sf):
    group = F.when(F.col("c_nationkey") % 4 != 0, (F.col("c_nationkey") % 4).cast("double"))
    return table(spark, sf, "customer").select("c_custkey", labels.group_label(group).alias("label"))
