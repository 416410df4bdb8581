import json

import pytest
from pyspark.sql import functions as F

from cellweave.operators import qc, regions
from cellweave.plans.outcomes import analyse_survival, test_markers  # noqa: F401
from cellweave.plans.preprocessing import preprocess
from cellweave.plans.triads import analyse_triads
from cellweave.plans.typing import Typing, type_by_rules
from cellweave.operators.rules import parse_rules
from cellweave.operators.triads import TriadSearch, condition_areas
from cellweave.schema import RAW_CELL_SCHEMA, marker_columns
from cellweave.sources import metadata, tables
from cellweave.streaming.arrivals import arriving_files, work_off


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))


def test_scan_cells_from_folders(spark, tmp_path):
    head = "label,x,y,area,DAPI,CD3,F4/80\n"
    write(tmp_path / "slide 1" / "WT_s1_x1_y2_mesmer_result.csv", head + "1,1.0,2.0,30,5,0.5,\n2,2,2,40,6,1.5,nan\n")
    write(tmp_path / "slide2" / "s2_KO_mesmer_result.csv", head + "1,1,2,30,5,0.5,2\nbad,x\n")
    write(tmp_path / "slide2" / "other.csv", head + "9,9,9,9,9,9,9\n")
    cells = tables.scan_cells(spark, str(tmp_path), ["WT", "KO"])
    assert marker_columns(cells) == ["CD3", "F4/80"]
    got = {(r.slide_folder, r.image_id, r.condition, r.tissue_id, r.cell_id, r["F4/80"]) for r in cells.collect()}
    assert got == {("slide 1", "WT_s1_x1_y2", "WT", "s1", "1", None), ("slide 1", "WT_s1_x1_y2", "WT", "s1", "2", None),
                   ("slide2", "s2_KO", "KO", "s2", "1", 2.0)}
    assert cells.count() == 3
    bad = tables.malformed(tables.raw_cells(spark, str(tmp_path))).collect()
    assert [(r.file_path.rsplit("/", 1)[1], r[tables.CORRUPT]) for r in bad] == [("s2_KO_mesmer_result.csv", "bad,x")]


def test_columns_are_read_by_name(spark, tmp_path):
    write(tmp_path / "a" / "WT_1_mesmer_result.csv", "label,x,y,area,DAPI,CD3,CD8\n1,1,2,3,4,0.3,0.8\n")
    write(tmp_path / "a" / "WT_2_mesmer_result.csv", "label,x,y,area,DAPI,CD8,CD3\n1,1,2,3,4,0.8,0.3\n")
    write(tmp_path / "b" / "WT_3_mesmer_result.csv", "label,area,y,x,DAPI,CD20\n1,3,2,1,4,0.9\n")
    write(tmp_path / "b" / "WT_4_mesmer_result.csv", "label,x,y,area,DAPI,\"CD4, long\"\n1,1,2,3,4,0.4\n", "latin-1")
    got = {r.image_id: r.asDict() for r in tables.scan_cells(spark, str(tmp_path), ["WT"]).collect()}
    assert {k: (r["CD3"], r["CD8"], r["CD20"], r["CD4, long"], r["x"], r["area"]) for k, r in got.items()} == {
        "WT_1": (0.3, 0.8, None, None, 1, 3), "WT_2": (0.3, 0.8, None, None, 1, 3), "WT_3": (None, None, 0.9, None, 1, 3),
        "WT_4": (None, None, None, 0.4, 1, 3)}


def test_unreadable_files_have_a_row(spark, tmp_path):
    write(tmp_path / "a" / "WT_1_mesmer_result.csv", "label,x,y,area,DAPI,CD3\n1,1,2,3,4,0.3\n")
    write(tmp_path / "a" / "WT_empty_mesmer_result.csv", "")
    (tmp_path / "a" / "WT_broken.gz_mesmer_result.csv").write_bytes(b"")
    (tmp_path / "b").mkdir()
    status = {r.file_path.rsplit("/", 1)[1]: r.status for r in tables.file_status(spark, str(tmp_path), "*mesmer_result.csv").collect()}
    assert status == {"WT_1_mesmer_result.csv": "OK", "WT_empty_mesmer_result.csv": "EMPTY", "WT_broken.gz_mesmer_result.csv": "EMPTY"}
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "x.csv.gz").write_bytes(b"\x1f\x8bnot gzip at all")
    assert [r.status for r in tables.file_status(spark, str(tmp_path / "c"), "*.gz").collect()] == ["ERROR"]
    lost = tables.unread_images(spark, str(tmp_path))
    assert {r.image_id for r in lost.collect()} == {"WT_empty", "WT_broken.gz"}
    cells = tables.scan_cells(spark, str(tmp_path), ["WT"])
    thr = qc.percentile_thresholds(cells, 1, 1)
    none = spark.createDataFrame([], "image_id string, z_count_cutoff double, z_sum_cutoff double")
    stats = qc.processing_stats(cells, cells, cells, none, thr, None, lost)
    assert {r.image_id: (r.status, r.original_cells) for r in stats.collect()} == {
        "WT_1": ("PROCESSED", 1), "WT_empty": ("ERROR", 0), "WT_broken.gz": ("ERROR", 0)}


def test_cells_without_ids_stay_apart(spark, tmp_path):
    write(tmp_path / "i_matched_with_boundaries.csv", "centroid_x,centroid_y,cell_type,CD3\n1,2,T,0.5\n1,2,T,0.5\n1,2,T,0.7\n1,2,B,0.5\n")
    write(tmp_path / "j_matched_with_boundaries.csv", "cell_id,centroid_x,centroid_y,cell_type\nq,1,2,T\n")
    rows = tables.scan_matched(spark, str(tmp_path), []).collect()
    assert len({(r.image_id, r.cell_id) for r in rows}) == 5 and {r.cell_id for r in rows if r.image_id == "j"} == {"q"}


def test_config_maps(spark):
    flat = tables.condition_area_table(spark, {"WT": 2, "KO": 3.5})
    nested = tables.condition_area_table(spark, {"WT": {"d1": 1, "d2": 1.0}, "KO": 3.5})
    for table in (flat, nested):
        assert {r.condition: r.area_um2 for r in condition_areas(table).collect()} == {"WT": 2.0, "KO": 3.5}
    assert tables.image_condition_table(spark, {"i": "WT"}).first() == ("i", "WT")


def test_scan_matched_skips_hidden_and_unmatched(spark, tmp_path):
    head = "cell_id,centroid_x,centroid_y,cell_type,matched,CD3\n"
    write(tmp_path / "CLR_reg001_A_matched_with_boundaries.csv", head + "a,1,2,T,True,0.5\nb,1,2,T,False,0.5\n")
    write(tmp_path / "._CLR_reg009_A_matched_with_boundaries.csv", head + "z,1,2,T,True,0.5\n")
    write(tmp_path / "empty_matched_with_boundaries.csv", head)
    explicit = spark.createDataFrame([("CLR_reg001_A", "mapped")], "image_id string, condition string")
    got = tables.scan_matched(spark, str(tmp_path), ["CLR"], explicit).collect()
    assert [(r.image_id, r.condition, r.cell_id, r.x) for r in got] == [("CLR_reg001_A", "mapped", "a", 1.0)]
    images = {r.image_id for r in tables.image_files(spark, str(tmp_path)).collect()}
    assert images == {"CLR_reg001_A", "empty"}


@pytest.mark.parametrize("encoding", ["utf-8", "latin-1", "utf-8-sig"])
def test_scan_encodings(spark, tmp_path, encoding):
    text = "cell_id,centroid_x,centroid_y,cell_type\né1,1,2,Zellé\n"
    write(tmp_path / "i_matched_with_boundaries.csv", text, encoding)
    write(tmp_path / "j_matched_with_boundaries.csv", text)
    rows = tables.scan_matched(spark, str(tmp_path), []).collect()
    assert sorted((r.image_id, r.cell_id, r.cell_type) for r in rows) == [("i", "é1", "Zellé"), ("j", "é1", "Zellé")]


def test_scan_patients_and_roi_labels(spark, tmp_path):
    write(tmp_path / "p.csv", 'Patient,Group,TMA spot / region,OS,OS_Censor,Sex\n1,2,"1,2",3.5,0,F\n,1,3,,,\n')
    rows = tables.scan_patients(spark, str(tmp_path / "p.csv")).collect()
    assert rows[0]["TMA spot / region"] == "1,2" and rows[0].OS == 3.5 and rows[0].Sex == "F" and rows[1].Patient is None
    write(tmp_path / "roi.txt", "Name\tX\tY\tROI Width\tROI Height\nr1\t1\t2\t3\t4\n")
    write(tmp_path / "q.csv", 'Patient,Group,TMA spot / region,OS,OS_Censor,Sex\n1.0,2.0,"1,2",3.5,0.0,F\nx,1,3,1,1,M\n')
    rows = tables.scan_patients(spark, str(tmp_path / "q.csv")).collect()
    assert [(r.Patient, r.Group, r.OS_Censor) for r in rows] == [(1, 2, 0)]
    assert [(r.Patient, r.Group, r.Sex) for r in tables.bad_patients(spark, str(tmp_path / "q.csv")).collect()] == [(None, 1, "M")]
    labels = regions.canonical_labels(tables.scan_roi_labels(spark, str(tmp_path / "roi.txt")))
    assert tuple(labels.first()) == ("r1", 1, 2, 3, 4)
    assert regions.canonical_labels(labels) is None


def test_metadata_documents(spark, tmp_path):
    write(tmp_path / "a_metadata.json", json.dumps({"channels": [{"Name": "x"}, {}], "panel": ["no"]}))
    write(tmp_path / "a.json", json.dumps({"panel": ["other"]}))
    write(tmp_path / "metadata_b.json", json.dumps({"ome_xml": "<OME><Channel Name='q &amp; r'/><Channel/></OME>"}))
    write(tmp_path / "c.json", json.dumps({"ome_xml": "<OME"}))
    write(tmp_path / "d.json", json.dumps({"panel": {"targets": ["t"]}}))
    write(tmp_path / "e.json", json.dumps({"channel_names": [], "markers": ["m"]}))
    images = spark.createDataFrame([(f"/raw/{n}.tif",) for n in "abcdef"], "path string")
    docs = metadata.match_documents(images, metadata.read_documents(spark, str(tmp_path)))
    got = {}
    for r in metadata.scan_channel_meta(docs, "text", ["path"]).collect():
        got.setdefault(r.path[5], {})[r.channel_index] = r.channel_name
    assert got == {"a": {0: "x", 1: "Channel_1"}, "b": {0: "q & r", 1: "Channel_1"}, "d": {0: "t"}}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("t1", "WT", 1.0), ("t2", "KO", 2.0)], "tissue_id string, condition string, v double")
    tables.write_per_key(df, str(tmp_path / "per"), ["tissue_id", "condition"])
    assert (tmp_path / "per" / "tissue_id=t1" / "condition=WT").is_dir()
    assert spark.read.parquet(str(tmp_path / "per")).count() == 2
    tables.write_tsv(df, str(tmp_path / "tsv"))
    tables.write_summary(df, str(tmp_path / "csv"))
    assert spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "tsv")).columns == df.columns
    profile = spark.createDataFrame([("1", 3, [("a", 1.5)], [("b", -1.0)], {"a": 50.0})],
                                    "cluster string, n bigint, high array<struct<marker:string,z:double>>, "
                                    "low array<struct<marker:string,z:double>>, pct_pos map<string,double>")
    calls = spark.createDataFrame([("1", "T cell", "low", "why"), ("7", "none such", "low", "no")], "cluster string, label string, confidence string, reason string")
    tables.write_audit_json(profile, calls, str(tmp_path / "audit"))
    doc = json.loads(spark.read.text(str(tmp_path / "audit")).first().value)
    assert doc["profiles"][0]["high"] == [{"marker": "a", "z": 1.5}] and [c["label"] for c in doc["calls"]] == ["T cell", "none such"]


def test_arrivals_are_handled_once(spark, tmp_path):
    schema = RAW_CELL_SCHEMA
    folder, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    head = ",".join(schema.names) + "\n"

    def go():
        stream = arriving_files(spark, folder, schema, "*mesmer_result.csv")
        work_off(stream, lambda b: tables.canonical_cells(b, ["WT"]), out, state)
        return sorted(r.image_id for r in spark.read.parquet(out).collect())

    write(tmp_path / "in" / "s" / "WT_a_mesmer_result.csv", head + "1,1,1,1,,,,,1\n")
    assert go() == ["WT_a"]
    write(tmp_path / "in" / "s" / "WT_b_mesmer_result.csv", head + "1,1,1,1,,,,,1\n")
    assert go() == ["WT_a", "WT_b"]
    assert go() == ["WT_a", "WT_b"]


def test_whole_analysis(spark):
    """All plans in a row on the line items of a few images."""
    from workload.views import MARKERS, areas, cells, patients
    sf = "/root/testdata/sf0.001"
    raw = cells(spark, sf).dropDuplicates(["image_id", "cell_id"]).drop("matched")
    done = spark.createDataFrame([("core3", "DII")], "tissue_id string, condition string")
    ready = preprocess(raw.drop("cell_type"), manifest=done)
    status = {r.status: r["count"] for r in ready.stats.groupBy("status").count().collect()}
    assert status == {"PROCESSED": 9, "SKIPPED": 1}
    classes = {r.classification: r["count"] for r in ready.classified.groupBy("classification").count().collect()}
    assert classes["Included"] == ready.cells.count() and sum(classes.values()) == raw.where("image_id <> 'reg003'").count()
    typed = type_by_rules(raw.drop("cell_type"), Typing(MARKERS, ["l_quantity"], gate_multiplier=-1.0),
                          parse_rules({"a": {"required": ["l_tax_pos"]}, "b": {"required": ["l_discount_pos"]}}))
    assert typed.thresholds.count() == 3 and typed.counts.count() >= 2
    search = TriadSearch(30.0, 1.0, "A", "N", "R", {"A": "first"})
    found = analyse_triads(raw, search, areas(spark, sf), ["CLR", "DII"])
    total = found.triads.count()
    assert total > 600 and found.summary.agg(F.sum("n_triads")).first()[0] == total
    assert found.trajectory.groupBy().agg(F.max("n_triads")).first()[0] <= total
    tests = test_markers(raw, found.triads, search, {"q": "l_quantity", "gone": "absent"}, ["CLR", "DII"])
    rows = tests.collect()
    assert len(rows) == 6 and {r.bonferroni_alpha for r in rows} == {round(0.05 / 6, 8)}
    assert {r.cell_type for r in rows} == {"first", "N", "R"} and all(0 <= r.p_value <= 1 for r in rows)
    result = analyse_survival(found.summary, patients(spark, sf))
    assert result.log_rank.count() == 2 and result.condition_log_rank.count() == 2
    assert result.patients.count() == 150 and result.curves.count() > 50
