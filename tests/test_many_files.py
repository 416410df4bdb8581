"""Files of cells: work of the driver that does not grow with their number, and names found once a file."""

from cellweave.schema import CORRUPT
from cellweave.sources import tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_files_are_read_by_folder_and_named_once(spark, tmp_path):
    rows = spark.range(600).selectExpr("concat('WT_', id % 20) AS image", "id AS label", "id AS x", "2 AS y", "'a,\"b' AS note")
    tables.write_files(rows, str(tmp_path / "slide 1"), "image", "_mesmer_result.csv")
    names = sorted(f.name for f in (tmp_path / "slide 1").iterdir())
    assert names == sorted(f"WT_{k}_mesmer_result.csv" for k in range(20))
    lines = (tmp_path / "slide 1" / "WT_7_mesmer_result.csv").read_text().splitlines()
    assert lines[0] == "label,x,y,note" and sorted(lines[1:]) == sorted(f'{k},{k},2,"a,\\"b"' for k in range(7, 600, 20))
    cells = tables.scan_cells(spark, str(tmp_path), ["WT"]).drop("note")
    # One folder in the plan, not a path a file, and no name is taken apart for every line.
    assert "(1 paths)" in plan(cells) and "(20 paths)" not in plan(cells) and "url_decode" not in plan(cells).lower()
    assert tables.malformed(tables.raw_cells(spark, str(tmp_path))).count() == 600  # the note is no number
    (tmp_path / "m").mkdir()
    tables.write_files(rows.drop("note"), str(tmp_path / "m"), "image", tables.RAW_SUFFIX, "ISO-8859-1")
    got = tables.scan_cells(spark, str(tmp_path / "m"), ["WT"]).collect()
    assert sorted((r.image_id, r.slide_folder, r.condition, int(r.cell_id), r.x) for r in got) == sorted(
        (f"WT_{k % 20}", "m", "WT", k, float(k)) for k in range(600))


def test_odd_lines_keep_their_bytes(spark, tmp_path):
    head = "cell_id,centroid_x,centroid_y,cell_type\n"
    (tmp_path / "a_matched_with_boundaries.csv").write_bytes(("\n \n" + head + 'é,1,2,"x, ""y"\n\n\x01,1,2,T\n' + head).encode())
    (tmp_path / "b_matched_with_boundaries.csv").write_bytes((head + "é,1,2,T\r\nq,1\n").encode("latin-1"))
    (tmp_path / "c_matched_with_boundaries.csv").write_bytes(b"\n\n")
    got = sorted((r.image_id, r.cell_id, r.x, r.cell_type) for r in tables.scan_matched(spark, str(tmp_path), []).collect())
    # Quotes are read as Spark's own reader reads them.
    quoted = spark.read.csv(spark.sparkContext.parallelize(['é,1,2,"x, ""y"'])).first()[3]
    assert got == [("a", "\x01", 1.0, "T"), ("a", "é", 1.0, quoted), ("b", "é", 1.0, "T")]
    raw = tables.read_delimited(spark, str(tmp_path), tables.MATCHED_CELL_SCHEMA, "*.csv")
    assert sorted(r[CORRUPT] for r in tables.malformed(raw).collect()) == [head.strip(), "q,1"]


def test_matched_cells_are_named_once_a_file(spark, tmp_path):
    rows = spark.range(60).selectExpr("concat('KO_', id % 3) AS image", "id AS centroid_x", "1 AS centroid_y", "'T' AS cell_type")
    tables.write_files(rows, str(tmp_path), "image", tables.MATCHED_SUFFIX)
    cells = tables.scan_matched(spark, str(tmp_path), ["KO"])
    assert "(1 paths)" in plan(cells) and "(3 paths)" not in plan(cells) and "url_decode" not in plan(cells).lower()
    assert sorted((r.image_id, r.condition, r.x) for r in cells.collect()) == sorted((f"KO_{k % 3}", "KO", float(k)) for k in range(60))


def test_lines_and_paths_of_the_usual_form_go_without_patterns_and_second_decoding(spark, tmp_path):
    paths = ["file:///a/b", "file:/a/b", "file:////a", "file://///a/file:/b", "file:", "file:/", "s3a://k/file:///a", "/a//b", "hdfs://n/a"]
    same = spark.createDataFrame([(p,) for p in paths], "p string").selectExpr("p", "regexp_replace(p, '^file:/+', 'file:/') AS q")
    assert all(r.q == r.got for r in same.withColumn("got", tables._one_slash(same.p)).collect())
    head = "cell_id,centroid_x,centroid_y,cell_type\n"
    for name, text in (("a", "\ufeff" + head + "ß,1,2,é\n"), ("b", "\x1f \t\n" + head + "\n𝒳,3,4,T\n")):
        (tmp_path / f"{name}_matched_with_boundaries.csv").write_bytes(text.encode())
    cells = tables.scan_matched(spark, str(tmp_path), [])
    # All files are UTF-8, so lines are read as that at once.
    assert "encode(" not in plan(cells).lower()
    assert sorted((r.image_id, r.cell_id, r.x) for r in cells.collect()) == [("a", "ß", 1.0), ("b", "𝒳", 3.0)]
    (tmp_path / "c_matched_with_boundaries.csv").write_bytes((head + "ß,5,6,é\n").encode("latin-1"))
    both = tables.scan_matched(spark, str(tmp_path), [])
    assert sorted((r.image_id, r.cell_id, r.x) for r in both.collect()) == [("a", "ß", 1.0), ("b", "𝒳", 3.0), ("c", "ß", 5.0)]
