"""Arriving files read by column name, and a batch that fails half way."""

import pytest
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from cellweave.sources.tables import FIRST_ENCODING, LAST_ENCODING
from cellweave.streaming import arrivals

FIXED = StructType([StructField("image_id", StringType())])


def test_files_of_any_header_and_a_batch_that_fails(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    (folder / "deep").mkdir(parents=True)

    def work(handle=lambda b: b.drop("file_path")):
        names = arrivals.arriving_names(spark, str(folder), "*.csv", 3)
        arrivals.work_off_files(names, FIXED, "*.csv", handle, out, state)

    def rows():
        return sorted((r.image_id, r.CD3, r.CD8) for r in arrivals.finished_rows(spark, out).collect())

    (folder / "a.csv").write_text("image_id,CD3,CD8\na,3,8\n")
    (folder / "deep" / "b [1] 5%41.csv").write_text("CD8,image_id,CD3\n8,b,3\n7,b,x\n")
    (folder / "c.csv").write_bytes("CD8,image_id\n8,é\n".encode("latin-1"))
    (folder / "d.csv").write_text("")
    (folder / "skipped.txt").write_text("image_id\nz\n")
    work()
    first = [("a", 3.0, 8.0), ("b", 3.0, 8.0), ("é", None, 8.0)]
    assert rows() == first
    files = {r.file_path.split("/")[-1][0]: (r.status, r.encoding) for r in arrivals.finished_files(spark, out).collect()}
    assert files == {"a": ("OK", FIRST_ENCODING), "b": ("OK", FIRST_ENCODING), "c": ("OK", LAST_ENCODING)}

    (folder / "e.csv").write_text("CD3,CD8,image_id\n1,2,e\n")

    def fails(batch):
        # Rows of a batch that ends before its files are listed.
        batch.limit(0).write.mode("overwrite").parquet(f"{out}/rows/batch=99")
        raise RuntimeError("lost")
    with pytest.raises(Exception):
        work(fails)
    assert rows() == first
    work()
    assert rows() == [*first[:2], ("e", 1.0, 2.0), first[2]]
    work()
    assert rows() == [*first[:2], ("e", 1.0, 2.0), first[2]]
    assert arrivals.finished_files(spark, out).count() == 4
