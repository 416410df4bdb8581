"""Working off files as they arrive: what was done once is not done again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.sources.tables import file_status, literal_path, read_listed, well_formed

# Fixed value: what Spark's listing of files has.
_LISTED = "path string, modificationTime timestamp, length bigint, content binary"


def arriving_files(spark: SparkSession, path: str, schema: T.StructType, glob: str,
                   files_per_batch: int | None = None) -> DataFrame:
    """Files with a header under a folder as a stream of rows.

    Columns are taken by place, so a file whose header names others, or in another order, ends the stream with an error.
    """
    reader = (spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
              .option("recursiveFileLookup", True).option("pathGlobFilter", glob))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(path).selectExpr("*", "_metadata.file_path AS file_path")


def work_off(stream: DataFrame, handle: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> None:
    """Handle everything that has arrived since the last call, then stop.

    The stream's checkpoint remembers the files. Images are independent, so a batch needs no
    state; it is written under its own number, and a repeated batch replaces itself.
    """
    def write(batch: DataFrame, number: int) -> None:
        handle(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def arriving_names(spark: SparkSession, path: str, glob: str, files_per_batch: int | None = None) -> DataFrame:
    """Names of files under a folder as a stream; nothing of their content is read. Files without a byte are passed over."""
    reader = spark.readStream.format("binaryFile").schema(_LISTED).option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select("path")


def work_off_files(names: DataFrame, fixed: T.StructType, glob: str, handle: Callable[[DataFrame], DataFrame], out: str,
                   checkpoint: str, sep: str = ",") -> None:
    """Handle the files that have arrived since the last call by column name, then stop.

    A batch's files are read in groups of one header and one encoding, so their columns may come in any order and number.
    Its rows go to ``out/rows/batch=N``, then its list of files to ``out/files/batch=N``: a batch counts when it is in that
    list. One that failed on the way is handled again under the same number and replaces what it left.
    """
    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        paths = [literal_path(r["path"]) for r in batch.distinct().collect()]
        status = file_status(spark, paths, glob)
        rows = handle(well_formed(read_listed(spark, paths, glob, status, fixed, sep)))
        rows.write.mode("overwrite").parquet(f"{out}/rows/batch={number}")
        status.drop("header").write.mode("overwrite").parquet(f"{out}/files/batch={number}")

    (names.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def finished_files(spark: SparkSession, out: str) -> DataFrame:
    """(file_path, status, encoding, batch) of every file of a finished batch; also those that could not be read."""
    return spark.read.parquet(f"{out}/files")


def finished_rows(spark: SparkSession, out: str) -> DataFrame:
    """Rows of finished batches, a column that a batch lacks null there. A batch without its list of files is left out."""
    rows = spark.read.option("mergeSchema", True).parquet(f"{out}/rows")
    return rows.join(F.broadcast(finished_files(spark, out).select("batch").distinct()), "batch", "left_semi")
