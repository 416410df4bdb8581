"""Reading cell tables, annotations and results; writing results."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.functions.names import (
    MATCHED_SUFFIX, RAW_SUFFIX, condition_prefix, detect_condition, file_name, strip_suffix, tissue_id)
from cellweave.operators.lineage import materialize
from cellweave.schema import CORRUPT, RAW_CELL_SCHEMA, col, nan_to_null

# Columns the canonical tables are made of; one that no file has is null.
REQUIRED = ("label", "x", "y", "area", "DAPI", "centroid_x", "centroid_y", "cell_type")

# The first encoding tried, and the one that reads any bytes and so ends the search.
FIRST_ENCODING = "UTF-8"
LAST_ENCODING = "ISO-8859-1"

MATCHED_CELL_SCHEMA = T.StructType([
    T.StructField("cell_id", T.StringType()), T.StructField("centroid_x", T.DoubleType()),
    T.StructField("centroid_y", T.DoubleType()), T.StructField("cell_type", T.StringType()),
    T.StructField("matched", T.BooleanType())])

PATIENT_SCHEMA = T.StructType([
    T.StructField("Patient", T.LongType()), T.StructField("Group", T.IntegerType()),
    T.StructField("TMA spot / region", T.StringType()),
    T.StructField("OS", T.DoubleType()), T.StructField("OS_Censor", T.IntegerType()),
    T.StructField("DFS", T.DoubleType()), T.StructField("DFS_Censor", T.IntegerType())])


def spread(scan: DataFrame) -> DataFrame:
    """Spread a plain scan of a few files over all cores before costly work on its rows.

    Tables with at least one split per core are returned as they are.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def with_markers(schema: T.StructType, markers: list[str]) -> T.StructType:
    """A fixed schema followed by one double column per marker."""
    return T.StructType([*schema.fields, *[T.StructField(m, T.DoubleType()) for m in markers]])


# Files listed with their kind and names that are broadcast to the lines; more are joined by a shuffle.
MOST_FILES = 500_000
# Column of what the path of a line's file tells, found out once for each file.
OF_FILE = "of_file"

# What became of a file.
READABLE, EMPTY, UNREADABLE = "OK", "EMPTY", "ERROR"


def _matching(spark: SparkSession, glob: str, fmt: str):
    return spark.read.format(fmt).option("recursiveFileLookup", True).option("pathGlobFilter", glob)


def _one_slash(uri: Column) -> Column:
    """Local files are written with one slash or three."""
    # A pattern would take longer than the rest for every line, so the usual forms go without.
    return (F.when(~uri.startswith("file:/"), uri)
            .when(uri.startswith("file:///") & (F.substring(uri, 9, 1) != "/"), F.concat(F.lit("file:"), F.substring(uri, 8, 1 << 30)))
            .otherwise(F.regexp_replace(uri, "^file:/+", "file:/")))


def literal_path(path: str) -> str:
    """A path in which no character stands for others."""
    return re.sub(r"([\\*?{}\[\]])", r"\\\1", path)


def file_status(spark: SparkSession, path: str | list[str], glob: str) -> DataFrame:
    """(file_path, status, encoding, header): one row for every matching file, under one path or several.

    One reading of the lines gives a file's first line and whether all its bytes are UTF-8; a
    file without is Latin-1. Files that cannot be read have no lines and stay in the list.
    """
    lines = _matching(spark, glob, "text").option("ignoreCorruptFiles", True).load(path)
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    # Most lines begin with a character that is not blank, which needs no pattern.
    written = (F.ascii("value") > 32) | F.col("value").rlike(r"[^\x00-\x20]")
    seen = (lines.select(F.col("_metadata.file_path").alias("file_path"), "value", place.alias("place"))
            .groupBy("file_path").agg(F.coalesce(F.min_by("value", F.when(written, F.col("place"))), F.lit("")).alias("first"), F.bool_and(F.is_valid_utf8("value")).alias("is_utf8"))
            .withColumn("file_path", _one_slash(F.col("file_path"))))
    found = _matching(spark, glob, "binaryFile").load(path)
    # The listing itself also has the files without a byte.
    # All names in one text: they would come to Python one by one.
    names = spark._jvm.org.apache.hadoop.util.StringUtils.join("\0", found._jdf.inputFiles())
    listed = spark.createDataFrame([(f,) for f in names.split("\0") if f], "file_path string").select(_one_slash(F.col("file_path")).alias("file_path"))
    sizes = found.select(_one_slash(F.col("_metadata.file_path")).alias("file_path"), "length")
    every = listed.join(sizes, "file_path", "left")
    encoding = F.when(F.col("is_utf8"), FIRST_ENCODING).otherwise(LAST_ENCODING)
    header = F.when(F.col("is_utf8"), F.col("first")).otherwise(F.decode(F.col("first").cast("binary"), LAST_ENCODING))
    return (every.join(seen, "file_path", "left")
            .select("file_path",
                    F.when(F.col("first").isNotNull(), READABLE).when(F.coalesce("length", F.lit(0)) == 0, EMPTY).otherwise(UNREADABLE).alias("status"),
                    F.when(F.col("first").isNotNull(), encoding).alias("encoding"),
                    F.regexp_replace(F.regexp_replace(header, "^\ufeff", ""), r"\r$", "").alias("header")))


def _columns(header: str, sep: str) -> list[str]:
    return next(csv.reader([header], delimiter=sep), [])


def read_delimited(spark: SparkSession, path: str | list[str], fixed: T.StructType, glob: str, sep: str = ",",
                   encoding: str | None = None, of_file: dict[str, Column] | None = None) -> DataFrame:
    """Files with a header under a folder, by column name.

    Lines are parsed by the header and encoding of their file, each file once; columns have the
    fixed type of their name, others are numbers, and a column a file lacks is null. Lines that
    do not fit are kept in ``CORRUPT``; empty and unreadable files are listed by file_status.
    ``of_file``, expressions of ``file_path``, are computed once a file and come as fields of ``OF_FILE``.
    The driver holds the files' names, as Spark's own listing does, and one line per kind of file.
    """
    return read_listed(spark, path, glob, file_status(spark, path, glob), fixed, sep, encoding, of_file)


def read_listed(spark: SparkSession, path: str | list[str], glob: str, status: DataFrame, fixed: T.StructType, sep: str = ",",
                encoding: str | None = None, of_file: dict[str, Column] | None = None) -> DataFrame:
    """The readable files of the path, listed by file_status, by column name."""
    named = [F.struct(*[c.alias(n) for n, c in of_file.items()]).alias(OF_FILE)] if of_file else []
    coding = F.lit(encoding) if encoding else F.col("encoding")
    files = materialize(status.where(F.col("status") == READABLE).select("file_path", "header", coding.alias("encoding"), *named))
    kinds = sorted(tuple(k) for k in files.select("header", "encoding").distinct().collect())
    known = {f.name: f for f in fixed.fields}
    schemas = [T.StructType([known.get(c, T.StructField(c, T.DoubleType())) for c in _columns(header, sep)]) for header, _ in kinds]
    columns: dict[str, T.StructField] = {}
    for f in [f for schema in schemas for f in schema.fields] + [f for f in fixed.fields if not kinds or f.name in REQUIRED]:
        seen = columns.setdefault(f.name.lower(), f)
        if seen.dataType != f.dataType:  # names that differ in case only
            wider = T.StringType() if T.StringType() in (seen.dataType, f.dataType) else T.DoubleType()
            columns[f.name.lower()] = T.StructField(seen.name, wider)
    bad = T.StructField(CORRUPT, T.StringType())
    every = [*columns.values(), bad]
    if not kinds:
        of_paths = [T.StructField("file_path", T.StringType()), *[f for f in files.schema.fields if f.name == OF_FILE]]
        return spark.createDataFrame([], T.StructType([*every, *of_paths]))

    def parsed(schema: T.StructType) -> Column:
        own = {f.name.lower(): f.name for f in [*schema.fields, bad]}
        ddl = ", ".join("`{}` {}".format(f.name.replace("`", "``"), f.dataType.simpleString()) for f in [*schema.fields, bad])
        fields = F.from_csv("line", ddl, {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "nanValue": "nan"})
        # An array of one, so that a line is parsed once however many columns are taken out.
        return F.transform(F.array(fields), lambda r: F.struct(*[
            (r.getField(own[f.name.lower()]) if f.name.lower() in own else F.lit(None)).cast(f.dataType).alias(f.name) for f in every]))

    codings = sorted({e for _, e in kinds})
    encoding = codings[0] if len(codings) == 1 else None
    numbers = spark.createDataFrame([(*k, n) for n, k in enumerate(kinds)], "header string, encoding string, kind int")
    listed = files.join(F.broadcast(numbers), ["header", "encoding"]).drop("header")
    lines = _lines(spark, path, glob, encoding or LAST_ENCODING).join(F.broadcast(listed) if files.count() <= MOST_FILES else listed, "file_path")
    if not encoding:
        # Files of both kinds: Latin-1 gives every byte a character, so the bytes of UTF-8 are found again.
        again = F.encode("line", LAST_ENCODING).cast("string")
        lines = lines.withColumn("line", F.when(F.col("encoding") == FIRST_ENCODING, again).otherwise(F.col("line")))
    row = reduce(lambda out, n: out.when(F.col("kind") == n, parsed(schemas[n])), range(1, len(kinds)), F.when(F.col("kind") == 0, parsed(schemas[0])))
    return lines.select(F.inline(row), "file_path", *[OF_FILE for _ in named])


def _lines(spark: SparkSession, path: str | list[str], glob: str, encoding: str) -> DataFrame:
    """(line, file_path): the lines under each file's header that are not blank."""
    shape = T.StructType([T.StructField("line", T.StringType()), T.StructField(CORRUPT, T.StringType())])
    # A separator that text does not have; a line that has it is kept whole as one that does not fit.
    reader = (_matching(spark, glob, "csv").schema(shape).option("header", True).option("sep", "\x01").option("quote", "")
              .option("encoding", encoding).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
              .option("columnPruning", False).option("enforceSchema", True).option("ignoreCorruptFiles", True))
    return reader.load(path).select(F.coalesce(CORRUPT, "line").alias("line"), _one_slash(F.col("_metadata.file_path")).alias("file_path"))


def well_formed(raw: DataFrame) -> DataFrame:
    """Lines that fit their columns; ``malformed`` has the others."""
    return raw.where(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in raw.columns else raw


def malformed(raw: DataFrame) -> DataFrame:
    """Lines that do not fit, with their file."""
    return raw.where(F.col(CORRUPT).isNotNull()).select("file_path", CORRUPT)


def raw_cells(spark: SparkSession, path: str, encoding: str | None = None, of_file: dict[str, Column] | None = None) -> DataFrame:
    """All lines of every ``*mesmer_result.csv``, well formed or not."""
    text_columns = [T.StructField("image_ID", T.StringType()), T.StructField("slide_folder", T.StringType())]
    return read_delimited(spark, path, T.StructType([*RAW_CELL_SCHEMA.fields, *text_columns]), "*" + RAW_SUFFIX, encoding=encoding, of_file=of_file)


def scan_cells(spark: SparkSession, path: str, conditions: list[str], encoding: str | None = None) -> DataFrame:
    """Raw cells of every ``*mesmer_result.csv`` in the slide folders, in canonical columns."""
    return canonical_cells(raw_cells(spark, path, encoding, _cell_names(conditions)), conditions)


def image_name(file_path: Column) -> Column:
    """Image id in the path of a file of raw cells."""
    return strip_suffix(file_name(F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))), "_" + RAW_SUFFIX, RAW_SUFFIX)


def unread_images(spark: SparkSession, path: str) -> DataFrame:
    """(image_id) of the files of raw cells that are empty or could not be read."""
    lost = file_status(spark, path, "*" + RAW_SUFFIX).where(F.col("status") != READABLE)
    return lost.select(image_name(F.col("file_path")).alias("image_id"))


def _plain_path() -> Column:
    """File path without URI escapes."""
    return F.url_decode(F.replace(F.col("file_path"), F.lit("+"), F.lit("%2B")))


def _cell_names(conditions: list[str]) -> dict[str, Column]:
    """Image, slide, condition and tissue from the path of a file of raw cells."""
    name = strip_suffix(file_name(_plain_path()), "_" + RAW_SUFFIX, RAW_SUFFIX)
    return {"image_id": name, "slide_folder": F.regexp_extract(_plain_path(), r"([^/]+)/[^/]*$", 1),
            "condition": detect_condition(name, conditions), "tissue_id": tissue_id(name, conditions)}


def canonical_cells(raw: DataFrame, conditions: list[str]) -> DataFrame:
    """Image, slide, condition and tissue from the file path; canonical column names."""
    names = _cell_names(conditions)
    rows = well_formed(raw).drop("image_ID", "slide_folder")
    rows = rows.withColumns({n: F.col(f"{OF_FILE}.{n}") if OF_FILE in raw.columns else c for n, c in names.items()})
    rows = rows.withColumn("cell_id", F.col("label").cast("string"))
    return nan_to_null(rows.withColumnRenamed("DAPI", "dapi").drop("file_path", OF_FILE))


def scan_matched(spark: SparkSession, path: str, conditions: list[str], explicit: DataFrame | None = None,
                 matched_only: bool = True, encoding: str | None = None) -> DataFrame:
    """Typed cells of every ``*_matched_with_boundaries.csv``; hidden files are not read."""
    raw = read_delimited(spark, path, MATCHED_CELL_SCHEMA, "*" + MATCHED_SUFFIX, encoding=encoding, of_file=_matched_names())
    return canonical_matched(raw, conditions, explicit, matched_only)


def _matched_names() -> dict[str, Column]:
    return {"image_id": strip_suffix(file_name(_plain_path()), MATCHED_SUFFIX)}


def canonical_matched(raw: DataFrame, conditions: list[str], explicit: DataFrame | None = None,
                      matched_only: bool = True) -> DataFrame:
    """Image and condition from the file path; canonical column names; matched cells."""
    image = F.col(f"{OF_FILE}.image_id") if OF_FILE in raw.columns else _matched_names()["image_id"]
    rows = well_formed(raw).withColumn("image_id", image).withColumnsRenamed({"centroid_x": "x", "centroid_y": "y"}).drop("file_path", OF_FILE)
    if "cell_id" not in rows.columns:
        rows = rows.withColumn("cell_id", F.lit(None).cast("string"))
    # Where a file gives no id, place and type name a cell, and its number among equal ones.
    spot = Window.partitionBy("image_id", "x", "y", "cell_type").orderBy(*[col(c) for c in rows.columns if c not in ("image_id", "x", "y", "cell_type")])
    named = F.concat(F.sha2(F.concat_ws("|", F.col("x").cast("string"), F.col("y").cast("string"), F.coalesce("cell_type", F.lit(""))), 256),
                     F.lit("-"), F.row_number().over(spot).cast("string"))
    unnamed = rows.where("cell_id is null").withColumn("cell_id", named)
    rows = unnamed if "cell_id" not in raw.columns else rows.where("cell_id is not null").unionByName(unnamed)
    rows = nan_to_null(assign_condition(rows, conditions, explicit))
    return filter_matched(rows, matched_only)


def assign_condition(rows: DataFrame, conditions: list[str], explicit: DataFrame | None = None) -> DataFrame:
    """Condition of each image: the explicit map (image_id, mapped_condition) first, then prefix."""
    if explicit is None:
        return rows.withColumn("condition", condition_prefix(F.col("image_id"), conditions))
    mapped = explicit.select("image_id", F.col("condition").alias("mapped_condition"))
    return (rows.join(mapped, "image_id", "left")
            .withColumn("condition", condition_prefix(F.col("image_id"), conditions, F.col("mapped_condition")))
            .drop("mapped_condition"))


def filter_matched(cells: DataFrame, matched_only: bool = True) -> DataFrame:
    """Matched cells only, where that is asked for and the column exists."""
    return cells.where(F.col("matched")) if matched_only and "matched" in cells.columns else cells


def image_files(spark: SparkSession, path: str) -> DataFrame:
    """Image ids of the matched-cell files, with or without rows."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*" + MATCHED_SUFFIX).load(path).select("path"))
    return files.select(strip_suffix(file_name(F.col("path")), MATCHED_SUFFIX).alias("image_id")).distinct()


def scan_flagged(cells: DataFrame, triads: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Flagged cells with the triads of their images; an absent triad table means none."""
    if triads is None:
        none = cells.select("image_id").where(F.lit(False)).withColumns({
            c: F.lit(None).cast(t) for c, t in (
                ("anchor_cell_id", "string"), ("partner1_cell_id", "string"), ("partner2_cell_id", "string"),
                ("dist_anchor_p1_um", "double"), ("dist_anchor_p2_um", "double"))})
        return cells, none
    images = cells.select("image_id").distinct()
    return cells, triads.join(images, "image_id", "left_semi")


def _patient_lines(spark: SparkSession, path: str) -> DataFrame:
    """Patient lines with typed columns, and ``fits``: whether every typed value could be read."""
    known = {f.name: f.dataType for f in PATIENT_SCHEMA.fields if not isinstance(f.dataType, T.StringType)}
    raw = spark.read.option("header", True).csv(path)
    text = lambda c: F.nullif(F.trim(col(c)), F.lit(""))
    # Tables saved with missing numbers hold 1.0 where 1 is meant.
    read = {c: text(c).try_cast("double") for c in raw.columns if c in known}
    fits = reduce(lambda a, b: a & b, [text(c).isNull() | number.isNotNull() for c, number in read.items()], F.lit(True))
    return raw.select(*[read[c].cast(known[c]).alias(c) if c in read else col(c) for c in raw.columns], fits.alias("fits"))


def scan_patients(spark: SparkSession, path: str) -> DataFrame:
    """Patient annotation with typed columns; others stay text. Lines that fit no type are left to bad_patients."""
    return _patient_lines(spark, path).where("fits").drop("fits")


def bad_patients(spark: SparkSession, path: str) -> DataFrame:
    """Patient lines with a value that is no number where one belongs; that value is null."""
    return _patient_lines(spark, path).where("not fits").drop("fits")


def condition_area_table(spark: SparkSession, areas: dict) -> DataFrame:
    """(condition, timepoint, area_um2) from a map of areas, flat or nested by time point."""
    rows = [(c, str(t), float(a)) for c, v in areas.items() for t, a in (v.items() if isinstance(v, dict) else [("", v)])]
    return spark.createDataFrame(rows, "condition string, timepoint string, area_um2 double")


def image_condition_table(spark: SparkSession, images: dict[str, str]) -> DataFrame:
    """(image_id, condition) from a map of images."""
    return spark.createDataFrame(sorted(images.items()), "image_id string, condition string")


def scan_roi_labels(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated region labels."""
    return spark.read.option("header", True).option("sep", "\t").csv(path)


def not_yet_done(rows: DataFrame, manifest: DataFrame, keys: tuple[str, ...] = ("tissue_id", "condition")) -> DataFrame:
    """Rows whose key is not in the manifest of finished ones."""
    done = manifest.select(*keys).distinct()
    return rows.join(done, list(keys), "left_anti")


def union_tables(parts: list[DataFrame]) -> DataFrame:
    """Tables of several images as one, by column name; a column one lacks is null there."""
    if not parts:
        raise ValueError("no table to put together")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def union_conditions(tables: dict[str, DataFrame], conditions: list[str]) -> DataFrame:
    """Tables of configured conditions and Unknown in order, relabelled by their key."""
    out = None
    for condition in [*conditions, "Unknown"]:
        if condition in tables:
            labelled = tables[condition].withColumn("condition", F.lit(condition))
            out = labelled if out is None else out.unionByName(labelled, allowMissingColumns=True)
    if out is None:
        raise ValueError("no table of any condition")
    return out


def write_files(df: DataFrame, path: str, key: str, suffix: str, encoding: str = FIRST_ENCODING) -> None:
    """One CSV file ``<key><suffix>`` per key, written line by line by one task, so a key is as many rows as one file may have.

    Tasks write files under their own names, so the driver neither lists nor moves any.
    """
    spark = df.sparkSession
    names = [c for c in df.columns if c != key]
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toUri().toString()
    head = spark.range(1).select(F.to_csv(F.struct(*[F.lit(c).alias(f"c{k}") for k, c in enumerate(names)]))).first()[0]
    # A fixed number of partitions, which are not put together where files are small.
    rows = df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), col(key)).sortWithinPartitions(col(key))
    lines = rows.select(col(key).cast("string").alias("name"), F.to_csv(F.struct(*[col(c) for c in names])).alias("line"))
    lines.mapInArrow(lambda batches: _written(batches, uri, head, suffix, encoding), "name string").count()


def _written(batches: Iterator[pa.RecordBatch], uri: str, head: str, suffix: str, encoding: str) -> Iterator[pa.RecordBatch]:
    """Files of lines in the order of their names. A file gets its name when it is whole, so a task may run again."""
    fs, folder = FileSystem.from_uri(uri)
    fs.create_dir(folder)
    attempt = TaskContext.get().taskAttemptId()
    now, out = None, None

    def finish() -> None:
        out.close()
        fs.move(f"{folder}/.{now}-{attempt}", f"{folder}/{now}{suffix}")

    for batch in batches:
        runs = pc.run_end_encode(batch.column(0))
        names, ends = runs.values.to_pylist(), runs.run_ends.to_pylist()
        for name, start, end in zip(names, [0, *ends], ends, strict=False):
            if name != now:
                if out:
                    finish()
                now, out = name, fs.open_output_stream(f"{folder}/.{name}-{attempt}")
                out.write(f"{head}\n".encode(encoding))
            out.write("".join(f"{line}\n" for line in batch.column(1).slice(start, end - start).to_pylist()).encode(encoding))
        yield pa.RecordBatch.from_pydict({"name": names})
    if out:
        finish()


def write_per_key(df: DataFrame, path: str, keys: list[str], fmt: str = "parquet", mode: str = "overwrite") -> None:
    """One folder per key value. Rows are not gathered by key, so a large key is many files."""
    writer = df.write.mode(mode).partitionBy(*keys).format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)


def write_tsv(df: DataFrame, path: str, keys: list[str] | None = None, mode: str = "overwrite") -> None:
    """Tab-separated text with a header."""
    writer = df.write.mode(mode).option("sep", "\t").option("header", True)
    (writer.partitionBy(*keys) if keys else writer).csv(path)


def write_summary(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A result table as CSV with a header."""
    df.write.mode(mode).option("header", True).csv(path)


def audit_document(profiles: DataFrame, proposals: DataFrame) -> DataFrame:
    """One row with one JSON text: the profiles of all clusters, and the proposed labels of all calls, known cluster or not.

    One entry per cluster, so the document is as small as the labelling it documents.
    """
    profile = F.struct("cluster", "n", "high", "low", "pct_pos")
    call = F.struct("cluster", "label", "confidence", "reason")
    listed = lambda df, entry, name: df.select(entry.alias("e")).agg(
        F.sort_array(F.collect_list(F.to_json("e"))).alias(name), F.lit(1).alias("one"))
    both = listed(profiles, profile, "profiles").join(listed(proposals, call, "calls"), "one")
    array = lambda name: F.concat(F.lit("["), F.array_join(name, ","), F.lit("]"))
    return both.select(F.concat(F.lit('{"profiles":'), array("profiles"), F.lit(',"calls":'), array("calls"), F.lit("}")).alias("value"))


def write_audit_json(profiles: DataFrame, proposals: DataFrame, path: str, mode: str = "overwrite") -> None:
    audit_document(profiles, proposals).select("value").write.mode(mode).text(path)
