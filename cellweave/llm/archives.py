"""Legacy archives (ARC) converted to WARC, and both formats written and read.

An ARC file begins with a version block whose last line names the fields of the records' header lines; the parser follows
it (versions 1 and 2), takes the block by its declared length, and goes on at the next header line. Fields are taken from
the right, since a legacy address may hold spaces. From each record the converter makes a WARC identifier (from the file
and the place in it), date, type and SHA-256 digests. Records whose payload of at least ``least`` bytes is equal to an
earlier one become revisits of it.

One file is one row of Spark's binary reader and is parsed as a stream: a task holds the packed file, one record and one
batch. Files are written by Spark's text writer, one row per record, whose line separator is the record separator of the
format; the first row of a partition carries the file's own first record. Files are as large as the partitions that are
written. What equal payloads revisit is decided on digests alone; the decisions return to the records by a broadcast up to
a counted bound and by a shuffle beyond it.

Defined cases: a null payload is empty; a null address is ``unknown:``; white space in an address is written as ``%20``; a
header line that does not parse is skipped up to the next that does; a block cut off by the end of its file is kept as
far as it goes and marked ``WARC-Truncated``, as is a block in a compressed file that is cut off or damaged: what comes before
the damage is read, the rest of that file is not; a file has to fit into one task, and cannot be over 2 GB; repeated rows are records of their own, the first is the response; records
without a rank come after those with one; an empty table gives archives without a record.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import hinted, stored
from cellweave.operators.lineage import owned_folder

# Fixed values of the formats.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
ARC_ORIGIN = {1: "1 0 ConversionTest", 2: "2 0 ConversionTest"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
WARC_VERSION = "WARC/1.0"
CRLF = "\r\n"

LEAST_PAYLOAD = 100
RANK_HEADER = "X-Page-Id"
_BATCH_BYTES = 8 << 20
_LENGTH = re.compile(rb"\d{1,18}\Z")
_DATE = re.compile(rb"\d{8,17}\Z")


# Reading: streams of one file.

class _Readable(io.RawIOBase):
    """A compressed file up to its end or to where it is damaged."""

    def __init__(self, content: bytes):
        self.file = gzip.GzipFile(fileobj=io.BytesIO(content))

    def readable(self) -> bool:
        return True

    def readinto(self, room) -> int:
        try:
            part = self.file.read1(len(room))
        except (EOFError, OSError, zlib.error):
            return 0
        room[:len(part)] = part
        return len(part)


def _opened(content: bytes) -> io.BufferedReader:
    packed = content[:2] == b"\x1f\x8b"
    return io.BufferedReader(_Readable(content) if packed else io.BytesIO(content), 1 << 18)


def _whole(stream: io.BufferedReader, n: int) -> bytes:
    parts, left = [], n
    while left and (part := stream.read(min(left, 1 << 24))):
        parts.append(part)
        left -= len(part)
    return b"".join(parts)


def arc_records(content: bytes) -> Iterator[dict]:
    """The records of one ARC file after its version block: ``place``, fields by name, ``block``, ``truncated``."""
    stream, place, fields = _opened(content), 0, ARC_FIELDS[1]
    while line := stream.readline():
        start, place = place, place + len(line)
        if line.startswith(b"filedesc:"):
            parts = line.split()
            if len(parts) >= len(ARC_FIELDS[1]) and _LENGTH.match(parts[-1]):
                about = _whole(stream, int(parts[-1]))
                place += len(about)
                names = about.decode("utf-8", "replace").splitlines()[1:2]
                if names and names[0].split()[-1:] == ["Archive-length"]:
                    fields = names[0].split()
            continue
        parts = line.rstrip(b"\r\n").rsplit(b" ", len(fields) - 1)
        named = dict(zip(fields, parts, strict=False))
        if len(parts) != len(fields) or not _LENGTH.match(parts[-1]) or not _DATE.match(named.get("Archive-date", b"")):
            continue
        declared = int(parts[-1])
        block = _whole(stream, declared)
        place += len(block)
        yield {"place": start, "block": block, "truncated": len(block) < declared,
               **{k: v.decode("utf-8", "replace") for k, v in named.items()}}


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record of one WARC file."""
    stream = _opened(content)
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        fields: dict[str, str] = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.partition(b":")
            fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
        length = fields.get("content-length", "0")
        yield fields, _whole(stream, int(length) if length.isdigit() else 0)


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """The head of an HTTP response with its closing empty line, and the payload; no head where there is none."""
    if block[:5] != b"HTTP/":
        return b"", block
    at = block.find(b"\r\n\r\n")
    return (block, b"") if at < 0 else (block[:at + 4], block[at + 4:])


def http_field(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode("utf-8", "replace").strip() if found else None


def _date(legacy: str) -> str:
    """14 digits as a WARC date; missing digits are the earliest time."""
    d = (legacy + "00000101000000"[len(legacy):])[:14] if len(legacy) < 14 else legacy[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _number(text: str | None) -> int | None:
    """A whole number in the range of a long."""
    number = int(text) if text and re.fullmatch(r"-?[0-9]{1,19}", text) else None
    return number if number is not None and -(1 << 63) <= number < 1 << 63 else None


CONVERTED = ("record_id string, kind string, uri string, date string, ip string, mime string, head binary, payload binary, "
             "payload_bytes bigint, payload_digest string, block_digest string, truncated boolean, rank bigint")


def _converted(path: str, content: bytes, with_payload: bool, rank_header: str) -> Iterator[tuple]:
    name = path.rsplit("/", 1)[-1]
    for r in arc_records(content):
        head, payload = split_http(r["block"])
        web = r["URL"].split(":", 1)[0].lower() in ("http", "https") or bool(head)
        yield (str(uuid.uuid5(uuid.NAMESPACE_URL, f"{name}#{r['place']}")), "response" if web and head else "resource", r["URL"],
               _date(r["Archive-date"]), r["IP-address"], r["Content-type"], head if with_payload else None,
               payload if with_payload else None, len(payload), hashlib.sha256(payload).hexdigest(),
               hashlib.sha256(r["block"]).hexdigest() if with_payload else None, r["truncated"], _number(http_field(head, rank_header)))


def _batched(rows: Iterator[tuple], columns: list[str], weight: int | None) -> Iterator[pd.DataFrame]:
    """Data frames of bounded size; ``weight`` is the place of the large value."""
    batch, size = [], 0
    for row in rows:
        batch.append(row)
        size += 500 + len((row[weight] if weight is not None else None) or b"")
        if size > _BATCH_BYTES:
            yield pd.DataFrame(batch, columns=columns)
            batch, size = [], 0
    if batch:
        yield pd.DataFrame(batch, columns=columns)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def read_arc(spark: SparkSession, path: str, with_payload: bool = True, rank_header: str = RANK_HEADER) -> DataFrame:
    """The records of a folder of ARC files, converted: ``CONVERTED``; ``rank`` is the number in an HTTP field."""
    columns = [c.split()[0] for c in CONVERTED.split(", ")]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"], strict=True):
                rows = _converted(file, content, with_payload, rank_header)
                for out in _batched(rows, columns, columns.index("payload")):
                    out["rank"] = out["rank"].astype("Int64")
                    yield out

    return _files(spark, path).mapInPandas(parse, CONVERTED)


WARC_ROWS = ("record_id string, record_type string, uri string, date string, payload_bytes bigint, payload_digest string, "
             "refers_to_id string, rank bigint, payload binary, intact boolean")


def read_warc(spark: SparkSession, path: str, with_payload: bool = True, rank_header: str = RANK_HEADER) -> DataFrame:
    """The records of a folder of WARC files but for the files' own: ``WARC_ROWS``.

    A response's digest and length are taken from the payload that was read, and ``intact`` says whether the header
    agrees; a revisit's are the header's.
    """
    columns = [c.split()[0] for c in WARC_ROWS.split(", ")]

    def rows_of(content: bytes) -> Iterator[tuple]:
        for fields, block in warc_records(content):
            kind = fields.get("warc-type")
            if kind == "warcinfo":
                continue
            head, payload = split_http(block)
            said = fields.get("warc-payload-digest", "").removeprefix("sha256:")
            digest, size = (said, _number(fields.get("warc-payload-length"))) if kind == "revisit" else (
                hashlib.sha256(payload).hexdigest(), len(payload))
            bare = lambda name: (v := fields.get(name)) and v.removeprefix("<urn:uuid:").removesuffix(">")
            yield (bare("warc-record-id"), kind, fields.get("warc-target-uri"), fields.get("warc-date"), size, digest,
                   bare("warc-refers-to"), _number(http_field(head, rank_header)), payload if with_payload else None, digest == said)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                for out in _batched(rows_of(content), columns, columns.index("payload")):
                    out["rank"] = out["rank"].astype("Int64")
                    yield out

    return _files(spark, path).mapInPandas(parse, WARC_ROWS)


# Writing: one row per record.

def _written(records: DataFrame, value: Column, first: Column, separator: str, path: str) -> None:
    """One file per partition; its first record is preceded by the file's own."""
    leads = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    (records.select(F.when(leads, F.concat(first, F.lit(separator), value)).otherwise(value).alias("value"))
     .write.option("lineSep", separator).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path))


def _length(text: Column) -> Column:
    return F.octet_length(text).cast("string")


def write_arc(pages: DataFrame, path: str, url: str = "url", payload: str = "html", rank: str = "page_id") -> None:
    """Legacy archives of HTTP responses, versions 1 and 2 by turns of the partitions."""
    body = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit(""))
    number = F.col(f"`{rank}`").cast("string")
    address = F.regexp_replace(F.coalesce(F.col(f"`{url}`"), F.lit("unknown:")), r"\s", "%20")
    date = F.date_format(F.timestamp_seconds(F.lit(1_600_000_000) + F.pmod(F.coalesce(F.col(f"`{rank}`"), F.lit(0)), F.lit(100_000_000))),
                         "yyyyMMddHHmmss")
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), _length(body),
                    F.coalesce(F.concat(F.lit(f"{CRLF}{RANK_HEADER}: "), number), F.lit("")), F.lit(CRLF * 2))
    old = F.pmod(F.spark_partition_id(), F.lit(2)) == 0
    rows = pages.select(address.alias("address"), date.alias("date"), F.concat(head, body).alias("block"), old.alias("old"))
    between = F.when(F.col("old"), " text/html ").otherwise(" text/html 200 - - 0 legacy.arc ")
    value = F.concat("address", F.lit(" 0.0.0.0 "), "date", between, _length(F.col("block")), F.lit("\n"), F.col("block"))
    blocks = {v: f"{ARC_ORIGIN[v]}\n{' '.join(ARC_FIELDS[v])}\n" for v in ARC_FIELDS}
    first = F.when(F.col("old"), f"filedesc://legacy.arc 0.0.0.0 20200913000000 text/plain {len(blocks[1])}\n{blocks[1]}").otherwise(
        f"filedesc://legacy.arc 0.0.0.0 20200913000000 text/plain 200 - - 0 legacy.arc {len(blocks[2])}\n{blocks[2]}")
    _written(rows, value, first, "\n", path)


def revisits(index: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """``record_id, refers_to_id, refers_to_uri, refers_to_date`` of records that repeat an earlier payload.

    The first of equal payloads has the lowest rank, then date and identifier. Its struct is an aggregate that is combined
    before the shuffle, however many records share a payload.
    """
    large = index.where((F.col("payload_bytes") >= least) & (F.col("kind") == "response"))
    order = F.struct(F.col("rank").isNull().alias("unranked"), "rank", "date", "record_id", "uri")
    first = large.groupBy("payload_digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return (large.join(first, "payload_digest").where("record_id <> first.record_id")
            .select("record_id", F.col("first.record_id").alias("refers_to_id"), F.col("first.uri").alias("refers_to_uri"),
                    F.col("first.date").alias("refers_to_date")))


def arc_to_warc(spark: SparkSession, arc_path: str, warc_path: str, least: int = LEAST_PAYLOAD, rank_header: str = RANK_HEADER) -> None:
    """Convert a folder of ARC files."""
    index = stored(read_arc(spark, arc_path, False, rank_header).drop("head", "payload", "block_digest"))
    repeated = stored(revisits(index, least))
    rows = read_arc(spark, arc_path, True, rank_header).join(hinted(repeated, repeated.count()), "record_id", "left")
    again = F.col("refers_to_id").isNotNull()
    head, payload = F.col("head").cast("string"), F.col("payload").cast("string")
    block = F.when(again, head).otherwise(F.concat(head, payload))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    revisit = F.concat(line("WARC-Refers-To", F.concat(F.lit("<urn:uuid:"), F.col("refers_to_id"), F.lit(">"))),
                       line("WARC-Refers-To-Target-URI", F.col("refers_to_uri")), line("WARC-Refers-To-Date", F.col("refers_to_date")),
                       line("WARC-Profile", F.lit(REVISIT_PROFILE)))
    value = F.concat(
        F.lit(WARC_VERSION + CRLF), line("WARC-Type", F.when(again, "revisit").otherwise(F.col("kind"))),
        line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.col("record_id"), F.lit(">"))), line("WARC-Date", F.col("date")),
        line("WARC-Target-URI", F.col("uri")), line("WARC-IP-Address", F.col("ip")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        line("WARC-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(again, revisit).otherwise(line("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.col("block_digest")))),
        F.when(F.col("truncated"), line("WARC-Truncated", F.lit("length"))).otherwise(""),
        line("Content-Type", F.when(F.col("kind") == "response", "application/http; msgtype=response").otherwise(F.col("mime"))),
        line("Content-Length", _length(F.col("block"))), F.lit(CRLF), F.col("block"))
    about = f"software: arc conversion{CRLF}format: WARC File Format 1.0{CRLF}"
    first = (f"{WARC_VERSION}{CRLF}WARC-Type: warcinfo{CRLF}WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, warc_path)}>{CRLF}"
             f"WARC-Date: 2020-09-13T00:00:00Z{CRLF}Content-Type: application/warc-fields{CRLF}Content-Length: {len(about)}{CRLF}{CRLF}{about}")
    _written(rows.withColumn("block", block), value, F.lit(first), CRLF * 2, warc_path)


def archived(pages: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """Pages written as legacy archives, converted, and read back: one row per page.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to, record_id, uri, date``.
    """
    spark = pages.sparkSession
    folder = f"{owned_folder(spark)}/archives-{uuid.uuid4().hex}"
    write_arc(pages, f"{folder}/arc")
    arc_to_warc(spark, f"{folder}/arc", f"{folder}/warc", least)
    back = stored(read_warc(spark, f"{folder}/warc", False))
    named = back.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("rank").alias("refers_to"))
    return (back.join(named, "refers_to_id", "left")
            .select(F.col("rank").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "uri", "date"))
