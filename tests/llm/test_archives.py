import gzip
import hashlib
import io
import uuid

from cellweave.llm import archives
from cellweave.operators.lineage import shared_folder

SCHEMA = "page_id bigint, url string, html string, block string, rank string, record_id int, payload string, value string"


def version_one(*records):
    about = b"1 0 Someone\nURL IP-address Archive-date Content-type Archive-length\n"
    out = b"filedesc://old.arc 0.0.0.0 19961022101010 text/plain %d\n%s\n" % (len(about), about)
    return out + b"".join(line % len(block) + b"\n" + block + b"\n" for line, block in records)


def test_versions_lengths_and_broken_lines():
    page = b"HTTP/1.0 200 OK\r\nContent-Type: text/html\r\n\r\nline\n\nhttp://not.a/ 1 2 3 4 header\n"
    one = version_one((b"http://a.example/with space 1.2.3.4 19970101 text/html %d", page), (b"dns:a.example 1.2.3.4 19970102030405 text/dns %d", b"20 a"))
    got = list(archives.arc_records(one))
    assert [r["URL"] for r in got] == ["http://a.example/with space", "dns:a.example"] and got[0]["block"] == page
    about = b"2 0 Someone\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"
    two = b"filedesc://new.arc 0.0.0.0 19990101000000 text/plain 200 - - 0 new.arc %d\n%s\n" % (len(about), about)
    two += b"garbage that is no header\nhttp://b.example/ 1.2.3.4 20000101000000 text/html 200 - - 9 new.arc 6\n\x00\xff1\n23\n"
    two += b"http://c.example/ 1.2.3.4 20000101000000 text/html 404 - - 9 new.arc 50\ncut"
    got = list(archives.arc_records(gzip.compress(two)))
    assert [(r["URL"], r["block"], r["truncated"]) for r in got] == [("http://b.example/", b"\x00\xff1\n23", False), ("http://c.example/", b"cut", True)]
    assert got[0]["Result-code"] == "200" and list(archives.arc_records(b"")) == []


def test_damaged_compressed_files_are_read_up_to_the_damage():
    noise = [hashlib.sha256(b"%d" % k).hexdigest().encode() * 40 for k in range(400)]
    one = version_one(*[(b"http://a.example/%d 1.2.3.4 19970101 text/html %%d" % k, body) for k, body in enumerate(noise)])
    packed = gzip.compress(one)
    whole = list(archives.arc_records(packed))
    assert [r["block"] for r in whole] == noise
    for bad in (packed[:-12], packed[:len(packed) // 2], packed[:len(packed) // 2] + bytes(64) + packed[len(packed) // 2 + 64:], packed + b"trailing", packed[:12]):
        got = list(archives.arc_records(bad))
        full = [r for r in got if not r["truncated"]]
        assert all(r["block"] == noise[k][:len(r["block"])] for k, r in enumerate(got[:len(got) // 3]))
        assert len(got) - len(full) <= 1 and len(full) >= len(noise) * (len(bad) - 4096) // len(packed) // 3
    assert [r["block"] for r in archives.arc_records(packed + b"trailing")] == noise
    # Members end where records do; a damaged one loses what follows in its file, nothing before.
    members = [gzip.compress(b) for b in (version_one((b"http://a.example/ 1.2.3.4 19970101 text/html %d", b"first")), b"http://b.example/ 1.2.3.4 1997010")]
    assert [r["block"] for r in archives.arc_records(members[0] + members[1][:-9])] == [b"first"]
    assert list(archives.warc_records(gzip.compress(b"WARC/1.0\r\nContent-Length: 9\r\n\r\n123456789")[:-8])) == [({"content-length": "9"}, b"123456789")]


def test_converted_fields():
    page = b"HTTP/1.0 200 OK\r\nX-Page-Id: 12\r\n\r\nbody"
    rows = list(archives._converted("s3://x/old.arc", version_one((b"http://a/ 1.2.3.4 1997 text/html %d", page), (b"http://a/ 1.2.3.4 19970304 text/html %d", page),
                                                                  (b"dns:a 1.2.3.4 19970304050607 text/dns %d", b"20 a")), True, "X-Page-Id"))
    by = [dict(zip([c.split()[0] for c in archives.CONVERTED.split(", ")], r, strict=True)) for r in rows]
    assert [r["kind"] for r in by] == ["response", "resource"] or [r["kind"] for r in by] == ["response", "response", "resource"]
    assert by[-2]["date"] == "1997-03-04T00:00:00Z" and by[-1]["date"] == "1997-03-04T05:06:07Z" and by[-2]["rank"] == 12
    assert by[-2]["payload"] == b"body" and by[-2]["payload_digest"] == hashlib.sha256(b"body").hexdigest()
    assert by[-2]["block_digest"] == hashlib.sha256(page).hexdigest() and by[-1]["payload"] == b"20 a"
    assert len({r["record_id"] for r in by}) == len(by) and all(uuid.UUID(r["record_id"]) for r in by)


def pages():
    long = "<p>" + "ä" * 60 + "</p>"
    rows = [(i, f"http://h/{i}", long) for i in (9, 4, 30)] + [(5, "http://h/x y\nz", "short"), (6, None, "short"), (7, "http://h/7", None), (8, "h", "")]
    rows += [(40, "http://h/40", "line\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\n\r\n" * 9), (41, "http://h/41", "\n\nx 1 19970101 y 5\n" * 20)]
    rows += [(50, "http://h/50", "big " * 300_000), (51, "http://h/51", "big " * 300_000), (52, "u", "z" * 99), (53, "u", "z" * 99), (54, "u", "y" * 100), (55, "u", "y" * 100)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", 1, "clash", "clash") for r in rows], SCHEMA).repartition(3)


def test_round_trip(spark):
    rows = pages()
    got = {r.page_id: r for r in archives.archived(frame(spark, rows)).collect()}
    first = {}
    for i, _, html in sorted(rows):
        first.setdefault(html or "", i)
    assert len(got) == len(rows)
    for i, url, html in rows:
        body = (html or "").encode()
        repeat = len(body) >= 100 and first[html or ""] != i
        r = got[i]
        assert (r.payload_bytes, r.payload_digest) == (len(body), hashlib.sha256(body).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", first[html or ""]) if repeat else ("response", None))
    assert got[5].uri == "http://h/x%20y%20z" and got[6].uri == "unknown:"


def test_files_are_warc_and_payloads_come_back(spark):
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    archives.write_arc(frame(spark, pages()), f"{folder}/arc")
    archives.arc_to_warc(spark, f"{folder}/arc", f"{folder}/warc")
    back = archives.read_warc(spark, f"{folder}/warc").collect()
    bodies = {i: (h or "").encode() for i, _, h in pages()}
    assert all(bytes(r.payload) == bodies[r["rank"]] and r.intact for r in back if r.record_type == "response")
    for r in spark.read.format("binaryFile").load(f"{folder}/warc").collect():
        stream = io.BytesIO(gzip.decompress(bytes(r.content)))
        while line := stream.readline():
            assert line == b"WARC/1.0\r\n"
            fields = {}
            while (line := stream.readline()) != b"\r\n":
                name, _, value = line.partition(b": ")
                fields[name] = value.strip()
            assert {b"WARC-Type", b"WARC-Record-ID", b"WARC-Date", b"Content-Length"} <= fields.keys()
            block = stream.read(int(fields[b"Content-Length"]))
            if b"WARC-Block-Digest" in fields:
                assert fields[b"WARC-Block-Digest"] == b"sha256:" + hashlib.sha256(block).hexdigest().encode()
            assert stream.read(4) == b"\r\n\r\n"


def test_repeated_rows_null_ids_and_empty_table(spark):
    body = "b" * 200
    got = sorted(((r.page_id, r.record_type, r.refers_to) for r in archives.archived(
        frame(spark, [(2, "u", body), (2, "u", body), (None, "u", body), (None, None, None)])).collect()), key=str)
    assert got == sorted([(2, "response", None), (2, "revisit", 2), (None, "revisit", 2), (None, "response", None)], key=str)
    assert archives.archived(frame(spark, [])).count() == 0
