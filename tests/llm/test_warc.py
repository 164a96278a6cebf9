import base64
import gzip
import hashlib
import io
import json
import os
import zipfile

import duckdb
import pytest
from pyspark.sql import functions as F

from kelpie.llm import warc
from kelpie.llm.queries import ORACLE, QUERIES
from kelpie.llm.storage import RangeReader

PAGES = [(1, "http://a/ b\r\nX: y", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "u", None), (4, "u", ""), (5, "u", "é" * 70000),
         (6, "u", "two"), (6, "u", "two"), (7, "u", "two"), (None, "u", "two"), (None, "u", "alone"), (8, "ü", "a\r\n\r\nb")]


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h in rows:
        f = first.get(h or "")
        again = f is not None and (i is None or i > f)
        out.append((i, len((h or "").encode()), digest(h), "revisit" if again else "response", f if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [64 << 20, 1])
def test_round_trip(spark, size):
    got = warc.read_archives(warc.write_archives(pages(spark), archive_bytes=size))
    rows = got.collect()
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in rows), key=str) == expected(PAGES)
    html = {(i, h or "") for i, _, h in PAGES}
    assert all((r["page_id"], bytes(r["payload"]).decode()) in html for r in rows if r["record_type"] == "response")


def test_smaller_payloads_are_all_responses(spark):
    got = warc.read_archives(warc.write_archives(pages(spark), min_payload=5)).where("payload_bytes < 5")
    assert {r["record_type"] for r in got.collect()} == {"response"}


def test_empty_table_and_extra_columns(spark):
    assert warc.read_archives(warc.write_archives(pages(spark, []))).count() == 0
    extra = pages(spark).withColumn("sha1", F.lit("x")).withColumn("first", F.lit(1)).withColumn("HTML_", F.lit("y"))
    assert warc.read_archives(warc.write_archives(extra)).count() == len(PAGES)


def test_archives_are_ordinary_zip_files(spark):
    for row in warc.write_archives(pages(spark)).collect():
        with zipfile.ZipFile(row["path"].removeprefix("file:")) as z:
            assert z.testzip() is None and all(i.compress_type == zipfile.ZIP_STORED for i in z.infolist())
            data = gzip.decompress(z.read(warc.RECORDS))
            assert data.count(b"WARC/1.1\r\n") == row["records"]


def test_directory_parser_against_zipfile(tmp_path):
    """Plain and ZIP64 directories, a comment, many members."""
    plain = tmp_path / "a.zip"
    with zipfile.ZipFile(plain, "w") as z:
        for k in range(300):
            z.writestr(f"d/ü{k}", os.urandom(k))
        z.comment = b"x" * 40
    wide = tmp_path / "b.zip"
    with zipfile.ZipFile(wide, "w") as z:
        for k in range(66_000):         # more entries than 16 bits count: a ZIP64 directory
            z.writestr(str(k), b"%d" % k)
    for path in (plain, wide):
        with RangeReader(str(path)) as f, zipfile.ZipFile(path) as z:
            got = warc.members(f)
            assert set(got) == set(z.namelist())
            for name in (z.namelist()[0], z.namelist()[-1]):
                method, size, at = got[name]
                assert method == 0 and f.read(at, size) == z.read(name)


def test_zip64_fields_of_an_entry(tmp_path):
    """An entry whose sizes and offset stand in its ZIP64 field, as in archives beyond 4 GB."""
    import struct
    body = b"hello"
    local = warc.LOCAL + struct.pack("<HHHHHIIIHH", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, 20) + b"n" \
        + struct.pack("<HHQQ", 1, 16, 5, 5) + body
    extra = struct.pack("<HHQQQ", 1, 24, 5, 5, 0)
    central = warc.CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, len(extra),
                                         0, 0, 0, 0, 0xFFFFFFFF) + b"n" + extra
    end64 = warc.END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(central), len(local))
    locator = warc.END64_LOCATOR + struct.pack("<IQI", 0, len(local) + len(central), 1)
    end = warc.END + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    path = tmp_path / "c.zip"
    path.write_bytes(local + central + end64 + locator + end)
    with RangeReader(str(path)) as f:
        method, size, at = warc.members(f)["n"]
        assert (method, f.read(at, size)) == (0, body)


def test_an_end_mark_inside_the_comment(tmp_path):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("n", b"hello")
        z.comment = b"PK_6" + b"x" * 40
    path = tmp_path / "d.zip"
    path.write_bytes(data.getvalue().replace(b"PK_6", warc.END))
    with RangeReader(str(path)) as f:
        _, size, at = warc.members(f)["n"]
        assert f.read(at, size) == b"hello"


def test_broken_archives_are_refused(tmp_path):
    path = tmp_path / "x.zip"
    path.write_bytes(b"nothing of the kind" * 10)
    with RangeReader(str(path)) as f, pytest.raises(ValueError):
        warc.members(f)


def test_index_names_each_record(spark):
    row = warc.write_archives(pages(spark)).first()
    with RangeReader(row["path"]) as f:
        found = warc.members(f)
        _, size, at = found[warc.INDEX]
        lines = [json.loads(x[x.index("{"):]) for x in f.read(at, size).decode().splitlines()]
    assert len(lines) == row["records"]
    assert sum(int(x["length"]) for x in lines) == found[warc.RECORDS][1]


def test_query_against_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    want = con.execute(ORACLE["op8_warc"]).fetchall()
    got = [tuple(r) for r in QUERIES["op8_warc"](spark, sf).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def foreign_archive(path, packed_index=False):
    """An archive in the standard layout, written by hand: two record files, one of them not compressed, bare file
    names in the index, other ids, header names in any case and without a blank behind the colon."""
    import base64
    import gzip
    import hashlib
    import zipfile

    def digest(x):
        return "sha1:" + base64.b32encode(hashlib.sha1(x).digest()).decode()

    one, two = "<p>eins ä</p>".encode(), b"plain text"
    http = b"HTTP/1.1 200 OK\r\ncontent-type:text/html\r\nX-Folded: a\r\n b\r\n\r\n" + one
    a = ("WARC/1.0\r\nwarc-type:response\r\nWARC-record-id: <urn:uuid:0001>\r\nWARC-Target-URI:http://example.com/a?b=1\r\n"
         f"WARC-Date: 2020-02-03T04:05:06Z\r\nWARC-Payload-Digest:{digest(one)}\r\nContent-Type: application/http;msgtype=response\r\n"
         f"content-length:{len(http)}\r\n\r\n").encode() + http + b"\r\n\r\n"
    b = ("WARC/1.1\nWARC-Type: resource\nWARC-Record-ID: <urn:uuid:0002>\nWARC-Target-URI: http://example.com/t\n"
         f"WARC-Date: 2020-02-03T04:05:07Z\nContent-Type: text/plain\nContent-Length: {len(two)}\n\n").encode() + two + b"\r\n\r\n"
    back = b"HTTP/1.1 200 OK\r\n\r\n"
    c = ("WARC/1.1\r\nWARC-Type: revisit\r\nWARC-Record-ID: <urn:uuid:0003>\r\nWARC-Target-URI: http://example.com/a\r\n"
         f"WARC-Refers-To: <urn:uuid:0001>\r\nWARC-Payload-Digest: {digest(one)}\r\nWARC-Date: 2020-02-04T04:05:06Z\r\n"
         f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(back)}\r\n\r\n").encode() + back + b"\r\n\r\n"
    info = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    first = [gzip.compress(x) for x in (info, a)]
    lines = ['!meta {"format": "cdxj"}',
             'com,example)/a?b=1 20200203040506 {"url": "http://example.com/a?b=1", "mime": "text/html", "status": 200, '
             f'"length": {len(first[1])}, "offset": {len(first[0])}, "filename": "first.warc.gz"}}',
             f'com,example)/a 20200204040506 {{"url": "x", "length": "{len(c)}", "offset": "{len(b)}", "filename": "second.warc"}}',
             f'com,example)/t 20200203040507 {{"url": "x", "length": "{len(b)}", "offset": "0", "filename": "archive/second.warc"}}']
    index = "\n".join(lines).encode()
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        z.writestr("datapackage.json", "{}", zipfile.ZIP_DEFLATED)
        z.writestr("archive/first.warc.gz", b"".join(first))
        z.writestr("archive/second.warc", b + c)
        z.writestr("indexes/index.cdx.gz" if packed_index else "indexes/index.cdxj", gzip.compress(index) if packed_index else index)
    return one, two


@pytest.mark.parametrize("packed_index", [False, True])
def test_a_foreign_archive_in_the_standard_layout(spark, tmp_path, packed_index):
    path = str(tmp_path / "foreign.wacz")
    one, two = foreign_archive(path, packed_index)
    got = {r["record_id"]: r for r in warc.read_archives(spark.createDataFrame([(path,)], "path string")).collect()}
    assert set(got) == {"<urn:uuid:0001>", "<urn:uuid:0002>", "<urn:uuid:0003>"}
    a, b, c = (got[f"<urn:uuid:000{i}>"] for i in (1, 2, 3))
    assert (a["record_type"], bytes(a["payload"]), a["target_uri"], a["payload_bytes"]) == ("response", one, "http://example.com/a?b=1", len(one))
    assert (b["record_type"], bytes(b["payload"]), b["payload_digest"]) == ("resource", two, warc.sha1_base32(two))
    assert (c["record_type"], c["refers_to_id"], c["payload_digest"], c["payload_bytes"]) == ("revisit", "<urn:uuid:0001>", a["payload_digest"], None)
    assert a["page_id"] is None and c["refers_to"] is None and a["date"] == "2020-02-03T04:05:06Z"


def test_index_lines_are_standard_and_sorted(spark):
    import re
    import zipfile
    pages = spark.createDataFrame([(1, "http://b.example.org/z", "x"), (2, "https://www.a.example.org:8080/Y?q=1#f", "y"), (3, None, "z")],
                                  "page_id long, url string, html string").coalesce(1)
    path = warc.write_archives(pages).first()["path"].removeprefix("file:")
    lines = zipfile.ZipFile(path).read(warc.INDEX).decode().splitlines()
    assert lines == sorted(lines) and all(re.match(r"\S+ 20240101000000 \{.*\}$", x) for x in lines)
    assert {x.split(" ")[0] for x in lines} == {"org,example,b)/z", "org,example,a:8080)/y?q=1", "about:blank"}


def test_headers():
    h = warc.Headers(["A-b:1", "a-B: 2", "C:  x ", " y", "junk"])
    assert h["a-B"] == "1" and h.get("c") == "x y" and "JUNK" not in h and h.get("zz", "none") == "none"
