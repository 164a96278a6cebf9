"""WARC records in ZIP-packaged archives.

An archive is a ZIP file whose members are *stored*, so that byte ranges of a
member are byte ranges of the file: ``archive/data.warc.gz`` holds the records,
each its own gzip member, and ``indexes/index.cdxj`` has a line for each: sort key
(the host's labels from the top domain down, then the path), time stamp, and a JSON object
with url, digest, offset, length and file name; lines ascend.  The reader also takes archives that
others have written so: any index members (plain or gzipped), file names with or without their folder,
several record files, records of any id, headers of any case.  It parses the end record, the central directory and their
ZIP64 forms, locates the stored members, reads the index, and range-reads record
by record.  Nothing is extracted.

Pages with equal payloads are written once: the record of the smallest page_id
is the ``response``, the others are ``revisit`` records that refer to it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import zipfile
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpie.llm.common import columns, new_folder, parallelism, write_and_read
from kelpie.llm.storage import RangeReader, created

ARCHIVE_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
# Fixed values of the WARC 1.1 format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- writing -------------------------------------------------------------------------------------

def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def _page_of(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:x-page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None,
                 revisit: bool, date: str = DATE) -> bytes:
    """One WARC record.  A revisit keeps the HTTP header, with the length of the
    whole payload, and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    # control characters and blanks can't stand in a header line
    uri = quote(url, safe="%/:?#[]@!$&'()*+,;=~-._") if url else "about:blank"
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(page_id)), ("WARC-Date", date),
            ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if revisit:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _urn(first))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def sort_key(url: str) -> str:
    """The key of a URL in an index: ``http://a.b.com:80/p?q`` -> ``com,b,a:80)/p?q``, lower case."""
    found = re.fullmatch(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)(:\d+)?([^#]*)(?:#.*)?", url, re.S)
    if not found:
        return quote(url.lower(), safe="%/:?[]@!$&'()*+,;=~-._")
    host, port, rest = found.groups()
    host = ",".join(reversed(host.removeprefix("www.").split("."))) + (port or "")
    return quote(f"{host}){rest or '/'}".lower(), safe="%/:?[]@!$&'()*+,;=~-._")


class _Archive:
    """One archive under construction: records go out as they come, the index is kept."""

    def __init__(self, out, date: str):
        self.stamp = re.sub(r"\D", "", date)[:14]
        self.zip = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(RECORDS, "w", force_zip64=True)
        self.at, self.index = 0, []

    def add(self, url: str | None, digest: str, record: bytes) -> None:
        packed = gzip.compress(record, 6, mtime=0)
        self.member.write(packed)
        line = {"url": url, "mime": "text/html", "status": "200", "digest": f"sha1:{digest}", "length": str(len(packed)),
                "offset": str(self.at), "filename": RECORDS.rsplit("/", 1)[1]}
        self.index.append(f"{sort_key(url or 'about:blank')} {self.stamp} {json.dumps(line)}")
        self.at += len(packed)

    def close(self) -> None:
        self.member.close()
        self.zip.writestr(INDEX, "".join(f"{x}\n" for x in sorted(self.index)).encode())
        self.zip.close()


def _writer(folder: str, archive_bytes: int, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done, rows = TaskContext.get().partitionId(), [], _rows(batches)
        row = next(rows, None)
        while row is not None:
            path = f"{folder}/part-{part:06d}-{len(done):04d}.wacz"
            with created(path) as out:
                archive = _Archive(out, date)
                while row is not None and archive.at < archive_bytes:
                    page_id, url, html, sha1, first, revisit = row
                    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                    archive.add(url, digest, record_bytes(page_id, url, html, digest, first, revisit, date))
                    row = next(rows, None)
                archive.close()
            done.append((path, len(archive.index)))
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()),
                                          pa.array([n for _, n in done], pa.int64())], ["path", "records"])

    return write


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        for i in range(b.num_rows):
            yield tuple(b.column(k)[i].as_py() for k in range(b.num_columns))


def write_archives(pages: DataFrame, min_payload: int = 0, archive_bytes: int = ARCHIVE_BYTES,
                   date: str = DATE) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html); return the manifest (path, records).

    Payloads of ``min_payload`` bytes or more that are equal get one response,
    that of the smallest page_id; repeated rows of that page_id are responses
    too.  A null html is an empty payload.  A null page_id revisits the group's
    smallest id; without any, each row of the group is a response.  A null url
    is written as ``about:blank``.  An empty table gives an empty manifest."""
    spark = pages.sparkSession
    src = columns(pages, page_id="long", url="string", html="string") \
        .withColumn("html", F.coalesce("html", F.lit("")).cast("binary")).withColumn("sha1", F.sha1("html"))
    groups = src.where(F.octet_length("html") >= min_payload).groupBy("sha1") \
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    marked = src.join(groups, "sha1", "left").select(
        "page_id", "url", "html", "sha1", "first",
        F.expr("first IS NOT NULL AND (page_id IS NULL OR page_id > first)").alias("revisit"))
    folder = new_folder(spark, "warc")
    return write_and_read(marked.mapInArrow(_writer(folder, archive_bytes, date), "path string, records long"),
                          "warc-manifest")


# --- reading -------------------------------------------------------------------------------------
# Fixed values of the ZIP format: record signatures, and the values that point to a ZIP64 field.
END, END64_LOCATOR, END64, CENTRAL, LOCAL = b"PK\5\6", b"PK\6\7", b"PK\6\6", b"PK\1\2", b"PK\3\4"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF


def _directory(f: RangeReader) -> tuple[int, int, int]:
    """Offset, size and entry count of the central directory."""
    tail_at = max(0, f.size - 22 - FULL16)
    tail = f.read(tail_at, f.size - tail_at)
    at = tail.rfind(END)
    while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
        at = tail.rfind(END, 0, at)     # the mark may also occur in the comment
    if at < 0:
        raise ValueError("not a ZIP archive: no end record")
    count, size, offset = struct.unpack_from("<HII", tail, at + 10)
    if FULL16 == count or FULL32 in (size, offset):
        locator = f.read(tail_at + at - 20, 20)
        if locator[:4] != END64_LOCATOR:
            raise ValueError("no ZIP64 locator")
        end64 = f.read(struct.unpack_from("<Q", locator, 8)[0], 56)
        if end64[:4] != END64:
            raise ValueError("no ZIP64 end record")
        count, size, offset = struct.unpack_from("<QQQ", end64, 32)
    return offset, size, count


def members(f: RangeReader) -> dict[str, tuple[int, int, int]]:
    """Name -> (method, size, offset of the first data byte) of every member."""
    offset, size, count = _directory(f)
    data, at, out = f.read(offset, size), 0, {}
    for _ in range(count):
        if data[at:at + 4] != CENTRAL:
            raise ValueError("broken central directory")
        method, = struct.unpack_from("<H", data, at + 10)
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", data, at + 20)
        local, = struct.unpack_from("<I", data, at + 42)
        name = data[at + 46:at + 46 + n_name].decode("utf-8")
        extra = data[at + 46 + n_name:at + 46 + n_name + n_extra]
        k = 0
        while k + 4 <= len(extra):
            tag, n = struct.unpack_from("<HH", extra, k)
            if tag == 1:    # ZIP64: only the fields that are full in the plain entry, in this order
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, k + 4))
                plain = next(wide) if plain == FULL32 else plain
                packed = next(wide) if packed == FULL32 else packed
                local = next(wide) if local == FULL32 else local
            k += 4 + n
        head = f.read(local, 30)
        if head[:4] != LOCAL:
            raise ValueError(f"no local header for {name}")
        skip = sum(struct.unpack_from("<HH", head, 26))
        out[name] = (method, packed, local + 30 + skip)
        at += 46 + n_name + n_extra + n_comment
    return out


class Headers(dict):
    """Header fields by name without regard to case; of repeated ones the first."""

    def __init__(self, lines: list[str]):
        super().__init__()
        last = None
        for line in lines:
            if line[:1] in (" ", "\t") and last:                    # a folded line goes on
                dict.__setitem__(self, last, f"{dict.__getitem__(self, last)} {line.strip()}")
                continue
            name, mark, value = line.partition(":")
            if mark:
                last = name.strip().lower()
                self.setdefault(last, value.strip())

    def __getitem__(self, name):
        return super().__getitem__(name.lower())

    def __contains__(self, name):
        return super().__contains__(name.lower())

    def get(self, name, default=None):
        return super().get(name.lower(), default)


def _head(data: bytes) -> tuple[list[str], bytes]:
    """Lines up to the first empty one (line ends of either kind), and what follows."""
    found = re.search(rb"\r?\n\r?\n", data)
    head, rest = (data, b"") if not found else (data[:found.start()], data[found.end():])
    return re.split(r"\r?\n", head.decode("utf-8", "replace")), rest


def parse_record(data: bytes) -> tuple[Headers, Headers, bytes]:
    """WARC headers, HTTP headers (none unless the block is an HTTP message) and payload of one record."""
    lines, rest = _head(data)
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    warc = Headers(lines[1:])
    block = rest[:int(warc["Content-Length"])]
    if not warc.get("Content-Type", "application/http").lower().startswith("application/http"):
        return warc, Headers([]), block
    lines, payload = _head(block)
    return warc, Headers(lines[1:]), payload


def _index_lines(f: RangeReader, found: dict[str, tuple[int, int, int]]) -> Iterator[dict]:
    """The entries of all index members.  What stands before the JSON object (sort key and time stamp,
    or another key) is not needed; lines without an object that names a range are headers."""
    names = sorted(n for n in found if n.startswith("indexes/") and re.search(r"\.cdxj?(\.gz)?$", n))
    if not names:
        raise ValueError("the archive has no index")
    for name in names:
        method, size, at = found[name]
        if method:
            raise ValueError("the index is not stored")
        data = f.read(at, size)
        for line in (gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data).decode("utf-8").splitlines():
            brace = line.find("{")
            if brace >= 0 and not line.startswith("!"):
                entry = json.loads(line[brace:])
                if {"offset", "length", "filename"} <= entry.keys():
                    yield entry


def records(path: str) -> Iterator[tuple[Headers, Headers, bytes]]:
    """All records of an archive, each by one range read that the index names."""
    with RangeReader(path) as f:
        found = members(f)
        by_base = {n.rsplit("/", 1)[-1]: n for n in sorted(found, reverse=True)}
        for entry in _index_lines(f, found):
            name = entry["filename"] if entry["filename"] in found else by_base.get(entry["filename"].rsplit("/", 1)[-1])
            if name is None:
                raise ValueError(f"the index names {entry['filename']}, which is not in the archive")
            method, size, start = found[name]
            if method:
                raise ValueError(f"{name} is not stored")
            offset, length = int(entry["offset"]), int(entry["length"])
            if offset + length > size:
                raise ValueError("an index entry is outside its member")
            data = f.read(start + offset, length)
            yield parse_record(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data)


_SCHEMA = ("page_id long, target_uri string, date string, payload_bytes long, payload_digest string, "
           "record_type string, refers_to long, payload binary, record_id string, refers_to_id string")


def _reader(with_payload: bool, batch_bytes: int = 8 << 20):
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(),
             pa.string(), pa.string()]
    names = [x.split()[0] for x in _SCHEMA.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for b in batches:
            for path in b.column(0).to_pylist():
                for warc, http, payload in records(path):
                    kind, stated = warc["WARC-Type"], warc.get("WARC-Payload-Digest", "")
                    digest = stated.removeprefix("sha1:")
                    if kind != "revisit":
                        own = sha1_base32(payload)
                        if stated.startswith("sha1:") and len(digest) == 32 and digest.upper() != own:
                            raise ValueError(f"{path}: a payload doesn't match its digest")
                        digest = own
                    whole = http.get("Content-Length") if kind == "revisit" else len(payload)
                    rows.append((_page_of(warc.get("WARC-Record-ID")), warc.get("WARC-Target-URI"), warc.get("WARC-Date"),
                                 None if whole is None else int(whole), digest or None, kind, _page_of(warc.get("WARC-Refers-To")),
                                 payload if with_payload else None, warc.get("WARC-Record-ID"), warc.get("WARC-Refers-To")))
                    held += 200 + len(payload) * with_payload
                    if held >= batch_bytes:
                        yield _batch(rows, kinds, names)
                        rows, held = [], 0
        yield _batch(rows, kinds, names)

    return read


def _batch(rows, kinds, names) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """Rows of all records of the archives in ``manifest`` (path).  ``payload_bytes``
    and ``payload_digest`` are those of the full payload, for revisits too (null where a foreign revisit
    doesn't say); every other payload is checked against its SHA-1, if one is stated.
    ``page_id`` and ``refers_to`` are null for records that :func:`write_archives` hasn't written;
    ``record_id`` and ``refers_to_id`` are the ids as they stand."""
    paths = manifest.select("path").repartition(parallelism(manifest.sparkSession), "path")
    return paths.mapInArrow(_reader(with_payload), _SCHEMA)
