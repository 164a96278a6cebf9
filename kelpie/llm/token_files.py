"""Token-ID output: binary files of separately compressed documents.

A shared zstandard dictionary is trained on serialized id arrays of a bounded
sample; every document becomes one zstandard frame under that dictionary, so a
short document can be read alone.  A file holds

* a header: magic, SHA-256 of the dictionary, bytes per id;
* the frames of consecutive documents, in ascending doc_id order;
* the offset index: a table of (doc_id, is null, offset, length, tokens), itself compressed;
* a trailer: offset and length of the index, number of documents, magic.

The dictionary lies beside the files under the name of its hash; a reader takes
the dictionary that the header names and refuses any other.  Files follow one
another in doc_id order by name.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kelpie.llm.common import columns, new_folder, not_null_text, parallelism, write_and_read
from kelpie.llm.storage import RangeReader, created
from kelpie.llm.tokenizing import END_ID, encoder, runs

MAGIC = b"KLPTOK1\n"
HEAD, TRAILER = "<8s32sB7x", "<QQQ8s"
HEAD_SIZE, TRAILER_SIZE = struct.calcsize(HEAD), struct.calcsize(TRAILER)
INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("offset", "<u8"), ("length", "<u4"), ("tokens", "<u4")])
FILE_BYTES = 32 << 20
LEVEL = 3
# the dictionary's sample: at most so many documents, none longer than so many characters
SAMPLE_DOCS, SAMPLE_CHARS, DICT_BYTES = 512, 1 << 16, 64 << 10


def _serialized(ids: np.ndarray, width: int) -> bytes:
    return ids.astype("<u2" if width == 2 else "<u4").tobytes()


def id_width(vocabulary: int) -> int:
    return 2 if vocabulary <= 1 << 16 else 4


def documents_of(batch_text: pa.Array, path: str) -> Iterator[np.ndarray]:
    """The ids of each text with the end id behind them."""
    enc = encoder(path)
    for _, texts in runs(batch_text):
        ids, start = enc.encode(texts)
        for a, b in zip(start[:-1].tolist(), start[1:].tolist()):
            out = np.empty(b - a + 1, np.uint32)
            out[:-1] = ids[a:b]
            out[-1] = END_ID
            yield out
    pa.default_memory_pool().release_unused()   # Arrow's pool would keep the largest chunk's memory


def train_dictionary(docs: DataFrame, path: str, seed: int = 5) -> bytes:
    """Dictionary from the ``SAMPLE_DOCS`` texts with the smallest seeded hash among
    those of up to ``SAMPLE_CHARS`` characters; empty if there is too little to learn from."""
    sample = docs.where(F.length("text") <= SAMPLE_CHARS) \
        .select("text", F.xxhash64(F.lit(seed), "doc_id", "text").alias("h")).orderBy("h", "text").limit(SAMPLE_DOCS)

    def serialize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = id_width(encoder(path).vocabulary)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([_serialized(x, width) for x in documents_of(b.column(0), path)], pa.binary())], ["ids"])

    rows = [bytes(r["ids"]) for r in sample.select("text").mapInArrow(serialize, "ids binary").collect()]
    try:
        return zstandard.train_dictionary(DICT_BYTES, rows).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _writer(folder: str, path: str, dictionary, file_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = dictionary.value
        extra = {"dict_data": zstandard.ZstdCompressionDict(shared)} if shared else {}
        pack = zstandard.ZstdCompressor(level=LEVEL, **extra)
        width, part, done = id_width(encoder(path).vocabulary), TaskContext.get().partitionId(), []
        docs = ((i, x) for b in batches for i, x in zip(b.column(0).to_pylist(), documents_of(b.column(1), path)))
        doc = next(docs, None)
        while doc is not None:
            name = f"{folder}/part-{part:06d}-{len(done):04d}.ktok"
            index, tokens = [], 0
            with created(name) as out:
                out.write(struct.pack(HEAD, MAGIC, hashlib.sha256(shared).digest(), width))
                at = HEAD_SIZE
                while doc is not None and at < file_bytes:
                    doc_id, ids = doc
                    frame = pack.compress(_serialized(ids, width))
                    out.write(frame)
                    index.append((doc_id or 0, doc_id is None, at, len(frame), len(ids)))
                    at += len(frame)
                    tokens += len(ids)
                    doc = next(docs, None)
                table = zstandard.compress(np.array(index, INDEX).tobytes())
                out.write(table + struct.pack(TRAILER, at, len(table), len(index), MAGIC))
            done.append((name, len(index), tokens))
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], t) for k, t in
                                          enumerate((pa.string(), pa.int64(), pa.int64()))],
                                         ["path", "documents", "tokens"])

    return write


def write_tokens(docs: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Encode every whole text of ``docs`` (doc_id, text) with the tokenizer file at
    ``path``, write the files, return the manifest (path, documents, tokens).

    A null text is empty: its document is the end id alone.  Null ids come
    first; rows that repeat an id lie together.  The range exchange also goes by
    text and row, so a repeated id or row spreads over as many tasks as it
    needs.  An empty table gives an empty manifest."""
    spark = docs.sparkSession
    src = columns(docs, doc_id="long", text="string").withColumn("text", not_null_text())
    dictionary = train_dictionary(src, path)
    folder = new_folder(spark, "tokens")
    with created(f"{folder}/{hashlib.sha256(dictionary).hexdigest()}.zdict") as out:
        out.write(dictionary)
    order = ["doc_id", "h", "row"]
    rows = src.withColumn("h", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id()) \
        .repartitionByRange(parallelism(spark), *order).sortWithinPartitions(*order).select("doc_id", "text")
    write = _writer(folder, path, spark.sparkContext.broadcast(dictionary), file_bytes)     # DICT_BYTES at most
    return write_and_read(rows.mapInArrow(write, "path string, documents long, tokens long"), "token-manifest")


# --- reading -------------------------------------------------------------------------------------

class TokenFile:
    """One file: its index, and any document by range reads."""

    def __init__(self, path: str):
        self._f = RangeReader(path)
        magic, self.dictionary, self.width = struct.unpack(HEAD, self._f.read(0, HEAD_SIZE))
        at, size, count, again = struct.unpack(
            TRAILER, self._f.read(self._f.size - TRAILER_SIZE, TRAILER_SIZE))
        if magic != MAGIC or again != MAGIC:
            raise ValueError(f"{path} is not a token file")
        self.index = np.frombuffer(zstandard.decompress(self._f.read(at, size)), INDEX, count)
        with RangeReader(f"{path.rsplit('/', 1)[0]}/{self.dictionary.hex()}.zdict") as d:
            shared = d.read(0, d.size)
        if hashlib.sha256(shared).digest() != self.dictionary:
            raise ValueError(f"{path}: the dictionary isn't the one that the header names")
        self._unpack = zstandard.ZstdDecompressor(
            **({"dict_data": zstandard.ZstdCompressionDict(shared)} if shared else {}))

    def _ids(self, frame: bytes) -> np.ndarray:
        return np.frombuffer(self._unpack.decompress(frame), "<u2" if self.width == 2 else "<u4").astype("<u4")

    def ids(self, row: int) -> np.ndarray:
        """One document, by one range read."""
        e = self.index[row]
        return self._ids(self._f.read(int(e["offset"]), int(e["length"])))

    def find(self, doc_id: int) -> list[np.ndarray]:
        """The documents of an id."""
        return [self.ids(int(r)) for r in np.flatnonzero((self.index["doc_id"] == doc_id) & (self.index["null"] == 0))]

    def scan(self, most: int = 4 << 20) -> Iterator[tuple[np.void, np.ndarray]]:
        """All documents in order, several neighbours per read."""
        ends = (self.index["offset"] + self.index["length"]).astype(np.int64)
        row = 0
        while row < len(ends):
            base = int(self.index["offset"][row])
            last = max(row + 1, int(np.searchsorted(ends, base + most, "right")))
            block = self._f.read(base, int(ends[last - 1]) - base)
            for e in self.index[row:last]:
                a = int(e["offset"]) - base
                yield e, self._ids(block[a:a + int(e["length"])])
            row = last

    def close(self) -> None:
        self._f.close()


def read_tokens(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """Every document of the files: doc_id, ``start`` (ids of all documents before
    it), n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit
    integers) and, if asked for, ids."""
    before = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)    # a row a file
    files = manifest.select("path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                f, rows, held = TokenFile(path), [], 0
                for e, ids in f.scan():
                    rows.append((None if e["null"] else int(e["doc_id"]), start, len(ids), zlib.crc32(ids.tobytes()),
                                 ids.tolist() if with_ids else None))
                    start += len(ids)
                    held += 64 + 8 * len(ids) * with_ids
                    if held > 4 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                f.close()
                yield _batch(rows)

    out = files.repartition(parallelism(manifest.sparkSession), "path") \
        .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<long>")
    return out if with_ids else out.drop("ids")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                      ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])
