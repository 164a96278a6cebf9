"""Packing: bounded-space online packing into training sequences.

Each task reads its documents in order and keeps a fixed number of open
windows.  A document longer than a window gives full sequences first; what is
left of it, or a shorter document whole, goes into the window that it fills
best.  When none has room, the fullest window is emitted and a new one opened.
At the end of a task its open windows are leftovers.  Finally the leftovers of
several tasks are merged: laid end to end and cut at the window's length, so
that one sequence of each such merge is short at most.

A task holds ``windows`` x ``length`` ids and the texts of one batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpie.llm.common import columns, new_folder, not_null_text
from kelpie.llm.token_files import documents_of

LENGTH = 2048
WINDOWS = 64
MERGE = 16              # tasks whose leftovers one merging task takes
_MERGED = 1 << 30       # sequence ids: (task, number) in 32 bits each; merging tasks count from here

SCHEMA = "doc_id long, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long"
_NAMES = [x.split()[0] for x in SCHEMA.split(", ")]
_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
Piece = tuple           # (doc_id, start, length, doc_tokens, ids as bytes)


class Windows:
    """The open windows of one task."""

    def __init__(self, length: int = LENGTH, most: int = WINDOWS):
        self.length, self.most = length, most
        self.room: list[int] = []
        self.held: list[list[Piece]] = []

    def place(self, piece: Piece) -> list[list[Piece]]:
        """Put a piece of at most ``length`` ids away; the windows that are emitted by that."""
        need, out = piece[2], []
        if need == self.length:
            return [[piece]]
        best = min((r, i) for i, r in enumerate(self.room) if r >= need)[1] \
            if any(r >= need for r in self.room) else None
        if best is None:
            if len(self.room) == self.most:
                out.append(self.take(min(range(self.most), key=self.room.__getitem__)))
            self.room.append(self.length)
            self.held.append([])
            best = len(self.room) - 1
        self.room[best] -= need
        self.held[best].append(piece)
        if not self.room[best]:
            out.append(self.take(best))
        return out

    def take(self, i: int) -> list[Piece]:
        del self.room[i]
        return self.held.pop(i)


def cut(doc_id: int | None, ids: np.ndarray, length: int) -> Iterator[Piece]:
    data = ids.astype("<u4").tobytes()
    for at in range(0, len(ids), length):
        n = min(length, len(ids) - at)
        yield doc_id, at, n, len(ids), data[4 * at:4 * (at + n)]


def _rows(window: list[Piece], sequence: int) -> Iterator[tuple]:
    offset = 0
    for p in window:
        yield (*p, sequence, offset)
        offset += p[2]


def _packer(path: str, length: int, windows: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held = TaskContext.get().partitionId(), 0, []
        open_ = Windows(length, windows)
        size = 0

        def batch(leftover: bool) -> pa.RecordBatch:
            cols = list(zip(*held)) if held else [()] * len(_KINDS)
            out = pa.RecordBatch.from_arrays(
                [*(pa.array(c, k) for c, k in zip(cols, _KINDS)), pa.array([part] * len(held), pa.int32()),
                 pa.array([leftover] * len(held), pa.bool_())], [*_NAMES, "part", "leftover"])
            held.clear()
            return out

        for b in batches:
            for doc_id, ids in zip(b.column(0).to_pylist(), documents_of(b.column(1), path)):
                for piece in cut(doc_id, ids, length):
                    for window in open_.place(piece):
                        held.extend(_rows(window, part << 32 | made))
                        made += 1
                        size += 4 * length
                if size > 4 << 20:
                    yield batch(False)
                    size = 0
        yield batch(False)
        while open_.held:
            held.extend(_rows(open_.take(0), part << 32 | made))
            made += 1
        yield batch(True)

    return pack


def _merger(length: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, held, fill = _MERGED + TaskContext.get().partitionId(), 0, [], 0
        for b in batches:
            for doc_id, start, n, tokens, ids in zip(*(b.column(k).to_pylist() for k in range(5))):
                at = 0
                while at < n:
                    take = min(n - at, length - fill)
                    held.append((doc_id, start + at, take, tokens, ids[4 * at:4 * (at + take)], task << 32 | made, fill))
                    at, fill = at + take, fill + take
                    if fill == length:
                        made, fill = made + 1, 0
            cols = list(zip(*held)) if held else [()] * len(_KINDS)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, _KINDS)], _NAMES)
            held.clear()

    return merge


def pack(docs: DataFrame, path: str, length: int = LENGTH, windows: int = WINDOWS) -> DataFrame:
    """Pieces of packed sequences for ``docs`` (doc_id, text): doc_id, start (ids
    of its document before the piece), length, doc_tokens, ids (little-endian
    unsigned 32-bit integers), sequence_id, offset.  The tokenizer file is at
    ``path``; each document ends with the end id.  A null or empty text is that
    id alone.  Null ids and repeated rows are documents like any other (each id
    of each row lies in one piece); an empty table gives no rows."""
    spark = docs.sparkSession
    src = columns(docs, doc_id="long", text="string").withColumn("text", not_null_text())
    folder = new_folder(spark, "packed")
    src.mapInArrow(_packer(path, length, windows), f"{SCHEMA}, part int, leftover boolean") \
        .write.option("compression", "zstd").partitionBy("leftover").parquet(folder)
    done = spark.read.schema(f"{SCHEMA}, part int, leftover boolean").parquet(folder)
    left = done.where("leftover")
    parts = left.agg(F.countDistinct("part")).first()[0]
    groups = max(1, -(-parts // MERGE))
    merged = left.withColumn("g", F.pmod("part", F.lit(groups))).repartition(groups, "g") \
        .sortWithinPartitions("g", "part", "sequence_id", "offset").select(*_NAMES).mapInArrow(_merger(length), SCHEMA)
    return done.where("NOT leftover").select(*_NAMES).unionByName(merged)
