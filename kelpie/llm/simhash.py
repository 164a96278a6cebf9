"""SimHash near-dedup: segment-popcount embedding and a grid range-join.

A document's 64-bit fingerprint is the bitwise majority of the XXH64 hashes of
its word shingles.  Fingerprints within ``distance`` bits of each other link.

The join embeds a fingerprint as the bit counts of its 32 two-bit segments.  The
Manhattan distance of two such vectors is a lower bound of the Hamming distance.
Within four bits, one half of the vector (16 segments) therefore lies within
Manhattan distance two, so some grid point of that half lies within one of both.
Each fingerprint is entered at its own grid point and at the (at most 32) points
one step away, for either half: about 50 cells.  Fingerprints that share a cell
are candidates; the Manhattan distance of the whole vectors is tested, then the
exact Hamming distance.

A cell of up to ``CELL`` fingerprints is compared inside one task, which returns
links for a spanning forest of it, never all its pairs.  Fingerprints of fuller
cells (dense clusters) take an exact way that has no pairs at all: each is
entered under every 64-bit value within two bits, and fingerprints that share a
value link, because two fingerprints within four bits have a value within two of both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpie.llm.common import aside, columns, write_and_read
from kelpie.llm.components import components
from kelpie.llm.secret_scan import row_key

SHINGLE, DISTANCE = 4, 4
SEED = 42
CELL = 4096             # larger cells go the way without pairs
PAIRWISE = 32           # cells up to this size are compared pair by pair across a whole batch
SEGMENT, HALF = 2, 16   # bits in a segment, segments in a half


# --- fingerprints --------------------------------------------------------------------------------

def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit fingerprint; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()   # of bytes: A-Z, and the six blanks
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_digest
    if len(words) <= shingle:
        hashes = digest(joined, seed)
    else:
        size = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(size + 1) - 1
        spans = zip((end - size).tolist(), end[shingle - 1:].tolist())
        hashes = b"".join([digest(joined[a:b], seed) for a, b in spans])
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(rows), 1 << 15):
        ones += np.unpackbits(rows[at:at + (1 << 15)], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(rows)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keyed: bool = False) -> DataFrame:
    """(doc_id, fp) of every row, the fingerprint as a signed long; written to the
    shared folder.  ``keyed``: also h, the text's hash, and k1, k2 (:func:`row_key`)."""
    src = columns(docs, doc_id="long", text="string")
    more = [F.xxhash64("text").alias("h"), *row_key()] if keyed else []
    names = ["doc_id", "fp", *(["h", "k1", "k2"] if keyed else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(b.column(1)[i].as_py(), shingle) for i in range(b.num_rows)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), *b.columns[2:]], names)

    out = src.select("doc_id", "text", *more).mapInArrow(run, ", ".join(f"{n} long" for n in names))
    return write_and_read(out, "fingerprints")


# --- the grid ------------------------------------------------------------------------------------

def segment_counts(fp: np.ndarray) -> np.ndarray:
    """(n, 32) bit counts of the segments."""
    bits = np.unpackbits(fp.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.reshape(len(fp), -1, SEGMENT).sum(2, dtype=np.int8)


def cells(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grid cells a fingerprint is entered in: (cell, index into fp)."""
    base = SEGMENT + 1
    place = base ** np.arange(HALF, dtype=np.int64)
    counts = segment_counts(fp).astype(np.int64)
    cell, at = [], []
    for half in range(2):
        c = counts[:, half * HALF:(half + 1) * HALF]
        own = c @ place + (half << 40)
        cell.append(own)
        at.append(np.arange(len(fp)))
        for step, inside in ((1, c < SEGMENT), (-1, c > 0)):
            row, seg = np.nonzero(inside)
            cell.append(own[row] + step * place[seg])
            at.append(row)
    return np.concatenate(cell), np.concatenate(at)


def _enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = b.column(0).to_numpy()
        for k in range(0, len(fp), 1 << 14):
            part = fp[k:k + (1 << 14)]
            cell, at = cells(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(part[at])], ["cell", "fp"])


def _close(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    """Which of the candidate pairs link: first the lower bound, then the exact distance."""
    ok = np.zeros(len(a), bool)
    at = np.flatnonzero(np.abs(segment_counts(a) - segment_counts(b)).sum(1) <= distance)
    ok[at] = np.bitwise_count(a[at] ^ b[at]) <= distance
    return ok


def forest(fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected among the fingerprints of one cell: each
    is reached once and compared with those not yet reached, a block at a time."""
    a, b = [], []
    rest = np.unique(fp)
    front = rest[:0]
    while len(rest):
        if not len(front):
            front, rest = rest[:1], rest[1:]
            continue
        block, front = front[:64], front[64:]
        near = np.bitwise_count(block[:, None] ^ rest[None, :]) <= distance
        hit = near.any(0)
        a.append(rest[hit])
        b.append(block[near[:, hit].argmax(0)])
        front, rest = np.concatenate([front, rest[hit]]), rest[~hit]
    none = fp[:0]
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def cell_links(cell: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows that are sorted by cell."""
    start = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    size = np.diff(np.append(start, len(cell)))
    a, b = [fp[:0]], [fp[:0]]
    small = np.flatnonzero((np.repeat(size, size) <= PAIRWISE) & (np.repeat(size, size) > 1))
    for k in range(1, PAIRWISE):
        small = small[small + k < len(cell)]
        small = small[cell[small] == cell[small + k]]
        if not len(small):
            break
        for at in range(0, len(small), 1 << 18):
            x, y = fp[small[at:at + (1 << 18)]], fp[small[at:at + (1 << 18)] + k]
            ok = _close(x, y, distance)
            a.append(x[ok])
            b.append(y[ok])
    for s, n in zip(start[size > PAIRWISE].tolist(), size[size > PAIRWISE].tolist()):
        x, y = forest(fp[s:s + n], distance)
        a.append(x)
        b.append(y)
    return np.concatenate(a), np.concatenate(b)


def _verify(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def links(c, f) -> pa.RecordBatch:
            a, b = cell_links(c, f, distance)
            pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], 1), axis=0).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cell = np.concatenate([cell, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy().view(np.uint64)])
            whole = int(np.searchsorted(cell, cell[-1]))    # the last cell may go on in the next batch
            if whole:
                yield links(cell[:whole], fp[:whole])
                cell, fp = cell[whole:], fp[whole:]
        yield links(cell, fp)

    return run


def _ball(radius: int):
    one = np.uint64(1) << np.arange(64, dtype=np.uint64)
    masks = [np.zeros(1, np.uint64), one]
    if radius == 2:
        i, j = np.triu_indices(64, 1)
        masks.append(one[i] | one[j])
    masks = np.concatenate(masks[:radius + 1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy()
            for k in range(0, len(fp), 256):
                part = fp[k:k + 256]
                value = (part.view(np.uint64)[:, None] ^ masks).view(np.int64).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(np.repeat(part, len(masks)))], ["v", "fp"])

    return run


def links(fps: DataFrame, distance: int = DISTANCE, cell: int = CELL) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints (column fp, distinct) that
    chains of pairs within ``distance`` bits connect.  ``distance`` may be 0 to 4."""
    if not 0 <= distance <= 4:
        raise ValueError("the grid's reach covers up to four bits")
    entries = fps.select("fp").mapInArrow(_enter, "cell long, fp long")
    full = write_and_read(entries.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell)
                          .select("cell"), "full-cells")
    light = entries.join(full, "cell", "left_anti").repartition("cell").sortWithinPartitions("cell")
    found = light.select("cell", "fp").mapInArrow(_verify(distance), "a long, b long")
    dense = entries.join(full, "cell", "left_semi").select("fp").distinct()
    if full.isEmpty():
        return found
    # a value within distance // 2 bits of one and within the rest of the distance of the other
    hubs = dense.mapInArrow(_ball(distance // 2), "v long, fp long").groupBy("v").agg(F.min("fp").alias("a"))
    spokes = dense.mapInArrow(_ball(distance - distance // 2), "v long, fp long").withColumnRenamed("fp", "b")
    return found.unionByName(spokes.join(hubs, "v").where("a <> b").select("a", "b").distinct())


def _rooted(rows: DataFrame, distance: int, cell: int) -> DataFrame:
    """(fp, rep, root) of every distinct fingerprint: its smallest doc_id, and the smallest fingerprint reachable."""
    nodes = write_and_read(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fingerprint-nodes")
    roots = components(links(nodes, distance, cell))
    return nodes.join(roots, nodes["fp"] == roots["node"], "left") \
        .select("fp", "rep", F.coalesce("root", "fp").alias("root"))


def cluster(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, cell: int = CELL) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, fp (signed long) and
    component_id, the smallest doc_id reachable by links, its own included.

    Texts without words (null, empty, blanks) have fingerprint zero and link
    like any other.  Repeated rows and equal fingerprints are one node.  A null
    doc_id takes part; it is never a component's id, which is null where no id is known.
    An empty table gives no rows."""
    rows = fingerprints(docs, shingle)
    rooted = _rooted(rows, distance, cell)
    smallest = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    by_fp = rooted.join(smallest, "root").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, cell: int = CELL) -> DataFrame:
    """``docs`` with one row left of every component: that of the smallest doc_id
    (a null one comes last), or where that repeats, the one whose text hashes
    lowest; all columns stay.  A component is known by its root fingerprint, so
    ids that are null or occur in several components lose none."""
    found = fingerprints(docs, shingle, keyed=True)
    keys = found.groupBy("fp", "doc_id", "h", "k1", "k2").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h", "k1", "k2", "n"))
    best = keys.groupBy("fp").agg(first.alias("r")).join(_rooted(found, distance, cell), "fp") \
        .groupBy("root").agg(F.min("r").alias("r"))
    kept = write_and_read(best.select(F.col("r.k1").alias("_sh_k1"), F.col("r.k2").alias("_sh_k2"), "r.n"),
                          "kept-documents")
    rows = aside(docs, "doc_id", "text")
    typed = rows.withColumns({"_sh_id": F.col("doc_id").cast("long"), "_sh_text": F.col("text").cast("string")})
    k1, k2 = row_key("_sh_text", "_sh_id")
    keyed = typed.withColumns({"_sh_k1": k1, "_sh_k2": k2})
    on = ["_sh_k1", "_sh_k2"]
    single = keyed.join(kept.where("n = 1"), on, "left_semi").select(*rows.columns)
    if kept.where("n > 1").isEmpty():
        return single.toDF(*docs.columns)
    # rows that agree in id and text
    row = F.struct(*[F.col(c) for c in rows.columns])
    several = keyed.join(kept.where("n > 1"), on, "left_semi") \
        .groupBy(*on).agg(F.first(row).alias("r")).select("r.*")
    return single.unionByName(several).toDF(*docs.columns)
