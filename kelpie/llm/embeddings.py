"""Embedding near-dedup: spherical-cap filters over a random product code.

Filter directions are pairs of random unit codewords, one for each half of a
randomly rotated space; with B codewords a half there are B*B directions, and
``CODES`` such codes or more, each with a rotation of its own.  A vector is list-decoded
to *all* directions whose inner product with it exceeds a threshold: its halves
are scored against the codewords, and only those pairs are formed whose sum can
still exceed.  Vectors that share a filter are candidates, and their cosine is
computed in double precision.

The threshold comes from the share of the sphere that a cap covers, so that a
cap holds about ``CAP`` vectors at any table size and a vector enters about
``FILTERS`` caps of each code.  The caps of a larger table are narrower, and one
code finds fewer of its links.  So codes are added until two vectors at exactly
the cosine asked for share a filter with a probability of ``RECALL``: rotations
are independent, so the shares that each code misses multiply, and each is
measured on random pairs when the code is drawn (README, "Recall").

A pair that shares several filters counts only in the first of them, so a
vector's links are added up without ever listing the pairs.  A filter with more
than ``CELL`` vectors is split into blocks, and every two blocks are compared in
a task of their own: no cap, no sampling, and no task with an unbounded group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpie.llm.common import columns, parallelism, write_and_read
from kelpie.llm.components import components

COSINE = 0.9
CODES, FILTERS = 8, 4                   # least codes; filters of each that a vector enters on average
RECALL, AIM = 0.99, 0.993               # least share of pairs at the threshold that meet; the estimate aimed at for it
PAIRS = 2000                            # random pairs tried with each code
CAP, WIDEST = 64, 4e-3                  # vectors a filter; largest share of the sphere
CELL = 1024
LEAST_DIM = 16


def cap_share(threshold: float, dim: int) -> float:
    """Share of the unit sphere in ``dim`` dimensions beyond ``threshold`` of a direction."""
    x = np.linspace(-1, 1, 200_001)[1:-1]
    density = np.exp((dim - 3) / 2 * np.log1p(-x * x))
    return float(density[x >= threshold].sum() / density.sum())


def threshold_for(share: float, dim: int) -> float:
    lo, hi = 0.0, 1.0
    for _ in range(40):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cap_share(mid, dim) > share else (lo, mid)
    return lo


class Code:
    """Random product codes for ``rows`` vectors of ``dim`` dimensions: at least
    ``codes``, and as many more as links at ``cosine`` need for ``RECALL`` (estimate: ``recall``)."""

    def __init__(self, dim: int, rows: int, seed: int = 7, codes: int = CODES, filters: float = FILTERS,
                 cap: int = CAP, cosine: float = COSINE):
        self.dim = max(dim, LEAST_DIM)
        rng = np.random.Generator(np.random.PCG64(seed))
        pairs = np.random.Generator(np.random.PCG64([seed, 1]))
        share = min(WIDEST, cap / max(1, rows))
        self.words = int(np.ceil(np.sqrt(filters / share)))
        self.threshold = threshold_for(share, self.dim) * np.sqrt(2)    # of the sum of both halves
        half = self.dim // 2
        self.codes = []
        missed = 1.0
        while len(self.codes) < codes or missed > 1 - AIM:
            turn = np.linalg.qr(rng.standard_normal((self.dim, self.dim)))[0][:dim]
            book = [rng.standard_normal((self.words, n)) for n in (half, self.dim - half)]
            # rotation and codewords in one: a vector's scores are one product with each matrix
            self.codes.append([turn[:, part] @ (b / np.linalg.norm(b, axis=1, keepdims=True)).T
                               for part, b in zip((slice(0, half), slice(half, None)), book)])
            missed *= 1 - self._met(len(self.codes) - 1, *_pairs(pairs, dim, cosine))
        self.recall = 1 - missed

    def _met(self, i: int, x: np.ndarray, y: np.ndarray) -> float:
        """Share of the pairs (x, y) that share a filter of code ``i``."""
        met = 0
        for at in range(0, len(x), 100):
            a, b = (np.stack(self._decode(i, v[at:at + 100]), 1) for v in (x, y))
            both = np.concatenate([a, b])
            found, times = np.unique(both, axis=0, return_counts=True)
            met += len(np.unique(found[times > 1, 0]))
        return met / len(x)

    def _decode(self, i: int, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, filters = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        first, second = (unit @ m for m in self.codes[i])
        row, word = np.nonzero(first >= (self.threshold - second.max(1))[:, None])
        for at in range(0, len(row), 4096):
            r, w = row[at:at + 4096], word[at:at + 4096]
            k, v = np.nonzero(second[r] >= (self.threshold - first[r, w])[:, None])
            rows.append(r[k])
            filters.append((i * self.words + w[k]) * self.words + v)
        return np.concatenate(rows), np.concatenate(filters)

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (vector, filter) whose inner product exceeds the threshold."""
        rows, filters = zip(*(self._decode(i, unit) for i in range(len(self.codes))))
        return np.concatenate(rows), np.concatenate(filters)


def _pairs(rng: np.random.Generator, dim: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """``PAIRS`` random pairs of unit vectors at exactly ``cosine`` (one dimension has equal ones only)."""
    x, z = rng.standard_normal((2, PAIRS, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if dim < 2:
        return x, x
    z -= (z * x).sum(1, keepdims=True) * x
    return x, cosine * x + np.sqrt(1 - cosine ** 2) * z / np.linalg.norm(z, axis=1, keepdims=True)


def _unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    v = v / np.abs(v).max(1, keepdims=True)     # no overflow or underflow in the norm
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _decoder(code, dim: int, item: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = code.value
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                v = _matrix(part.column(2), dim)
                row, filt = c.decode(_unit(v))
                order = np.lexsort((filt, row))
                row, filt = row[order], filt[order]
                bounds = np.searchsorted(row, np.arange(part.num_rows + 1))
                own = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(filt))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(filt), part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)),
                     part.column(2).take(pa.array(row)), own.take(pa.array(row))],
                    ["filter", "id", "n", "v", "filters"])

    return run


def spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest of a symmetric link matrix."""
    fresh, out = np.ones(len(linked), bool), []
    for s in range(len(linked)):
        if not fresh[s]:
            continue
        fresh[s] = False
        front = [s]
        while front:
            x = front.pop()
            near = np.flatnonzero(linked[x] & fresh)
            fresh[near] = False
            out += [(x, y) for y in near.tolist()]
            front += near.tolist()
    return out


def compare(filt: int, n: np.ndarray, unit: np.ndarray, side: np.ndarray | None, offsets: np.ndarray,
            filters: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """One cell: the rows with links that count here, how many vectors they link to, and a forest of those links.
    ``side``: the block of each row where two blocks of a split filter meet, else None."""
    linked = unit @ unit.T >= cosine
    np.fill_diagonal(linked, False)
    if side is not None:
        linked &= side[:, None] != side[None, :]
    at = np.flatnonzero(linked.any(1))
    if not len(at):
        return at, n[at], []
    linked = linked[np.ix_(at, at)]
    size = offsets[at + 1] - offsets[at]
    who = np.repeat(np.arange(len(at)), size)
    own = filters[np.repeat(offsets[at] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())]
    who, own = who[own < filt], own[own < filt]
    name, inverse, times = np.unique(own, return_inverse=True, return_counts=True)
    shared = times[inverse] > 1
    column = np.cumsum(times > 1)[inverse[shared]] - 1
    holds = np.zeros((len(at), int((times > 1).sum())), np.float32)
    holds[who[shared], column] = 1
    linked &= holds @ holds.T == 0          # a pair with an earlier filter in common counts there
    return at, linked @ n[at], [(int(at[x]), int(at[y])) for x, y in spanning(linked)]


def _verifier(dim: int, cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        out: list[tuple[int, int, int | None]] = []

        def cell() -> None:
            if not held or sum(b.num_rows for b in held) < 2:
                return
            t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            ids = t.column(3).to_numpy()
            lists = t.column(7)
            offsets = lists.offsets.to_numpy()
            side = None if key[1] == key[2] else t.column(4).to_numpy()
            at, n, forest = compare(key[0], t.column(5).to_numpy(), _unit(_matrix(t.column(6), dim)), side,
                                    offsets, lists.values.to_numpy(), cosine)
            out.extend((int(ids[i]), int(k), None) for i, k in zip(at, n) if k)
            out.extend((int(ids[x]), 0, int(ids[y])) for x, y in forest)

        def rows() -> pa.RecordBatch:
            cols = list(zip(*out)) if out else [(), (), ()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["id", "links", "other"])

        for b in batches:
            if not b.num_rows:
                continue
            k = np.stack([b.column(i).to_numpy() for i in range(3)], 1)
            cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1).tolist(), len(k)]
            for a, z in zip(cuts[:-1], cuts[1:]):
                this = tuple(k[a].tolist())
                if this != key:
                    cell()
                    held.clear()
                    key = this
                held.append(b.slice(a, z - a))
            yield rows()
        cell()
        yield rows()

    return run


def link(vectors: DataFrame, cosine: float = COSINE, seed: int = 7, codes: int = CODES,
         filters: float = FILTERS, cell: int = CELL) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): vec_id, n_links (other
    vectors linked directly), component_id (smallest vec_id reachable), kept.

    Equal vectors are one class and all link with one another; different vectors
    link if their cosine is ``cosine`` or more and they share a filter.  A vector
    that is null, empty, zero or holds a null or non-finite component links with
    nothing.  Where lengths differ, shorter vectors count as filled up with
    zeros.  A null vec_id takes part but is never a component's id nor kept; an
    empty table gives no rows; other columns are not looked at."""
    spark = vectors.sparkSession
    kind = next(f.dataType for f in vectors.schema.fields if f.name == "embedding").elementType
    item = "float" if isinstance(kind, T.FloatType) else "double"
    rows = columns(vectors, vec_id="long", embedding=f"array<{item}>").withColumnRenamed("embedding", "v")
    usable = F.expr("v IS NOT NULL AND exists(v, x -> x <> 0) AND "
                    "forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    rows = rows.withColumn("ok", F.coalesce(usable, F.lit(False)))
    dim = rows.where("ok").agg(F.max(F.size("v"))).first()[0] or 1
    filled = F.when(F.size("v") < dim, F.concat("v", F.array_repeat(F.lit(0).cast(item), F.lit(dim) - F.size("v")))) \
        .otherwise(F.col("v"))
    keyed = rows.withColumn("v", F.when(F.col("ok"), filled)) \
        .withColumns({"k1": F.xxhash64(F.lit(1), "v"), "k2": F.xxhash64(F.lit(2), "v")})
    classes = write_and_read(
        keyed.where("ok").groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("rep"),
                                                  F.first("v").alias("v"))
        .withColumn("id", F.monotonically_increasing_id()), "vector-classes")

    code = spark.sparkContext.broadcast(Code(dim, classes.count(), seed, codes, filters, cosine=cosine))
    entries = classes.select("id", "n", "v").mapInArrow(
        _decoder(code, dim, item), f"filter long, id long, n long, v array<{item}>, filters array<long>")
    full = write_and_read(entries.groupBy("filter").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > cell)
                          .select("filter", F.ceil(F.col("m") / cell).cast("long").alias("blocks")), "full-filters")
    split = entries.join(full, "filter", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long"))) \
        .withColumn("side", F.pmod(F.xxhash64("id"), F.col("blocks"))) \
        .withColumn("to", F.explode(F.expr("sequence(0L, blocks - 1)"))) \
        .select("filter", F.least("side", "to").alias("c1"), F.greatest("side", "to").alias("c2"), "id", "side", "n", "v",
                "filters")
    cells = split.repartition(parallelism(spark), "filter", "c1", "c2").sortWithinPartitions("filter", "c1", "c2", "id")
    found = write_and_read(cells.mapInArrow(_verifier(dim, cosine), "id long, links long, other long"), "vector-links")

    degree = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.where("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b")))
    rooted = classes.select("id", "k1", "k2", "n", "rep") \
        .join(roots, F.col("id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "id"))
    smallest = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_class = rooted.join(smallest, "root").join(degree, "id", "left") \
        .select("k1", "k2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    linked = keyed.where("ok").select("vec_id", "k1", "k2").join(of_class, ["k1", "k2"]) \
        .select("vec_id", "n_links", "component_id")
    alone = keyed.where("NOT ok").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                         F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone) \
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
