"""Mixing sources to target weights.

Each source is a stream of words, cut into blocks of ``BLOCK`` words.  A source
gets as many output slots as its target holds blocks, and a multinomial draw
says how many of them each output shard takes.  Slot j of a source is mapped to
a block by pseudorandom permutations of the source's block indexes (a new one
for each pass over the source), so no block is taken a second time before all
were taken once, and none more than twice.  Slots and blocks are then joined by
block index.

The draws are conditioned on the sources' totals: a source's slots fall on the
shards by a multinomial draw with equal shares.  Given a shard's size, its
counts over the sources are then multinomial with the target weights, while
what a source gives in all is its target, to the block, at any table size.

For the join a source's stream runs through *lanes*: documents are dealt to
lanes of about ``LANE`` words by a hash of their content, and the lanes follow
one another in the stream.  There are as many lanes as words, rows and bytes ask
for.  Copies of one row that would fill an eighth of a lane are numbered and dealt in
portions below that, so neither a hot source nor a hot row is one lane.  A lane's texts and
the slots that name its blocks meet in one cogroup, so texts are shuffled once.
Nothing depends on files or partitions: reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpie.llm.common import not_null_text, parallelism, unique_names, write_and_read

BLOCK = 64              # words in a block
LANE = 1 << 18          # words in a lane, about
LANE_ROWS = 1 << 16     # rows in a lane at most, about: wordless ones count too
LANE_BYTES = 1 << 24    # and bytes of text
SHARD = 1 << 14         # blocks in an output shard, about
DRAW = 4096             # shards that one draw covers at most
WEIGHTS = (5, 2, 1)     # of the sources in code point order, null last, repeating
SHARE, MOST = 1.5, 2    # of all words that the mix takes; of a source's (and document's) words at most
SEED = 11
OUT = ("text", "s", "lane", "ord", "size", "words", "shard", "slot", "block", "epoch", "at")

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def word_starts(raw: bytes) -> np.ndarray:
    """Byte offsets at which the words of a UTF-8 text begin."""
    space = _SPACE[np.frombuffer(raw, np.uint8)]
    return np.flatnonzero(~space & np.concatenate([[True], space[:-1]])) if len(space) else np.zeros(0, np.int64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def permute(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1, one per key, at ``index``: a Feistel
    network on the next power of four, walked until it is inside again."""
    n, key = n.astype(np.uint64), key.astype(np.uint64)
    bits = np.maximum(1, (np.ceil(np.log2(np.maximum(2, n.astype(np.float64)))) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> bits[todo], out[todo] & mask[todo]
        for r in range(4):
            left, right = right, left ^ (_mix(right + _mix(key[todo] + np.uint64(r + 1))) & mask[todo])
        out[todo] = left << bits[todo] | right
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


# --- targets -------------------------------------------------------------------------------------

def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, s, target) from (source, size): s is the place in code
    point order, null last.  The sources share ``share`` of all words by weight;
    none gets more than ``most`` times its size, and what is above goes to the
    others by weight.  One row a source: the windows see nothing else."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size")) \
        .withColumn("s", F.row_number().over(order) - 1) \
        .withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                      (F.pmod("s", F.lit(len(weights))) + 1).cast("int"))) \
        .withColumn("top", F.col("source_size") * float(most))
    # sources that reach their limit first; the level is where the rest's share fits under all their limits
    by_level = Window.orderBy(F.col("top") / F.col("w"), "s")
    rows = ranked.withColumn("before", F.coalesce(F.sum("top").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))) \
        .withColumn("heavier", F.sum("w").over(by_level.rowsBetween(0, Window.unboundedFollowing))) \
        .withColumn("budget", F.sum("source_size").over(Window.partitionBy()) * float(share)) \
        .withColumn("level", (F.col("budget") - F.col("before")) / F.col("heavier")) \
        .withColumn("level", F.when(F.col("level") * F.col("w") <= F.col("top"), F.col("level"))) \
        .withColumn("level", F.first("level", ignorenulls=True).over(by_level.rowsBetween(Window.unboundedPreceding,
                                                                                         Window.unboundedFollowing)))
    return rows.select("source", "source_size", "s",
                       F.least(F.col("top"), F.coalesce(F.col("level") * F.col("w"), F.col("top"))).alias("target"))


# --- slots ---------------------------------------------------------------------------------------

def _draw(seed: int):
    """(s, blocks, slots, first, from, shards): deal ``slots`` to at most DRAW equal ranges of shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s, blocks, slots, first, a, shards in zip(*(b.column(k).to_pylist() for k in range(6))):
                width = -(-shards // DRAW)
                begin = np.arange(a, a + shards, width)
                size = np.minimum(width, a + shards - begin)
                rng = np.random.Generator(np.random.PCG64([seed, s, a, shards]))
                count = rng.multinomial(slots, size / shards)
                start = first + np.concatenate([[0], np.cumsum(count)[:-1]])
                at = np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), s)), pa.array(np.full(len(at), blocks)), pa.array(count[at]),
                     pa.array(start[at]), pa.array(begin[at]), pa.array(size[at])],
                    ["s", "blocks", "slots", "first", "a", "shards"])

    return run


_DRAWN = "s long, blocks long, slots long, first long, a long, shards long"


def _map_slots(seed: int):
    """Slot j of a source -> epoch and block index."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s, blocks, shard, j = (b.column(k).to_numpy() for k in range(4))
            epoch = j // blocks
            key = _mix((s * 8191 + epoch * 131 + seed).astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), b.column(3), pa.array(epoch), pa.array(permute(j % blocks, blocks, key))],
                ["s", "shard", "slot", "epoch", "block"])

    return run


# --- the mix -------------------------------------------------------------------------------------

def _cutter(schema: pa.Schema, text_at: int, size_at: int, lane_at: int, block: int, whole: bool):
    carry = [i for i in range(len(schema)) if i not in (text_at, size_at, lane_at, lane_at + 1)]

    def run(docs: pa.Table, slots: pa.Table) -> pa.Table:
        n = docs.num_rows
        texts = docs.column(text_at)
        size = docs.column(size_at).to_numpy()
        start = np.concatenate([[0], np.cumsum(size)])
        order = np.lexsort((slots["slot"].to_numpy(), slots["block"].to_numpy()))
        named = slots["block"].to_numpy()[order] - slots["base"].to_numpy()[order]      # block index in the lane
        info = {k: slots[k].to_numpy()[order] for k in ("shard", "slot", "epoch", "block")}
        row, text, words, slot, at = [], [], [], [], []
        for d in range(n):
            got = []
            if size[d]:
                lo, hi = np.searchsorted(named, [start[d] // block, (start[d + 1] - 1) // block + 1])
                if hi > lo:
                    raw = texts[d].as_py().encode("utf-8", "surrogatepass")
                    byte = np.append(word_starts(raw), len(raw))
                    byte[0] = 0
                    for k in range(lo, hi):
                        a = max(int(named[k]) * block - int(start[d]), 0)
                        z = min((int(named[k]) + 1) * block - int(start[d]), int(size[d]))
                        got.append((k, a, z, raw[byte[a]:byte[z]].decode("utf-8", "surrogatepass")))
            if whole and got:
                got.sort(key=lambda g: (info["epoch"][g[0]], g[1]))
                parts, last = [], 0
                for k, a, z, piece in got:
                    if parts and info["epoch"][k] != last and not parts[-1][-1:].isspace():
                        parts.append("\n")
                    parts.append(piece)
                    last = info["epoch"][k]
                got = [(got[0][0], 0, sum(z - a for _, a, z, _ in got), "".join(parts))]
            for k, a, z, piece in got or [(None, 0, 0, None)]:
                row.append(d)
                text.append(piece)
                words.append(z - a)
                slot.append(k)
                at.append(a)
        rows = pa.array(row, pa.int64())
        pick = pa.array(slot, pa.int64())
        lane = docs.column(lane_at).combine_chunks().take(rows), docs.column(lane_at + 1).combine_chunks().take(rows)
        out = [docs.column(i).combine_chunks().take(rows) for i in carry]
        out += [pa.array(text, pa.string()), *lane, rows, pa.array(size[row] if row else [], pa.int64()),
                pa.array(words, pa.int64())]
        out += [pa.array(info[k], pa.int64()).take(pick) for k in ("shard", "slot", "block", "epoch")]
        names = [schema.field(i).name for i in carry] + ["text", "s", "lane", "ord", "size", "words", "shard", "slot",
                                                         "block", "epoch", "at"]
        return pa.table([*out, pa.array(at, pa.int64())], names)

    return run


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        raw = [(b.column(2)[i].as_py() or "").encode("utf-8", "surrogatepass") for i in range(b.num_rows)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array([len(word_starts(r)) for r in raw], pa.int64()),
             pa.array([len(r) for r in raw], pa.int64())], ["source", "h", "size", "bytes"])


def _portions(counted: DataFrame, lane: int, rows: int, width: int) -> DataFrame:
    """(source, h, copies, size, bytes, per): rows of equal content that would fill an eighth of a lane, and how
    many of them make a portion."""
    def eighth(most: int, of: str):
        return F.greatest(F.lit(1), F.floor(F.lit(most // 8) / F.greatest(F.lit(1), F.col(of))))

    return counted.groupBy("source", "h").agg(F.count(F.lit(1)).alias("copies"), F.max("size").alias("size"),
                                              F.max("bytes").alias("bytes")) \
        .withColumn("per", F.least(eighth(lane, "size"), eighth(width, "bytes"), F.lit(max(1, rows // 8))).cast("long")) \
        .where("copies > per")


def _portion_hash(h, portion):
    return F.when(portion == 0, h).otherwise(F.xxhash64(h, portion))


class Mix:
    """A mix of ``docs`` (doc_id, text, source and any other columns).

    ``targets``  one row a source: source, source_size, s, target;
    ``pieces()`` the mix itself, a row for each run of words that a slot takes of a document;
    ``documents()`` what the mix takes of each document as one text.

    A null text is empty; a document without words is never taken.  Null is a
    source of its own, the last.  Rows that repeat are documents like any other.
    Input columns that clash with the mix's own come back with ``_in``
    appended.  An empty table gives no rows."""

    def __init__(self, docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK,
                 lane: int = LANE, shard: int = SHARD, seed: int = SEED, rows: int = LANE_ROWS, width: int = LANE_BYTES):
        self.docs = unique_names(docs, OUT[1:], ("doc_id", "text", "source"))
        self.block, self.seed = block, seed
        content = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
        counted = write_and_read(
            self.docs.select("source", content.alias("h"), "text").mapInArrow(_sizes, "source string, h long, size long, bytes long"),
            "mix-sizes")
        self.targets = write_and_read(targets(counted, weights, share, most), "mix-targets")
        hot = write_and_read(_portions(counted, lane, rows, width), "mix-copies")
        self.hot_rows = hot.count()
        placed = self.docs.withColumn("text", not_null_text()).withColumn("_mx_key", content)
        if self.hot_rows:
            same = hot.select(F.col("source").alias("_mx_source"), F.col("h").alias("_mx_h"), "per")
            is_hot = F.col("source").eqNullSafe(F.col("_mx_source")) & (F.col("_mx_key") == F.col("_mx_h"))
            copies = write_and_read(placed.join(same, is_hot).drop("_mx_source", "_mx_h")
                                    .withColumn("_mx_part", F.spark_partition_id()), "mix-hot")
            # a copy's number: the copies in earlier partitions and its place in its own
            each = copies.groupBy("source", "_mx_key", "_mx_part").agg(F.count(F.lit(1)).alias("_mx_n"))
            earlier = Window.partitionBy("source", "_mx_key").orderBy("_mx_part").rowsBetween(Window.unboundedPreceding, -1)
            each = each.select(F.col("source").alias("_mx_source"), F.col("_mx_key").alias("_mx_h"), F.col("_mx_part").alias("_mx_p"),
                               F.coalesce(F.sum("_mx_n").over(earlier), F.lit(0)).alias("_mx_base"))
            place = F.row_number().over(Window.partitionBy("source", "_mx_key", "_mx_part").orderBy("doc_id")) - 1
            numbered = copies.withColumn("_mx_i", place).join(
                each, F.col("source").eqNullSafe(F.col("_mx_source")) & (F.col("_mx_key") == F.col("_mx_h"))
                & (F.col("_mx_part") == F.col("_mx_p")))
            portion = F.floor((F.col("_mx_base") + F.col("_mx_i")) / F.col("per"))
            dealt = numbered.withColumn("_mx_key", _portion_hash(F.col("_mx_key"), portion)).select(*placed.columns)
            placed = placed.join(same, is_hot, "left_anti").unionByName(dealt)
            at = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / F.col("per")))).alias("portion")
            n = F.least(F.col("per"), F.col("copies") - F.col("portion") * F.col("per"))
            dealt = hot.select("*", at).select("source", _portion_hash(F.col("h"), F.col("portion")).alias("h"), (F.col("size") * n).alias("size"))
            mine = hot.select(F.col("source").alias("_mx_source"), F.col("h").alias("_mx_h"))
            keyed = counted.select("source", "h", "size").join(
                mine, F.col("source").eqNullSafe(F.col("_mx_source")) & (F.col("h") == F.col("_mx_h")), "left_anti").unionByName(dealt)
        else:
            keyed = counted.select("source", "h", "size")
        volume = counted.groupBy("source").agg(F.count(F.lit(1)).alias("_mx_rows"), F.sum("bytes").alias("_mx_bytes"))
        # written: its size is then known to be that of a row a source
        lanes_of = write_and_read(
            self.targets.join(volume.withColumnRenamed("source", "_mx_source"), F.col("source").eqNullSafe(F.col("_mx_source"))).select(
                "_mx_source", "s",
                F.greatest(F.lit(1).cast("long"), F.ceil(F.col("source_size") / lane), F.ceil(F.col("_mx_rows") / rows),
                           F.ceil(F.col("_mx_bytes") / width)).alias("_mx_lanes")), "mix-lane-counts")

        def in_lanes(df: DataFrame, h) -> DataFrame:
            # a row a source: broadcast where it is small, else a join whose hot keys Spark splits
            return df.join(lanes_of, df["source"].eqNullSafe(lanes_of["_mx_source"])) \
                .withColumn("lane", F.pmod(h, F.col("_mx_lanes"))).drop("_mx_source", "_mx_lanes")

        in_source = Window.partitionBy("s").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
        self._lanes = write_and_read(
            in_lanes(keyed, F.col("h")).groupBy("s", "lane").agg(F.sum("size").alias("words"))
            .withColumn("n", F.ceil(F.col("words") / block).cast("long"))
            .withColumn("base", F.coalesce(F.sum("n").over(in_source), F.lit(0).cast("long"))), "mix-lanes")
        blocks = self._lanes.groupBy("s").agg(F.sum("n").alias("blocks"))
        quota = write_and_read(
            self.targets.join(blocks, "s").where("source_size > 0")
            .select(F.col("s").cast("long").alias("s"), "blocks",
                    F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long").alias("slots")),
            "mix-quota")
        total = quota.agg(F.sum("slots")).first()[0] or 0
        shards = max(1, -(-total // shard))
        drawn = quota.where("slots > 0").select(
            "s", "blocks", "slots", F.lit(0).cast("long").alias("first"), F.lit(0).cast("long").alias("a"),
            F.lit(shards).cast("long").alias("shards"))
        width = shards
        while width > 1:        # one draw for up to DRAW shards, two for up to DRAW squared, ...
            drawn = drawn.mapInArrow(_draw(seed), _DRAWN)
            width = -(-width // DRAW)
        drawn = write_and_read(drawn, "mix-draws").repartition(parallelism(docs.sparkSession), "s", "a")
        slots = drawn.select("s", "blocks", F.col("a").alias("shard"),
                             F.explode(F.expr("sequence(first, first + slots - 1)")).alias("j")) \
            .mapInArrow(_map_slots(seed), "s long, shard long, slot long, epoch long, block long")
        # the lane that holds a block: lanes are entered in the block ranges they touch
        step = max(1, lane // block)
        ranges = self._lanes.where("n > 0").select(
            F.col("s").cast("long").alias("s"), "lane", "base", "n",
            F.explode(F.expr(f"sequence(base div {step}, (base + n - 1) div {step})")).alias("range"))
        self._slots = slots.withColumn("range", F.expr(f"block div {step}")).join(ranges, ["s", "range"]) \
            .where("block >= base AND block < base + n").select("s", "lane", "base", "shard", "slot", "epoch", "block")
        self._placed = in_lanes(placed, F.col("_mx_key")).drop("_mx_key").withColumn("s", F.col("s").cast("long"))

    def _run(self, whole: bool) -> DataFrame:
        names = [c for c in self.docs.columns if c != "text"]
        docs = self._placed.withColumn("size", F.lit(0).cast("long")) \
            .select(*names, "text", "size", "s", "lane", F.xxhash64("text").alias("_mx_h"))
        schema = T.StructType([*(f for f in self.docs.schema if f.name != "text"),
                               T.StructField("text", T.StringType()),
                               *(T.StructField(n, T.LongType()) for n in OUT[1:])])
        at, id_at = len(names), names.index("doc_id")
        block = self.block
        arrow = pa.schema([pa.field(n, pa.null()) for n in [*names, "text", "size", "s", "lane"]])
        cut = _cutter(arrow, at, at + 1, at + 2, block, whole)

        def lane(texts: pa.Table, slots: pa.Table) -> pa.Table:
            """The documents of a lane in the stream's order: by id, null first, then text."""
            keys = pa.table([texts.column(id_at), texts.column(at + 4)], ["id", "h"])
            order = pc.sort_indices(keys, sort_keys=[("id", "ascending"), ("h", "ascending")], null_placement="at_start")
            texts = texts.take(order).drop_columns(["_mx_h"])
            n = [len(word_starts(t.as_py().encode("utf-8", "surrogatepass"))) for t in texts.column(at)]
            return cut(texts.set_column(at + 1, "size", pa.array(n, pa.int64())), slots)

        return docs.groupBy("s", "lane").cogroup(self._slots.groupBy("s", "lane")).applyInArrow(lane, schema)

    def pieces(self, untaken: bool = False) -> DataFrame:
        """The mix: the input's columns with ``text`` the words taken (blanks kept),
        shard, slot (of its source; a shard's order is any order of its slots),
        block, epoch, at (word offset in the document), words, and the document's
        (s, lane, ord) and size.  ``untaken``: also a row of 0 words for each
        document that the mix takes nothing of."""
        out = self._run(False)
        return out if untaken else out.where("words > 0")

    def documents(self) -> DataFrame:
        """One row for each document that the mix takes anything of, with the input's
        columns; ``text`` is what it takes, a second pass behind the first."""
        return self._run(True).where("words > 0").select(*self.docs.columns)
