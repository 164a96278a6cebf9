"""Merkle dataset manifest: a 16-ary tree per source and one over the sources' roots.

Digests are SHA-256, lower-case hex, and are joined as hex text.  A leaf is the
digest of a row's fields.  Leaves of a source ascend by doc_id; while more than one
node remains, every 16 consecutive ones (the last run may be shorter) become
their digest.  The last node is the source's subroot.  Subroots, ordered by source
(null first, then by UTF-8 bytes), are leaves of the upper tree, whose last
node is the root.

A parent retains the hash state before each child's slot (:class:`Parent`).  To fold
a changed child into its parent, the state before its slot is copied, fed
with the replacement and the siblings on its right, and finished: what lies
to the left is never hashed again.

The work is spread by position.  Rows are range-partitioned by (source, doc_id); a
count per partition and source gives each row its gapless position, without a window
over a source.  Blocks of 256 consecutive nodes (two levels) are then hashed together,
level pair by level pair, so a source of any size is many tasks; a round
has 1/256 of the rows of the one below.  On the way back down each block gets the path of
its top node (16 children a level) and hands paths to its nodes; the blocks of
leaves fold every row up to the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpie.llm.common import columns, parallelism, write_and_read

FAN = 16
BLOCK = FAN * FAN
ROWS = 1 << 20          # rows a range partition
_ROW = (1 << 33) - 1    # the part of monotonically_increasing_id that counts within a partition
_UPPER = ""             # the key of the tree over the subroots; sources' keys begin with 0 or 1


# --- one tree, in a task -------------------------------------------------------------------------

class Parent:
    """A node with its children's digests (hex) and the hash state before each slot."""

    __slots__ = ("before", "digest", "joined")

    def __init__(self, children: list[bytes]):
        state, self.before = hashlib.sha256(), []
        for child in children:
            self.before.append(state.copy())
            state.update(child)
        self.joined = b"".join(children)
        self.digest = state.hexdigest().encode()

    def siblings(self, slot: int) -> bytes:
        return self.joined[:64 * slot] + self.joined[64 * (slot + 1):]

    def fold(self, slot: int, digest: bytes) -> bytes:
        """The digest of this node with another child in ``slot``."""
        state = self.before[slot].copy()
        state.update(digest)
        state.update(self.joined[64 * (slot + 1):])
        return state.hexdigest().encode()


def depth(n: int) -> int:
    """Levels between ``n`` nodes and the one that remains of them."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def rise(digests: list[bytes], levels: int) -> list[list[Parent]]:
    """The parents of consecutive nodes, level by level; the first node begins a run."""
    out = []
    for _ in range(levels):
        out.append([Parent(digests[i:i + FAN]) for i in range(0, len(digests), FAN)])
        digests = [p.digest for p in out[-1]]
    return out


def climb(grown: list[list[Parent]], at: int) -> list[tuple[Parent, int]]:
    """(parent, slot) of a node on each level of ``rise``'s result."""
    out = []
    for level in grown:
        out.append((level[at // FAN], at % FAN))
        at //= FAN
    return out


def pack_path(path: list[tuple[Parent, int]]) -> bytes:
    """Per level: slot, number of children, the children's digests (32 bytes each)."""
    return b"".join(bytes((slot, len(p.joined) // 64)) + bytes.fromhex(p.joined.decode()) for p, slot in path)


def unpack_path(data: bytes) -> list[tuple[Parent, int]]:
    out, at = [], 0
    while at < len(data):
        slot, m = data[at], data[at + 1]
        out.append((Parent([data[at + 2 + 32 * k:at + 34 + 32 * k].hex().encode() for k in range(m)]), slot))
        at += 2 + 32 * m
    return out


def fold(path: list[tuple[Parent, int]], digest: bytes) -> bytes:
    """The root that a digest at the path's lower end leads to."""
    for parent, slot in path:
        digest = parent.fold(slot, digest)
    return digest


# --- leaves and positions ------------------------------------------------------------------------

def leaf_digest(*values: Column) -> Column:
    """Digest of fields: each ``-`` if null, else UTF-8 byte count, ``:``, value."""
    texts = [v.cast("string") for v in values]
    parts = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
             for t in texts]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def with_positions(rows: DataFrame, order: list[str], parts: int) -> DataFrame:
    """``rows`` (``tree`` and others) with ``pos``, gapless from 0 in each tree by ``order``,
    and ``n``, the rows of the tree.  Rows that tie in all of ``order`` spread over
    partitions as needed, so they must be alike in what matters."""
    laid = rows.withColumn("_tie", F.monotonically_increasing_id()) \
        .repartitionByRange(parts, "tree", *order, "_tie").sortWithinPartitions("tree", *order, "_tie").drop("_tie") \
        .withColumn("part", F.spark_partition_id()) \
        .withColumn("row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW)))
    laid = write_and_read(laid, "merkle-sorted")
    counts = laid.groupBy("tree", "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("m"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)   # a row a partition
    offsets = counts.select("tree", "part", (F.coalesce(F.sum("m").over(before), F.lit(0)) - F.col("first")).alias("base"),
                            F.sum("m").over(Window.partitionBy("tree")).alias("n"))
    return write_and_read(laid.join(offsets, ["tree", "part"])
                          .withColumn("pos", F.col("base") + F.col("row")).drop("part", "row", "base"), "merkle-leaves")


# --- trees as tables -----------------------------------------------------------------------------

def _hexes(column: pa.ChunkedArray) -> list[bytes]:
    return [d.hex().encode() for d in column.to_pylist()]


def _rise_block(nodes: pa.Table) -> pa.Table:
    nodes = nodes.sort_by("pos")
    n = nodes["n"][0].as_py()
    levels = min(2, depth(n))
    top = rise(_hexes(nodes["digest"]), levels)[-1][0]
    for _ in range(levels):
        n = -(-n // FAN)
    return pa.table({"tree": nodes["tree"].slice(0, 1), "pos": pa.array([nodes["pos"][0].as_py() // BLOCK], pa.int64()),
                     "n": pa.array([n], pa.int64()), "digest": pa.array([bytes.fromhex(top.digest.decode())], pa.binary())})


def _blocks(nodes: DataFrame):
    return nodes.withColumn("block", F.floor(F.col("pos") / BLOCK)).groupBy("tree", "block")


def _grow(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The rounds of nodes with a parent, from the leaves up, and each tree's last node."""
    rounds, tops = [], nodes.where("n = 1").select("tree", "digest")
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        rounds.append(nodes.where("n > 1"))
        nodes = write_and_read(_blocks(rounds[-1].select("tree", "pos", "n", "digest"))
                               .applyInArrow(_rise_block, "tree string, pos long, n long, digest binary"), "merkle-nodes")
        tops = tops.unionByName(nodes.where("n = 1").select("tree", "digest"))
        most = -(-most // BLOCK)
    return rounds, tops


def _path_block(nodes: pa.Table, above: pa.Table) -> pa.Table:
    nodes, path = nodes.sort_by("pos"), above["path"][0].as_py()
    grown = rise(_hexes(nodes["digest"]), min(2, depth(nodes["n"][0].as_py())))
    return pa.table({"tree": nodes["tree"], "pos": nodes["pos"],
                     "path": pa.array([pack_path(climb(grown, i)) + path for i in range(len(nodes))], pa.binary())})


def _descend(rounds: list[DataFrame], paths: DataFrame) -> DataFrame:
    """Paths (tree, pos, path) of the lowest round's blocks, from those of the trees' last nodes (tree, path)."""
    paths = paths.withColumn("pos", F.lit(0).cast("long"))
    for nodes in reversed(rounds[1:]):
        ended = paths.join(nodes.select("tree").distinct(), "tree", "left_anti")    # trees that end below this round
        lower = _blocks(nodes.select("tree", "pos", "n", "digest")) \
            .cogroup(paths.withColumnRenamed("pos", "block").join(nodes.select("tree").distinct(), "tree", "left_semi")
                     .groupBy("tree", "block")).applyInArrow(_path_block, "tree string, pos long, path binary")
        paths = write_and_read(lower.unionByName(ended), "merkle-paths")
    return paths


PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _prove_block(nodes: pa.Table, above: pa.Table) -> pa.Table:
    nodes = nodes.sort_by("pos")
    leaves, claimed = _hexes(nodes["digest"]), nodes["claimed"].to_pylist()
    grown = rise(leaves, min(2, depth(nodes["n"][0].as_py())))
    path, upper = unpack_path(above["path"][0].as_py()), above["upper"][0].as_py()
    root = above["root"][0].as_py().hex()
    below = len(path) - upper                   # levels of the source's own tree above the block
    out: list[list] = [[] for _ in range(6)]
    for i, leaf in enumerate(leaves):
        way = climb(grown, i) + path
        own = len(grown) + below
        subroot = way[own - 1][0].digest if own else leaf
        proof = hashlib.sha256()
        for parent, slot in way:
            proof.update(parent.siblings(slot))
        folded = fold(way, leaf if claimed[i] is None else claimed[i].hex().encode()).decode()
        for column, value in zip(out, (leaf.decode(), subroot.decode(), root, proof.hexdigest(), folded, folded == root)):
            column.append(value)
    kinds = [pa.string()] * 5 + [pa.bool_()]
    names = ["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return pa.table({"doc_id": nodes["doc_id"], **{n: pa.array(c, k) for n, c, k in zip(names, out, kinds)}})


class Manifest:
    """The tree over ``docs`` (doc_id, source, lang, n_chars, text), kept as tables.

    ``claim`` is an expression over these columns: the text that a row is said to have, or
    null for its own.  :meth:`prove` folds it.

    Null sources make a tree of their own, the first.  Null ids come first in their source;
    rows that share an id are ordered by their digest; rows that repeat in all
    fields are leaves of their own.  Texts are hashed whole; null fields count as ``-``.  Other
    columns are ignored.  An empty table has no rows, and its root is None."""

    def __init__(self, docs: DataFrame, claim: Column | None = None):
        src = columns(docs, doc_id="long", source="string", lang="string", n_chars="long", text="string")
        claim = F.lit(None).cast("string") if claim is None else claim
        fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
        leaves = src.select(
            F.when(F.col("source").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), "source")).alias("tree"), "doc_id",
            leaf_digest(*fields, F.col("text")).alias("digest"),
            F.when(claim.isNotNull(), leaf_digest(*fields, claim)).alias("claimed"))
        parts = max(parallelism(docs.sparkSession), -(-src.count() // ROWS))
        self.leaves = with_positions(leaves, ["doc_id", "digest"], parts)
        self._rounds, self.subroots = _grow(self.leaves)
        sources = self.subroots.select(F.lit(_UPPER).alias("tree"), F.col("tree").alias("source"), "digest")
        self.sources = with_positions(sources, ["source"], parts)
        self._upper, top = _grow(self.sources)
        root = top.first()
        self.root: str | None = None if root is None else bytes(root["digest"]).hex()

    def _source_paths(self) -> DataFrame:
        """tree, path and number of levels of the way from each subroot to the root."""
        start = self.sources.sparkSession.createDataFrame([(_UPPER, bytearray())], "tree string, path binary")
        if not self._upper:
            return self.sources.select(F.col("source").alias("tree"), F.lit(b"").alias("path"), F.lit(0).alias("upper"))
        blocks = _descend(self._upper, start).withColumnRenamed("pos", "block")
        paths = _blocks(self.sources.select("tree", "pos", "n", "digest")) \
            .cogroup(blocks.groupBy("tree", "block")).applyInArrow(_path_block, "tree string, pos long, path binary")
        most = depth(self.sources.agg(F.max("n")).first()[0])
        return self.sources.select("pos", F.col("source").alias("tree")) \
            .join(paths.select("pos", "path"), "pos").select("tree", "path", F.lit(most).alias("upper"))

    def prove(self) -> DataFrame:
        """Per row: doc_id, leaf, subroot, root, proof_sha256 (digest of all siblings, level by level, left to
        right), folded_root (from the claimed text, else the row's own, and the siblings), verified."""
        tops = write_and_read(self._source_paths().withColumn("root", F.unhex(F.lit(self.root))), "merkle-tops")
        blocks = _descend(self._rounds, tops.select("tree", "path")).withColumnRenamed("pos", "block")
        blocks = blocks.join(tops.select("tree", "upper", "root"), "tree")
        return _blocks(self.leaves).cogroup(blocks.groupBy("tree", "block")).applyInArrow(_prove_block, PROOF)
