"""Merkle manifest against a plain recursive version."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from kelpie.llm import merkle
from kelpie.llm.queries import op13_merkle_manifest

from .helpers import awkward, clashing, documents


def H(x):
    return hashlib.sha256(x.encode()).hexdigest()


def plain_leaf(d, t, lang, source, n):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d, source, lang, n, t)))


def plain_levels(nodes):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [H("".join(nodes[i:i + 16])) for i in range(0, len(nodes), 16)]
        out.append(nodes)
    return out


def plain_fold(levels, at, digest):
    """(siblings, folded top) of a changed node."""
    siblings = []
    for nodes in levels[:-1]:
        run = nodes[at // 16 * 16:at // 16 * 16 + 16]
        siblings += run[:at % 16] + run[at % 16 + 1:]
        run[at % 16] = digest
        digest, at = H("".join(run)), at // 16
    return siblings, digest


def plain(rows):
    """doc_id, leaf, subroot, root, proof, folded root, verified of (doc_id, text, lang, source, n_chars)."""
    trees = {}
    for r in rows:
        trees.setdefault(r[3], []).append((r, plain_leaf(*r)))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        trees[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    grown = {s: plain_levels([leaf for _, leaf in trees[s]]) for s in order}
    upper = plain_levels([grown[s][-1][0] for s in order])
    root, out = upper[-1][0], []
    for k, s in enumerate(order):
        for i, ((d, t, lang, _, n), leaf) in enumerate(trees[s]):
            claimed = leaf
            if d is not None and t is not None and zlib.crc32(str(d).encode()) % 5 == 0:
                low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
                claimed = plain_leaf(d, low, lang, s, n)
            own, top = plain_fold(grown[s], i, claimed)
            more, folded = plain_fold(upper, k, top)
            out.append((d, leaf, grown[s][-1][0], root, H("".join(own + more)), folded, folded == root))
    return out


@pytest.mark.parametrize("n", [1, 2, 16, 17, 33, 256, 257])
def test_parents_fold_from_the_state_before_the_slot(n):
    digests = [H(str(i)).encode() for i in range(n)]
    grown = merkle.rise(digests, merkle.depth(n))
    levels = plain_levels([d.decode() for d in digests])
    assert [[p.digest.decode() for p in level] for level in grown] == levels[1:]
    for at in {0, n // 2, n - 1}:
        path = merkle.climb(grown, at)
        assert merkle.pack_path(merkle.unpack_path(merkle.pack_path(path))) == merkle.pack_path(path)
        for way in (path, merkle.unpack_path(merkle.pack_path(path))):
            siblings, folded = plain_fold(levels, at, H("other"))
            assert merkle.fold(way, H("other").encode()).decode() == folded
            assert "".join(p.siblings(s).decode() for p, s in way) == "".join(siblings)


def run_query(spark, path, rows):
    documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    return sorted(map(str, (tuple(r) for r in op13_merkle_manifest(spark, str(path)).collect())))


def with_length(rows):
    return [(d, t, lang, s, None if t is None else len(t)) for d, t, lang, s in rows]


def test_awkward_rows(spark, tmp_path):
    rows = awkward() + [(600 + i, f"Upper CASE ÄÖ {i}", "en", f"s{i % 3}") for i in range(30)]
    got = run_query(spark, tmp_path, rows)
    assert got == sorted(map(str, plain(with_length(rows))))
    docs = documents(spark, rows)
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256"]
    assert sorted(merkle.Manifest(clashing(docs)).prove().select(*columns).collect(), key=str) \
        == sorted(merkle.Manifest(docs).prove().select(*columns).collect(), key=str)
    assert any(x.endswith("False)") for x in got) and any(x.endswith("True)") for x in got)


def test_hot_source_of_several_rounds(spark, tmp_path):
    """4,500 rows in one source (three rounds of blocks), lone leaves, runs of one, equal rows."""
    rows = [(i * 7 % 100_003, f"Text {i}", "en", "hot") for i in range(4500)]
    rows += [(i, f"T{i}", "de", f"s{i % 40:02d}") for i in range(300)] + [(9, "X", "de", "alone"), (5, "Y", None, None)]
    rows += [(77, "Same Row", "en", "same")] * 300 + [(i, "z", "en", "seventeen") for i in range(17)]
    assert run_query(spark, tmp_path, rows) == sorted(map(str, plain(with_length(rows))))


def test_more_sources_than_a_block(spark, tmp_path):
    rows = [(i, f"Text {i}", "en", f"é{i % 300}") for i in range(700)]
    assert run_query(spark, tmp_path, rows) == sorted(map(str, plain(with_length(rows))))


def test_one_row_and_none(spark, tmp_path):
    rows = [(3, "Only", "en", "s")]
    assert run_query(spark, tmp_path / "one", rows) == sorted(map(str, plain(with_length(rows))))
    assert run_query(spark, tmp_path / "none", []) == []
    assert merkle.Manifest(documents(spark, [])).root is None


def test_claims_are_found_out(spark):
    docs = documents(spark, [(i, f"text {i}", "en", "s") for i in range(50)])
    out = merkle.Manifest(docs, F.when(F.col("doc_id") == 7, F.lit("forged"))).prove()
    assert [r["doc_id"] for r in out.where("NOT verified").collect()] == [7]
    assert merkle.Manifest(docs).prove().where("NOT verified").count() == 0
    changed = docs.withColumn("text", F.when(F.col("doc_id") == 7, "forged").otherwise(F.col("text")))
    assert merkle.Manifest(changed).root == out.where("doc_id = 7").first()["folded_root"]
