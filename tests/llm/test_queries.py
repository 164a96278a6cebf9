"""The opN_ queries themselves, over one fixture: digest columns against plain versions."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from kelpie.llm.queries import QUERIES
from kelpie.llm.tokenizing import public_path
from tests.llm.helpers import WORD, awkward, documents
from tests.llm.test_embeddings import plain as plain_links
from tests.llm.test_embeddings import vectors
from tests.llm.test_mixing import plain_targets
from tests.llm.test_quality import plain as plain_counts
from tests.llm.test_simhash import plain_components, plain_fingerprint


@pytest.fixture(scope="module")
def rows():
    return awkward()


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory, rows):
    path = str(tmp_path_factory.mktemp("queries"))
    documents(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(40)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(vectors(40) + [(9000, None), (9001, [0.0] * 64)], "vec_id long, embedding array<float>") \
        .write.parquet(f"{path}/embeddings.parquet")
    return path


def collected(spark, sf, name):
    return QUERIES[name](spark, sf).collect()


def ids_of(name, texts):
    tok = Tokenizer.from_file(public_path(name))
    return [[*e.ids, 1] for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_op1(spark, sf, rows):
    got = collected(spark, sf, "op1_sharding")
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _, _ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    assert {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert set(slots) == set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(s) for s in slots.values()]
    assert max(counts) - min(counts) <= 1


def test_op2(spark, sf, rows):
    got = collected(spark, sf, "op2_mixing")
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    goal = plain_targets(dict(sizes))
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((d, len(WORD.findall(t or ""))) for d, t, _, _ in rows)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    # a row's source is known by its size and target
    by = {(sizes[s], round(goal[s], 6)): s for s in sizes}
    taken = defaultdict(int)
    for r in got:
        taken[by[r["source_size"], round(r["target"], 6)]] += r["taken"]
    assert all(abs(taken[s] - goal[s]) <= 64 * 3 for s in sizes)
    again = collected(spark, sf, "op2_mixing")
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_op3(spark, sf, rows):
    got = collected(spark, sf, "op3_quality_rules")
    want = Counter((d, *plain_counts(t)) for d, t, _, _ in rows)
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_op4(spark, sf, rows):
    got = collected(spark, sf, "op4_simhash")
    fps = [plain_fingerprint(t) for _, t, _, _ in rows]
    comp = plain_components([d for d, *_ in rows], fps)
    want = Counter((d, f"{f:016x}", c) for (d, *_), f, c in zip(rows, fps, comp))
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want


def test_op5(spark, sf, rows):
    got = sorted(collected(spark, sf, "op5_token_files"), key=lambda r: r["start"])
    ids = ids_of("word_bpe_49k.json", [t for _, t, _, _ in rows])
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter((d, len(x), crc(x)) for (d, *_), x in zip(rows, ids))
    order = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in got]
    assert order == sorted(order)
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]


def test_op6(spark, sf, rows):
    got = collected(spark, sf, "op6_packing")
    ids = defaultdict(list)
    for (d, *_), x in zip(rows, ids_of("byte_bpe_50k.json", [t for _, t, _, _ in rows])):
        ids[d].append(x)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        whole = [x for x in ids[r["doc_id"]] if len(x) == r["doc_tokens"]]
        assert any(crc(x[r["start"]:r["start"] + r["length"]]) == r["ids_crc32"] for x in whole)
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(r["length"] for r in got) == sum(len(x) for xs in ids.values() for x in xs)


def test_op7(spark, sf):
    got = sorted((tuple(r) for r in collected(spark, sf, "op7_embedding_dedup")), key=str)
    assert got == plain_links(vectors(40) + [(9000, None), (9001, [0.0] * 64)])
