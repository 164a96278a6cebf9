import random
import string

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from kelpie.llm import simhash
from kelpie.llm.components import components
from tests.llm.helpers import WORD, awkward, clashing, documents, prose

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain_fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, fps, distance=4):
    """Smallest id by fingerprint distance, by brute force; null ids never name a component."""
    n, comp = len(fps), list(range(len(fps)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(n):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                comp[find(i)] = find(j)
    root = [find(i) for i in range(n)]
    best = {}
    for r, i in zip(root, ids):
        if i is not None:
            best[r] = min(i, best.get(r, i))
    return [best.get(r) for r in root]


def none_last(d):
    return d is None, d or 0


def plain_representatives(ids, fps):
    """The smallest id of every brute-force component, one entry each; None, sorted last, for one without ids."""
    groups = {}
    for d, c in zip(ids, plain_components(list(range(len(ids))), fps)):      # by place: ids may be null or repeat
        groups.setdefault(c, []).append(d)
    return sorted((min(g, key=none_last) for g in groups.values()), key=none_last)


def test_spark_hash_is_the_contract_hash(spark):
    got = spark.sql("SELECT xxhash64('a b c d') h").first()["h"] & (2 ** 64 - 1)
    assert got == xxhash.xxh64_intdigest(b"a b c d", 42)


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a B c", "A b C d", "x " * 50, "É é Ä ä Kelvin K İ", "a b c d e\x0bf"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("cell", [simhash.CELL, 3])
def test_cluster_against_brute_force(spark, cell):
    rows = awkward()
    fps = [plain_fingerprint(t) for _, t, _, _ in rows]
    want = sorted(zip([d for d, *_ in rows], fps, plain_components([d for d, *_ in rows], fps)), key=str)
    got = sorted(((r["doc_id"], r["fp"] & (2 ** 64 - 1), r["component_id"])
                  for r in simhash.cluster(clashing(documents(spark, rows)), cell=cell).collect()), key=str)
    assert got == want


@pytest.mark.parametrize("distance,cell", [(4, 4096), (4, 2), (3, 4096), (3, 2), (2, 3), (1, 2), (0, 1)])
def test_links_connect_exactly_what_brute_force_connects(spark, distance, cell):
    rng = random.Random(distance * 31 + cell)
    centre = [rng.getrandbits(64) for _ in range(6)]
    fps = {0, 2 ** 64 - 1}
    for c in centre:
        for _ in range(40):
            x = c
            for _ in range(rng.randint(0, 7)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    roots = {r["node"]: r["root"] for r in components(simhash.links(df, distance, cell)).collect()}
    signed = [r["fp"] for r in df.collect()]
    got = [roots.get(s, s) for s in signed]
    want = plain_components(list(range(len(fps))), fps, distance)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_larger_distances_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 5)


def test_a_dense_cell_gives_a_forest_not_all_pairs():
    rng = np.random.default_rng(1)
    fp = np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 64, 400, dtype=np.uint64))
    a, b = simhash.forest(fp, 4)
    assert len(a) == len(np.unique(fp)) - 1


def test_empty_table(spark):
    assert simhash.cluster(documents(spark, [])).count() == 0
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + k) for k in range(1, 200)] + [(5000, 5000)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {1000 + k: 1000 for k in range(1, 200)}


def test_keep_one(spark):
    rows = awkward()
    kept = simhash.keep_one(documents(spark, rows)).collect()
    assert sorted((r["doc_id"] for r in kept), key=none_last) == \
        plain_representatives([d for d, *_ in rows], [plain_fingerprint(t) for _, t, _, _ in rows])
    assert {(r["doc_id"], r["text"], r["source"]) for r in kept} <= {(d, t, s) for d, t, _, s in rows}
    assert simhash.keep_one(documents(spark).withColumn("fp", F.lit(1))).columns[-1] == "fp"


def test_keep_one_leaves_a_row_of_every_component(spark):
    rows = awkward() + [(None, prose(500 + i, 60), "en", "s1") for i in range(6)]       # unique, without an id
    rows += [(None, prose(500, 60), "de", "s2")] * 3                                    # equal rows without an id
    rows += [(3, prose(600, 70), "en", "s1"), (5, prose(601, 70), "en", "s1"), (5, prose(3, 120) + " end0", "en", "s1")]
    fps = [plain_fingerprint(t) for _, t, _, _ in rows]
    comp = plain_components(list(range(len(rows))), fps)                                # by place, not by id
    groups = {}
    for (d, t, _, _), c in zip(rows, comp):
        groups.setdefault(c, []).append((d is None, d or 0, t))
    group_of = {(d, t): c for (d, t, _, _), c in zip(rows, comp)}
    docs = clashing(documents(spark, rows))
    for cell in (simhash.CELL, 3):
        kept = simhash.keep_one(docs, cell=cell)
        assert kept.columns == docs.columns
        kept = kept.collect()
        assert sorted(group_of[r["doc_id"], r["text"]] for r in kept) == sorted(groups)
        for r in kept:
            group = groups[group_of[r["doc_id"], r["text"]]]
            assert (r["doc_id"] is None, r["doc_id"] or 0) == min(g[:2] for g in group)
            assert (r["doc_id"], r["text"], r["source"]) in {(d, t, s) for d, t, _, s in rows}
