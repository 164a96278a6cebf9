import numpy as np
import pytest
from pyspark.sql import functions as F

from kelpie.llm import embeddings


def plain(rows, cosine=0.9):
    n = len(rows)
    width = max((len(v) for _, v in rows if v), default=0)
    unit = []
    for _, v in rows:
        ok = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        x = np.array(list(v) + [0.0] * (width - len(v)), float) if ok else None
        unit.append(x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()) if ok else None)
    linked = [[i != j and unit[i] is not None and unit[j] is not None and unit[i] @ unit[j] >= cosine for j in range(n)]
              for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            x = todo.pop()
            new = [j for j in range(n) if linked[x][j] and j not in seen]
            seen.update(new)
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        comp = min(ids) if ids else None
        out.append((rows[i][0], sum(linked[i]), comp, rows[i][0] is not None and rows[i][0] == comp))
    return sorted(out, key=str)


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return sorted((tuple(r) for r in embeddings.link(df, **more).collect()), key=str)


def vectors(n=120, dim=64, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        base = rng.standard_normal(dim)
        for k in range(1 + (i % 9 == 0) * 6):
            rows.append((len(rows), np.float32(base + rng.standard_normal(dim) * 0.12 * (k > 0)).tolist()))
    return rows


@pytest.mark.parametrize("cell", [embeddings.CELL, 3])
def test_against_brute_force(spark, cell):
    rows = vectors()
    assert run(spark, rows, cell=cell) == plain(rows)


def test_awkward_rows(spark):
    v = np.float32(np.random.default_rng(3).standard_normal(16)).tolist()
    rows = [(1, v), (2, v), (3, [2 * x for x in v]), (4, [-x for x in v]), (5, None), (6, []), (7, [0.0] * 16),
            (8, [float("nan")] + v[1:]), (9, [float("inf")] + v[1:]), (10, [None] + v[1:]), (11, v[:8]), (None, v),
            (None, None), (12, [1e-30] * 16), (13, [1e30] * 16), (2, v), (14, [-0.0] * 15 + [1.0]), (15, [0.0] * 15 + [1.0])]
    assert run(spark, rows) == plain(rows)


def test_links_of_copies_are_counted_without_pairs(spark):
    v, w = np.float32(np.random.default_rng(4).standard_normal((2, 64))).tolist()
    rows = [(i, v) for i in range(500)] + [(1000 + i, w) for i in range(3)]
    got = run(spark, rows)
    assert {r[1:3] for r in got if r[0] < 500} == {(499, 0)} and {r[1:3] for r in got if r[0] >= 1000} == {(2, 1000)}


def test_a_dense_cluster_in_blocks(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal(64)
    rows = [(i, np.float32(base + 0.05 * rng.standard_normal(64)).tolist()) for i in range(150)]
    assert run(spark, rows, cell=16) == plain(rows)


def test_recall_at_the_threshold():
    """Pairs at cosine 0.9 exactly share a filter, at the table sizes the code adapts to."""
    rng = np.random.default_rng(6)
    x, z = rng.standard_normal((2, 600, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(1 - 0.81) * z / np.linalg.norm(z, axis=1, keepdims=True)
    for rows, least in ((1000, 0.99), (50_000, 0.98), (1_000_000, 0.94)):
        code = embeddings.Code(64, rows)
        a, b = (set(zip(*(c.tolist() for c in code.decode(v)))) for v in (x, y))
        assert len({r for r, _ in a & b}) / 600 > least


def test_double_vectors_other_columns_and_empty_table(spark):
    rows = vectors(20)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select(
        "*", *[F.lit(1).alias(n) for n in ("id", "n", "k1", "root", "label", "filter", "v", "ok", "VEC_ID")])
    assert sorted((tuple(r) for r in embeddings.link(df).collect()), key=str) == plain(rows)
    assert run(spark, []) == []


def test_dimensions_below_and_above_the_codes(spark):
    for dim in (1, 2, 17, 300):
        rows = vectors(12, dim, seed=dim)
        assert run(spark, rows) == plain(rows)


def test_recall_holds_as_the_table_grows():
    """Codes are added for larger tables; checked with pairs other than those they were chosen by."""
    rng = np.random.default_rng(8)
    x, z = rng.standard_normal((2, 400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(1 - 0.81) * z / np.linalg.norm(z, axis=1, keepdims=True)
    codes = []
    for rows in (10_000, 1_000_000, 10_000_000):
        code = embeddings.Code(64, rows)
        a, b = (set(zip(*(c.tolist() for c in code.decode(v)))) for v in (x, y))
        assert code.recall >= embeddings.RECALL and len({r for r, _ in a & b}) / 400 > 0.975
        codes.append(len(code.codes))
    assert codes[0] == embeddings.CODES and codes == sorted(codes) and codes[-1] > codes[0]
