"""Blocked order helpers against a pandas brute force, with tiny blocks so
every block boundary case is hit."""

import numpy as np
import pytest
import pandas as pd
from pyspark.sql import functions as F

from kelpie.operators.sequence import blocked_lag, dense_position, running_sum


def _frame(spark, n=200, groups=3, seed=1):
    rng = np.random.default_rng(seed)
    ids = rng.permutation(np.arange(0, n * 3, 3))[:n]
    g = rng.integers(0, groups, n)
    g[: n // 2] = 0  # one hot group
    v = rng.integers(0, 50, n)
    pdf = pd.DataFrame({"g": g, "o": ids, "v": v})
    return spark.createDataFrame(pdf), pdf


def test_dense_position_matches_rank(spark):
    df, pdf = _frame(spark)
    out = dense_position(df, "g", "o", block=7).toPandas().sort_values(["g", "o"])
    exp = pdf.sort_values(["g", "o"]).assign(pos=lambda d: d.groupby("g").cumcount())
    assert out["pos"].tolist() == exp["pos"].tolist()


def test_dense_position_global(spark):
    df, pdf = _frame(spark)
    out = dense_position(df, None, "o", block=5).toPandas().sort_values("o")
    assert out["pos"].tolist() == list(range(len(pdf)))


def test_running_sum(spark):
    df, pdf = _frame(spark)
    out = running_sum(df, "g", "o", "v", "rs", block=11).toPandas().sort_values(["g", "o"])
    exp = pdf.sort_values(["g", "o"]).assign(rs=lambda d: d.groupby("g")["v"].cumsum())
    assert out["rs"].tolist() == exp["rs"].tolist()


def test_blocked_lag(spark):
    df, pdf = _frame(spark)
    d = dense_position(df, "g", "o", block=6)
    out = blocked_lag(d, "g", "pos", {"l1": ("v", 1), "l3": ("v", 3)}, block=4).toPandas().sort_values(["g", "o"])
    exp = pdf.sort_values(["g", "o"])
    exp["l1"] = exp.groupby("g")["v"].shift(1)
    exp["l3"] = exp.groupby("g")["v"].shift(3)
    assert out["l1"].fillna(-1).tolist() == exp["l1"].fillna(-1).tolist()
    assert out["l3"].fillna(-1).tolist() == exp["l3"].fillna(-1).tolist()


def test_no_single_partition_window_over_rows(spark):
    df, _ = _frame(spark)
    plan = dense_position(df, "g", "o", block=7)._jdf.queryExecution().executedPlan().toString()
    # the row-level window is partitioned by (group, block)
    assert "_kp_blk" in plan


def _ratchet_brute(pdf, change, d):
    out = []
    for k, g in pdf.sort_values(["g", "o"]).groupby("g"):
        ref = None
        for o, v in zip(g["o"], g["v"]):
            if ref is None:
                ref = v
                continue
            if v != ref and ((change == "up" and v - ref >= d) or (change == "down" and ref - v >= d)):
                out.append((str(k), int(o), float(v), float(ref)))
                ref = v
    return sorted(out)


def test_ratchet_parallel_matches_brute_force(spark):
    import pandas as pd
    from kelpie.operators.monitor import improvements
    rng = np.random.default_rng(5)
    n = 400
    pdf = pd.DataFrame({"g": rng.integers(0, 3, n), "o": rng.permutation(n) * 2,
                        "v": np.round(np.cumsum(rng.normal(0.2, 1.0, n)), 2)})
    pdf.loc[: n // 2, "g"] = 0
    df = spark.createDataFrame(pdf)
    for change in ("up", "down"):
        for d in (0.5, 2.0, 0.0, -0.5):
            got = sorted(tuple(r) for r in improvements(df, "g", "o", "v", change, d, block=16)
                         .select("key", "order", "value", "reference").collect())
            assert got == _ratchet_brute(pdf, change, d), (change, d)


@pytest.mark.parametrize("d", [0.0, 0.3, 2.5, 40.0])
def test_ratchet_of_a_rising_hot_key_in_a_tree_of_blocks(spark, d):
    """1,200 rising values of one key in blocks of two: three levels of composed functions."""
    import pandas as pd
    from kelpie.operators.monitor import improvements
    rng = np.random.default_rng(9)
    n = 1200
    v = np.cumsum(rng.choice([0.1, 0.5, 1.0, 3.0], n)) + rng.choice([0, 0, -5.0], n)
    pdf = pd.DataFrame({"g": ["hot"] * n + ["b", "b", "c"], "o": [*range(n), 0, 1, 0], "v": [*v, 1.0, 2.0, 5.0]})
    got = sorted(tuple(r) for r in improvements(spark.createDataFrame(pdf), "g", "o", "v", "up", d, block=2)
                 .select("key", "order", "value", "reference").collect())
    assert got == _ratchet_brute(pdf, "up", d)


def test_composed_functions_equal_their_parts():
    from kelpie.operators import monitor as M
    rng = np.random.default_rng(10)
    for _ in range(200):
        v = np.cumsum(rng.choice([0.25, 1.0, 2.0], rng.integers(2, 40)))
        d = float(rng.choice([0.0, 0.5, 1.0, 3.0, 20.0]))
        cuts = sorted({0, len(v), *rng.integers(1, len(v), 3).tolist()})
        before = [None if a == 0 else v[a - 1] for a in cuts[:-1]]
        parts = [M._block_steps(v[a:b], t, d) for a, b, t in zip(cuts, cuts[1:], before)]
        for i in range(1, len(parts)):
            whole = M._compose(parts[i:], before[i], d)
            for r in v[:cuts[i]][v[:cuts[i]] > before[i] - max(d, 1e-9)]:
                want = r
                for x in v[cuts[i]:]:
                    if M._moved(d)(x, want):
                        want = x
                assert M._apply(*whole, np.array([r]), d)[0] == want


def test_positions_of_any_order_key(spark):
    """Hashes as order: no dense blocks, and no window longer than a partition."""
    from pyspark.sql import functions as F
    from kelpie.operators.sequence import PART, laid_by_range, range_position, range_running_max
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("g"),
                                  F.md5(F.col("id").cast("string")).alias("o"), F.rand(3).alias("v"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        laid = laid_by_range(df, "g", ["o"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert laid.where("g = 'hot'").select(PART).distinct().count() >= 4
    got = range_running_max(range_position(laid, "g", ["o"], with_total=True), "g", ["o"], "v", "top").toPandas()
    want = got.sort_values(["g", "o"]).reset_index(drop=True)
    assert (want["pos"] == want.groupby("g").cumcount()).all()
    assert (want["pos_total"] == want.groupby("g")["o"].transform("size")).all()
    top = want.groupby("g")["v"].transform(lambda s: s.cummax().shift())
    assert ((want["top"] == top) | (want["top"].isna() & top.isna())).all()


def test_auc_of_scores_that_lie_close_together(spark):
    """All scores within 1e-6 of 0, ties among them: the partitions follow the scores."""
    from kelpie.operators.metrics import auc
    from kelpie.operators.sequence import PART, laid_by_range
    rng = np.random.default_rng(12)
    score = np.round(rng.random(4000) * 1e-6, 10)
    score[0] = 1.0
    y = (rng.random(4000) < 0.3 + 3e5 * score).astype(int)
    df = spark.createDataFrame([(float(s), int(t)) for s, t in zip(score, y)], "p double, y int")
    below = sum((score[y == 0] < s).sum() + 0.5 * (score[y == 0] == s).sum() for s in score[y == 1])
    assert auc(df, "y", "p").first()["auc"] == pytest.approx(below / ((y == 1).sum() * (y == 0).sum()), abs=1e-9)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in laid_by_range(df, None, ["p"]).groupBy(PART).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(sizes) >= 6 and max(sizes) < 4000 / 4
    assert auc(df.where("y = 1"), "y", "p").first()["auc"] is None
