"""Gradients of the NumPy model specs by finite differences; loss falls."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kelpie.operators import train as TR


@pytest.mark.parametrize("spec", [TR.SoftmaxRegression(k=3), TR.MLP(hidden=5, k=3),
                                  TR.MultiExitChain(dims=(4, 5, 3), k=3, weights=(0.5, 1.0)),
                                  TR.LogisticRegression(), TR.LinearRegression()])
def test_numeric_gradient(spec):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(7, 4))
    y = rng.integers(0, 2 if isinstance(spec, TR.LogisticRegression) else 3, 7).astype(float)
    w = rng.uniform(0.5, 2.0, 7)
    P = spec.init(4, seed=1)
    for k in P:
        P[k] = P[k] + rng.normal(scale=0.1, size=P[k].shape)
    _, G, _ = spec.loss_grad(P, X, y, w)
    for k in P:
        idx = tuple(rng.integers(0, s) for s in P[k].shape)
        eps = 1e-6
        Pp = {q: v.copy() for q, v in P.items()}
        Pm = {q: v.copy() for q, v in P.items()}
        Pp[k][idx] += eps
        Pm[k][idx] -= eps
        num = (spec.loss_grad(Pp, X, y, w)[0] - spec.loss_grad(Pm, X, y, w)[0]) / (2 * eps)
        assert abs(num - G[k][idx]) < 1e-4 * max(1.0, abs(num))


def test_fit_loss_falls(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.col("embedding").alias("features"), "label")
    res = TR.fit(df, TR.SoftmaxRegression(k=10), epochs=4, lr=0.5)
    losses = [v for e, s, m, v in res.history if m == "loss"]
    assert losses[-1] < losses[0]


def test_gradient_matches_local_numpy(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(40, 5))
    y = rng.integers(0, 3, 40)
    df = spark.createDataFrame([(X[i].tolist(), int(y[i])) for i in range(40)], "features array<double>, label int") \
        .repartition(4)
    spec = TR.SoftmaxRegression(k=3)
    P = spec.init(5)
    G, loss, _, n, _ = TR.gradient(df, spec, P)
    loss2, G2, _ = spec.loss_grad(P, X, y.astype(float), np.ones(40))
    assert n == 40 and np.allclose(G["W"], G2["W"]) and abs(loss - loss2) < 1e-9


def test_large_head_scores_like_small(spark):
    from kelpie.operators import models as MD
    rng = np.random.default_rng(2)
    W = rng.normal(size=(3, 5))
    m = MD.LinearModel(W=W, b=np.zeros(3), temperature=2.0)
    df = spark.createDataFrame([(i, rng.normal(size=5).tolist()) for i in range(20)], "id int, x array<double>")
    a = {r["id"]: r["values"] for r in m.apply(df, "x").collect()}
    big = MD.LinearModel(W=W, b=np.zeros(3), temperature=2.0, arrow=True)
    b = {r["id"]: r["values"] for r in big.apply(df, "x").collect()}
    assert all(np.allclose(a[i], b[i]) for i in a)
