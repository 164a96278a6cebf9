"""Federated rounds as tables against a plain NumPy version."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kelpie.operators import rounds as R
from kelpie.operators import train as TR

D, K = 5, 3


def samples(seed=1, n=240):
    """Device "10" holds two thirds of all rows, "9" and "2" the rest."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        x = rng.normal(size=D)
        out.append((("10", "10", "10", "10", "2", "9")[i % 6], [float(v) for v in x], float(np.argmax(x[:K]))))
    return out


@pytest.fixture(scope="module")
def frame(spark):
    rows = samples() + [(None, [0.0] * D, 1.0), ("9", None, 1.0), ("9", [1.0] * D, None)]
    return spark.createDataFrame(rows, "device string, features array<double>, label double")


def plain_fit(rows, P, epochs, lr):
    spec = TR.SoftmaxRegression(k=K)
    X, y = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    history = []
    for _ in range(epochs):
        loss, g, correct = spec.loss_grad(P, X, y, np.ones(len(y)))
        history.append((loss / len(y), correct / len(y), len(y)))
        P = {k: P[k] - lr * g[k] / len(y) for k in P}
    return P, history


def plain_run(rows, rounds, epochs, lr, registered):
    """The queue, one update after the other."""
    devices = ["2", "9", "10"]
    P = TR.SoftmaxRegression(k=K).init(D)
    queue, records, fifo = [], [], 0
    for r in range(rounds):
        need = 1 if registered == -1 else registered
        while len(queue) < need:
            for d in devices:
                queue.append((d, *plain_fit([x for x in rows if x[0] == d], P, epochs, lr)))
        used, queue = queue[:need], queue[need:]
        for d, _, h in used:
            fifo += 1
            records.append((r, d, fifo, h[-1][2], round(h[-1][0], 4), round(h[-1][1], 4)))
        P = {k: (P[k] + sum(u[1][k] for u in used)) / (len(used) + 1) for k in P}
    return P, records


def as_dict(model):
    like = TR.SoftmaxRegression(k=K).init(D)
    rows = {r["layer"]: r["values"] for r in model.orderBy("layer", "chunk").collect()}
    return {k: np.array(rows[i]).reshape(like[k].shape) for i, k in enumerate(sorted(like))}


@pytest.mark.parametrize("registered, block_rows", [(3, 1 << 16), (2, 7), (-1, 50), (5, 1 << 16)])
def test_rounds_behind_the_gate(frame, registered, block_rows):
    run = R.run_federated(frame, TR.SoftmaxRegression(k=K), "device", rounds=3, epochs=2, lr=0.5, registered=registered,
                          block_rows=block_rows)
    P, records = plain_run(samples(), 3, 2, 0.5, registered)
    got = as_dict(run.model())
    assert all(np.allclose(got[k], P[k]) for k in P)
    have = [(r["round"], r["device"], r["fifo"], r["num_samples"], r["train_loss"], r["train_acc"])
            for r in run.records.orderBy("fifo").collect()]
    assert [x[:4] for x in have] == [x[:4] for x in records]
    assert np.allclose([x[4:] for x in have], [x[4:] for x in records], atol=1.1e-4)
    assert {r["version"] for r in run.versions.select("version").distinct().collect()} == {-1, 0, 1, 2}
    first = as_dict(run.model(0))
    assert all(not v.any() for v in first.values())


def test_a_hot_device_is_many_blocks(frame):
    blocks = R.Blocks.of(frame, "device", rows=7)
    sizes = {}
    for r in blocks.rows.groupBy("device", "salt").count().collect():
        sizes.setdefault(r["device"], []).append(r["count"])
    assert len(sizes["10"]) == blocks.most == 23 and max(sizes["10"]) <= 21
    start = R.init_model(frame.sparkSession, TR.SoftmaxRegression(k=K), D)
    models, history = R.local_fit(blocks, start, TR.SoftmaxRegression(k=K), epochs=3, lr=0.5)
    for d in ("2", "9", "10"):
        P, h = plain_fit([x for x in samples() if x[0] == d], TR.SoftmaxRegression(k=K).init(D), 3, 0.5)
        got = as_dict(models.where(F.col("device") == d))
        assert all(np.allclose(got[k], P[k]) for k in P)
        have = history.where(F.col("device") == d).orderBy("epoch").collect()
        assert np.allclose([(r["loss"], r["accuracy"], r["num_data"]) for r in have], h)


def test_partials_add_up_in_a_tree(spark):
    rows = [("d", s, 0, c, [float(s), 1.0], 1.0, 2.0, 1, 3) for s in range(300) for c in range(2)]
    out = R._add_up(spark.createDataFrame(rows, R._PARTIAL), 300).collect()
    assert sorted((r["chunk"], r["values"], r["loss"], r["wsum"], r["correct"], r["n"]) for r in out) == \
        [(c, [44850.0, 300.0], 300.0, 600.0, 300, 900) for c in range(2)]


def test_models_of_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(R, "CHUNK", 4)
    frame = spark.createDataFrame(samples(2, 60), "device string, features array<double>, label double")
    spec = TR.SoftmaxRegression(k=K)
    run = R.run_federated(frame, spec, "device", rounds=2, epochs=1, lr=0.5)
    assert run.model().where("layer = 0").count() == 4
    P, _ = plain_run(samples(2, 60), 2, 1, 0.5, 3)
    got = run.model().collect()
    for layer, k in enumerate(sorted(P)):
        flat = [v for r in sorted((r for r in got if r["layer"] == layer), key=lambda r: r["chunk"]) for v in r["values"]]
        assert np.allclose(flat, P[k].ravel())


def test_other_strategies_and_an_empty_table(spark, frame):
    run = R.run_federated(frame, TR.SoftmaxRegression(k=K), "device", rounds=1, epochs=1, lr=0.5, strategy="Krum")
    zero = TR.SoftmaxRegression(k=K).init(D)
    models = [zero] + [plain_fit([x for x in samples() if x[0] == d], zero, 1, 0.5)[0] for d in ("2", "9", "10")]
    score = [sum(sum(np.linalg.norm(a[k] - b[k]) for k in a) for b in models) for a in models]
    best = models[int(np.argmin(score))]
    got = as_dict(run.model())
    assert all(np.allclose(got[k], best[k]) for k in best)
    none = R.run_federated(frame.limit(0), TR.SoftmaxRegression(k=K), "device", rounds=2)
    assert none.records.count() == 0 and {r["version"] for r in none.versions.collect()} <= {-1}
    with pytest.raises(ValueError):
        R.run_federated(frame, TR.SoftmaxRegression(k=K), "device", rounds=2, part=F.lit(7), parts=2)


def test_the_driver_gets_no_model(frame, monkeypatch):
    """Nothing that is collected holds parameters."""
    from pyspark.sql.classic.dataframe import DataFrame
    seen, collect, first = [], DataFrame.collect, DataFrame.first
    monkeypatch.setattr(DataFrame, "collect", lambda self: seen.append(self.columns) or collect(self))
    monkeypatch.setattr(DataFrame, "first", lambda self: seen.append(self.columns) or first(self))
    R.run_federated(frame, TR.SoftmaxRegression(k=K), "device", rounds=2, epochs=2)
    assert seen and not any("values" in c for c in seen)
