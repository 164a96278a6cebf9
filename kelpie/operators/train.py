"""Data-parallel training, evaluation and self-training (T01-T09, T12, G01,
G10, G11, X01).

Samples never leave the executors: every epoch broadcasts the parameters,
each task folds its Arrow batches into a partial (loss, gradient, count)
and the partials are added up by a grouped sum.  The driver holds parameters, metrics and
counts only.  Model specs (X01) are small NumPy classes shipped in the
task closure; no user code text is executed.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpie.operators.models import EPS, fit_centroids
from kelpie.session import cut_lineage

# ------------------------------------------------------------- model specs ----


def _softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    e = np.exp(z)
    return e / e.sum(axis=1, keepdims=True)


def _onehot(y: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros((len(y), k))
    out[np.arange(len(y)), y.astype(int)] = 1.0
    return out


class ModelSpec:
    """X01 protocol: ``init``, ``predict``, ``loss_grad`` over NumPy batches."""

    name = "spec"

    def init(self, d: int, seed: int = 0) -> dict[str, np.ndarray]:
        raise NotImplementedError

    def predict(self, P: dict, X: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def loss_grad(self, P: dict, X: np.ndarray, y: np.ndarray, w: np.ndarray):
        """(sum of weighted losses, dict of summed gradients, #correct)."""
        raise NotImplementedError


@dataclass
class SoftmaxRegression(ModelSpec):
    k: int = 10
    name: str = "softmax_regression"

    def init(self, d, seed=0):
        return {"W": np.zeros((self.k, d)), "b": np.zeros(self.k)}

    def predict(self, P, X):
        return _softmax(X @ P["W"].T + P["b"])

    def loss_grad(self, P, X, y, w):
        p = self.predict(P, X)
        Y = _onehot(y, self.k)
        loss = float(-(w * np.log(np.clip(p[np.arange(len(y)), y.astype(int)], EPS, 1.0))).sum())
        D = (p - Y) * w[:, None]
        correct = int((p.argmax(axis=1) == y).sum())
        return loss, {"W": D.T @ X, "b": D.sum(axis=0)}, correct


@dataclass
class LogisticRegression(ModelSpec):
    name: str = "logistic_regression"

    def init(self, d, seed=0):
        return {"W": np.zeros((1, d)), "b": np.zeros(1)}

    def predict(self, P, X):
        return 1.0 / (1.0 + np.exp(-(X @ P["W"].T + P["b"])))

    def loss_grad(self, P, X, y, w):
        p = self.predict(P, X)[:, 0]
        pc = np.clip(p, EPS, 1 - EPS)
        loss = float(-(w * (y * np.log(pc) + (1 - y) * np.log(1 - pc))).sum())
        D = ((p - y) * w)[:, None]
        return loss, {"W": D.T @ X, "b": D.sum(axis=0)}, int(((p > 0.5) == (y > 0.5)).sum())


@dataclass
class LinearRegression(ModelSpec):
    name: str = "linear_regression"

    def init(self, d, seed=0):
        return {"W": np.zeros((1, d)), "b": np.zeros(1)}

    def predict(self, P, X):
        return X @ P["W"].T + P["b"]

    def loss_grad(self, P, X, y, w):
        r = self.predict(P, X)[:, 0] - y
        D = (2 * r * w)[:, None]
        return float((w * r * r).sum()), {"W": D.T @ X, "b": D.sum(axis=0)}, 0


@dataclass
class MLP(ModelSpec):
    """d -> hidden (ReLU) -> k softmax."""
    hidden: int = 32
    k: int = 10
    name: str = "mlp"

    def init(self, d, seed=0):
        rng = np.random.default_rng(seed)
        return {"A": rng.normal(0, np.sqrt(2.0 / d), (d, self.hidden)), "c": np.zeros(self.hidden),
                "B": rng.normal(0, np.sqrt(1.0 / self.hidden), (self.hidden, self.k)), "e": np.zeros(self.k)}

    def predict(self, P, X):
        h = np.maximum(X @ P["A"] + P["c"], 0)
        return _softmax(h @ P["B"] + P["e"])

    def loss_grad(self, P, X, y, w):
        z = X @ P["A"] + P["c"]
        h = np.maximum(z, 0)
        p = _softmax(h @ P["B"] + P["e"])
        loss = float(-(w * np.log(np.clip(p[np.arange(len(y)), y.astype(int)], EPS, 1.0))).sum())
        D = (p - _onehot(y, self.k)) * w[:, None]
        dh = (D @ P["B"].T) * (z > 0)
        return loss, {"A": X.T @ dh, "c": dh.sum(0), "B": h.T @ D, "e": D.sum(0)}, int((p.argmax(1) == y).sum())


@dataclass
class MultiExitChain(ModelSpec):
    """Stage i maps h_i -> h_{i+1} = ReLU(h_i A_i + c_i) and exit i predicts
    softmax(h_{i+1} B_i + e_i); joint loss = Σ weight_i · CE_i.  The last exit
    gives the final prediction."""
    dims: tuple = (64, 32, 16)
    k: int = 10
    weights: tuple = (1.0, 1.0)
    name: str = "multi_exit"

    def init(self, d, seed=0):
        rng = np.random.default_rng(seed)
        P = {}
        dims = (d,) + tuple(self.dims[1:])
        for i in range(len(dims) - 1):
            P[f"A{i}"] = rng.normal(0, np.sqrt(2.0 / dims[i]), (dims[i], dims[i + 1]))
            P[f"c{i}"] = np.zeros(dims[i + 1])
            P[f"B{i}"] = rng.normal(0, np.sqrt(1.0 / dims[i + 1]), (dims[i + 1], self.k))
            P[f"e{i}"] = np.zeros(self.k)
        return P

    def _n(self, P):
        return sum(1 for key in P if key.startswith("A"))

    def exits(self, P, X):
        h, outs, zs, hs = X, [], [], [X]
        for i in range(self._n(P)):
            z = h @ P[f"A{i}"] + P[f"c{i}"]
            h = np.maximum(z, 0)
            zs.append(z)
            hs.append(h)
            outs.append(_softmax(h @ P[f"B{i}"] + P[f"e{i}"]))
        return outs, zs, hs

    def predict(self, P, X):
        return self.exits(P, X)[0][-1]

    def loss_grad(self, P, X, y, w):
        outs, zs, hs = self.exits(P, X)
        n = self._n(P)
        Y = _onehot(y, self.k)
        G = {key: np.zeros_like(v) for key, v in P.items()}
        loss = 0.0
        dh_next = np.zeros_like(hs[-1])
        for i in reversed(range(n)):
            lw = self.weights[i] if i < len(self.weights) else 1.0
            p = outs[i]
            loss += lw * float(-(w * np.log(np.clip(p[np.arange(len(y)), y.astype(int)], EPS, 1.0))).sum())
            D = (p - Y) * (w * lw)[:, None]
            G[f"B{i}"] += hs[i + 1].T @ D
            G[f"e{i}"] += D.sum(0)
            dh = D @ P[f"B{i}"].T + dh_next
            dz = dh * (zs[i] > 0)
            G[f"A{i}"] += hs[i].T @ dz
            G[f"c{i}"] += dz.sum(0)
            dh_next = dz @ P[f"A{i}"].T
        return loss, G, int((outs[-1].argmax(1) == y).sum())


MODEL_SPECS: dict[str, type] = {}


def register_model(name: str, spec_cls: type) -> None:
    """Make a model spec selectable by name."""
    MODEL_SPECS[name] = spec_cls


for _n, _c in (("softmax_regression", SoftmaxRegression), ("logistic_regression", LogisticRegression),
               ("linear_regression", LinearRegression), ("mlp", MLP), ("multi_exit", MultiExitChain)):
    register_model(_n, _c)


# --------------------------------------------------------- distributed sums ----

def _flatten(P: dict) -> np.ndarray:
    return np.concatenate([P[k].ravel() for k in sorted(P)])


def _unflatten(v: np.ndarray, like: dict) -> dict:
    out, i = {}, 0
    for k in sorted(like):
        n = like[k].size
        out[k] = v[i:i + n].reshape(like[k].shape)
        i += n
    return out


def _batch_arrays(batch: pa.RecordBatch, features: str, label: str, weight: str | None):
    col = batch.column(batch.schema.get_field_index(features))
    offs = np.asarray(col.offsets)
    d = int(offs[1] - offs[0]) if len(col) else 0
    X = col.values.slice(int(offs[0]), int(offs[-1] - offs[0])).to_numpy(zero_copy_only=False).astype(np.float64)
    X = X.reshape(len(col), d) if len(col) else X.reshape(0, 0)
    y = batch.column(batch.schema.get_field_index(label)).to_numpy(zero_copy_only=False).astype(np.float64)
    w = batch.column(batch.schema.get_field_index(weight)).to_numpy(zero_copy_only=False).astype(np.float64) \
        if weight else np.ones(len(y))
    return X, y, w


_PARTIAL_SCHEMA = "key string, grad array<double>, loss double, correct long, n long, wsum double"


def partial_sums(df: DataFrame, spec: ModelSpec, P: dict, features: str = "features", label: str = "label",
                 weight: str | None = None, key: str | None = None) -> DataFrame:
    """One row per (task, key): summed loss and gradient of that task's rows."""
    return _partials(df, spec, P, features, label, weight, key)[0]


def _partials(df: DataFrame, spec: ModelSpec, P: dict, features: str = "features", label: str = "label",
              weight: str | None = None, key: str | None = None):
    """The partial sums and the broadcast they read (to be destroyed after use)."""
    sc = df.sparkSession.sparkContext
    bP = sc.broadcast(P)
    cols = [F.col(features).alias("_x"), F.col(label).cast("double").alias("_y")]
    cols.append(F.col(weight).cast("double").alias("_w") if weight else F.lit(1.0).alias("_w"))
    cols.append(F.col(key).cast("string").alias("_k") if key else F.lit("").alias("_k"))
    src = df.where(F.col(label).isNotNull()).select(*cols)

    def fold(batches):
        params = bP.value
        acc: dict[str, list] = {}
        for b in batches:
            if b.num_rows == 0:
                continue
            keys = np.asarray(b.column(3).to_pylist(), dtype=object)
            for k in np.unique(keys):
                sel = np.nonzero(keys == k)[0]
                sub = b.take(pa.array(sel))
                X, y, w = _batch_arrays(sub, "_x", "_y", "_w")
                loss, G, correct = spec.loss_grad(params, X, y, w)
                g = _flatten(G)
                a = acc.setdefault(k, [np.zeros_like(g), 0.0, 0, 0, 0.0])
                a[0] += g
                a[1] += loss
                a[2] += correct
                a[3] += len(y)
                a[4] += float(w.sum())
        if acc:
            ks = list(acc)
            yield pa.RecordBatch.from_pydict({
                "key": ks, "grad": [acc[k][0].tolist() for k in ks], "loss": [acc[k][1] for k in ks],
                "correct": [acc[k][2] for k in ks], "n": [acc[k][3] for k in ks], "wsum": [acc[k][4] for k in ks]},
                schema=pa.schema([("key", pa.string()), ("grad", pa.list_(pa.float64())), ("loss", pa.float64()),
                                  ("correct", pa.int64()), ("n", pa.int64()), ("wsum", pa.float64())]))

    return src.mapInArrow(fold, _PARTIAL_SCHEMA), bP


def _summed(rows: DataFrame, P: dict) -> dict:
    """Partial sums added up number by number, per key: ``P``'s shapes, loss, correct, n, wsum.  Spark adds them
    without a second Python worker beside the one that folds; the driver gets one number a parameter."""
    numbers = F.concat("grad", F.array(F.col("loss"), F.col("correct").cast("double"), F.col("n").cast("double"), F.col("wsum")))
    few = rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)   # a row a task and key: else every task would deal out its numbers
    sums = few.select("key", F.posexplode(numbers).alias("i", "x")).groupBy("key", "i").agg(F.sum("x").alias("x")).toArrow()
    keys, at, x = (sums.column(c).to_numpy() for c in ("key", "i", "x"))
    size, out = sum(v.size for v in P.values()), {}
    for k in set(keys):
        mine = keys == k
        v = np.zeros(size + 4)
        v[at[mine]] = x[mine]
        out[k] = (_unflatten(v[:size], P), float(v[size]), int(v[size + 1]), int(v[size + 2]), float(v[size + 3]))
    return out


def gradient(df: DataFrame, spec: ModelSpec, P: dict, **kw):
    """Summed (grad dict, loss, correct, n, wsum) over the whole frame."""
    rows, sent = _partials(df, spec, P, **kw)
    try:
        sums = _summed(rows, P)
    finally:
        sent.destroy()      # parameters of one step only
    return sums.get("", (_unflatten(np.zeros(sum(v.size for v in P.values())), P), 0.0, 0, 0, 0.0))


def gradient_by_key(df: DataFrame, spec: ModelSpec, P: dict, key: str, **kw) -> dict:
    """Sums per value of ``key`` (few: the splits of a fit)."""
    rows, sent = _partials(df, spec, P, key=key, **kw)
    try:
        return _summed(rows, P)
    finally:
        sent.destroy()


# ------------------------------------------------------------------- fits ----

@dataclass
class FitResult:
    params: dict
    history: list = field(default_factory=list)     # rows (epoch, split, metric, value)
    training_time: float = 0.0


def feature_dim(df: DataFrame, features: str = "features") -> int:
    r = df.select(F.size(features).alias("d")).where(F.col("d") > 0).first()
    return int(r["d"]) if r else 0


def evaluate_params(df: DataFrame, spec: ModelSpec, P: dict, **kw) -> dict:
    _, loss, correct, n, wsum = gradient(df, spec, P, **kw)
    return {"loss": loss / max(wsum, 1e-12), "accuracy": correct / max(n, 1), "n": n}


def fit(df: DataFrame, spec: ModelSpec, epochs: int = 10, lr: float = 0.5, features: str = "features",
        label: str = "label", weight: str | None = None, validation: DataFrame | None = None,
        init: dict | None = None, seed: int = 0) -> FitResult:
    """Full-batch gradient descent, one distributed pass per epoch.

    ``history`` gets training loss/accuracy per epoch (measured in the pass
    that computes the gradient, i.e. before the update) and, with a
    validation frame, ``val_`` metrics of the updated parameters.  Training
    and validation rows share one pass (partial sums keyed by split), so an
    epoch costs one job; the last validation needs one extra pass.
    """
    t0 = time.time()
    P = init if init is not None else spec.init(feature_dim(df, features), seed)
    hist = []
    cols = [F.col(features).alias("_f"), F.col(label).alias("_l")] + \
        ([F.col(weight).alias("_w")] if weight else [])
    data = df.select(*cols, F.lit("t").alias("_split"))
    if validation is not None:
        vcols = [F.col(features).alias("_f"), F.col(label).alias("_l")] + ([F.lit(1.0).alias("_w")] if weight else [])
        data = data.unionByName(validation.select(*vcols, F.lit("v").alias("_split")))
    kw = {"features": "_f", "label": "_l", "weight": "_w" if weight else None}
    # read once per epoch: keep the (small, projected) training rows on the executors
    data = data.persist(StorageLevel.MEMORY_AND_DISK)

    def val_rows(ep, sums):
        if validation is not None and "v" in sums:
            _, vl, vc, vn, vw = sums["v"]
            return [(ep, "validation", "loss", vl / max(vw, 1e-12)), (ep, "validation", "accuracy", vc / max(vn, 1))]
        return []

    for ep in range(epochs):
        sums = gradient_by_key(data, spec, P, "_split", **kw)
        if ep > 0:
            hist += val_rows(ep - 1, sums)
        if "t" not in sums:
            break
        G, loss, correct, n, wsum = sums["t"]
        P = {k: P[k] - lr * G[k] / wsum for k in P}
        hist += [(ep, "training", "loss", loss / wsum), (ep, "training", "accuracy", correct / n)]
    if validation is not None and epochs > 0:
        hist += val_rows(epochs - 1, gradient_by_key(data.where(F.col("_split") == "v"), spec, P, "_split", **kw))
    data.unpersist()
    hist.sort(key=lambda r: (r[0], r[1] != "training"))
    return FitResult(P, hist, time.time() - t0)


def gradient_step(df: DataFrame, spec: ModelSpec, P: dict, lr: float, **kw) -> dict:
    """One full-batch step (the SQL-checkable unit of every trainer)."""
    G, _, _, n, wsum = gradient(df, spec, P, **kw)
    return {k: P[k] - lr * G[k] / wsum for k in P} if n else P


class Sgd:
    """Plain gradient descent, with momentum if asked for."""

    def __init__(self, lr: float = 0.5, momentum: float = 0.0):
        self.lr, self.momentum, self._v = lr, momentum, {}

    def update(self, P: dict, G: dict) -> dict:
        self._v = {k: self.momentum * self._v.get(k, 0.0) + G[k] for k in P}
        return {k: P[k] - self.lr * self._v[k] for k in P}


class Adam:
    """Gradient descent with bias-corrected first and second moments."""

    def __init__(self, lr: float = 0.001, beta1: float = 0.9, beta2: float = 0.999, eps: float = 1e-7):
        self.lr, self.b1, self.b2, self.eps, self._m, self._s, self._t = lr, beta1, beta2, eps, {}, {}, 0

    def update(self, P: dict, G: dict) -> dict:
        self._t += 1
        self._m = {k: self.b1 * self._m.get(k, 0.0) + (1 - self.b1) * G[k] for k in P}
        self._s = {k: self.b2 * self._s.get(k, 0.0) + (1 - self.b2) * G[k] ** 2 for k in P}
        rate = self.lr * np.sqrt(1 - self.b2 ** self._t) / (1 - self.b1 ** self._t)
        return {k: P[k] - rate * self._m[k] / (np.sqrt(self._s[k]) + self.eps) for k in P}


OPTIMIZERS = {"sgd": Sgd, "adam": Adam}


def fit_minibatch(df: DataFrame, spec: ModelSpec, batch: int, order: str, epochs: int = 1, optimizer="sgd",
                  features: str = "features", label: str = "label", weight: str | None = None,
                  init: dict | None = None, seed: int = 0, steps: int | None = None) -> FitResult:
    """T01 with ``batch`` rows a step: consecutive rows by ``order`` (unique, integral)
    form the batches, every epoch takes them in the same order, and each step is one
    distributed pass over its batch.  ``steps`` stops an epoch early (steps per epoch).
    ``optimizer`` is a name of :data:`OPTIMIZERS` or an object with ``update``.

    The rows are written once, partitioned by batch, so a step reads its own
    files only and a lost executor repeats one step."""
    from kelpie.operators.sequence import dense_position
    from kelpie.session import scratch_path
    t0 = time.time()
    spark = df.sparkSession
    opt = OPTIMIZERS[optimizer]() if isinstance(optimizer, str) else optimizer
    P = init if init is not None else spec.init(feature_dim(df, features), seed)
    cols = [F.col(features).alias("features"), F.col(label).alias("label"), F.col(order).cast("long").alias("_o")]
    cols += [F.col(weight).cast("double").alias("weight")] if weight else []
    rows = dense_position(df.where(F.col(label).isNotNull()).select(*cols), None, "_o", name="_pos") \
        .withColumn("_batch", F.floor(F.col("_pos") / batch).cast("long")).drop("_pos", "_o")
    path = scratch_path(spark, f"minibatches-{uuid.uuid4().hex}")
    rows.repartition("_batch").write.partitionBy("_batch").parquet(path)
    stored = spark.read.parquet(path)
    n_batches = (stored.agg(F.max("_batch")).first()[0] or 0) + 1 if not stored.isEmpty() else 0
    hist = []
    for ep in range(epochs):
        loss = correct = n = wsum = 0
        for b in range(min(n_batches, steps) if steps else n_batches):
            G, bl, bc, bn, bw = gradient(stored.where(F.col("_batch") == b), spec, P, features="features", label="label",
                                         weight="weight" if weight else None)
            P = opt.update(P, {k: G[k] / bw for k in G})
            loss, correct, n, wsum = loss + bl, correct + bc, n + bn, wsum + bw
        if n:
            hist += [(ep, "training", "loss", loss / wsum), (ep, "training", "accuracy", correct / n)]
    return FitResult(P, hist, time.time() - t0)


def history_frame(spark, result: FitResult, result_id: str = "r0") -> DataFrame:
    """Epoch history as a long table (result, epoch, split, metric, value)."""
    rows = [(result_id, int(e), s, m, float(v)) for e, s, m, v in result.history]
    return spark.createDataFrame(rows, "result string, epoch int, split string, metric string, value double")


def evaluate_model(df: DataFrame, spec: ModelSpec, P: dict, names: list[str], **kw) -> dict[str, float]:
    """Test scores by metric name.  The scores come as a list, the loss first and then the metrics in
    the order in which the model was compiled; name k takes the k-th score, names beyond them none."""
    m = evaluate_params(df, spec, P, **kw)
    return dict(zip(names, (m["loss"], m["accuracy"])))


def result_row(spark, result: FitResult, result_id: str = "r0", test: dict[str, float] | None = None,
               matrix: DataFrame | None = None, indefinite: bool = False) -> DataFrame:
    """The row that a finished fit reports: every epoch's metrics, the test scores, the confusion matrix as
    nested lists over the sorted classes (a row per true class), the training time in seconds, and
    whether the fit goes on indefinitely.  ``matrix`` is :func:`kelpie.operators.metrics.confusion_matrix`'s frame."""
    def series(split):
        out: dict[str, list[float]] = {}
        for _, s, metric, value in sorted((h for h in result.history if h[1] == split), key=lambda h: h[0]):
            out.setdefault(metric, []).append(float(value))
        return out

    row = spark.createDataFrame(
        [(result_id, series("training"), series("validation"), test or {}, round(result.training_time, 4), indefinite)],
        "result string, train_metrics map<string,array<double>>, val_metrics map<string,array<double>>, "
        "test_metrics map<string,double>, training_time double, indefinite boolean")
    if matrix is None:
        return row.withColumn("confusion_matrix", F.lit(None).cast("array<array<bigint>>"))
    lines = matrix.groupBy("y").agg(F.transform(F.sort_array(F.collect_list(F.struct("yhat", "n"))), lambda s: s["n"]).alias("line"))
    nested = lines.agg(F.transform(F.sort_array(F.collect_list(F.struct("y", "line"))), lambda s: s["line"]).alias("confusion_matrix"))
    return row.crossJoin(nested)        # one row each


def predict_frame(df: DataFrame, spec: ModelSpec, P: dict, features: str = "features",
                  out: str = "values") -> DataFrame:
    """T10 for NumPy specs: Arrow-batched prediction with broadcast parameters."""
    from pyspark.sql import types as T
    bP = df.sparkSession.sparkContext.broadcast(P)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def pred(col: pa.Array) -> pa.Array:
        offs = np.asarray(col.offsets)
        n = len(col)
        d = int(offs[1] - offs[0]) if n else 0
        X = col.values.slice(int(offs[0]), int(offs[-1] - offs[0])).to_numpy(zero_copy_only=False).astype(np.float64)
        V = spec.predict(bP.value, X.reshape(n, d)) if n else np.zeros((0, 1))
        k = V.shape[1]
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(V.ravel()))

    return df.withColumn(out, pred(F.col(features)))


def fit_many(df: DataFrame, specs: dict[str, ModelSpec], **kw) -> dict[str, FitResult]:
    """Every model of a configuration trains on the same (persisted) data."""
    cached = df.persist()
    try:
        return {name: fit(cached, spec, **kw) for name, spec in specs.items()}
    finally:
        cached.unpersist()


# ---------------------------------------------------------- self-training ----

def self_train(labelled: DataFrame, pool: DataFrame, rounds: int = 5, confidence: float = 0.9,
               features: str = "features", label: str = "label", key: str = "id",
               temperature: float = 10.0, n_classes: int | None = None):
    """Up to ``rounds``: fit, predict the pool, keep confident rows (F02),
    add them with their pseudo label (U02), remove them from the pool (J11);
    stop when nothing is confident or the pool is empty.

    Learner: nearest-centroid softmax (parameters = class means).  Each round
    the grown training set and the pool are checkpointed to the shared
    checkpoint folder, so lineage stays short and a lost executor only
    recomputes one round.
    """
    from kelpie.functions.features import argmax
    from kelpie.operators.serve import score

    train = labelled.select(key, features, F.col(label).cast("int").alias(label), F.lit(0).alias("round"))
    rest = pool.select(key, features)
    model = fit_centroids(train, features, label, n_classes=n_classes, temperature=temperature)
    for r in range(1, rounds + 1):
        # one scored, checkpointed pool per round: the confident part joins the
        # training set, the rest is the next pool (no anti-join needed)
        scored = score(rest, model, features).withColumn("_ok", F.array_max("values") >= F.lit(confidence))
        scored = cut_lineage(scored.select(key, features, argmax("values").alias(label), "_ok"))
        n_ok = scored.where("_ok").count()
        if n_ok == 0:
            break
        train = train.unionByName(scored.where("_ok").select(key, features, label, F.lit(r).alias("round")))
        rest = scored.where(~F.col("_ok")).select(key, features)
        train = cut_lineage(train)
        # the model returned has seen the pseudo-labels of the last round too
        model = fit_centroids(train, features, label, n_classes=n_classes, temperature=temperature)
        if n_ok == scored.count():
            break
    return train, model


# ------------------------------------------------------------------ T12 ----

def corrupt(df: DataFrame, device: str, faulty, how: str = "flip", features: str = "features",
            label: str = "label", n_classes: int = 10) -> DataFrame:
    """Deterministic faulty device: ``flip`` negates the features, ``shift``
    relabels y -> (y+1) mod k, ``zero`` blanks the features."""
    bad = F.col(device) == F.lit(faulty)
    if how == "flip":
        return df.withColumn(features, F.when(bad, F.transform(features, lambda x: -x)).otherwise(F.col(features)))
    if how == "shift":
        return df.withColumn(label, F.when(bad, F.pmod(F.col(label) + 1, F.lit(n_classes))).otherwise(F.col(label)))
    if how == "zero":
        return df.withColumn(features, F.when(bad, F.transform(features, lambda x: x * 0)).otherwise(F.col(features)))
    raise ValueError(how)
