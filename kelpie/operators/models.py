"""Model specs (X01) and their Spark-side scoring expressions.

A model is a small set of NumPy parameters held by the driver (bounded by the
model size, never by the data).  Linear heads score with built-in array
expressions inside whole-stage codegen; deeper models score with an Arrow
UDF that runs one NumPy matmul per batch.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Probabilities are clipped to [EPS, 1 - EPS] inside
# cross-entropy, as the training framework does.
EPS = 1e-7


def _lit_array(v) -> Column:
    return F.array(*[F.lit(float(x)) for x in np.asarray(v, dtype=np.float64).ravel()])


def dot(x: Column, w) -> Column:
    """x · w for an array column x and a constant vector w (sum in index order)."""
    return F.aggregate(F.zip_with(x, _lit_array(w), lambda a, b: a.cast("double") * b),
                       F.lit(0.0), lambda acc, y: acc + y)


def _let(x: Column, use) -> Column:
    """``use(x)`` with ``x`` computed once.  A projection of its own does not ensure that: when a filter on
    the result is pushed below it, every place that names the column gets a copy of its expression."""
    return F.transform(F.array(x), use)[0]


def _softmax(z: Column) -> Column:
    """Softmax of an array column that is itself an expression."""
    exps = lambda z: _let(F.array_max(z), lambda top: F.transform(z, lambda v: F.exp(v - top)))
    shares = lambda e: _let(F.aggregate(e, F.lit(0.0), lambda acc, y: acc + y),
                            lambda total: F.transform(e, lambda v: v / total))
    return _let(z, lambda z: _let(exps(z), shares))


@dataclass
class LinearModel:
    """values = activation(temperature · (W x + b)); W has one row per output."""

    W: np.ndarray
    b: np.ndarray
    activation: str = "softmax"     # softmax | sigmoid | linear
    temperature: float = 1.0
    meta: dict = field(default_factory=dict)
    arrow: bool = False             # score by an Arrow UDF with broadcast parameters, for heads too large for a literal

    @property
    def n_out(self) -> int:
        return int(self.W.shape[0])

    def logits(self, x: Column) -> Column:
        """All outputs in ONE compact expression: a constant weight matrix and a
        lambda over its rows (no per-output expression copies)."""
        W = F.array(*[_lit_array(row) for row in np.asarray(self.W, dtype=np.float64)])
        b = _lit_array(self.b)
        t = F.lit(float(self.temperature))
        return F.transform(W, lambda w, k: (F.aggregate(F.zip_with(x, w, lambda a, c: a.cast("double") * c),
                                                         F.lit(0.0), lambda acc, y: acc + y) + b[k]) * t)

    def apply(self, df: DataFrame, x: str, out: str = "values") -> DataFrame:
        """Score a frame: logits, then the activation on that array, in one expression that
        computes each once, also where a filter on ``out`` is pushed below it.  A model made
        with ``arrow=True`` scores through an Arrow UDF with broadcast parameters
        instead of a constant expression; its size alone changes nothing."""
        if self.arrow:
            return self._apply_arrow(df, x, out)
        return df.withColumn(out, self.values(F.col(x)))

    def values(self, x: Column) -> Column:
        """Single-expression form (for use inside select lists)."""
        z = self.logits(x)
        if self.activation == "linear":
            return z
        if self.activation == "sigmoid":
            return F.transform(z, lambda v: 1.0 / (1.0 + F.exp(-v)))
        return _softmax(z)

    def _apply_arrow(self, df: DataFrame, x: str, out: str) -> DataFrame:
        from pyspark.sql import types as T
        bc = df.sparkSession.sparkContext.broadcast(self)

        @F.arrow_udf(T.ArrayType(T.DoubleType()))
        def pred(col: pa.Array) -> pa.Array:
            n = len(col)
            offs = np.asarray(col.offsets)
            dim = int(offs[1] - offs[0]) if n else 0
            X = col.values.slice(int(offs[0]), int(offs[-1] - offs[0])).to_numpy(zero_copy_only=False)
            V = bc.value.predict_np(X.astype(np.float64).reshape(n, dim)) if n else np.zeros((0, 1))
            k = V.shape[1]
            return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(V.ravel()))

        return df.withColumn(out, pred(F.col(x)))

    # NumPy twin (used inside Arrow UDFs and by the driver-side optimiser)
    def predict_np(self, X: np.ndarray) -> np.ndarray:
        z = (X @ self.W.T + self.b) * self.temperature
        if self.activation == "linear":
            return z
        if self.activation == "sigmoid":
            return 1.0 / (1.0 + np.exp(-z))
        z = z - z.max(axis=1, keepdims=True)
        e = np.exp(z)
        return e / e.sum(axis=1, keepdims=True)


def fit_centroids(df: DataFrame, features: str = "features", label: str = "label",
                  n_classes: int | None = None, temperature: float = 10.0,
                  weight: str | None = None) -> LinearModel:
    """Nearest-centroid learner: W[k] = (weighted) mean feature vector of class k.

    Each task folds its Arrow batches into per-class (sum vector, weight)
    partials; ``reduceByKey`` combines them map-side, and the driver receives
    only the k x d parameter table.
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    src = df.where(F.col(label).isNotNull()).select(F.col(label).cast("int").alias("k"), w.alias("w"),
                                                    F.col(features).alias("x"))

    def fold(batches):
        acc: dict[int, list] = {}
        for b in batches:
            if b.num_rows == 0:
                continue
            x = b.column(2)
            offs = np.asarray(x.offsets)
            dim = int(offs[1] - offs[0])
            X = x.values.slice(int(offs[0]), int(offs[-1] - offs[0])).to_numpy(zero_copy_only=False)
            X = X.astype(np.float64).reshape(b.num_rows, dim)
            k = b.column(0).to_numpy(zero_copy_only=False)
            wt = b.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
            for c in np.unique(k):
                sel = k == c
                a = acc.setdefault(int(c), [np.zeros(dim), 0.0])
                a[0] += (X[sel] * wt[sel][:, None]).sum(axis=0)
                a[1] += float(wt[sel].sum())
        if acc:
            ks = sorted(acc)
            yield pa.RecordBatch.from_pydict(
                {"k": ks, "s": [acc[c][0].tolist() for c in ks], "w": [acc[c][1] for c in ks]},
                schema=pa.schema([("k", pa.int32()), ("s", pa.list_(pa.float64())), ("w", pa.float64())]))

    parts = src.mapInArrow(fold, "k int, s array<double>, w double").rdd \
        .map(lambda r: (r["k"], (np.asarray(r["s"]), r["w"])))
    sums = parts.reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1])).collect()   # k rows
    if not sums:
        raise ValueError("no labelled rows to fit")
    ks = sorted(c for c, _ in sums)
    d = len(sums[0][1][0])
    K = (max(ks) + 1) if n_classes is None else n_classes
    W = np.zeros((K, d))
    for c, (vec, wt) in sums:
        W[c] = vec / wt
    return LinearModel(W=W, b=np.zeros(K), activation="softmax", temperature=temperature,
                       meta={"kind": "centroid", "classes": ks})
