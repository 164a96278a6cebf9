"""Quality rules: counts with fixed limits, then a trained verdict.

The verdict is a logistic regression on hashed word and character n-grams,
trained on labelled quality rows and probability-calibrated on labelled rows it
was not trained on (Platt scaling).  Texts are scored in Arrow batches against
a fixed threshold on that probability.

The classifier is fitted on a bounded sample: the ``max_train`` labelled rows
with the smallest seeded hash of their id, three quarters of them for the
weights, one quarter for the calibration.  Everything else covers all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpie.llm.common import aside, columns, write_and_read
from kelpie.llm.textstats import Chunk, Grams, chunks

MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
THRESHOLD = 0.5
MAX_TRAIN = 6000
TRAIN_PARTITIONS = 6
BITS = 16
WORD_N, CHAR_N = (1, 2), (1, 2, 3)
SCALE = 30.0            # features are relative frequencies times this
SEED = 3


@dataclass(frozen=True)
class Model:
    """Weights by hashed feature; probability = 1 / (1 + exp(-(slope * score + shift)))."""
    weights: np.ndarray
    intercept: float
    slope: float
    shift: float


def _raw_scores(texts: list[str], chunk: Chunk, model: Model) -> np.ndarray:
    score = np.full(len(texts), model.intercept)
    bits = len(model.weights).bit_length() - 1
    for feature, a, b in Grams(texts, chunk, bits).parts(WORD_N, CHAR_N):
        total = np.concatenate([[0.0], np.cumsum(model.weights[feature])])
        score += SCALE * (total[b] - total[a]) / np.maximum(1, b - a)
    return score


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse training vectors: (label, calibrate, idx, val)."""
    for b in batches:
        for first, texts in chunks(b.column(2)):
            chunk = Chunk(texts)
            parts = list(Grams(texts, chunk, BITS).parts(WORD_N, CHAR_N))
            idx, val = [], []
            for d in range(len(texts)):
                got = [(feature[a[d]:e[d]], SCALE / max(1, e[d] - a[d])) for feature, a, e in parts]
                f, inverse = np.unique(np.concatenate([g for g, _ in got]), return_inverse=True)
                w = np.concatenate([np.full(len(g), x) for g, x in got])
                idx.append(f.astype(np.int32))
                val.append(np.bincount(inverse, w, len(f)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(first, len(texts)), b.column(1).slice(first, len(texts)),
                 pa.array(idx, pa.list_(pa.int32())), pa.array(val, pa.list_(pa.float64()))],
                ["label", "calibrate", "idx", "val"])


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, seed: int = SEED) -> Model | None:
    """Fit on ``labels`` (doc_id, quality 0/1) joined to ``docs`` (doc_id, text).

    Ids whose labels contradict each other, and null labels or ids, are left
    out.  Each id gives one row, the text with the smallest hash if it has several, so the sample is
    ``max_train`` rows at most however often an id occurs.  None if the sample lacks one of
    the two classes: there is then nothing to learn."""
    marked = columns(labels, doc_id="long", quality="int").where("doc_id IS NOT NULL AND quality IN (0, 1)") \
        .groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("hi")).where("label = hi") \
        .select("doc_id", "label", F.xxhash64(F.lit(seed), "doc_id").alias("h")) \
        .orderBy("h", "doc_id").limit(max_train)
    marked = marked.select("doc_id", F.col("label").cast("double").alias("label"),
                           (F.pmod(F.col("h"), F.lit(4)) == 0).alias("calibrate"))
    text = columns(docs, doc_id="long", text="string")
    # the sample's ids: max_train rows at most
    sample = text.join(F.broadcast(marked), "doc_id").groupBy("doc_id", "label", "calibrate") \
        .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("label", "calibrate", "text")
    rows = sample.mapInArrow(_features, "label double, calibrate boolean, idx array<int>, val array<double>")
    # few partitions whatever the corpus: a gradient is as wide as the model, and one is sent for each
    rows = write_and_read(rows.repartition(TRAIN_PARTITIONS), "quality-sample")
    # not in the pass above: two Python steps in one stage keep twice the workers, for as long as the executor lives
    vector = F.udf(lambda i, v: Vectors.sparse(1 << BITS, i, v), VectorUDT())
    rows = rows.select("label", "calibrate", vector("idx", "val").alias("features"))
    counts = {(r["calibrate"], r["label"]): r["count"] for r in rows.groupBy("calibrate", "label").count().collect()}
    if not all(counts.get((False, y)) for y in (0.0, 1.0)):
        return None
    n = counts[False, 0.0] + counts[False, 1.0]
    balance = F.when(F.col("label") == 1, n / counts[False, 1.0]).otherwise(n / counts[False, 0.0])
    fitted = LogisticRegression(maxIter=40, regParam=1e-3, standardization=False, weightCol="w") \
        .fit(rows.where("NOT calibrate").withColumn("w", balance))
    weights, intercept = fitted.coefficients.toArray().astype(np.float32), float(fitted.intercept)
    if not all(counts.get((True, y)) for y in (0.0, 1.0)):
        return Model(weights, intercept, 1.0, 0.0)
    margin = array_to_vector(F.array(vector_to_array("rawPrediction")[1]))     # in the JVM, for the same reason
    platt = LogisticRegression(maxIter=50, regParam=1e-4, featuresCol="m", predictionCol="pp",
                               rawPredictionCol="pr", probabilityCol="pq") \
        .fit(fitted.transform(rows.where("calibrate")).select("label", margin.alias("m")))
    return Model(weights, intercept, float(platt.coefficients[0]), float(platt.intercept))


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in batches:
            for first, texts in chunks(b.column(1)):
                c = Chunk(texts)
                p = np.ones(len(texts)) if m is None else \
                    1 / (1 + np.exp(-np.clip(m.slope * _raw_scores(texts, c, m) + m.shift, -50, 50)))
                counts = (c.n_words, c.word_chars(), c.n_symbols(), c.n_dup_lines(), c.n_repeat_words())
                failed = (c.n_words < MIN_WORDS) | (100 * counts[4] > MAX_REPEAT_PERCENT * c.n_words)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(texts)), *(pa.array(x, pa.int64()) for x in counts),
                     pa.array(failed), pa.array(p), pa.array(~failed & (p >= THRESHOLD))],
                    ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                     "base_failed", "quality", "kept"])

    return run


_SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, quality double, kept boolean")


def judge(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the counts, ``base_failed``, the
    calibrated probability ``quality`` and ``kept``.  A null or empty text has no
    words and fails; null ids and repeated rows are judged like any other;
    without a model (None) the fixed limits decide alone; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return columns(docs, doc_id="long", text="string").mapInArrow(_score(shared), _SCHEMA)


def filter_documents(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns, in one pass and without a join."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")
    judge_batch = _score(shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column(at)
            probe = pa.RecordBatch.from_arrays([pa.nulls(b.num_rows, pa.int64()), text], ["doc_id", "text"])
            keep = pa.chunked_array([x.column(8) for x in judge_batch([probe])], pa.bool_()).combine_chunks()
            yield b.filter(keep)

    rows = aside(docs, "text")
    return rows.mapInArrow(run, rows.schema).toDF(*docs.columns)
