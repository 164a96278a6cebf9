"""Stateful streaming versions of the order-dependent operators.

Each keeps a small per-key state in the state store (``applyInPandasWithState``, or
the processors of :mod:`kelpie.streaming.processors`; W03 in a table of its own):
rows of a key inside one micro-batch are ordered, folded against the state,
and the state is updated — a micro-batch never needs older rows.  Results
equal the batch operators when micro-batches arrive in order.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import StructType

from kelpie.functions.features import round_js
from kelpie.operators.monitor import _moved
from kelpie.session import path_exists
from kelpie.streaming.processors import numbered_series, round_gate, run_to_table
from kelpie.streaming.streams import foreach_microbatch, idempotent_append


def _run(out: DataFrame, path: str, checkpoint: str) -> None:
    q = (out.writeStream.outputMode("append").foreachBatch(lambda b, i: idempotent_append(b, i, path))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def ratchet_stream(stream: DataFrame, key: str, order: str, value: str, path: str, checkpoint: str,
                   change: str = "up", d: float = 0.05) -> None:
    """W05 on a stream: state = current reference per key."""
    moved, sign = _moved(d), 1.0 if change == "up" else -1.0
    out_schema = "key string, order long, value double, reference double"

    def fn(k, pdfs, state):
        pdf = pd.concat(list(pdfs)).sort_values("o")
        ref = state.get[0] if state.exists else None
        ks, os_, vs, rs = [], [], [], []
        for o, v in zip(pdf["o"].tolist(), pdf["v"].tolist()):
            if ref is None:
                ref = v
                continue
            if moved(v, ref):
                ks.append(k[0]), os_.append(o), vs.append(v * sign), rs.append(ref * sign)
                ref = v
        state.update((ref,))
        yield pd.DataFrame({"key": pd.Series(ks, dtype=object), "order": pd.Series(os_, dtype="int64"),
                            "value": pd.Series(vs, dtype="float64"), "reference": pd.Series(rs, dtype="float64")})

    s = stream.select(F.col(key).cast("string").alias("k"), F.col(order).cast("long").alias("o"),
                      (F.col(value).cast("double") * F.lit(sign)).alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    out = s.groupBy("k").applyInPandasWithState(fn, out_schema, "ref double", "append", GroupStateTimeout.NoTimeout)
    _run(out, path, checkpoint)


def leader_stream(stream: DataFrame, key: str, label: str, order: str, classes: list[str], path: str,
                  checkpoint: str, window: int = 0, decimals: int = 4) -> None:
    """W03 on a stream: state = class counts, total and the last leader of each key, a table at
    ``path``-state with one version per micro-batch.  The rows of a micro-batch go on from the
    version before it, all keys in one window pass: with many keys of few rows, a Python call for
    each key and micro-batch would cost more than the rows.  A replayed micro-batch reads the same
    version and writes the same rows and the same state again."""
    spark, kept = stream.sparkSession, f"{path}-state"
    counts = [f"c{i}" for i in range(len(classes))]
    state_schema = StructType.fromDDL(", ".join(["k string", *[f"{c} long" for c in counts], "total long, leader string, batch_id long"]))
    out = stream.select(F.col(key).cast("string").alias("k"), F.col(order).cast("long").alias("o"),
                        F.col(label).cast("string").alias("l"))

    def state_before(batch_id: int) -> DataFrame:
        if not path_exists(spark, kept):
            return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in state_schema if f.name != "batch_id"])
        versions = spark.read.schema(state_schema).parquet(kept).where(F.col("batch_id") < batch_id)
        last = versions.agg(F.max("batch_id")).first()[0]
        return versions.where(F.col("batch_id") == F.lit(last).cast("long")).drop("batch_id")

    def handle(batch: DataFrame, batch_id: int) -> None:
        old = state_before(batch_id).select(F.col("k").alias("_k"), *[F.col(c).alias(f"_{c}") for c in [*counts, "total", "leader"]])
        so_far = Window.partitionBy("k").orderBy("o", "l")
        rows = batch.join(old, F.col("k").eqNullSafe(F.col("_k")), "left")
        rows = rows.select("k", "o", "l", F.col("_leader"), *[
            (F.coalesce(F.col(f"_{c}"), F.lit(0)) + F.coalesce(F.sum((F.col("l") == F.lit(name)).cast("long")).over(
                so_far.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))).alias(c) for c, name in zip(counts, classes)],
            (F.coalesce(F.col("_total"), F.lit(0)) + F.row_number().over(so_far)).cast("long").alias("total"))
        shares = F.array(*[round_js(F.col(c) / F.col("total"), decimals) for c in counts])
        rows = rows.withColumn("_shares", shares).withColumn("leader", F.element_at(
            F.array(*[F.lit(str(c)) for c in classes]), F.array_position("_shares", F.array_max("_shares")).cast("int")))
        rows = rows.withColumn("_last", F.coalesce(F.lag("leader").over(so_far), F.col("_leader")))
        emit = F.col("_last").isNull() | (F.col("_last") != F.col("leader"))
        if window:
            emit = emit | (F.pmod(F.col("total"), F.lit(window)) == 0)
        rows = rows.withColumn("emit", emit).persist()      # the rows handed out, and the state after them
        try:
            idempotent_append(rows.select(F.col("k").alias("user"), F.col("o").alias("order"), "leader", "emit"), batch_id, path)
            new = rows.groupBy("k").agg(F.max_by(F.struct(*counts, "total", "leader"), "total").alias("s")).select("k", "s.*")
            rest = old.join(new.select("k"), F.col("_k").eqNullSafe(F.col("k")), "left_anti") \
                .select(*[F.col(f"_{c}").alias(c) for c in ["k", *counts, "total", "leader"]])
            idempotent_append(new.unionByName(rest), batch_id, kept)
        finally:
            rows.unpersist()

    foreach_microbatch(out, handle, checkpoint).awaitTermination()


def round_gate_stream(stream: DataFrame, federation: str, order: str, registered: int, path: str,
                      checkpoint: str) -> None:
    """G07 on a stream: updates wait in state until ``registered`` of them
    arrived; the complete round is then released with its round number (an
    incomplete last round stays held back)."""
    run_to_table(round_gate(stream, federation, order, registered), path, checkpoint)


def status_register_stream(stream: DataFrame, key: str, order: str, status: str, path: str, checkpoint: str,
                           k: int = 4) -> None:
    """W02 on a stream (R04 classification view): state = the last k statuses
    of each monitored key; every row is emitted with the k before it."""
    out_schema = f"key string, order long, status string, " + ", ".join(f"prev_{i} string" for i in range(1, k + 1))

    def fn(kk, pdfs, state):
        pdf = pd.concat(list(pdfs)).sort_values("o")
        last = list(state.get[0]) if state.exists else []
        rows = []
        for o, s in zip(pdf["o"].tolist(), pdf["s"].tolist()):
            prev = list(reversed(last[-k:]))
            rows.append([kk[0], o, s] + prev + [None] * (k - len(prev)))
            last = (last + [s])[-k:]
        state.update((last,))
        yield pd.DataFrame(rows, columns=["key", "order", "status"] + [f"prev_{i}" for i in range(1, k + 1)]) \
            .astype({"order": "int64"})

    s = stream.select(F.col(key).cast("string").alias("k"), F.col(order).cast("long").alias("o"),
                      F.col(status).cast("string").alias("s"))
    out = s.groupBy("k").applyInPandasWithState(fn, out_schema, "last array<string>", "append",
                                                GroupStateTimeout.NoTimeout)
    _run(out, path, checkpoint)


def regression_series_stream(stream: DataFrame, key: str, order: str, values: str, path: str,
                             checkpoint: str) -> None:
    """W04 on a stream (R04 regression view): each output dimension gets points
    numbered 0, 1, 2 ... in arrival order; state = points so far per key and dimension."""
    run_to_table(numbered_series(stream, key, order, values), path, checkpoint)
