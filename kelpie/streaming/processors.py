"""Stateful stream operators on ``transformWithState``.

State lives in RocksDB, one small entry per key: a value (the newest version, the number of
rounds or points so far, whether a federation was launched) or a short list (updates that
wait for their round).  A key's rows of a micro-batch come as an iterator of Arrow batches
and are never concatenated as frames: a maximum is folded batch by batch, and where order
matters only the order column (and the value that goes with it) is gathered in NumPy.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from kelpie.operators.registry import federated_models, match_pairs
from kelpie.streaming.streams import idempotent_append

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_CHUNK = 1 << 16        # rows a frame that is handed out


@contextmanager
def _state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB (a query takes the setting when it starts)."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def run_to_table(out: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Take what is there, append it to the table at ``path`` once per micro-batch, stop."""
    with _state_in_rocksdb(out.sparkSession):
        q = (out.writeStream.outputMode("append").foreachBatch(lambda b, i: idempotent_append(b, i, path))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def _transform(stream: DataFrame, keys: list[str], processor: StatefulProcessor, schema: str) -> DataFrame:
    return stream.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="None")


class _Keyed(StatefulProcessor):
    """A processor with one value state named ``value``."""

    state = "n long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.value = handle.getValueState("value", self.state)

    def close(self) -> None:
        pass


def _gathered(frames: Iterator[pd.DataFrame], *names: str) -> list[np.ndarray]:
    """The named columns of a key's rows, sorted by the first."""
    parts = [[f[n].to_numpy() for n in names] for f in frames]
    columns = [np.concatenate(p) for p in zip(*parts)]
    order = np.argsort(columns[0], kind="stable")
    return [c[order] for c in columns]


# ------------------------------------------------------------------ R06 ----

class _Newest(_Keyed):
    """Hands out a key's newest row of the micro-batch if it is newer than all handled before."""

    def __init__(self, order: str, kind: str, columns: list[str]):
        self.order, self.state, self.columns = order, f"done {kind}", columns

    def handleInputRows(self, key, rows, timerValues):
        best = None
        for pdf in rows:
            top = pdf.loc[[pdf[self.order].idxmax()]]
            if best is None or top[self.order].iloc[0] > best[self.order].iloc[0]:
                best = top
        newest, done = best[self.order].iloc[0].item(), self.value.get()
        if done is None or newest > done[0]:
            self.value.update((newest,))
            yield best[self.columns]


def newest_rows(stream: DataFrame, key: str, order: str) -> DataFrame:
    """Per micro-batch the newest row of each key, unless a newer one was handled before."""
    schema = stream.schema
    kind = schema[order].dataType.simpleString()
    return _transform(stream.where(F.col(order).isNotNull()), [key], _Newest(order, kind, stream.columns), schema)


# ------------------------------------------------------------------ G07 ----

class _Gate(_Keyed):
    """Rounds of ``registered`` updates; those of an incomplete round wait in a list state."""

    state = "rounds long"

    def __init__(self, registered: int):
        self.registered = registered

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.waiting = handle.getListState("waiting", "update_id long")

    def handleInputRows(self, key, rows, timerValues):
        k = self.registered
        (ids,) = _gathered(rows, "update_id")
        ids = np.concatenate([np.array([x[0] for x in self.waiting.get()], np.int64), ids])
        done = self.value.get()
        done, full = (done[0] if done else 0), len(ids) // k
        for a in range(0, full * k, _CHUNK):
            part = ids[a:min(a + _CHUNK, full * k)]
            yield pd.DataFrame({"federation": [key[0]] * len(part), "update_id": part,
                                "round": done + np.arange(a, a + len(part)) // k})
        self.value.update((int(done + full),))
        rest = [(int(x),) for x in ids[full * k:]]
        if rest:
            self.waiting.put(rest)
        else:
            self.waiting.clear()


def round_gate(stream: DataFrame, federation: str, order: str, registered: int) -> DataFrame:
    """federation, update_id, round: released when the round has ``registered`` updates (-1: at once)."""
    s = stream.select(F.col(federation).cast("string").alias("federation"), F.col(order).cast("long").alias("update_id")) \
        .where("update_id IS NOT NULL")
    return _transform(s, ["federation"], _Gate(1 if registered == -1 else registered),
                      "federation string, update_id long, round long")


# ------------------------------------------------------------------ W04 ----

class _Numbered(_Keyed):
    def handleInputRows(self, key, rows, timerValues):
        order, value = _gathered(rows, "order", "value")
        done = self.value.get()
        first = done[0] if done else 0
        for a in range(0, len(order), _CHUNK):
            b = min(a + _CHUNK, len(order))
            yield pd.DataFrame({"key": [key[0]] * (b - a), "order": order[a:b], "point": first + np.arange(a, b),
                                "i": np.full(b - a, key[1], np.int32), "value": value[a:b]})
        self.value.update((int(first + len(order)),))


def numbered_series(stream: DataFrame, key: str, order: str, values: str) -> DataFrame:
    """key, order, point, i, value: each output dimension of a key (a topic partition) is a series of
    its own, numbered from 0 in arrival order; state and work are per key and dimension."""
    s = stream.select(F.col(key).cast("string").alias("key"), F.col(order).cast("long").alias("order"),
                      F.posexplode(F.col(values).cast("array<double>")).alias("i", "value"))
    return _transform(s, ["key", "i"], _Numbered(), "key string, order long, point long, i int, value double")


# ------------------------------------------------------------------ J05 ----

class _First(_Keyed):
    """Hands out a key's least row once."""

    state = "launched boolean"

    def __init__(self, order: list[str], columns: list[str]):
        self.order, self.columns = order, columns

    def handleInputRows(self, key, rows, timerValues):
        if self.value.get() is not None:
            return
        best = None
        for pdf in rows:
            top = pdf.nsmallest(1, self.order)
            if best is None or tuple(top[self.order].iloc[0]) < tuple(best[self.order].iloc[0]):
                best = top
        self.value.update((True,))
        yield best[self.columns]


def first_launches(stream: DataFrame, fed: str, order: list[str]) -> DataFrame:
    """One row per federated id over all micro-batches: the least by ``order`` (numbers) of the
    first batch that holds the id.  Rows without an id launch nothing."""
    s = stream.where(F.col(fed).isNotNull() & (F.col(fed) != ""))
    return _transform(s, [fed], _First(order, stream.columns), stream.schema)


def first_launch_stream(datasources: DataFrame, models: DataFrame) -> DataFrame:
    """J05 on a stream of data sources against stored models: fed, ds_id, model_id, once per id.  Each id's
    first model is found before the join, so an id's pairs are never formed."""
    ds = datasources.select(F.col("federated_string_id").alias("fed"), F.col("ds_id").cast("long").alias("ds_id"))
    return first_launches(ds.join(federated_models(models), "fed"), "fed", ["ds_id"])


# ------------------------------------------------------------------ J03 ----

def match_stream(datasources: DataFrame, models: DataFrame, ds_time: str | None = None, model_time: str | None = None,
                 within: str | None = None) -> DataFrame:
    """J01 - J03 on two streams: a model meets the data sources that are stored and those that come later.

    A stream-stream inner join that keeps both sides as state.  With ``within`` (an interval; then both
    time columns are needed) a pair must lie that close in event time, both streams get a
    watermark of that delay, and rows that can meet nothing any more leave the state; without it
    all rows are kept.  Columns as :func:`kelpie.operators.registry.match`."""
    if within is None:
        return match_pairs(datasources, models)
    ds = datasources.withColumn("_ds_time", F.col(ds_time)).withWatermark("_ds_time", within)
    ms = models.withColumn("_m_time", F.col(model_time)).withWatermark("_m_time", within)
    near = F.expr(f"_m_time >= _ds_time - INTERVAL {within} AND _m_time <= _ds_time + INTERVAL {within}")
    return match_pairs(ds, ms, near, ["_ds_time"], ["_m_time"])
