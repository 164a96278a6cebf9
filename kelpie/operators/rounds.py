"""Federated rounds as tables.

A model is a table ``(layer, chunk, values)``: layers in the order of their names, cut into
chunks of ``CHUNK`` numbers.  Device models add the device; every round adds a version.  No
model passes through the driver, which holds counts, shapes and paths only.

* **Local fit.**  A device's rows are dealt once into blocks of about ``ROWS`` rows, so a device
  that holds a third of all rows is many tasks.  In each epoch every block is cogrouped
  with its device's model and gives a partial gradient per chunk; the partials are
  added up in a tree of at most ``FAN`` at a time, and one join moves the models of all
  devices a step.  The number of jobs is the number of epochs, whatever the number of devices.
* **Gate.**  Updates queue in the order of their arrival (wave by wave, devices in the natural order
  of their ids).  Round r takes its ``registered`` updates (G07); what comes late waits for
  the next round; -1 lets each update be a round of its own.
* **Aggregation.**  FedAvg is a mean per (layer, chunk, position) with partial sums per task;
  other strategies go by name through :func:`kelpie.operators.federated.aggregate`.
* **Records.**  One row per update that was used (G09), with the metrics of its last epoch.

A model must fit one task (a spec's forward pass needs all of it); nothing else
grows with a group.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpie.operators.federated import CHUNK, aggregate, round_record
from kelpie.operators.rewards import assign_round, fifo_position
from kelpie.operators.train import ModelSpec, feature_dim
from kelpie.session import scratch_path

ROWS = 1 << 16
FAN = 64
FINAL = -1
_PARAMS = "device string, layer int, chunk int, values array<double>"
_PARTIAL = "device string, salt long, layer int, chunk int, values array<double>, loss double, wsum double, correct long, n long"


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: the next step starts from files."""
    path = scratch_path(df.sparkSession, f"rounds/{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _chunked(P: dict[str, np.ndarray], size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    for layer, name in enumerate(sorted(P)):
        flat = np.asarray(P[name], float).ravel()
        for c in range(0, max(1, len(flat)), size):
            yield layer, c // size, flat[c:c + size]


def init_model(spark: SparkSession, spec: ModelSpec, d: int, seed: int = 0) -> DataFrame:
    """The spec's first parameters, made in a task."""
    size = CHUNK

    def make(batches):
        for b in batches:
            for _ in range(b.num_rows):
                layer, chunk, values = zip(*_chunked(spec.init(d, seed), size))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(layer, pa.int32()), pa.array(chunk, pa.int32()), pa.array(list(values), pa.list_(pa.float64()))],
                    ["layer", "chunk", "values"])

    return spark.range(0, 1, 1, 1).mapInArrow(make, "layer int, chunk int, values array<double>")


@dataclass
class Blocks:
    """Samples dealt into blocks: ``rows`` (device, salt, part, features, label, weight) and ``devices`` (device, blocks)."""

    rows: DataFrame
    devices: DataFrame
    d: int
    most: int       # blocks of the largest device
    count: int      # devices

    @classmethod
    def of(cls, df: DataFrame, device: str, features: str = "features", label: str = "label", weight: str | None = None,
           part=None, rows: int = ROWS) -> Blocks:
        """Rows without a device, label or features teach nothing and are left out.  ``part`` is a
        column that :func:`local_fit` can choose rows by."""
        src = df.select(F.col(device).cast("string").alias("device"), F.col(features).cast("array<double>").alias("features"),
                        F.col(label).cast("double").alias("label"),
                        (F.lit(1.0) if weight is None else F.col(weight).cast("double")).alias("weight"),
                        (F.lit(0) if part is None else part).cast("long").alias("part")) \
            .where("device IS NOT NULL AND features IS NOT NULL AND label IS NOT NULL")
        devices = _stored(src.groupBy("device").agg(F.ceil(F.count(F.lit(1)) / rows).cast("long").alias("blocks")), "devices")
        dealt = src.join(devices, "device").withColumn("salt", F.monotonically_increasing_id() % F.col("blocks")).drop("blocks")
        top = devices.agg(F.max("blocks"), F.count(F.lit(1))).first()
        dealt = _stored(dealt, "rows")
        return cls(dealt, devices, feature_dim(dealt), int(top[0] or 0), int(top[1]))


def _add_up(partial: DataFrame, most: int) -> DataFrame:
    """Sums per (device, layer, chunk), at most FAN arrays at a time."""
    while True:
        partial = partial.withColumn("salt", F.floor(F.col("salt") / FAN)).groupBy("device", "salt", "layer", "chunk").agg(
            F.sort_array(F.collect_list(F.struct("values"))).alias("those"), *[F.sum(c).alias(c) for c in ("loss", "wsum", "correct", "n")])
        arrays = F.transform("those", lambda s: s["values"])
        partial = partial.withColumn("values", F.aggregate(F.slice(arrays, 2, FAN), arrays[0],
                                                           lambda a, b: F.zip_with(a, b, lambda x, y: x + y))).drop("those")
        if most <= FAN:
            return partial.drop("salt")
        most = -(-most // FAN)


def _epoch(blocks: Blocks, rows: DataFrame, params: DataFrame, spec: ModelSpec, lr: float, seed: int) -> DataFrame:
    """One full-batch step of every device: params with loss, accuracy and num_data of the pass."""
    d, size = blocks.d, CHUNK

    def fit_block(data: pa.Table, model: pa.Table) -> pa.Table:
        if not len(data) or not len(model):
            return pa.table({f.name: pa.array([], f.type) for f in out_schema}, schema=out_schema)
        P, flat = spec.init(d, seed), {}
        for layer, chunk, values in zip(model["layer"].to_pylist(), model["chunk"].to_pylist(), model["values"]):
            flat.setdefault(layer, {})[chunk] = values.values.to_numpy()
        for layer, name in enumerate(sorted(P)):
            P[name] = np.concatenate([flat[layer][c] for c in sorted(flat[layer])]).reshape(P[name].shape)
        X = data["features"].combine_chunks()
        X = X.flatten().to_numpy(zero_copy_only=False).reshape(len(data), -1)
        if X.shape[1] != d:
            raise ValueError(f"features of {X.shape[1]} numbers, expected {d}")
        y, w = (data[c].to_numpy() for c in ("label", "weight"))
        loss, grad, correct = spec.loss_grad(P, X, y, w)
        rows = list(_chunked(grad, size))
        m = len(rows)                                       # the pass's sums go with every chunk
        return pa.table({
            "device": pa.array([data["device"][0].as_py()] * m), "salt": pa.array([data["salt"][0].as_py()] * m, pa.int64()),
            "layer": pa.array([r[0] for r in rows], pa.int32()), "chunk": pa.array([r[1] for r in rows], pa.int32()),
            "values": pa.array([r[2] for r in rows], pa.list_(pa.float64())),
            "loss": pa.array([float(loss)] * m), "wsum": pa.array([float(w.sum())] * m),
            "correct": pa.array([int(correct)] * m, pa.int64()), "n": pa.array([len(y)] * m, pa.int64())},
            schema=out_schema)

    out_schema = pa.schema([("device", pa.string()), ("salt", pa.int64()), ("layer", pa.int32()), ("chunk", pa.int32()),
                            ("values", pa.list_(pa.float64())), ("loss", pa.float64()), ("wsum", pa.float64()),
                            ("correct", pa.int64()), ("n", pa.int64())])
    salts = blocks.devices.select("device", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("salt"))
    models = salts.join(params.select("device", "layer", "chunk", "values"), "device")
    partial = rows.groupBy("device", "salt").cogroup(models.groupBy("device", "salt")).applyInArrow(fit_block, _PARTIAL)
    step = _add_up(partial, blocks.most).withColumnRenamed("values", "g")
    weight = F.greatest(F.col("wsum"), F.lit(1e-12))
    moved = params.select("device", "layer", "chunk", "values").join(step, ["device", "layer", "chunk"]).select(
        "device", "layer", "chunk", F.zip_with("values", "g", lambda v, g: v - F.lit(lr) * g / weight).alias("values"),
        (F.col("loss") / weight).alias("loss"), (F.col("correct") / F.greatest(F.col("n"), F.lit(1))).alias("accuracy"),
        F.col("n").alias("num_data"))
    return _stored(moved, "models")


def local_fit(blocks: Blocks, start: DataFrame, spec: ModelSpec, epochs: int = 1, lr: float = 0.5, part: int | None = None,
              seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Every device fits ``epochs`` full-batch steps from the model ``start`` (layer, chunk, values).

    Returns the device models (device, layer, chunk, values) and the history (device, epoch, loss, accuracy, num_data);
    an epoch's metrics are those of the model it starts from.  With ``part`` only rows of that part take
    part, and devices without any give no model."""
    rows = blocks.rows if part is None else blocks.rows.where(F.col("part") == part)
    # every device begins with the same model: one row per device and chunk, matched by layer and chunk
    present = blocks.devices.select("device") if part is None else rows.select("device").distinct()
    layers = start.groupBy("layer").agg(F.max("chunk").alias("top")).collect()      # a row a layer
    shape = F.array(*[F.struct(F.lit(x["layer"]).alias("layer"), F.lit(x["top"]).alias("top")) for x in layers])
    params = present.select("device", F.explode(shape).alias("l")) \
        .select("device", "l.layer", F.explode(F.sequence(F.lit(0), F.col("l.top"))).alias("chunk")).join(start, ["layer", "chunk"])
    history = None
    for e in range(epochs):
        params = _epoch(blocks, rows, params, spec, lr, seed)
        one = params.groupBy("device").agg(*[F.max(c).alias(c) for c in ("loss", "accuracy", "num_data")]) \
            .select("device", F.lit(e).alias("epoch"), "loss", "accuracy", "num_data")
        history = one if history is None else history.unionByName(one)
    return params.select("device", "layer", "chunk", "values"), history


def mean_model(models: DataFrame) -> DataFrame:
    """G02 on chunks: element-wise mean of all models in (layer, chunk, values)."""
    long = models.select("layer", "chunk", F.posexplode("values").alias("pos", "v"))
    mean = long.groupBy("layer", "chunk", "pos").agg(F.avg("v").alias("v"))
    return mean.groupBy("layer", "chunk").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "v"))), lambda s: s["v"]).alias("values"))   # CHUNK numbers


def _combine(current: DataFrame, members: DataFrame, strategy: str) -> DataFrame:
    """The next global model from the current one and the device models of a round."""
    if strategy == "FedAvg":
        return mean_model(current.unionByName(members.select("layer", "chunk", "values")))
    whole = current.withColumn("model_id", F.lit("")).unionByName(
        members.select("layer", "chunk", "values", F.concat(F.lit("d"), "device").alias("model_id")))
    whole = whole.groupBy("model_id", "layer").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("chunk", "values"))), lambda s: s["values"])).alias("values"))
    after = aggregate(whole, strategy, "")
    at = F.sequence(F.lit(0), F.ceil(F.size("values") / CHUNK).cast("int") - 1)
    return after.select("layer", F.explode(at).alias("chunk"), "values") \
        .select("layer", "chunk", F.slice("values", F.col("chunk") * CHUNK + 1, CHUNK).alias("values"))


@dataclass
class FederatedRun:
    """``versions`` (version, layer, chunk, values): the global model that each round began with and,
    as version -1, the last one.  ``records``: one row per update used.  ``history``: the metrics of every
    wave, device and epoch."""

    versions: DataFrame
    records: DataFrame
    history: DataFrame

    def model(self, version: int = FINAL) -> DataFrame:
        return self.versions.where(F.col("version") == version).drop("version")


def run_federated(df: DataFrame, spec: ModelSpec, device: str, rounds: int = 3, epochs: int = 1, lr: float = 0.5,
                  strategy: str = "FedAvg", registered: int | None = None, part=None, parts: int = 0, seed: int = 0,
                  block_rows: int = ROWS, **names) -> FederatedRun:
    """Local fits, gate, aggregation and records for ``rounds`` rounds.

    ``registered`` updates make a round (all devices by default; -1: each update alone).  Devices
    are asked again, with the newest global model, whenever the queue can't fill the next round.  With
    ``parts`` and ``part`` (a column counted from 0) wave w trains on part min(w, parts - 1)."""
    spark = df.sparkSession
    blocks = Blocks.of(df, device, part=part, rows=block_rows, **names)
    current = _stored(init_model(spark, spec, blocks.d, seed), "global")
    versions, records, waves, passes, arrived = None, None, [], None, 0
    need = blocks.count if registered is None else registered
    each = 1 if need == -1 else need
    if not blocks.count or each < 1:
        return FederatedRun(current.select(F.lit(FINAL).alias("version"), "*"), spark.createDataFrame([], _RECORD),
                            spark.createDataFrame([], _HISTORY))
    for r in range(rounds):
        begun = current.select(F.lit(r).alias("version"), "*")
        versions = begun if versions is None else versions.unionByName(begun)
        while arrived < (r + 1) * each:
            w = len(waves)
            models, history = local_fit(blocks, current, spec, epochs, lr, min(w, parts - 1) if parts else None, seed)
            waves.append(models.withColumn("wave", F.lit(w)))
            history = _stored(history.select(F.lit(w).alias("wave"), "*"), "history")
            passes = history if passes is None else passes.unionByName(history)
            came = history.where("epoch = 0").count() if parts else blocks.count
            if not came:
                raise ValueError("no device holds rows of this round's part")
            arrived += came
        queue = fifo_position(_sent(passes), "federation", "wave", tiebreak=["id_length", "device"])
        used = assign_round(queue, "federation", need).where(F.col("round") == r)
        models = waves[0]
        for more in waves[1:]:
            models = models.unionByName(more)
        members = models.join(used.select("wave", "device"), ["wave", "device"])
        current = _stored(_combine(current, members, strategy), "global")
        record = round_record(used.select(F.col("round").cast("int").alias("round"), "device", "fifo", "num_data", "metrics")) \
            .select("round", "device", "fifo", "num_samples", "train_loss", "train_acc", "val_loss", "val_acc")
        records = record if records is None else records.unionByName(record)
    return FederatedRun(versions.unionByName(current.select(F.lit(FINAL).alias("version"), "*")), records, passes)


_RECORD = ("round int, device string, fifo long, num_samples int, train_loss double, train_acc double, val_loss double, "
           "val_acc double")
_HISTORY = "wave int, device string, epoch int, loss double, accuracy double, num_data long"


def _sent(history: DataFrame) -> DataFrame:
    """The message of each device and wave: its metrics per epoch as JSON and its number of rows."""
    series = history.groupBy("wave", "device").agg(F.sort_array(F.collect_list(F.struct("epoch", "loss", "accuracy"))).alias("h"),
                                           F.max("num_data").cast("string").alias("num_data"))
    metrics = F.to_json(F.struct(F.struct(F.transform("h", lambda x: x["loss"]).alias("loss"),
                                          F.transform("h", lambda x: x["accuracy"]).alias("accuracy")).alias("training")))
    return series.select(F.lit("0").alias("federation"), F.col("wave").cast("long").alias("wave"),
                         F.length("device").alias("id_length"), "device", "num_data", metrics.alias("metrics"))
