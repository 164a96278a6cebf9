"""Structured Streaming jobs.

Every query is checkpointed in the shared checkpoint folder
(``spark.checkpoint.dir``), so a restarted driver or lost executor resumes
from the last committed micro-batch.  Sinks are idempotent per ``batchId``
(dynamic partition overwrite), which turns the at-least-once replay of a
micro-batch into an exactly-once table.
"""

from __future__ import annotations

import time
from collections.abc import Callable

import numpy as np
from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kelpie.operators.sequence import dense_position
from kelpie.session import cut_lineage, path_exists, scratch_path
from kelpie.sources.topics import TOPIC_SCHEMA, control_records, string_to_ranges


def checkpoint_location(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"streams/{name}")


# ------------------------------------------------------------------ S13 ----

def stream_topic(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                 schema=TOPIC_SCHEMA) -> DataFrame:
    """Continuous scan of a topic table folder (declared schema, no inference).
    With the Kafka connector the same frame comes from ``format("kafka")``."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def run_until_idle(query: StreamingQuery, idle_ms: int = 60000, poll_s: float = 0.5) -> StreamingQuery:
    """Stop when no input arrived for ``idle_ms`` (the deployment's stream
    timeout); ``-1`` keeps the query running."""
    if idle_ms == -1:
        return query
    last_data = None          # the idle clock starts with the first progress report
    seen = None
    while query.isActive:
        p = query.lastProgress
        fresh = p is not None and (p.get("batchId"), p.get("timestamp")) != seen
        if fresh:
            seen = (p.get("batchId"), p.get("timestamp"))
            if last_data is None or p.get("numInputRows", 0) > 0:
                last_data = time.time()
        if last_data is not None and (time.time() - last_data) * 1000 >= idle_ms:
            query.stop()
            break
        time.sleep(poll_s)
    return query


# ------------------------------------------------------------------ R01 ----

def foreach_microbatch(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                       available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Micro-batches in arrival order; empty batches are skipped."""
    def guarded(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            fn(batch, batch_id)

    w = stream.writeStream.foreachBatch(guarded).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 second")
    return w.start()


# ------------------------------------------------------------------ R02 ----

def idempotent_append(batch: DataFrame, batch_id: int, path: str) -> None:
    """At-least-once delivery made exactly-once: the batch id is a partition and
    a replayed batch overwrites its own partition only."""
    (batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
          .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy("batch_id").parquet(path))


def checkpointed_copy(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Copy a topic stream (headers included) with a checkpoint; a
    restart resumes after the last committed batch."""
    q = foreach_microbatch(stream, lambda b, i: idempotent_append(b, i, path), checkpoint)
    q.awaitTermination()
    return q


# ------------------------------------------------------------- T10 / T11 ----

def serve_stream(stream: DataFrame, decode: Callable[[DataFrame], DataFrame], model, limit: float, final_path: str,
                 upper_path: str, checkpoint: str, features: str = "features") -> StreamingQuery:
    """Score a topic stream and route it by confidence: rows at or above ``limit``
    go to the final sink as prediction records, the rest to the next tier's sink
    with the input vector as RAW bytes.  Key and headers pass through to both.

    ``decode`` turns topic rows into rows with ``features`` (keeping key and
    headers).  Both sinks write under the batch id, so a replayed micro-batch
    leaves each of them as it was."""
    from kelpie.operators.serve import prediction_records, route, score

    def handle(batch: DataFrame, batch_id: int) -> None:
        scored = score(decode(batch), model, features).persist()
        final, upper = route(scored, limit, hidden=features)
        idempotent_append(prediction_records(final), batch_id, final_path)
        idempotent_append(upper.select("key", "headers", "value"), batch_id, upper_path)
        scored.unpersist()

    q = foreach_microbatch(stream, handle, checkpoint)
    q.awaitTermination()
    return q


# ------------------------------------------------------------------ R04 ----

def monitor(stream: DataFrame, label: str, path: str, checkpoint: str) -> StreamingQuery:
    """Live class monitor: running counts per class in the state store
    (update mode); each micro-batch rewrites the snapshot of changed classes
    with its batch id, the reader keeps the newest row per class."""
    counts = stream.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    q = (counts.writeStream.outputMode("update")
         .foreachBatch(lambda b, i: idempotent_append(b, i, path))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def monitor_snapshot(spark: SparkSession, path: str) -> DataFrame:
    snap = spark.read.parquet(path)
    return snap.groupBy("label").agg(F.max_by("n", "batch_id").alias("n"))


def monitor_predictions(stream: DataFrame, by: str, path: str, checkpoint: str, since: Column | None = None) -> StreamingQuery:
    """Live monitor of prediction records (S21) for classification: the class is the argmax of the record's
    values (the first of equal ones); per ``by`` (a topic or partition) and class the running count.

    ``since`` bounds the record time from below: a monitor that is opened starts with the newest
    records, not with the topic's history.  Records without values are passed over."""
    from kelpie.functions.features import argmax
    values = F.from_json(F.col("value").cast("string"), "values array<double>")["values"]
    s = stream if since is None else stream.where(F.col("timestamp") >= since)
    s = s.select(F.col(by).alias("by"), values.alias("values")).where(F.size("values") > 0)
    counts = s.select("by", argmax(F.col("values")).cast("int").alias("cls")).groupBy("by", "cls").agg(F.count(F.lit(1)).alias("n"))
    q = (counts.writeStream.outputMode("update")
         .foreachBatch(lambda b, i: idempotent_append(b, i, path))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def prediction_shares(spark: SparkSession, path: str, decimals: int = 4) -> DataFrame:
    """by, cls, n and the class's share of all its ``by``'s predictions so far."""
    now = spark.read.parquet(path).groupBy("by", "cls").agg(F.max_by("n", "batch_id").alias("n"))
    total = now.groupBy("by").agg(F.sum("n").alias("total"))
    return now.join(total, "by").select("by", "cls", "n", F.round(F.col("n") / F.col("total"), decimals).alias("share"))


# ------------------------------------------------------------------ S09 ----

def publish_online(stream: DataFrame, topic: str, data: str, label: str | None, path: str, checkpoint: str, *, deployment_id: int,
                   partition: Column | str, order: str, description: str = "", validation_rate: float = 0.0,
                   data_type: str | None = None, label_type: str | None = None) -> StreamingQuery:
    """Publish a stream of samples and announce it once, at its first sample.

    Records go to ``path``/records, offsets go on from batch to batch.  The first batch that holds a
    sample decides the format (S04, unless types are given) and writes the one control row, incremental
    and without a size, to ``path``/control.  Everything a batch writes lies in folders of its own
    batch id: a batch that is run again, after a crash between any two writes, replaces what it wrote
    before, and whether an earlier batch has announced the stream is read from the control folder."""
    from kelpie.functions.codecs import encode_raw_col, infer_format
    from kelpie.sources.topics import append_topic, control_record, topic_ranges
    spark = stream.sparkSession

    def before(name: str, batch_id: int, schema: str) -> DataFrame | None:
        if not path_exists(spark, f"{path}/{name}"):
            return None
        return spark.read.schema(f"{schema}, batch_id long").parquet(f"{path}/{name}").where(F.col("batch_id") < batch_id)

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        fmt = infer_format(batch, data, label).first()          # types, and shapes over the whole batch
        kinds = data_type or fmt["data_type"], label_type or fmt["label_type"]
        ends = before("ends", batch_id, "partition int, end long")
        start = None if ends is None else ends.groupBy("partition").agg(F.max("end").alias("end"))
        log = append_topic(batch, topic, key=F.lit(None) if label is None else encode_raw_col(label, kinds[1]),
                           value=encode_raw_col(data, kinds[0]), partition=partition, order=order, start=start)
        idempotent_append(log, batch_id, f"{path}/records")
        mine = spark.read.parquet(f"{path}/records").where(F.col("batch_id") == batch_id)
        idempotent_append(mine.groupBy(F.col("partition").cast("int").alias("partition")).agg((F.max("offset") + 1).alias("end")),
                          batch_id, f"{path}/ends")
        told = before("control", batch_id, "deployment_id long")
        if told is None or told.isEmpty():
            config = {"data_type": kinds[0], "label_type": kinds[1] or "", "data_reshape": fmt["data_reshape"] or "",
                      "label_reshape": fmt["label_reshape"] or ""}
            control = control_record(topic_ranges(mine.select("topic", F.col("partition").cast("int").alias("partition"), "offset")),
                                     deployment_id=deployment_id, input_config=config, description=description,
                                     validation_rate=validation_rate, incremental=True)
            idempotent_append(control, batch_id, f"{path}/control")

    q = foreach_microbatch(stream, handle, checkpoint)
    q.awaitTermination()
    return q


# ------------------------------------------------------------------ R05 ----

def on_control(control_stream: DataFrame, log: DataFrame, path: str, checkpoint: str,
               fn: Callable[[DataFrame], DataFrame] | None = None,
               read: Callable[..., DataFrame] = control_records, **layout) -> StreamingQuery:
    """Control-plane stream: every control row triggers the read of the records
    it announces (J14 range join against the topic table).  A topic table laid out by offset is
    read by the announced folders only; ``bucket`` must then be the one it was written with.
    ``read`` says what ``fn`` gets: the records of each control row, or with
    :func:`kelpie.sources.topics.control_counts` their number, for which overlapping ranges
    are not multiplied out."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        ranges = string_to_ranges(batch.select("deployment_id", "topic"), "topic")
        rec = read(ranges.select("topic", "partition", "start", "end", "deployment_id"), log, **layout)
        out = fn(rec) if fn else rec
        idempotent_append(out, batch_id, path)

    q = foreach_microbatch(control_stream, handle, checkpoint)
    q.awaitTermination()
    return q


# ------------------------------------------------------------------ R06 ----

def latest_control(control_stream: DataFrame, key: str, order: str, path: str, checkpoint: str) -> StreamingQuery:
    """Skip to the newest control record per key: per micro-batch only the
    newest row of a key is handled, and only when it is newer than the last
    handled version, which lives in the state store (restarts keep it)."""
    from kelpie.streaming.processors import newest_rows, run_to_table

    return run_to_table(newest_rows(control_stream, key, order), path, checkpoint)


def handled_controls(spark: SparkSession, path: str, key: str, order: str) -> DataFrame:
    t = spark.read.parquet(path)
    return t.groupBy(key).agg(F.max_by(F.struct(*[c for c in t.columns if c != key]), F.col(order)).alias("r")) \
        .select(key, "r.*")


# ------------------------------------------------------------------ T05 ----

def fit_stream(stream: DataFrame, spec, params_path: str, checkpoint: str, d: int, lr: float = 0.5,
               validation_rate: float = 0.0, features: str = "features", label: str = "label", epochs: int = 1,
               order: str | None = None) -> StreamingQuery:
    """Incremental fit: warm start on each micro-batch (``epochs`` full-batch steps on its train
    split, L02); parameters are stored per batch id, so a replayed batch
    recomputes the same version from the previous one.  ``order`` (an integral, unique column) fixes
    which rows of a batch come first in the split; without it they come as they were read."""
    from kelpie.operators.splits import split_batch
    from kelpie.operators.train import gradient_step
    spark = stream.sparkSession

    def load(before: int):
        r = []
        if path_exists(spark, params_path):     # any other failure to read is an error
            rows = spark.read.parquet(params_path).where(F.col("batch_id") < before)
            r = rows.orderBy(F.col("batch_id").desc()).limit(1).collect()   # one parameter row
        if not r:
            return spec.init(d)
        flat = np.asarray(r[0]["params"])
        like = spec.init(d)
        from kelpie.operators.train import _unflatten
        return _unflatten(flat, like)

    def handle(batch: DataFrame, batch_id: int) -> None:
        from kelpie.operators.train import _flatten, evaluate_params
        P = load(batch_id)
        # the split counts positions, so they must be dense over all partitions of the batch
        seq = F.monotonically_increasing_id() if order is None else F.col(order).cast("long")
        rows = dense_position(cut_lineage(batch.withColumn("_seq", seq)), None, "_seq", name="_pos").drop("_seq")
        b = split_batch(rows, validation_rate, pos="_pos").persist()
        for _ in range(epochs):
            P = gradient_step(b.where(F.col("split") == "train"), spec, P, lr, features=features, label=label)
        val = b.where(F.col("split") == "validation")
        m = evaluate_params(val, spec, P, features=features, label=label) if validation_rate > 0 else \
            {"loss": None, "accuracy": None, "n": 0}
        b.unpersist()
        row = (batch_id, _flatten(P).tolist(), m["loss"] if m["n"] else None, m["accuracy"] if m["n"] else None)
        spark.createDataFrame([row], "batch_id long, params array<double>, val_loss double, val_accuracy double") \
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(params_path)

    q = foreach_microbatch(stream, handle, checkpoint)
    q.awaitTermination()
    return q


def incremental_results(spark: SparkSession, params_path: str, metric: str = "val_accuracy",
                        change: str = "up", improvement: float = 0.05, indefinite: bool = True) -> DataFrame:
    """T05 result rows: in indefinite mode a new result row is written whenever
    the monitored validation metric improved by ``improvement`` (W05 ratchet
    over the per-batch metrics); in timed mode the single result row is the
    last version."""
    from kelpie.operators.monitor import improvements
    versions = spark.read.parquet(params_path).where(F.col(metric).isNotNull()) \
        .withColumn("deployment", F.lit("stream"))
    if not indefinite:
        return versions.groupBy("deployment").agg(F.max_by(F.struct("batch_id", metric), "batch_id").alias("r")) \
            .select("deployment", "r.*")
    ups = improvements(versions, "deployment", "batch_id", metric, change=change, d=improvement)
    return ups.select(F.col("key").alias("deployment"), F.col("order").alias("batch_id"),
                      F.col("value").alias(metric), F.col("reference").alias("previous"))


# ------------------------------------------------------------------ T07 ----

def self_train_stream(stream: DataFrame, labelled: DataFrame, out_path: str, checkpoint: str,
                      confidence: float = 0.9, temperature: float = 10.0, key: str = "id",
                      features: str = "features", n_classes: int | None = None) -> StreamingQuery:
    """Streaming self-training: every unlabelled micro-batch is scored once by
    the model fitted on labelled ∪ pseudo-labelled rows so far; confident rows
    are appended; the query stops at a batch without a confident row.  That
    batch is not committed: a restart from the same checkpoint begins with it,
    and no later batch has been consumed."""
    from kelpie.functions.features import argmax
    from kelpie.operators.models import fit_centroids
    from kelpie.operators.quality import confident
    from kelpie.operators.serve import score
    spark = stream.sparkSession
    stopped_at: list[int] = []

    def handle(batch: DataFrame, batch_id: int) -> None:
        train = labelled.select(key, features, "label")
        if path_exists(spark, out_path):
            pseudo = spark.read.parquet(out_path).where(F.col("batch_id") < batch_id).drop("batch_id")
            train = train.unionByName(pseudo.select(key, features, "label"))
        model = fit_centroids(train, features, "label", n_classes=n_classes, temperature=temperature)
        sel = confident(score(batch, model, features), confidence) \
            .select(key, features, argmax("values").alias("label")).persist()     # asked for a row, then written
        try:
            if sel.isEmpty():
                stopped_at.append(batch_id)
                raise RuntimeError(f"batch {batch_id} has no confident row")
            idempotent_append(sel, batch_id, out_path)
        finally:
            sel.unpersist()

    q = foreach_microbatch(stream, handle, checkpoint)
    try:
        q.awaitTermination()
    except StreamingQueryException:
        if not stopped_at:
            raise
    return q
