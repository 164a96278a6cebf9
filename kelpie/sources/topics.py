"""Topic tables: keyed record logs with offsets, ranges and control records.

A topic table has the columns of Spark's Kafka source
``(topic, partition, offset, timestamp, key, value, headers)``.  It is stored
as Parquet partitioned by ``topic, partition`` so range reads prune files
and push the offset predicate into the scan; with the Kafka connector on the
classpath the same frames can be written with ``format("kafka")``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpie.functions.codecs import key_bytes, key_bytes_error, key_to_int
from kelpie.operators.sequence import DEFAULT_BLOCK, dense_position, running_sum
from kelpie.session import cut_lineage

TOPIC_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("headers", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())]))),
])

RANGES = 100_000        # exploded range rows that are broadcast at most
RANGE_SCHEMA = "topic string, partition int, start long, end long"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ------------------------------------------------------------------ S01 ----

def append_topic(df: DataFrame, topic: str, key: Column | str = "key", value: Column | str = "value",
                 partition: Column | str | None = None, num_partitions: int = 1,
                 order: str | None = None, start: DataFrame | None = None,
                 headers: Column | str | None = None, timestamp: Column | str | None = None,
                 block: int = DEFAULT_BLOCK) -> DataFrame:
    """Rows -> topic records with (partition, offset).

    ``partition`` defaults to ``pmod(xxhash64(key), num_partitions)`` (keyed
    partitioner).  Offsets continue from ``start`` (a frame of
    ``partition, end``, e.g. :func:`topic_ranges` of the stored log) and follow
    ``order`` (integral, unique) inside a partition; they are assigned by
    blocked prefix counts, not by a window over the whole partition.
    """
    k = _c(key)
    part = _c(partition).cast("int") if partition is not None else \
        F.pmod(F.xxhash64(k), F.lit(num_partitions)).cast("int")
    out = df.select(
        F.lit(topic).alias("topic"), part.alias("partition"),
        (F.col(order) if order else F.monotonically_increasing_id()).alias("_seq"),
        (_c(timestamp).cast("timestamp") if timestamp is not None else F.current_timestamp()).alias("timestamp"),
        k.cast("binary").alias("key"), _c(value).cast("binary").alias("value"),
        (_c(headers) if headers is not None else F.lit(None).cast(TOPIC_SCHEMA["headers"].dataType)).alias("headers"),
    )
    out = dense_position(out, "partition", "_seq", block=block, name="_pos")
    if start is not None:
        base = start.select(F.col("partition").cast("int").alias("partition"), F.col("end").alias("_base"))
        out = out.join(base, "partition", "left")
    else:
        out = out.withColumn("_base", F.lit(0).cast("long"))
    out = out.withColumn("offset", F.coalesce(F.col("_base"), F.lit(0)) + F.col("_pos"))
    return out.select(*TOPIC_SCHEMA.fieldNames())


BUCKET = "offset_bucket"     # folder level of topic tables laid out by offset
BUCKETED_SCHEMA = T.StructType([*TOPIC_SCHEMA.fields, T.StructField(BUCKET, T.LongType())])


def write_topic(df: DataFrame, path: str, mode: str = "append", bucket: int | None = None) -> None:
    """Persist a topic frame; ``topic/partition`` folders make range reads prune.  With ``bucket`` the records
    of so many consecutive offsets share a folder of their own, so a read prunes to the
    announced ranges (:func:`control_records` with the same ``bucket``)."""
    if bucket is None:
        df.write.mode(mode).partitionBy("topic", "partition").parquet(path)
    else:
        folders = ["topic", "partition", BUCKET]
        df.withColumn(BUCKET, F.floor(F.col("offset") / bucket).cast("long")).repartition(*folders) \
            .write.mode(mode).partitionBy(*folders).parquet(path)


def read_topic(spark: SparkSession, path: str, bucketed: bool = False) -> DataFrame:
    return spark.read.schema(BUCKETED_SCHEMA if bucketed else TOPIC_SCHEMA).parquet(path)


def append_unlabelled(df: DataFrame, topic: str, value: Column | str = "value", **kw) -> DataFrame:
    """Unlabelled side topic, key = single byte 0."""
    return append_topic(df, topic, key=F.lit(bytearray(b"\x00")), value=value, **kw)


# ------------------------------------------------------------------ S06 ----

def topic_ranges(log: DataFrame, since: DataFrame | None = None) -> DataFrame:
    """Per (topic, partition) the new records since a previous snapshot.

    ``end`` is the exclusive end offset (the reference calls it ``length``);
    partitions unseen in ``since`` start at 0.  ``since`` has columns
    ``topic, partition, end``.
    """
    ends = log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end"))
    if since is None:
        return ends.select("topic", "partition", F.lit(0).cast("long").alias("start"), "end",
                           F.col("end").alias("n"))
    prev = since.select("topic", "partition", F.col("end").alias("_prev"))
    j = ends.join(prev, ["topic", "partition"], "left")
    start = F.coalesce(F.col("_prev"), F.lit(0)).cast("long")
    return j.select("topic", "partition", start.alias("start"), "end", (F.col("end") - start).alias("n"))


# ------------------------------------------------------------------ S07 ----

def range_text(topic: Column | str, partition: Column | str, start: Column | str, end: Column | str) -> Column:
    return F.concat_ws(":", _c(topic), _c(partition).cast("string"), _c(start).cast("string"), _c(end).cast("string"))


def ranges_to_string(ranges: DataFrame, by: list[str] | None = None) -> DataFrame:
    """S07 render: ``topic:partition:start:end`` joined by ',' in partition order."""
    by = by or []
    item = F.struct(F.col("topic"), F.col("partition"),
                    range_text("topic", "partition", "start", "end").alias("t"))
    return ranges.groupBy(*by).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(item)), lambda x: x["t"]), ",").alias("ranges"))


def string_to_ranges(df: DataFrame, col: str = "ranges") -> DataFrame:
    """S07 parse: one row per range; a range without end keeps ``end`` null."""
    parts = F.split(F.col("_r"), ":")
    return (df.withColumn("_r", F.explode(F.split(F.col(col), ",")))
              .withColumn("topic", parts[0])
              .withColumn("partition", parts[1].cast("int"))
              .withColumn("start", parts[2].cast("long"))
              .withColumn("end", F.when(F.size(parts) > 3, parts[3]).cast("long"))
              .drop("_r"))


# -------------------------------------------------------------- S08/S09 ----

def control_record(ranges: DataFrame, by: list[str] | None = None, *, deployment_id: Column | str | int,
                   input_format: str = "RAW", input_config: Column | dict | None = None,
                   description: str = "", validation_rate: float = 0.0, test_rate: float = 0.0,
                   incremental: bool = False, unsupervised: DataFrame | None = None,
                   dataset_restrictions: str | None = None, federated_string_id: str | None = None,
                   label_weights: Column | None = None, streaming_data_chunks: int | None = None,
                   timestamp: Column | None = None) -> DataFrame:
    """S08 (batch) / S09 (online) control record, one row per ``by`` group.

    Every partition that received data gets its own range (the reference
    only describes the first record's partition).  In online mode
    ``total_msg`` is only set when an unsupervised topic exists.
    """
    by = by or []
    agg = ranges.groupBy(*by).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(
            "topic", "partition", range_text("topic", "partition", "start", "end").alias("t")))),
            lambda x: x["t"]), ",").alias("topic"),
        F.sum(F.col("end") - F.col("start")).cast("long").alias("total_msg"),
        *( [F.max(timestamp).alias("timestamp")] if timestamp is not None else []))
    if unsupervised is not None:
        keys = by or ["_g"]
        if not by:  # one group on both sides: an equi-join on a constant key
            agg, unsupervised = agg.withColumn("_g", F.lit(0)), unsupervised.withColumn("_g", F.lit(0))
        u = ranges_to_string(unsupervised, keys).withColumnRenamed("ranges", "unsupervised_topic")
        agg = agg.join(u, keys, "left").drop("_g")
    else:
        agg = agg.withColumn("unsupervised_topic", F.lit(None).cast("string"))
    if isinstance(input_config, dict):
        cfg = F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in input_config.items()]))
    elif input_config is None:
        cfg = F.lit(None).cast("string")
    else:
        cfg = input_config
    total = F.col("total_msg")
    if incremental:
        total = F.when(F.col("unsupervised_topic").isNotNull(), total)
    dep = F.lit(deployment_id) if isinstance(deployment_id, int) else _c(deployment_id)
    out = agg.select(
        *by,
        dep.cast("long").alias("deployment_id"),
        "topic", "unsupervised_topic",
        F.lit(input_format).alias("input_format"),
        F.lit(description).alias("description"),
        F.lit(dataset_restrictions).cast("string").alias("dataset_restrictions"),
        cfg.alias("input_config"),
        F.lit(float(validation_rate)).alias("validation_rate"),
        F.lit(float(test_rate)).alias("test_rate"),
        total.alias("total_msg"),
        F.lit(bool(incremental)).alias("incremental"),
        F.lit(federated_string_id).cast("string").alias("federated_string_id"),
        (label_weights if label_weights is not None else F.lit(None).cast("map<int,double>")).alias("label_weights"),
        F.lit(streaming_data_chunks).cast("int").alias("streaming_data_chunks"),
        *(["timestamp"] if timestamp is not None else []),
    )
    return out


def publish_federated(df: DataFrame, topic: str, device: Column | str, data: str, label: str, order: str, *, deployment_id: int,
                      data_type: str, label_type: str, federated_prefix: str = "fed", restrictions: str = "{}",
                      chunks: int | None = None, weights: bool = True) -> tuple[DataFrame, DataFrame]:
    """(records, control rows) of a federated data set: a topic partition and a control row for each
    device, with its restrictions, federated id (prefix and device), class weights and number of chunks."""
    from kelpie.functions.codecs import encode_raw_col
    from kelpie.operators.metrics import class_weights
    src = df.withColumn("_device", _c(device).cast("int"))
    log = append_topic(src, topic, key=encode_raw_col(label, label_type), value=encode_raw_col(data, data_type),
                       partition=F.col("_device"), order=order)
    ranges = topic_ranges(log).withColumn("device", F.col("partition"))
    control = control_record(ranges, by=["device"], deployment_id=deployment_id, dataset_restrictions=restrictions,
                             input_config={"data_type": data_type, "label_type": label_type, "data_reshape": "", "label_reshape": ""},
                             streaming_data_chunks=chunks) \
        .withColumn("federated_string_id", F.concat(F.lit(federated_prefix), F.col("device").cast("string")))
    if weights:     # a map a device: as many entries as classes
        w = class_weights(src, label, by="_device").groupBy(F.col("_device").alias("device")).agg(
            F.map_from_entries(F.collect_list(F.struct(F.col(label).cast("int").alias("k"), F.col("weight")))).alias("label_weights"))
        control = control.drop("label_weights").join(w, "device", "left")
    return log, control


def weights_control(log: DataFrame, by: str, *, version: Column, settings: dict | None = None, metrics: Column | None = None,
                    num_data: Column | None = None) -> DataFrame:
    """The control row of each published model (column ``by`` of ``log``): the range of its layers, its version,
    the training settings and, from a device, its metrics and number of rows."""
    per = log.groupBy(by, "topic", "partition").agg(F.min("offset").alias("start"), (F.max("offset") + 1).alias("end"),
                                                    F.max(version).alias("version"))
    out = per.groupBy(by).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(
        "topic", "partition", range_text("topic", "partition", "start", "end").alias("t")))), lambda x: x["t"]), ",").alias("topic"),
        F.max("version").cast("int").alias("version"), F.sum(F.col("end") - F.col("start")).cast("long").alias("layers"))
    text = F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in (settings or {}).items()])) if settings else F.lit("{}")
    return out.select(by, "topic", "version", "layers", text.alias("training_settings"),
                      (F.lit(None).cast("string") if metrics is None else metrics).alias("metrics"),
                      (F.lit(None) if num_data is None else num_data).cast("long").alias("num_data"))


KEY_WIDTH = 8   # bytes of a deployment id: every long that is not negative fits


def control_key_error(deployment_id: Column | str = "deployment_id", key_width: int = KEY_WIDTH) -> Column:
    """Why a control row can't be keyed (null if it can)."""
    dep = _c(deployment_id)
    return F.when(dep.isNull(), F.lit("no deployment id")) \
        .when(dep < 0, F.lit("negative deployment id")).otherwise(key_bytes_error(dep, "int", width=key_width))


def control_dead_letters(control: DataFrame, key_width: int = KEY_WIDTH) -> DataFrame:
    """The control rows that :func:`control_to_log` can't key, with ``key_error``."""
    return control.withColumn("key_error", control_key_error(key_width=key_width)).where("key_error IS NOT NULL")


def control_to_log(control: DataFrame, key_width: int = KEY_WIDTH) -> DataFrame:
    """Control rows -> (key, value, timestamp) records: key = deployment id bytes
    (big-endian), value = JSON.  Rows whose id has no key of that width are no
    records; :func:`control_dead_letters` has them."""
    body = [c for c in control.columns if c not in ("deployment_id", "timestamp")]
    ts = F.col("timestamp") if "timestamp" in control.columns else F.current_timestamp()
    return control.where(control_key_error(key_width=key_width).isNull()).select(
        key_bytes("deployment_id", "int", width=key_width).alias("key"),
        F.encode(F.to_json(F.struct(*body)), "UTF-8").alias("value"), ts.alias("timestamp"))


# Field names and types on the wire.
CONTROL_JSON_SCHEMA = (
    "topic string, unsupervised_topic string, input_format string, description string, "
    "dataset_restrictions string, input_config string, validation_rate double, test_rate double, "
    "total_msg long, incremental boolean, federated_string_id string, label_weights map<string,double>, "
    "streaming_data_chunks int")


# ------------------------------------------------------------------ S12 ----

def read_range(log: DataFrame, topic: str, partition: int, start: int, end: int | None = None) -> DataFrame:
    """Bounded scan ``start <= offset < end`` (``end`` None = to the end)."""
    cond = (F.col("topic") == topic) & (F.col("partition") == partition) & (F.col("offset") >= start)
    if end is not None:
        cond = cond & (F.col("offset") < end)
    return log.where(cond)


# ------------------------------------------------------------------ J14 ----

def control_records(ranges: DataFrame, log: DataFrame, bucket: int = DEFAULT_BLOCK) -> DataFrame:
    """Every range row picks its records ``start <= offset < end``.

    Range join as a bucketed equi-join: each range is exploded into the
    offset buckets it covers (rows ~ range length / bucket), each log row
    has exactly one bucket, so no (topic, partition) lands in one task.

    A log read from a table laid out by offset (:func:`write_topic` with the same ``bucket``) is joined on
    its folders.  While the exploded ranges are few (at most ``RANGES`` rows, counted), they are
    broadcast, and Spark prunes the log's folders by them at run time: bytes read follow the
    announced ranges, not the topic.  Beyond that the join shuffles as for any log.
    """
    laid_out = BUCKET in log.columns
    out = [c for c in log.columns if c != BUCKET]
    r = ranges.where(F.col("end") > F.col("start")).withColumn("_b", F.explode(F.sequence(
        F.floor(F.col("start") / bucket).cast("long"),
        F.floor((F.col("end") - 1) / bucket).cast("long"))))
    l = log.withColumnRenamed(BUCKET, "_b") if laid_out else log.withColumn("_b", F.floor(F.col("offset") / bucket).cast("long"))
    rcols = [c for c in ranges.columns if c not in ("topic", "partition")]
    r = r.select("topic", "partition", "_b", *[F.col(c).alias(f"_rng_{c}") for c in rcols])
    if laid_out and r.count() <= RANGES:
        r = F.broadcast(r)
    j = l.join(r, ["topic", "partition", "_b"]).where(
        (F.col("offset") >= F.col("_rng_start")) & (F.col("offset") < F.col("_rng_end")))
    return j.select(*out, *[F.col(f"_rng_{c}").alias(c) for c in rcols if c not in ("start", "end")])


def _announced(ranges: DataFrame, bucket: int) -> DataFrame:
    """(topic, partition, _b): the offset buckets that ranges cover, each once.  Overlapping ranges are merged
    before they are spread over buckets, so their number does not multiply the buckets."""
    r = ranges.select("topic", "partition", F.floor(F.col("start") / bucket).cast("long").alias("_lo"),
                      F.floor((F.col("end") - 1) / bucket).cast("long").alias("_hi")) \
        .groupBy("topic", "partition", "_lo").agg(F.max("_hi").alias("_hi"))
    before = Window.partitionBy("topic", "partition").orderBy("_lo").rowsBetween(Window.unboundedPreceding, -1)
    return r.withColumn("_lo", F.greatest(F.col("_lo"), F.max("_hi").over(before) + 1)).where("_lo <= _hi") \
        .select("topic", "partition", F.explode(F.sequence("_lo", "_hi")).alias("_b"))


def control_counts(ranges: DataFrame, log: DataFrame, bucket: int = DEFAULT_BLOCK) -> DataFrame:
    """J14 where a range's number of records is asked: one row a range that has records, with ``n``, without
    the pairs of :func:`control_records`.

    Every announced record is read once, however many ranges hold it: a range's number is the
    difference of two running counts, of the records before its end and before its start.  The
    folders of a log laid out by offset are pruned as there."""
    r = ranges.where(F.col("end") > F.col("start"))
    l = log.withColumnRenamed(BUCKET, "_b") if BUCKET in log.columns else \
        log.withColumn("_b", F.floor(F.col("offset") / bucket).cast("long"))
    folders = _announced(r, bucket)
    if BUCKET in log.columns:
        folders = cut_lineage(folders)
        if folders.count() <= RANGES:
            folders = F.broadcast(folders)
    key = ["topic", "partition", "offset"]
    held = l.join(folders, ["topic", "partition", "_b"]).select(*key, F.lit(1).alias("_n"), F.lit(False).alias("_asked"))
    asked = r.select("topic", "partition", F.explode(F.array("start", "end")).alias("offset"), F.lit(0).alias("_n"),
                     F.lit(True).alias("_asked"))
    cells = held.unionByName(asked).groupBy(*key).agg(F.sum("_n").alias("_n"), F.max("_asked").alias("_asked"))
    upto = running_sum(cells, ["topic", "partition"], "offset", "_n", "_upto", block=bucket).where("_asked") \
        .select(*key, (F.col("_upto") - F.col("_n")).alias("_before"))
    out = r
    for at in ("start", "end"):
        out = out.join(upto.select("topic", "partition", F.col("offset").alias(at), F.col("_before").alias(f"_{at}")),
                       ["topic", "partition", at])
    return out.select(*ranges.columns, (F.col("_end") - F.col("_start")).alias("n")).where("n > 0")


# ------------------------------------------------------------------ S14 ----

def datasources_from_log(control_log: DataFrame) -> DataFrame:
    """Control log -> datasource rows (deployment from big-endian key, UTC ISO time)."""
    body = F.from_json(F.col("value").cast("string"), CONTROL_JSON_SCHEMA)
    return control_log.select(
        key_to_int("key").alias("deployment_id"),
        body.alias("b"),
        F.date_format(F.col("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias("time"),
    ).select("deployment_id", "b.*", "time").withColumn(
        "label_weights", F.transform_keys("label_weights", lambda k, v: k.cast("int")))


def replay(datasources: DataFrame, src_deployment: Column, deployment_id: Column) -> DataFrame:
    """Re-announce an earlier datasource to another deployment (no data resent).

    ``src_deployment``/``deployment_id`` are columns so a whole table of
    replay requests can be applied with one join upstream.
    """
    return datasources.where(F.col("deployment_id") == src_deployment) \
        .withColumn("deployment_id", deployment_id).drop("time")


# ------------------------------------------------------------------ S17 ----

def inspect(log: DataFrame, n: int, from_beginning: bool = True) -> DataFrame:
    """First (or last) ``n`` records of a topic with readable key/value views."""
    order = [F.col("offset").asc(), F.col("partition").asc()] if from_beginning else \
        [F.col("offset").desc(), F.col("partition").desc()]
    top = log.orderBy(*order).limit(n)  # the limit is the feature (TakeOrderedAndProject)
    ktxt = F.col("key").cast("string")
    vtxt = F.col("value").cast("string")
    return top.select(
        "topic", "partition", "offset",
        F.conv(F.hex("key"), 16, 10).cast("decimal(38,0)").alias("key_int"),
        F.when(F.is_valid_utf8(ktxt), ktxt).alias("key_text"),
        F.hex("key").alias("key_hex"),
        F.when(F.is_valid_utf8(vtxt) & F.try_parse_json(vtxt).isNotNull(), F.lit("json"))
         .when(F.is_valid_utf8(vtxt), F.lit("text")).otherwise(F.lit("bytes")).alias("value_kind"),
        F.when(F.is_valid_utf8(vtxt), vtxt).alias("value_text"),
        F.length("value").alias("value_bytes"),
    )


# ------------------------------------------------------------------ S15 ----

# Field names and types on the wire.
FED_DATASOURCE_SCHEMA = (
    "topic string, unsupervised_topic string, input_format string, input_config string, incremental boolean, "
    "federated_string_id string, total_msg long, validation_rate double, test_rate double, description string, "
    "dataset_restrictions string, label_weights string, streaming_data_chunks int, timestamp timestamp")

# Field names and types on the wire.
MODEL_SOURCE_SCHEMA = (
    "model_format struct<input_shape: string, output_shape: string>, "
    "federated_params struct<federated_string_id: string, data_restriction: string, min_data: long>, "
    "framework string, distributed boolean, incremental boolean, blockchain string")


def fed_datasources(log: DataFrame) -> DataFrame:
    """Federated data log -> datasource rows; a missing timestamp becomes now."""
    b = F.from_json(F.col("value").cast("string"), FED_DATASOURCE_SCHEMA)
    return log.select(b.alias("b")).select("b.*").withColumn(
        "timestamp", F.coalesce(F.col("timestamp"), F.current_timestamp()))


def model_sources(log: DataFrame) -> DataFrame:
    """Model log -> model-source rows (nested JSON flattened; blockchain defaults to {})."""
    b = F.from_json(F.col("value").cast("string"), MODEL_SOURCE_SCHEMA)
    return log.select(b.alias("b")).select(
        F.col("b.model_format.input_shape").alias("input_shape"),
        F.col("b.model_format.output_shape").alias("output_shape"),
        F.col("b.federated_params.federated_string_id").alias("federated_string_id"),
        F.col("b.federated_params.data_restriction").alias("data_restriction"),
        F.col("b.federated_params.min_data").alias("min_data"),
        F.col("b.framework").alias("framework"), F.col("b.distributed").alias("distributed"),
        F.col("b.incremental").alias("incremental"),
        F.coalesce(F.col("b.blockchain"), F.lit("{}")).alias("blockchain"))
