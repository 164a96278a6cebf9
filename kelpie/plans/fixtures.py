"""Fixture mapping: the driver tables re-read as the inputs of each operator.

``events``     -> topic log (offset order = event_id, partition = user_id % 4,
                  key = event_type, value = props JSON), metric history, class stream
``embeddings`` -> image-like labelled samples (64 floats, 10 classes) and weight rows
``labels``     -> truth / prediction pairs, class balance
``documents``  -> unlabelled pool (no row in labels)
``orders`` / ``lineitem`` / ``part`` / ``customer`` -> registry, ledger and device tables
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpie.functions.codecs import encode_raw_col
from kelpie.session import read_table
from kelpie.sources.topics import append_topic

N_EVENT_PARTITIONS = 4
N_EMB_PARTITIONS = 4


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def sample_id_header(col: str, **more: str) -> F.Column:
    items = [("sample_id", col), *more.items()]
    return F.array(*[F.struct(F.lit(k).alias("key"), F.encode(F.col(c).cast("string"), "UTF-8").alias("value"))
                     for k, c in items])


def header_value(name: str) -> F.Column:
    return F.filter("headers", lambda h: h["key"] == name)[0]["value"].cast("string")


def events_log(spark: SparkSession, sf_dir: str, dense: bool = True) -> DataFrame:
    """``events`` as a topic table.  ``dense`` renumbers offsets 0.. per partition
    (what the broker would assign); otherwise offset = event_id."""
    ev = t(spark, sf_dir, "events")
    part = F.pmod(F.col("user_id"), F.lit(N_EVENT_PARTITIONS)).cast("int")
    if dense:
        return append_topic(ev, "events", key=F.encode("event_type", "UTF-8"), value=F.encode("props", "UTF-8"),
                            partition=part, order="event_id", timestamp="ts",
                            headers=sample_id_header("event_id", user_id="user_id"))
    return ev.select(F.lit("events").alias("topic"), part.alias("partition"), F.col("event_id").alias("offset"),
                     F.col("ts").alias("timestamp"), F.encode("event_type", "UTF-8").alias("key"),
                     F.encode("props", "UTF-8").alias("value"),
                     sample_id_header("event_id", user_id="user_id").alias("headers"))


def published_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events topic written once to the shared folder (``topic/partition``
    folders) and read back: later reads prune partitions and push offsets."""
    import uuid

    from kelpie.session import scratch_path
    from kelpie.sources.topics import read_topic, write_topic
    path = scratch_path(spark, f"topics/events-{uuid.uuid4().hex}")
    write_topic(events_log(spark, sf_dir), path)
    return read_topic(spark, path)


def embeddings_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` published as RAW records (S03 + S01): value = float32 bytes of
    the 64-vector, key = int32 bytes of the label, header sample_id = vec_id."""
    em = t(spark, sf_dir, "embeddings")
    return append_topic(
        em, "embeddings",
        key=encode_raw_col(F.col("label"), "int32"),
        value=encode_raw_col(F.col("embedding"), "float32"),
        partition=F.pmod(F.col("vec_id"), F.lit(N_EMB_PARTITIONS)), order="vec_id",
        timestamp=F.timestamp_seconds(F.col("vec_id")), headers=sample_id_header("vec_id"))
