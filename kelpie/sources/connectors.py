"""Optional connectors: Kafka topics and Spark's Avro functions.

Both need packages that are not on every classpath (``spark-sql-kafka`` and
``spark-avro``).  When present, topics are read and written with Spark's
Kafka source/sink (same columns as the Parquet topic tables) and Avro payloads
use ``to_avro``/``from_avro``; when absent the Parquet topic tables and the
Arrow codecs in :mod:`kelpie.functions.codecs` do the same work.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_PROBES: dict[str, bool] = {}


def avro_available(spark: SparkSession) -> bool:
    """True when ``to_avro`` resolves (the spark-avro package is loaded)."""
    if "avro" not in _PROBES:
        try:
            from pyspark.sql.avro.functions import to_avro
            spark.range(1).select(to_avro(F.struct(F.lit(1.0).alias("a")))).collect()
            _PROBES["avro"] = True
        except Exception:  # noqa: BLE001  (package missing)
            _PROBES["avro"] = False
    return _PROBES["avro"]


def encode_avro_col(spark: SparkSession, cols: list[str], schema: str) -> Column:
    """S05 with the built-in writer when available, else the Arrow encoder."""
    from kelpie.functions import codecs
    if avro_available(spark):
        from pyspark.sql.avro.functions import to_avro
        fields = codecs.parse_avro_schema(schema)
        return to_avro(F.struct(*[F.col(c).alias(n) for c, (n, _) in zip(cols, fields)]),
                       schema.replace("'", '"'))
    return codecs.encode_avro_col(cols, schema)


def decode_avro_col(spark: SparkSession, col: str, schema: str) -> Column:
    """P03 with the built-in reader when available: fields in schema order as ARRAY<DOUBLE>."""
    from kelpie.functions import codecs
    if avro_available(spark):
        from pyspark.sql.avro.functions import from_avro
        fields = codecs.parse_avro_schema(schema)
        rec = from_avro(F.col(col), schema.replace("'", '"'))
        return F.array(*[rec[n].cast("double") for n, _ in fields])
    return codecs.decode_avro_col(col, schema)


def offsets_json(topic: str, offsets: dict[int, int]) -> str:
    """Kafka ``startingOffsets``/``endingOffsets`` JSON for one topic."""
    return json.dumps({topic: {str(p): int(o) for p, o in offsets.items()}})


def read_kafka(spark: SparkSession, bootstrap: str, topic: str, starting: dict[int, int] | None = None,
               ending: dict[int, int] | None = None) -> DataFrame:
    """S12 on Kafka: bounded batch read of ``start <= offset < end`` per partition
    (the end offsets are exclusive, as in the ranges of the control records)."""
    r = (spark.read.format("kafka").option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic).option("includeHeaders", "true"))
    r = r.option("startingOffsets", offsets_json(topic, starting) if starting else "earliest")
    r = r.option("endingOffsets", offsets_json(topic, ending) if ending else "latest")
    return r.load().select("topic", "partition", "offset", "timestamp", "key", "value", "headers")


def stream_kafka(spark: SparkSession, bootstrap: str, topic: str, starting: str = "earliest",
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """S13 / R02 on Kafka: a checkpointed consumer starts at ``earliest`` once and
    then resumes from its checkpoint; parallelism = topic partitions."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", topic).option("startingOffsets", starting).option("includeHeaders", "true"))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load().select("topic", "partition", "offset", "timestamp", "key", "value", "headers")


def write_kafka(df: DataFrame, bootstrap: str, topic: str | None = None) -> None:
    """S01 / S21 on Kafka: key, value and headers to the topic (``topic`` column otherwise)."""
    cols = ["key", "value"] + (["headers"] if "headers" in df.columns else []) + \
        (["topic"] if topic is None else [])
    w = df.select(*cols).write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
    if topic is not None:
        w = w.option("topic", topic)
    w.save()
