"""Range reads from topic tables laid out by offset."""

import uuid

from pyspark.sql import functions as F

from kelpie.session import scratch_path
from kelpie.sources import topics as TP

BUCKET = 100


def topic(spark, bucket=BUCKET):
    path = scratch_path(spark, f"pruned-{uuid.uuid4().hex}")
    rows = spark.range(8000).select(
        F.lit("t").alias("topic"), (F.col("id") % 4).cast("int").alias("partition"), F.expr("id div 4").alias("offset"),
        F.timestamp_seconds("id").alias("timestamp"), F.lit(None).cast("binary").alias("key"),
        F.col("id").cast("string").cast("binary").alias("value"), F.lit(None).cast(TP.TOPIC_SCHEMA["headers"].dataType).alias("headers"))
    TP.write_topic(rows, path, bucket=bucket)
    return path, TP.read_topic(spark, path, bucketed=True)


def ranges(spark, rows):
    return spark.createDataFrame(rows, "topic string, partition int, start long, end long, who string")


def files_read(df):
    """Files that the scan of the log has opened."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaf.metrics().get("numFiles").get().value() for leaf in (leaves.apply(i) for i in range(leaves.size()))
               if leaf.metrics().contains("numFiles"))


def test_reads_follow_the_announced_ranges(spark):
    path, log = topic(spark)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        asked = [("t", 1, 150, 260, "a"), ("t", 3, 1990, 2000, "b"), ("t", 2, 5, 5, "empty"), ("other", 0, 0, 50, "c")]
        rec = TP.control_records(ranges(spark, asked), log, BUCKET)
        plan = rec._jdf.queryExecution().executedPlan().toString()
        assert "dynamicpruning" in plan.lower()
        got = sorted((r["who"], r["partition"], r["offset"], bytes(r["value"])) for r in rec.collect())
        few = files_read(rec)
        whole = TP.control_records(ranges(spark, [("t", p, 0, 2000, "all") for p in range(4)]), log, BUCKET)
        assert whole.count() == 8000
        whole.collect()
        many = files_read(whole)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    want = [("a", 1, o, str(4 * o + 1).encode()) for o in range(150, 260)] + [("b", 3, o, str(4 * o + 3).encode()) for o in range(1990, 2000)]
    assert got == sorted(want)
    assert set(rec.columns) == {*TP.TOPIC_SCHEMA.fieldNames(), "who"}
    # of the 80 folders of 100 offsets: those of the partitions and buckets that are named
    assert few <= 3 * 4 and many >= 80


def test_the_same_records_as_from_a_plain_log(spark, monkeypatch):
    path, log = topic(spark)
    plain = log.drop(TP.BUCKET)
    asked = ranges(spark, [("t", p, s, s + 333, f"{p}/{s}") for p in range(4) for s in range(0, 1900, 170)])
    want = sorted(map(str, TP.control_records(asked, plain, 64).select("who", "partition", "offset").collect()))
    for most in (100_000, 0):       # broadcast, and by a shuffle
        monkeypatch.setattr(TP, "RANGES", most)
        assert sorted(map(str, TP.control_records(asked, log, BUCKET).select("who", "partition", "offset").collect())) == want


def test_no_ranges(spark):
    path, log = topic(spark)
    assert TP.control_records(ranges(spark, []), log, BUCKET).count() == 0
