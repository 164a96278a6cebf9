"""Streaming behaviour that the query catalogue cannot show: idle stop
and at-least-once replay made idempotent (R02)."""

import tempfile
import time

from pyspark.sql import functions as F

from kelpie.streaming import streams as ST


def test_idle_stop_ends_the_query(spark):
    src = tempfile.mkdtemp(prefix="kelpie-src-")
    spark.range(0, 50).withColumn("v", F.col("id") * 2).write.mode("append").parquet(src)
    stream = spark.readStream.schema("id long, v long").parquet(src)
    seen = []
    q = ST.foreach_microbatch(stream, lambda b, i: seen.append(b.count()), tempfile.mkdtemp(prefix="kelpie-ck-"),
                              available_now=False, processing_time="200 milliseconds")
    t0 = time.time()
    ST.run_until_idle(q, idle_ms=1500, poll_s=0.2)
    assert not q.isActive
    assert sum(seen) == 50
    assert time.time() - t0 < 60


def test_replayed_batch_is_idempotent(spark):
    out = tempfile.mkdtemp(prefix="kelpie-out-") + "/t"
    b = spark.range(0, 10)
    ST.idempotent_append(b, 3, out)
    ST.idempotent_append(b, 3, out)      # the same micro-batch delivered twice
    ST.idempotent_append(spark.range(10, 15), 4, out)
    assert spark.read.parquet(out).count() == 15
