"""Plan checks: range reads prune topic partitions and push the offset
predicate into the Parquet scan; projections prune columns."""

import tempfile

from kelpie.plans.fixtures import events_log
from kelpie.sources.topics import read_range, read_topic, write_topic


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_range_read_prunes_and_pushes(spark, sf):
    path = tempfile.mkdtemp(prefix="kelpie-topic-") + "/events"
    write_topic(events_log(spark, sf), path)
    r = read_range(read_topic(spark, path), "events", 2, 10, 30).select("offset")
    p = _plan(r)
    assert "PartitionFilters: [isnotnull(topic" in p and "(partition#" in p
    assert "PushedFilters: [IsNotNull(offset), GreaterThanOrEqual(offset,10), LessThan(offset,30)]" in p
    assert "ReadSchema: struct<offset:bigint>" in p
    assert r.count() == 20


def test_projection_prunes_columns(spark, sf):
    from kelpie.operators.metrics import feature_ranges
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    p = _plan(feature_ranges(li, ["l_tax"]))
    assert "ReadSchema: struct<l_tax:double>" in p
