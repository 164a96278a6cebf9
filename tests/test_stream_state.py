"""Stateful stream operators: equal to plain folds over several micro-batches and restarts, with small state."""

import uuid

import pytest
from pyspark.sql import functions as F

from kelpie.operators.registry import first_launch_by_id, match
from kelpie.session import scratch_path
from kelpie.streaming import processors as P


class Source:
    """A folder that grows file by file: a file is a micro-batch."""

    def __init__(self, spark, schema):
        self.spark, self.schema = spark, schema
        self.path, self.out, self.ck = (scratch_path(spark, f"test-{k}-{uuid.uuid4().hex}") for k in ("in", "out", "ck"))

    def add(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(self.path)


def rows_of(spark, source, *columns):
    return sorted(tuple(r) for r in spark.read.parquet(source.out).select(*columns).collect())


def test_gate_holds_a_round_back_over_batches_and_restarts(spark):
    s = Source(spark, "fed string, o long")
    order = [("hot", i) for i in range(3000)] + [("b", 1), ("b", 2)]
    s.add([r for r in order if r[1] % 2 == 0 and r[1] < 1501][::-1])
    P.run_to_table(P.round_gate(s.stream(), "fed", "o", 7), s.out, s.ck)
    first = [o for _, o in order[:3000] if o % 2 == 0 and o < 1501]
    s.add([("hot", 5001), ("b", 3)])
    s.add([("hot", i) for i in range(6000, 9000)][::-1] + [("b", i) for i in range(4, 9)] + [(None, 1), ("b", None)])
    q = P.run_to_table(P.round_gate(s.stream(), "fed", "o", 7), s.out, s.ck)
    hot = first + [5001, *range(6000, 9000)]
    b = [2, 3, 4, 5, 6, 7, 8]
    want = [("hot", o, i // 7) for i, o in enumerate(hot[:len(hot) // 7 * 7])] + [("b", o, 0) for o in b]
    assert [r for r in rows_of(spark, s, "federation", "update_id", "round") if r[0] is not None] == sorted(want)
    # a value a key, and at most six waiting updates
    state = q.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] <= 3 * 7
    assert "rocksdbCommitFlushLatencyMs" in str(state["customMetrics"]) or "rocksdb" in str(state["customMetrics"]).lower()


def test_gate_of_single_updates(spark):
    s = Source(spark, "fed string, o long")
    s.add([("a", 3), ("a", 1)])
    s.add([("a", 2)])
    P.run_to_table(P.round_gate(s.stream(), "fed", "o", -1), s.out, s.ck)
    assert [(r[0], r[2]) for r in sorted(rows_of(spark, s, "federation", "update_id", "round"), key=lambda r: r[2])] == \
        [("a", 0), ("a", 1), ("a", 2)]


def test_newest_version_survives_a_restart(spark):
    s = Source(spark, "k long, version long, what string")
    s.add([(1, v, f"v{v}") for v in range(50)] + [(2, 9, "old")])
    P.run_to_table(P.newest_rows(s.stream(), "k", "version"), s.out, s.ck)
    s.add([(1, 20, "stale"), (2, 10, "new"), (3, 1, "first"), (3, None, "none")])
    s.add([(1, 49, "again"), (2, 10, "again")])
    P.run_to_table(P.newest_rows(s.stream(), "k", "version"), s.out, s.ck)
    assert rows_of(spark, s, "k", "version", "what") == [(1, 49, "v49"), (2, 9, "old"), (2, 10, "new"), (3, 1, "first")]


def test_series_are_numbered_per_partition_and_dimension(spark):
    s = Source(spark, "p string, o long, v array<float>")
    s.add([("p0", i, [float(i), -1.0]) for i in (3, 1, 2)] + [("p1", 1, [5.0])])
    s.add([("p0", 9, [9.0, 9.5, 9.75]), ("p1", 4, None), ("p1", 7, [])])
    P.run_to_table(P.numbered_series(s.stream(), "p", "o", "v"), s.out, s.ck)
    assert rows_of(spark, s, "key", "i", "point", "order", "value") == sorted(
        [("p0", 0, n, o, float(o)) for n, o in enumerate((1, 2, 3, 9))] + [("p0", 1, n, o, v) for n, (o, v) in enumerate(
            ((1, -1.0), (2, -1.0), (3, -1.0), (9, 9.5)))] + [("p0", 2, 0, 9, 9.75), ("p1", 0, 0, 1, 5.0)])


DS = "ds_id long, data_reshape string, restrictions string, total_msg long, incremental boolean, federated_string_id string, at timestamp"
MODEL = ("model_id long, input_shape string, data_restriction string, min_data long, distributed boolean, blockchain string, "
         "federated_string_id string, at timestamp")


def ds_rows(n, day=0, start=0):
    from datetime import datetime, timedelta
    return [(start + i, ("64", "28 28", "5")[i % 3], '{"b": 1, "a": %d}' % (i % 2), 100 * i, i % 4 == 1,
             f"f{i % 5}" if i % 6 == 0 else None, datetime(2024, 1, 1) + timedelta(days=day)) for i in range(n)]


def model_rows(n, day=0, start=0):
    from datetime import datetime, timedelta
    return [(start + i, ("64", "28 28", "5 6 7")[i % 3], '{"a": %d, "b": 1}' % (i % 2), 300, i % 3 == 2, "{}",
             f"f{i % 5}" if i % 4 == 0 else None, datetime(2024, 1, 1) + timedelta(days=day)) for i in range(n)]


def test_models_meet_stored_and_later_data_sources(spark):
    d, m = Source(spark, DS), Source(spark, MODEL)
    for k in range(2):
        d.add(ds_rows(20, start=100 * k))
        m.add(model_rows(12, start=100 * k))
        P.run_to_table(P.match_stream(d.stream(), m.stream()), d.out, d.ck)
    want = match(spark.read.parquet(d.path), spark.read.parquet(m.path))
    columns = ["ds_id", "model_id", "case", "by_federated_id"]
    got = rows_of(spark, d, *columns)
    assert got == sorted(tuple(r) for r in want.select(*columns).collect())
    assert any(r[0] < 100 <= r[1] for r in got) and any(r[1] < 100 <= r[0] for r in got)


def test_watermarks_let_old_rows_leave_the_state(spark):
    """With an interval only near pairs match, and state stays within it however long the streams run."""
    d, m = Source(spark, DS), Source(spark, MODEL)
    days, each = 8, 12
    for k in range(days):
        d.add(ds_rows(each, day=10 * k, start=100 * k))
        m.add(model_rows(each, day=10 * k, start=100 * k))
    q = P.run_to_table(P.match_stream(d.stream(), m.stream(), "at", "at", "5 days"), d.out, d.ck)
    near = match(spark.read.parquet(d.path), spark.read.parquet(m.path)).where("floor(ds_id / 100) = floor(model_id / 100)")
    assert rows_of(spark, d, "ds_id", "model_id", "case") == sorted(tuple(r) for r in near.select("ds_id", "model_id", "case").collect())
    kept = sum(s["numRowsTotal"] for s in q.lastProgress["stateOperators"])
    whole = P.run_to_table(P.match_stream(d.stream(), m.stream()), d.out + "-all", d.ck + "-all")
    everything = sum(s["numRowsTotal"] for s in whole.lastProgress["stateOperators"])
    assert everything >= days * each and kept <= everything // 2


def test_one_launch_per_id(spark):
    d = Source(spark, DS)
    models = spark.createDataFrame(model_rows(30) + [(999, "5", "{}", 1, False, "{}", "unseen", None)], MODEL)
    for k in range(3):
        d.add(ds_rows(40, start=100 * k)[::-1] + [(100 * k + 77, "5", "{}", 1, False, "", None), (100 * k + 78, "5", "{}", 1, False, "alone", None)])
        P.run_to_table(P.first_launch_stream(d.stream(), models), d.out, d.ck)
    want = first_launch_by_id(spark.read.parquet(d.path), models)
    got = rows_of(spark, d, "fed", "ds_id", "model_id")
    assert got == sorted(tuple(r) for r in want.collect()) and len(got) == 5
    pairs = match(spark.read.parquet(d.path), models).where("by_federated_id")
    pairs = pairs.join(spark.read.parquet(d.path).select("ds_id", F.col("federated_string_id").alias("fed")), "ds_id")
    assert got == sorted(tuple(r) for r in pairs.groupBy("fed").agg(F.min("ds_id"), F.min("model_id")).collect())


def test_match_counts_without_the_pairs(spark):
    from kelpie.operators.registry import match_counts
    ds = spark.createDataFrame(ds_rows(200) + [(5000 + i, "64", '{"a": 0, "b": 1}', 250 + i % 3, False, None, None) for i in range(300)]
                               + [(6000, "64", '{"a": 0, "b": 1}', None, False, "", None), (6001, "64", '{"a": 0, "b": 1}', None, True, None, None)], DS)
    models = spark.createDataFrame(model_rows(100) + [(7000 + i, "64", '{"b": 1, "a": 0}', (250, 251, None)[i % 3], False, "{}", None, None)
                                                      for i in range(300)] + [(8000, "5 6 7", '{"a": 0, "b": 1}', 1, True, '{"x": 1}', None, None)], MODEL)
    want = match(ds, models).groupBy("ds_id", "case").count()
    assert sorted(map(tuple, match_counts(ds, models).collect())) == sorted(map(tuple, want.collect()))
    assert match_counts(ds.limit(0), models).count() == 0 and match_counts(ds, models.limit(0)).count() == 0
