"""Publishing: the first-sample control row, federated data sets, weights, server cases."""

import itertools
import uuid

import pytest
from pyspark.sql import functions as F

from kelpie.operators.registry import server_case
from kelpie.session import scratch_path
from kelpie.sources import topics as TP
from kelpie.streaming import streams as ST

SCHEMA = "id long, p int, x array<float>, y int"


class Broken(RuntimeError):
    pass


@pytest.mark.parametrize("crash_at", ["records", "ends", "control", None])
def test_one_control_row_after_a_crash_in_the_first_batch(spark, monkeypatch, crash_at):
    src, path, ck = (scratch_path(spark, f"test-{k}-{uuid.uuid4().hex}") for k in ("in", "topic", "ck"))

    def add(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
        ST.publish_online(stream, "live", "x", "y", path, ck, deployment_id=5, partition="p", order="id")

    add([])                                     # a batch without a sample announces nothing
    add([(i, i % 2, [float(i), 1.0], i % 3) for i in range(10)])
    written = ST.idempotent_append
    if crash_at:
        def once(df, batch_id, where):
            written(df, batch_id, where)
            if where.endswith(crash_at):
                raise Broken(where)
        monkeypatch.setattr(ST, "idempotent_append", once)
        with pytest.raises(Exception):
            run()
        monkeypatch.setattr(ST, "idempotent_append", written)
    run()
    add([(i, i % 2, [float(i), 1.0], i % 3) for i in range(10, 17)])
    run()
    control = spark.read.parquet(f"{path}/control").collect()
    assert len(control) == 1 and control[0]["topic"] == "live:0:0:5,live:1:0:5" and control[0]["incremental"] and control[0]["total_msg"] is None
    assert '"data_type":"float32"' in control[0]["input_config"] and '"data_reshape":"2"' in control[0]["input_config"]
    log = spark.read.parquet(f"{path}/records").select("partition", "offset").collect()
    assert sorted((int(r["partition"]), r["offset"]) for r in log) == [(0, o) for o in range(9)] + [(1, o) for o in range(8)]


def test_server_cases_by_the_table(spark):
    """Distributed, incremental, federated, ledger -> case."""
    table = {(0, 0, 0): 1, (0, 1, 0): 2, (1, 0, 0): 3, (1, 1, 0): 4, (0, 0, 1): 5, (0, 1, 1): 6, (1, 0, 1): 7, (1, 1, 1): 8}
    rows = [tuple(bool(x) for x in r) for r in itertools.product((0, 1), repeat=4)]
    df = spark.createDataFrame(rows, "d boolean, i boolean, f boolean, b boolean")
    for r in df.withColumn("c", server_case(*[F.col(k) for k in "difb"])).collect():
        want = 9 if r["f"] and r["b"] and not r["d"] and not r["i"] else table[int(r["d"]), int(r["i"]), int(r["f"])]
        assert r["c"] == want
    none = spark.range(1).select(server_case(*[F.lit(None).cast("boolean")] * 4).alias("c")).first()
    assert none["c"] == 1


def test_federated_data_sets(spark):
    rows = [(i, i % 2, [float(i)], i % 3) for i in range(30)] + [(99, 5, [1.0], 0)]
    log, control = TP.publish_federated(spark.createDataFrame(rows, SCHEMA), "fed", "p", "x", "y", "id", deployment_id=4,
                                        data_type="float32", label_type="int32", federated_prefix="site", restrictions='{"a": 1}', chunks=3)
    got = {r["device"]: r for r in control.collect()}
    assert set(got) == {0, 1, 5} and got[0]["topic"] == "fed:0:0:15" and got[5]["total_msg"] == 1
    assert got[1]["federated_string_id"] == "site1" and got[1]["streaming_data_chunks"] == 3 and got[1]["dataset_restrictions"] == '{"a": 1}'
    assert set(got[5]["label_weights"]) == {0} and set(got[0]["label_weights"]) == {0, 1, 2}
    assert log.count() == 31


def test_weights_control_row_of_each_model(spark):
    layers = spark.createDataFrame([(m, n, [float(n)]) for m in ("a", "b") for n in range(4 if m == "a" else 2)],
                                   "model string, layer int, values array<double>")
    log = None
    for m in ("a", "b"):
        one = TP.append_topic(layers.where(F.col("model") == m), f"w-{m}", key=F.col("layer").cast("string").cast("binary"),
                              value=F.lit(b"x"), partition=F.lit(0), order="layer").withColumn("model", F.lit(m))
        log = one if log is None else log.unionByName(one)
    out = {r["model"]: r for r in TP.weights_control(log, "model", version=F.lit(3), settings={"batch": 8},
                                                     metrics=F.lit('{"loss": [1]}'), num_data=F.lit(7)).collect()}
    assert out["a"]["topic"] == "w-a:0:0:4" and out["b"]["layers"] == 2 and out["a"]["version"] == 3
    assert out["a"]["training_settings"] == '{"batch":8}' and out["b"]["metrics"] == '{"loss": [1]}' and out["b"]["num_data"] == 7
