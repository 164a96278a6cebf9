"""Results that only show beyond the gate's sizes: keys above a byte, batches of
several partitions, nulls, many devices."""

import random

import pytest
from pyspark.sql import functions as F

from kelpie.functions.features import shape_text
from kelpie.operators.federated import fed_avg_sequential, krum_choice
from kelpie.operators.monitor import improvements
from kelpie.operators.rewards import payout
from kelpie.session import ensure_checkpoint_dir, path_exists
from kelpie.sources.topics import control_dead_letters, control_to_log, datasources_from_log


def control(spark, ids):
    return spark.createDataFrame([(i, f"t:0:0:{k}", k) for k, i in enumerate(ids)], "deployment_id long, topic string, total_msg long")


def test_control_keys_of_any_size(spark):
    ids = [0, 1, 255, 256, 70_000, 2 ** 40, 2 ** 62]
    log = control_to_log(control(spark, ids))
    assert sorted(r["deployment_id"] for r in datasources_from_log(log).collect()) == ids


def test_ids_without_a_key_are_dead_letters(spark):
    ctl = control(spark, [5, None, -1, 300])
    assert [r["deployment_id"] for r in datasources_from_log(control_to_log(ctl, key_width=1)).collect()] == [5]
    dead = {(r["deployment_id"], r["key_error"]) for r in control_dead_letters(ctl, key_width=1).collect()}
    assert dead == {(None, "no deployment id"), (-1, "negative deployment id"), (300, "does not fit 1 byte(s)")}
    assert control_to_log(ctl).count() + control_dead_letters(ctl).count() == 4


def test_stream_fit_splits_whole_batches(spark, tmp_path, monkeypatch):
    from kelpie.operators import splits
    from kelpie.operators.train import SoftmaxRegression
    from kelpie.streaming import streams
    seen = []
    split = splits.split_batch
    monkeypatch.setattr(splits, "split_batch", lambda *a, **k: seen.append(split(*a, **k)) or seen[-1])
    counts = []
    persist = type(spark.range(1)).unpersist
    monkeypatch.setattr(type(spark.range(1)), "unpersist", lambda df, *a: (
        counts.append({r["split"]: r["count"] for r in df.groupBy("split").count().collect()})
        if "split" in df.columns else None) or persist(df, *a))
    rows = spark.range(1000).select(F.array(*[F.rand(i) for i in range(3)]).alias("features"),
                                    (F.col("id") % 2).cast("int").alias("label")).repartition(4)
    path = str(tmp_path / "src")
    rows.write.parquet(path)
    stream = spark.readStream.schema(rows.schema).parquet(path)
    streams.fit_stream(stream, SoftmaxRegression(k=2), str(tmp_path / "params"), str(tmp_path / "ck"), d=3,
                       validation_rate=0.2)
    assert counts == [{"train": 800, "validation": 200}] and len(seen) == 1


def plain_ratchet(values, d, up):
    out, ref = [], None
    for o, v in values:
        if v is None or v != v:
            continue
        if ref is None:
            ref = v
        elif v != ref and ((v - ref if up else ref - v) >= d):
            out.append((o, v, ref))
            ref = v
    return out


@pytest.mark.parametrize("block", [2, 4, 64])
@pytest.mark.parametrize("d", [5.0, 0.0, -2.0])
@pytest.mark.parametrize("change", ["up", "down"])
def test_ratchet_passes_over_nulls(spark, block, d, change):
    rng = random.Random(int(d) + block)
    values = [(0, None), (1, 0.0), (2, 1.0), (3, None), (4, float("nan")), (5, 4.0), (6, 12.0)] + \
        [(7 + i, rng.choice([None, float(rng.randint(-20, 20))])) for i in range(40)]
    df = spark.createDataFrame([("k", o, v) for o, v in values], "key string, o long, v double")
    got = sorted((r["order"], r["value"], r["reference"]) for r in improvements(df, "key", "o", "v", change, d, block).collect())
    assert got == plain_ratchet(values, d, change == "up")


def weights(spark, n, arrival=None):
    rows = [("0", 0, [1], [100.0], -1)] + [(str(i), 0, [1], [float(i)], arrival(i) if arrival else i) for i in range(1, n + 1)]
    return spark.createDataFrame(rows, "model_id string, layer int, shape array<int>, values array<double>, arrived int")


def test_sequential_average_of_twelve_devices(spark):
    def mean(order):
        acc = 100.0
        for i in order:
            acc = (acc + i) / 2
        return acc

    w = weights(spark, 12)
    assert fed_avg_sequential(w, "0").first()["values"][0] == pytest.approx(mean(range(1, 13)))
    back = weights(spark, 12, lambda i: -i + 50)
    assert fed_avg_sequential(back, "0", "arrived").first()["values"][0] == pytest.approx(mean(range(12, 0, -1)))


def test_krum_ties_go_to_the_first_arrival(spark):
    rows = [("0", 0, [1], [50.0])] + [(i, 0, [1], [v]) for i, v in (("10", 1.0), ("9", 1.0), ("2", 1.0), ("11", 1.0))]
    w = spark.createDataFrame(rows, "model_id string, layer int, shape array<int>, values array<double>")
    assert krum_choice(w, "0").first()["model_id"] == "2"


def test_self_training_returns_a_model_of_all_rows(spark):
    from kelpie.operators.models import fit_centroids
    from kelpie.operators.train import self_train
    rng = random.Random(1)
    pt = lambda i, c: (i, [10.0 * c + rng.random(), rng.random()], c)
    labelled = spark.createDataFrame([pt(i, i % 2) for i in range(6)], "id long, features array<double>, label int")
    pool = spark.createDataFrame([pt(100 + i, i % 2) for i in range(30)], "id long, features array<double>, label int")
    train, model = self_train(labelled, pool.drop("label"), rounds=1, confidence=0.5, n_classes=2)
    again = fit_centroids(train, "features", "label", n_classes=2, temperature=10.0)
    assert train.count() == 36 and repr(model) == repr(again)


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getConf(self):      # noqa: N802
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_path_exists(spark, tmp_path):
    assert path_exists(spark, str(tmp_path)) and not path_exists(spark, str(tmp_path / "no"))


def test_payout_scales_to_the_wallet(spark):
    df = spark.createDataFrame([("a", 30), ("b", 10), ("a", 20)], "account string, tokens long")
    plan = payout(df, 30.0)
    assert "SinglePartition" not in plan._jdf.queryExecution().toString()
    assert {r["account"]: r[2] if len(r) > 2 else None for r in plan.collect()}.keys() == {"a", "b"}


@pytest.mark.parametrize("text,want", [("(None, 28, 28)", "28 28"), ("(None, 5)", "5"), ("(None, 32,32, 3)", "32 32 3"),
                                       ("784", "784"), ("", ""), ("(None,)", "(None,)"), (None, None)])
def test_shape_text(spark, text, want):
    assert spark.createDataFrame([(text,)], "s string").select(shape_text("s")).first()[0] == want


def test_model_chain_is_long_and_may_hold_a_cycle(spark):
    from kelpie.operators.registry import model_chain
    links = [(i, i - 1 if i else None) for i in range(12)] + [(100, 102), (101, 100), (102, 101)]
    models = spark.createDataFrame(links, "model_id long, father_id long")
    roots = spark.createDataFrame([(0,), (100,)], "model_id long")
    got = {(r["root"], r["model_id"], r["depth"]) for r in model_chain(spark, models, roots).collect()}
    assert got == {(0, i, i) for i in range(12)} | {(100, 100, 0), (100, 101, 1), (100, 102, 2)}
