"""Invariants: splits disjoint and complete, the truncation trap, FedAvg of
equal models, Krum picks an input, payout within the wallet, confusion total."""

import numpy as np
from pyspark.sql import functions as F

from kelpie.operators import federated as FD
from kelpie.operators import metrics as M
from kelpie.operators import rewards as RW
from kelpie.operators import splits as L


def test_truncation_trap():
    assert int(0.29 * 100) == 28  # the reference's double arithmetic, kept on purpose


def test_split_random_exact_sizes(spark):
    df = spark.range(0, 101).withColumnRenamed("id", "i")
    s = L.split_random(df, "i", 0.1, 0.2, seed=4)
    c = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert c == {"train": 71, "validation": 10, "test": 20}
    assert s.select("i").distinct().count() == 101


def test_split_ordered_single_rate(spark):
    log = spark.range(0, 50).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    s = L.split_ordered(log, 0.2, 0.0)
    c = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert c == {"train": 40, "validation": 10}


def test_fedavg_equal_models_is_identity(spark):
    vals = [0.5, -1.0, 2.0]
    rows = [(m, 0, 0, [3], vals) for m in ("0", "1", "2")]
    w = spark.createDataFrame(rows, FD.WEIGHTS_SCHEMA)
    out = FD.fed_avg(w, "0").first()["values"]
    assert np.allclose(out, vals)


def test_krum_picks_an_input(spark):
    rows = [("0", 0, 0, [2], [0.0, 0.0]), ("1", 0, 0, [2], [0.1, 0.0]), ("2", 0, 0, [2], [0.0, 0.1]),
            ("3", 0, 0, [2], [9.0, 9.0])]
    w = spark.createDataFrame(rows, FD.WEIGHTS_SCHEMA)
    chosen = FD.krum_choice(w, "0").first()["model_id"]
    assert chosen in {"0", "1", "2"}
    assert FD.krum(w, "0").first()["values"] in ([0.0, 0.0], [0.1, 0.0], [0.0, 0.1])


def test_krum_fallbacks(spark):
    one = spark.createDataFrame([("0", 0, 0, [1], [1.0]), ("1", 0, 0, [1], [3.0])], FD.WEIGHTS_SCHEMA)
    assert FD.krum(one, "0").first()["values"] == [2.0]      # < 2 devices -> FedAvg
    none = spark.createDataFrame([("0", 0, 0, [1], [1.0])], FD.WEIGHTS_SCHEMA)
    assert FD.krum(none, "0").first()["values"] == [1.0]     # no device -> global


def test_payout_within_wallet(spark):
    b = spark.createDataFrame([("a", 60), ("b", 60), ("a", 30)], "account string, tokens long")
    p = RW.payout(b, 100.0).agg(F.sum("payout")).first()[0]
    assert p <= 100.0 + 1e-9


def test_reward_gap(spark):
    df = spark.createDataFrame([(0.6,), (0.5,), (0.9,), (1.2,), (2.0,)], "r double")
    got = [r[0] for r in df.select(RW.reward_factor("r")).collect()]
    assert got == [0.0, 1.0, 0.5, 1.0 / 3.0, 0.0]


def test_confusion_total(spark):
    df = spark.createDataFrame([(0, 1), (1, 1), (2, 0), (1, 1)], "y int, p int")
    cm = M.confusion_matrix(df, "y", "p")
    assert cm.agg(F.sum("n")).first()[0] == 4 and cm.count() == 9
