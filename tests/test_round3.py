"""Findings of round 3: counts of announced records, evenly dealt pairs, distinct keys, one scoring, sums in Spark."""

import uuid

import numpy as np
from pyspark.sql import functions as F

from kelpie.session import scratch_path
from kelpie.sources import topics as TP


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_counts_of_announced_records_without_pairs(spark):
    offsets = [*range(0, 40), 7, 7, 1000, 1001]
    log = spark.createDataFrame([("t", p, o) for p in (0, 1) for o in offsets] + [("t", 0, None), ("t", None, 3)],
                                "topic string, partition int, offset long")
    asked = [("t", 0, s, e, i) for i, (s, e) in enumerate([(0, 40), (5, 8), (7, 8), (39, 1001), (40, 1000), (3, 3), (9, None), (0, 5000)])]
    asked += [("t", 1, 0, 40, 0), ("other", 0, 0, 40, 9), ("t", 2, 0, 40, 10), ("t", 0, 5, 8, 1)]
    ranges = spark.createDataFrame(asked, "topic string, partition int, start long, end long, who int")
    pairs = TP.control_records(ranges, log, 16).groupBy("who").agg(F.count(F.lit(1)).alias("n"))
    counts = TP.control_counts(ranges, log, 16)
    assert counts.columns == [*ranges.columns, "n"]
    want = {r["who"]: r["n"] for r in pairs.collect()}
    assert {r["who"]: r["n"] for r in counts.groupBy("who").agg(F.sum("n").alias("n")).collect()} == want
    assert want == {0: 84, 1: 10, 2: 3, 3: 2, 7: 44}


def test_counts_prune_a_topic_laid_out_by_offset(spark):
    path = scratch_path(spark, f"counts-{uuid.uuid4().hex}")
    rows = spark.range(4000).select(
        F.lit("t").alias("topic"), (F.col("id") % 4).cast("int").alias("partition"), F.expr("id div 4").alias("offset"),
        F.timestamp_seconds("id").alias("timestamp"), F.lit(None).cast("binary").alias("key"),
        F.lit(None).cast("binary").alias("value"), F.lit(None).cast(TP.TOPIC_SCHEMA["headers"].dataType).alias("headers"))
    TP.write_topic(rows, path, bucket=100)
    # many ranges over the same folders: each folder is announced once
    ranges = spark.createDataFrame([("t", 1, i % 50, 150 + i, i) for i in range(300)], "topic string, partition int, start long, end long, who int")
    assert sorted(TP._announced(ranges, 100).collect()) == [("t", 1, b) for b in range(5)]
    got = TP.control_counts(ranges, TP.read_topic(spark, path, bucketed=True), 100)
    assert {r["who"]: r["n"] for r in got.collect()} == {i: 150 + i - i % 50 for i in range(300)}
    apart = spark.createDataFrame([("t", 0, 0, 10, 1), ("t", 0, 910, 920, 2)], ranges.schema)
    assert sorted(r["_b"] for r in TP._announced(apart, 100).collect()) == [0, 9]


def test_pairs_by_id_are_dealt_in_tiles(spark, monkeypatch):
    from kelpie.operators import registry as J
    monkeypatch.setattr(J, "TILE", 7)
    ds = spark.range(60).selectExpr(
        "IF(id = 59, NULL, id) AS ds_id", "'64' AS data_reshape", "'{}' AS restrictions", "CAST(NULL AS BIGINT) AS total_msg",
        "id % 3 = 0 AS incremental", "CASE WHEN id < 40 OR id = 59 THEN 'hot' WHEN id < 50 THEN 'b' WHEN id < 55 THEN '' END AS federated_string_id")
    ds = ds.unionByName(ds.where("ds_id = 5"))      # a row that comes twice matches twice
    ms = spark.range(30).selectExpr(
        "id AS model_id", "'784' AS input_shape", "'{}' AS data_restriction", "1L AS min_data", "id % 2 = 0 AS distributed",
        "IF(id % 5 = 0, '{\"net\": \"x\"}', '{}') AS blockchain", "CASE WHEN id < 25 THEN 'hot' WHEN id < 28 THEN 'c' END AS federated_string_id")
    got = J.match(ds, ms).where("by_federated_id")

    def case(d, m):
        if m % 2 == 0:
            return 4 if d % 3 == 0 else 3
        return 2 if d % 3 == 0 else (5 if m % 5 == 0 else 1)

    rows = [*range(40), 5, 59]
    want = [(None if d == 59 else d, m, case(d, m)) for d in rows for m in range(25)]
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(((r["ds_id"], r["model_id"], r["case"]) for r in got.collect()), key=key) == sorted(want, key=key)
    # 13 ids at most made 13 tasks: now one id's pairs lie in many partitions
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        where = J.match(ds, ms).where("by_federated_id").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert where > 4


def test_keys_in_use_meet_the_models_once(spark):
    from kelpie.operators import registry as J
    models = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "k int")
    uses = spark.createDataFrame([(2,)] * 50 + [(3,), (None,), (9,)], "k int")
    free, used, left = J.deletable(models, uses, "k"), J.in_use(models, uses, "k"), J.remaining(models, uses, "k")
    assert sorted(str(r["k"]) for r in free.collect()) == sorted(str(r["k"]) for r in left.collect()) == ["1", "None"]
    assert sorted(r["k"] for r in used.collect()) == [2, 2, 3]
    assert all("Aggregate [k" in plan(d) for d in (free, used, left))     # the uses come to the join one row a key


def test_leaders_over_batches_and_a_restart(spark):
    from kelpie.streaming.stateful import leader_stream
    src, out, ck = (scratch_path(spark, f"lead-{k}-{uuid.uuid4().hex}") for k in ("in", "out", "ck"))
    schema = "u string, o long, l string"
    rng = np.random.default_rng(3)
    rows = [("u%d" % rng.integers(6), o, ["a", "b", "c", "other", None][rng.integers(5)]) for o in range(400)]
    rows = [(None if u == "u5" else u, o, l) for u, o, l in rows]
    rows[:5] = [("u0", o, l) for o, l in enumerate([None, "other", "b", "a", "a"])]
    rows[399] = ("late", 399, "c")
    for part in ((0, 150), (150, 160), (160, 400)):
        spark.createDataFrame(rows[slice(*part)][::-1], schema).coalesce(1).write.mode("append").parquet(src)
        leader_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src), "u", "l", "o", ["a", "b", "c"], out, ck, window=10)
    want, state = [], {}
    for u, o, l in rows:
        n, total, last = state.get(u, ({}, 0, None))
        n, total = {**n, l: n.get(l, 0) + 1}, total + 1
        shares = [float(int(n.get(c, 0) / total * 1e4 + 0.5)) / 1e4 for c in "abc"]
        lead = "abc"[shares.index(max(shares))]
        want.append((str(u), o, lead, last is None or lead != last or total % 10 == 0))
        state[u] = n, total, lead
    got = spark.read.parquet(out)
    assert sorted((str(r["user"]), r["order"], r["leader"], r["emit"]) for r in got.collect()) == sorted(want)
    assert dict(got.dtypes)["emit"] == "boolean" and dict(got.dtypes)["order"] == "bigint"
    # the state is a table of a row a key, without a Python call for each of them
    kept = spark.read.parquet(f"{out}-state")
    assert kept.where(F.col("batch_id") == kept.agg(F.max("batch_id")).first()[0]).count() == len(state)


def test_a_filter_on_scores_does_not_multiply_the_scoring(spark):
    from kelpie.operators.models import LinearModel
    from kelpie.operators.quality import confident
    rng = np.random.default_rng(1)
    m = LinearModel(W=rng.normal(size=(3, 4)), b=rng.normal(size=3), temperature=2.0)
    X = rng.normal(size=(20, 4))
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(X)], "id int, x array<double>")
    scored = m.apply(df, "x")
    chosen = confident(scored, 0.6)
    P = m.predict_np(X)
    assert {r["id"] for r in chosen.collect()} == {i for i, p in enumerate(P) if p.max() >= 0.6}
    assert all(np.allclose(r["values"], P[r["id"]]) for r in scored.collect())
    # the logits are in the plan once for the filter and once for the column
    assert plan(chosen).count("zip_with") <= 2
    none = m.apply(spark.createDataFrame([(None,)], "x array<double>"), "x").first()["values"]
    assert none is None or none == [None] * 3


def test_partial_sums_are_added_in_spark(spark):
    from kelpie.operators import train as TR
    rng = np.random.default_rng(2)
    X, y = rng.normal(size=(50, 3)), rng.integers(0, 2, 50)
    df = spark.createDataFrame([([float(v) for v in x], int(c), "a" if i % 3 else "b") for i, (x, c) in enumerate(zip(X, y))],
                               "features array<double>, label int, part string").repartition(5)
    spec = TR.SoftmaxRegression(k=2)
    P = {"W": rng.normal(size=(2, 3)), "b": rng.normal(size=2)}
    by = TR.gradient_by_key(df, spec, P, "part")
    a = np.arange(50) % 3 > 0
    for k, rows in (("a", a), ("b", ~a)):
        loss, G, correct = spec.loss_grad(P, X[rows], y[rows], np.ones(rows.sum()))
        assert np.allclose(by[k][0]["W"], G["W"]) and np.allclose(by[k][0]["b"], G["b"]) and np.isclose(by[k][1], loss)
        assert by[k][2:] == (correct, int(rows.sum()), float(rows.sum()))
    G, loss, correct, n, wsum = TR.gradient(df.where("label > 5"), spec, P)
    assert n == 0 and wsum == 0 and not G["W"].any()
    # one Python worker a task: nothing of the adding runs in Python
    rows = TR.partial_sums(df, spec, P, key="part")
    assert not hasattr(TR, "_combine") and TR._summed(rows, P).keys() == {"a", "b"}
