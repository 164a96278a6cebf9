"""Training, evaluation and federated-round queries.

Single gradient steps and nearest-centroid learners have DuckDB oracles;
multi-epoch fits are registered rows-only (their weights depend on float
summation order) and are covered by invariant tests."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from kelpie.operators import train as TR
from kelpie.operators import splits as L
from kelpie.operators.registry import with_sample_weight
from kelpie.plans.fixtures import t
from kelpie.plans.registry import register
from kelpie.plans.q_serving import _CENTROID_SCORES

LR = 0.5
K = 10


def _samples(spark, sf):
    return t(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("features"), "label")


def _params_frame(spark, P: dict, extra: dict | None = None):
    rows = []
    for name, v in sorted(P.items()):
        a = np.atleast_2d(v) if v.ndim == 2 else v.reshape(-1, 1)
        for k in range(a.shape[0]):
            for j in range(a.shape[1]):
                rows.append((*(extra or {}).values(), name, k, j, round(float(a[k, j]), 6)))
    cols = ", ".join(f"{c} string" for c in (extra or {})) + (", " if extra else "")
    return spark.createDataFrame(rows, cols + "param string, k int, j int, value double")


def _gd_sql(epochs: int, lr: float, train_where: str, val_where: str | None, result: str, tail: str | None = None) -> str:
    """Full-batch gradient descent of softmax regression from zero weights,
    unrolled epoch by epoch in SQL (the oracle of the distributed trainer)."""
    ctes = [f"""ranked AS (SELECT vec_id, label, embedding,
        row_number() OVER (ORDER BY md5('1:' || CAST(vec_id AS VARCHAR)), vec_id) - 1 AS rank,
        count(*) OVER () AS n FROM embeddings)""",
            f"tr AS (SELECT vec_id, label, embedding FROM ranked WHERE {train_where})",
            "x AS (SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS j, "
            "CAST(unnest(embedding) AS DOUBLE) AS x FROM tr)",
            "ks AS (SELECT CAST(range AS INTEGER) AS k FROM range(10))",
            "w0 AS (SELECT ks.k, x.j, 0.0::DOUBLE AS w FROM ks, (SELECT DISTINCT j FROM x) x)",
            "b0 AS (SELECT k, 0.0::DOUBLE AS b FROM ks)",
            "ntr AS (SELECT count(*) AS n FROM tr)"]
    if val_where:
        ctes += [f"va AS (SELECT vec_id, label, embedding FROM ranked WHERE {val_where})",
                 "xv AS (SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS j, "
                 "CAST(unnest(embedding) AS DOUBLE) AS x FROM va)"]

    def scored(t: str, xs: str, rows: str, w: str, b: str) -> list[str]:
        return [f"z{t} AS (SELECT x.vec_id, w.k, sum(x.x * w.w) + any_value(b.b) AS z FROM {xs} x "
                f"JOIN {w} w ON w.j = x.j JOIN {b} b ON b.k = w.k GROUP BY x.vec_id, w.k)",
                f"e{t} AS (SELECT vec_id, k, exp(z - max(z) OVER (PARTITION BY vec_id)) AS ez FROM z{t})",
                f"p{t} AS (SELECT vec_id, k, ez / sum(ez) OVER (PARTITION BY vec_id) AS p FROM e{t})",
                f"m{t} AS (SELECT p.vec_id, avg(-ln(greatest(p.p, 1e-7))) FILTER (WHERE p.k = r.label) AS loss, "
                f"max(CASE WHEN p.k = r.label THEN 1 ELSE 0 END) FILTER (WHERE p.p = mx.mp) AS hit0, "
                f"min(p.k) FILTER (WHERE p.p = mx.mp) AS top FROM p{t} p JOIN {rows} r ON r.vec_id = p.vec_id "
                f"JOIN (SELECT vec_id, max(p) AS mp FROM p{t} GROUP BY vec_id) mx ON mx.vec_id = p.vec_id "
                f"GROUP BY p.vec_id)",
                f"s{t} AS (SELECT avg(m.loss) AS loss, avg(CASE WHEN m.top = r.label THEN 1.0 ELSE 0.0 END) AS acc "
                f"FROM m{t} m JOIN {rows} r ON r.vec_id = m.vec_id)"]

    hist = []
    for t in range(epochs):
        ctes += scored(f"t{t}", "x", "tr", f"w{t}", f"b{t}")
        ctes += [f"""gw{t} AS (SELECT w.k, x.j, sum((p.p - CASE WHEN r.label = p.k THEN 1 ELSE 0 END) * x.x) AS g
                 FROM pt{t} p JOIN tr r ON r.vec_id = p.vec_id JOIN x ON x.vec_id = p.vec_id
                 JOIN w{t} w ON w.k = p.k AND w.j = x.j GROUP BY w.k, x.j)""",
                 f"""gb{t} AS (SELECT p.k, sum(p.p - CASE WHEN r.label = p.k THEN 1 ELSE 0 END) AS g
                 FROM pt{t} p JOIN tr r ON r.vec_id = p.vec_id GROUP BY p.k)""",
                 f"w{t + 1} AS (SELECT w.k, w.j, w.w - {lr} * g.g / ntr.n AS w FROM w{t} w JOIN gw{t} g USING (k, j), ntr)",
                 f"b{t + 1} AS (SELECT b.k, b.b - {lr} * g.g / ntr.n AS b FROM b{t} b JOIN gb{t} g USING (k), ntr)"]
        hist += [f"SELECT {t} AS epoch, 'training' AS split, 'loss' AS metric, loss AS value FROM st{t}",
                 f"SELECT {t}, 'training', 'accuracy', acc FROM st{t}"]
        if val_where:
            ctes += scored(f"v{t}", "xv", "va", f"w{t + 1}", f"b{t + 1}")
            hist += [f"SELECT {t}, 'validation', 'loss', loss FROM sv{t}",
                     f"SELECT {t}, 'validation', 'accuracy', acc FROM sv{t}"]
    return ("WITH " + ",\n".join(ctes) + f",\nh AS ({' UNION ALL '.join(hist)})\n" + tail if tail else
            "WITH " + ",\n".join(ctes) + f",\nh AS ({' UNION ALL '.join(hist)})\n"
            f"SELECT '{result}' AS result, CAST(epoch AS INTEGER) AS epoch, split, metric, round(value, 6) AS value FROM h")


_TRAIN_SPLIT = "rank < floor((1 - (0.2::DOUBLE + 0.0::DOUBLE)) * n) + (n - (floor((1 - (0.2::DOUBLE + 0.0::DOUBLE)) * n) + floor(0.2::DOUBLE * n)))"
_VAL_SPLIT = "NOT (" + _TRAIN_SPLIT + ")"


def _fed_sql(rounds: int, chunks: int, lr: float) -> str:
    """Chunked federated rounds unrolled in SQL: round r, every device takes one
    full-batch step on its rows of chunk r from the global weights, then the
    global becomes the mean of itself and the device results (FedAvg)."""
    ctes = ["""ranked AS (SELECT vec_id, label, embedding, vec_id % 3 AS device,
        row_number() OVER (ORDER BY md5('11:' || CAST(vec_id AS VARCHAR)), vec_id) - 1 AS rank,
        count(*) OVER () AS n FROM embeddings)""",
            f"ch AS (SELECT *, CAST(least(floor(rank / floor(n / {chunks})), {chunks - 1}) AS INTEGER) AS rnd FROM ranked)",
            "x AS (SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS j, "
            "CAST(unnest(embedding) AS DOUBLE) AS x FROM ch)",
            "ks AS (SELECT CAST(range AS INTEGER) AS k FROM range(10))",
            "w0 AS (SELECT ks.k, x.j, 0.0::DOUBLE AS w FROM ks, (SELECT DISTINCT j FROM x) x)",
            "b0 AS (SELECT k, 0.0::DOUBLE AS b FROM ks)"]
    recs = []
    for r in range(rounds):
        c = min(r, chunks - 1)
        ctes += [f"d{r} AS (SELECT vec_id, label, device FROM ch WHERE rnd = {c})",
                 f"z{r} AS (SELECT d.vec_id, w.k, sum(x.x * w.w) + any_value(b.b) AS z FROM d{r} d JOIN x USING (vec_id) "
                 f"JOIN w{r} w ON w.j = x.j JOIN b{r} b ON b.k = w.k GROUP BY d.vec_id, w.k)",
                 f"e{r} AS (SELECT vec_id, k, exp(z - max(z) OVER (PARTITION BY vec_id)) AS ez FROM z{r})",
                 f"p{r} AS (SELECT vec_id, k, ez / sum(ez) OVER (PARTITION BY vec_id) AS p FROM e{r})",
                 f"""m{r} AS (SELECT p.vec_id, any_value(d.device) AS device, any_value(d.label) AS label,
                     max(-ln(greatest(p.p, 1e-7))) FILTER (WHERE p.k = d.label) AS loss,
                     min(p.k) FILTER (WHERE p.p = mx.mp) AS top
                     FROM p{r} p JOIN d{r} d USING (vec_id)
                     JOIN (SELECT vec_id, max(p) AS mp FROM p{r} GROUP BY vec_id) mx USING (vec_id) GROUP BY p.vec_id)""",
                 f"""rec{r} AS (SELECT {r} AS round, CAST(device AS VARCHAR) AS device, count(*) AS num_data,
                     avg(loss) AS loss, avg(CASE WHEN top = label THEN 1.0 ELSE 0.0 END) AS accuracy FROM m{r} GROUP BY device)""",
                 f"""gw{r} AS (SELECT d.device, p.k, x.j, sum((p.p - CASE WHEN d.label = p.k THEN 1 ELSE 0 END) * x.x) AS g
                     FROM p{r} p JOIN d{r} d USING (vec_id) JOIN x USING (vec_id) GROUP BY d.device, p.k, x.j)""",
                 f"""gb{r} AS (SELECT d.device, p.k, sum(p.p - CASE WHEN d.label = p.k THEN 1 ELSE 0 END) AS g
                     FROM p{r} p JOIN d{r} d USING (vec_id) GROUP BY d.device, p.k)""",
                 f"nd{r} AS (SELECT device, count(*) AS n FROM d{r} GROUP BY device)",
                 f"""w{r + 1} AS (SELECT w.k, w.j, (w.w + sum(w.w - {lr} * g.g / nd.n)) / (count(*) + 1) AS w
                     FROM w{r} w JOIN gw{r} g ON g.k = w.k AND g.j = w.j JOIN nd{r} nd ON nd.device = g.device
                     GROUP BY w.k, w.j, w.w)""",
                 f"""b{r + 1} AS (SELECT b.k, (b.b + sum(b.b - {lr} * g.g / nd.n)) / (count(*) + 1) AS b
                     FROM b{r} b JOIN gb{r} g ON g.k = b.k JOIN nd{r} nd ON nd.device = g.device GROUP BY b.k, b.b)"""]
        recs.append(f"SELECT * FROM rec{r}")
    return ("WITH " + ",\n".join(ctes) + f",\nallrec AS ({' UNION ALL '.join(recs)})\n"
            "SELECT CAST(round AS INTEGER) AS round, device, num_data, round(loss, 6) AS loss, "
            "round(accuracy, 6) AS accuracy FROM allrec")


_STEP_SQL = """WITH e AS (SELECT vec_id, label, {w} AS w, unnest(embedding) AS x, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS j
           FROM embeddings),
ks AS (SELECT CAST(range AS INTEGER) AS k FROM range(10)),
tot AS (SELECT sum({w}) AS ws FROM embeddings),
gw AS (SELECT ks.k, e.j, sum(e.w * (0.1 - CASE WHEN e.label = ks.k THEN 1 ELSE 0 END) * CAST(e.x AS DOUBLE)) AS g
       FROM e JOIN ks ON true GROUP BY ks.k, e.j),
gb AS (SELECT ks.k, sum({w} * (0.1 - CASE WHEN label = ks.k THEN 1 ELSE 0 END)) AS g FROM embeddings JOIN ks ON true GROUP BY ks.k)
SELECT 'W' AS param, k, j, round(-0.5 * g / ws, 6) AS value FROM gw, tot
UNION ALL SELECT 'b', k, 0, round(-0.5 * g / ws, 6) FROM gb, tot"""


@register("t01_gradient_step", _STEP_SQL.format(w="1.0"))
def t01(spark, sf):
    spec = TR.SoftmaxRegression(k=K)
    P = TR.gradient_step(_samples(spark, sf), spec, spec.init(64), LR)
    return _params_frame(spark, P)


@register("t09_weighted_step", _STEP_SQL.format(w="CASE label WHEN 0 THEN 3.0 WHEN 1 THEN 0.6 ELSE 1.0 END"))
def t09(spark, sf):
    spec = TR.SoftmaxRegression(k=K)
    d = with_sample_weight(_samples(spark, sf), {"0": 3.0, "1": 0.6, "x": 2.0}, label="label", out="w")
    P = TR.gradient_step(d, spec, spec.init(64), LR, weight="w")
    return _params_frame(spark, P)


def _rounded_history(spark, res, name):
    h = TR.history_frame(spark, res, name)
    return h.withColumn("value", F.round("value", 6))


@register("t01_fit", _gd_sql(10, LR, _TRAIN_SPLIT, _VAL_SPLIT, "softmax"))
def t01f(spark, sf):
    s = L.split_random(_samples(spark, sf), "vec_id", 0.2, 0.0, seed=1)
    res = TR.fit(s.where("split = 'train'"), TR.SoftmaxRegression(k=K), epochs=10, lr=LR,
                 validation=s.where("split = 'validation'"))
    return _rounded_history(spark, res, "softmax")


@register("t02_fit_many")
def t02(spark, sf):
    specs = {"softmax": TR.SoftmaxRegression(k=K), "mlp": TR.MLP(hidden=16, k=K)}
    res = TR.fit_many(_samples(spark, sf), specs, epochs=3, lr=LR)
    rows = [(n, r.history[-2][3], r.history[-1][3], float(r.training_time)) for n, r in res.items()]
    return spark.createDataFrame(rows, "model string, loss double, accuracy double, training_time double")


@register("t03_evaluate", _CENTROID_SCORES + """,
u AS (SELECT label AS c FROM scored UNION SELECT pred FROM scored),
cc AS (SELECT label AS y, pred AS yhat, count(*) AS n FROM scored GROUP BY 1, 2)
SELECT a.c AS y, b.c AS yhat, coalesce(cc.n, 0) AS n FROM u a JOIN u b ON true LEFT JOIN cc ON cc.y = a.c AND cc.yhat = b.c""")
def t03(spark, sf):
    from kelpie.operators.metrics import confusion_matrix
    from kelpie.plans.q_serving import published_scores
    from kelpie.functions.features import argmax
    s = published_scores(spark, sf).withColumn("pred", argmax("values")).withColumn("label", F.col("label").cast("int"))
    return confusion_matrix(s, "label", "pred")


@register("t04_history", _gd_sql(3, LR, "true", None, "t04"))
def t04(spark, sf):
    res = TR.fit(_samples(spark, sf), TR.SoftmaxRegression(k=K), epochs=3, lr=LR)
    return _rounded_history(spark, res, "t04")


_RESULT_TAIL = """, u AS (SELECT label AS c FROM va UNION SELECT top FROM mv2),
cm AS (SELECT a.c AS y, b.c AS yhat, (SELECT count(*) FROM mv2 m JOIN va r ON r.vec_id = m.vec_id WHERE r.label = a.c AND m.top = b.c) AS n
       FROM u a JOIN u b ON true)
SELECT CASE split WHEN 'training' THEN 'train_metrics' ELSE 'val_metrics' END AS section, metric AS name, CAST(epoch AS INTEGER) AS i,
       round(value, 6) AS value FROM h
UNION ALL SELECT 'test_metrics', metric, 0, round(value, 6) FROM h WHERE split = 'validation' AND epoch = 2
UNION ALL SELECT 'confusion_matrix', CAST(dense_rank() OVER (ORDER BY y) - 1 AS VARCHAR), CAST(dense_rank() OVER (ORDER BY yhat) - 1 AS INTEGER),
       CAST(n AS DOUBLE) FROM cm"""


@register("t04_result_row", _gd_sql(3, LR, _TRAIN_SPLIT, _VAL_SPLIT, "t04", _RESULT_TAIL))
def t04_result(spark, sf):
    """The row that a fit of three epochs reports, taken apart: metrics of every epoch, test scores by name, matrix."""
    from kelpie.functions.features import argmax
    from kelpie.operators.metrics import confusion_matrix
    d = L.split_random(_samples(spark, sf), "vec_id", 0.2, 0.0, seed=1)
    train, test, spec = d.where("split = 'train'"), d.where("split = 'validation'"), TR.SoftmaxRegression(k=K)
    res = TR.fit(train, spec, epochs=3, lr=LR, validation=test)
    scored = TR.predict_frame(test, spec, res.params).select(F.col("label").cast("int").alias("label"), argmax("values").cast("int").alias("pred"))
    row = TR.result_row(spark, res, "t04", TR.evaluate_model(test, spec, res.params, ["loss", "accuracy"]),
                        confusion_matrix(scored, "label", "pred"))
    out = None
    for section in ("train_metrics", "val_metrics"):
        part = row.select(F.explode(section).alias("name", "v")).select(F.lit(section).alias("section"), "name", F.posexplode("v").alias("i", "value"))
        out = part if out is None else out.unionByName(part)
    tests = row.select(F.explode("test_metrics").alias("name", "value")).select(F.lit("test_metrics").alias("section"), "name", F.lit(0).alias("i"), "value")
    lines = row.select(F.posexplode("confusion_matrix").alias("y", "line")).select(
        F.lit("confusion_matrix").alias("section"), F.col("y").cast("string").alias("name"), F.posexplode("line").alias("i", "n")) \
        .select("section", "name", "i", F.col("n").cast("double").alias("value"))
    return out.unionByName(tests).unionByName(lines).withColumn("value", F.round("value", 6))


SELF_T, SELF_CONF, SELF_ROUNDS = 30.0, 0.6, 5
_LABELLED = "md5('self:' || CAST(vec_id AS STRING)) < '3'"


def _self_sql():
    parts = [f"""WITH e0 AS (SELECT vec_id, label, embedding FROM embeddings),
t0 AS (SELECT vec_id, label, 0 AS round FROM e0 WHERE {_LABELLED}),
p0 AS (SELECT vec_id FROM e0 WHERE NOT ({_LABELLED})),
x AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM e0)"""]
    for r in range(1, SELF_ROUNDS + 1):
        parts.append(f"""c{r} AS (SELECT t.label AS k, x.i, avg(CAST(x.x AS DOUBLE)) AS c FROM t{r-1} t JOIN x USING (vec_id) GROUP BY 1, 2),
s{r} AS (SELECT x.vec_id, c.k, {SELF_T} * sum(CAST(x.x AS DOUBLE) * c.c) AS z FROM p{r-1} p JOIN x USING (vec_id)
         JOIN c{r} c ON c.i = x.i GROUP BY 1, 2),
q{r} AS (SELECT vec_id, k, exp(z - max(z) OVER (PARTITION BY vec_id)) AS ez FROM s{r}),
r{r} AS (SELECT vec_id, k, ez / sum(ez) OVER (PARTITION BY vec_id) AS p FROM q{r}),
m{r} AS (SELECT vec_id, max(p) AS mp, min(k) FILTER (WHERE p = mx) AS kk FROM (SELECT *, max(p) OVER (PARTITION BY vec_id) AS mx FROM r{r}) GROUP BY vec_id),
n{r} AS (SELECT vec_id, kk AS label, {r} AS round FROM m{r} WHERE mp >= {SELF_CONF}),
t{r} AS (SELECT * FROM t{r-1} UNION ALL SELECT * FROM n{r}),
p{r} AS (SELECT vec_id FROM p{r-1} WHERE vec_id NOT IN (SELECT vec_id FROM n{r}))""")
    return ",\n".join(parts) + f"\nSELECT vec_id, CAST(label AS INTEGER) AS label, CAST(round AS INTEGER) AS round FROM t{SELF_ROUNDS}"


@register("t06_self_train", _self_sql())
def t06(spark, sf):
    s = _samples(spark, sf)
    lab = s.where(F.expr(_LABELLED))
    pool = s.where(~F.expr(_LABELLED))
    train, _ = TR.self_train(lab, pool, rounds=SELF_ROUNDS, confidence=SELF_CONF, key="vec_id",
                             temperature=SELF_T, n_classes=K)
    return train.select("vec_id", F.col("label").cast("int").alias("label"), F.col("round").cast("int").alias("round"))


@register("t08_multi_exit")
def t08(spark, sf):
    res = TR.fit(_samples(spark, sf), TR.MultiExitChain(dims=(64, 32, 16), k=K), epochs=5, lr=0.5)
    return TR.history_frame(spark, res, "multi_exit")


@register("t12_corrupt", """
SELECT vec_id, vec_id % 3 AS device,
       round(list_sum(list_transform(embedding, lambda x: CASE WHEN vec_id % 3 = 1 THEN -CAST(x AS DOUBLE) ELSE CAST(x AS DOUBLE) END)), 6) AS total
FROM embeddings""")
def t12(spark, sf):
    d = _samples(spark, sf).withColumn("device", F.col("vec_id") % 3)
    c = TR.corrupt(d, "device", 1, "flip")
    return c.select("vec_id", "device", F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double")), 6)
                    .alias("total"))


_DEV_SQL = """WITH e AS (SELECT vec_id % 3 AS device, label, unnest(embedding) AS x, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS j
           FROM embeddings),
ks AS (SELECT CAST(range AS INTEGER) AS k FROM range(10)),
nd AS (SELECT vec_id % 3 AS device, count(*) AS n FROM embeddings GROUP BY 1),
gw AS (SELECT e.device, ks.k, e.j, sum((0.1 - CASE WHEN e.label = ks.k THEN 1 ELSE 0 END) * CAST(e.x AS DOUBLE)) AS g
       FROM e JOIN ks ON true GROUP BY 1, 2, 3),
gb AS (SELECT vec_id % 3 AS device, ks.k, sum(0.1 - CASE WHEN label = ks.k THEN 1 ELSE 0 END) AS g
       FROM embeddings JOIN ks ON true GROUP BY 1, 2),
dev AS (SELECT device, 'W' AS param, k, j, -0.5 * g / n AS value FROM gw JOIN nd USING (device)
        UNION ALL SELECT device, 'b', k, 0, -0.5 * g / n FROM gb JOIN nd USING (device))"""


def _long_params(models, *keys):
    """Chunked softmax parameters as one row per number: layer 0 is W (K rows), layer 1 is b."""
    from kelpie.operators.rounds import CHUNK
    at = F.col("chunk") * CHUNK + F.col("pos")
    d = 64
    return models.select(*keys, "layer", "chunk", F.posexplode("values").alias("pos", "v")).select(
        *keys, F.when(F.col("layer") == 0, "W").otherwise("b").alias("param"),
        F.when(F.col("layer") == 0, F.floor(at / d)).otherwise(at).cast("int").alias("k"),
        F.when(F.col("layer") == 0, at % d).otherwise(0).cast("int").alias("j"), F.round("v", 6).alias("value"))


def _by_device(spark, sf):
    return _samples(spark, sf).withColumn("device", F.col("vec_id") % 3)


@register("g01_local_fit", _DEV_SQL + """
SELECT CAST(device AS VARCHAR) AS device, param, k, j, round(value, 6) AS value FROM dev""")
def g01(spark, sf):
    from kelpie.operators import rounds as R
    spec = TR.SoftmaxRegression(k=K)
    blocks = R.Blocks.of(_by_device(spark, sf), "device")
    models, _ = R.local_fit(blocks, R.init_model(spark, spec, blocks.d), spec, epochs=1, lr=LR)
    return _long_params(models, "device")


@register("g10_federated_round", _DEV_SQL + """
SELECT param, k, j, round(sum(value) / ((SELECT count(*) FROM nd) + 1), 6) AS value FROM dev GROUP BY 1, 2, 3""")
def g10(spark, sf):
    from kelpie.operators.rounds import run_federated
    run = run_federated(_by_device(spark, sf), TR.SoftmaxRegression(k=K), "device", rounds=1, epochs=1, lr=LR)
    return _long_params(run.model())


def _run_sql(rounds: int, epochs: int, lr: float, result: str) -> str:
    """Federated rounds of several local epochs unrolled in SQL: every device steps from the global
    weights on all its rows, then the global becomes the mean of itself and the devices'."""
    ctes = ["d AS (SELECT vec_id, label, CAST(vec_id % 3 AS VARCHAR) AS device FROM embeddings WHERE label IS NOT NULL)",
            "nd AS (SELECT device, count(*) AS n FROM d GROUP BY device)",
            "x AS (SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS j, "
            "CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)",
            f"ks AS (SELECT CAST(range AS INTEGER) AS k FROM range({K}))",
            "w0 AS (SELECT ks.k, x.j, 0.0::DOUBLE AS w FROM ks, (SELECT DISTINCT j FROM x) x)",
            "b0 AS (SELECT k, 0.0::DOUBLE AS b FROM ks)"]
    records = []
    for r in range(rounds):
        ctes += [f"lw{r}_0 AS (SELECT device, k, j, w FROM w{r}, nd)", f"lb{r}_0 AS (SELECT device, k, b FROM b{r}, nd)"]
        for e in range(epochs):
            s, nxt = f"{r}_{e}", f"{r}_{e + 1}"
            ctes += [
                f"z{s} AS (SELECT d.vec_id, w.k, sum(x.x * w.w) + any_value(b.b) AS z FROM d JOIN x USING (vec_id) "
                f"JOIN lw{s} w ON w.j = x.j AND w.device = d.device JOIN lb{s} b ON b.k = w.k AND b.device = d.device "
                "GROUP BY d.vec_id, w.k)",
                f"e{s} AS (SELECT vec_id, k, z, exp(z - max(z) OVER (PARTITION BY vec_id)) AS ez FROM z{s})",
                f"p{s} AS (SELECT vec_id, k, ez / sum(ez) OVER (PARTITION BY vec_id) AS p FROM e{s})",
                f"g{s} AS (SELECT d.device, d.vec_id, p.k, p.p - CASE WHEN d.label = p.k THEN 1 ELSE 0 END AS g FROM p{s} p JOIN d USING (vec_id))",
                f"lw{nxt} AS (SELECT w.device, w.k, w.j, any_value(w.w) - {lr} * sum(g.g * x.x) / any_value(nd.n) AS w FROM g{s} g "
                f"JOIN x USING (vec_id) JOIN lw{s} w ON w.device = g.device AND w.k = g.k AND w.j = x.j JOIN nd ON nd.device = w.device "
                "GROUP BY w.device, w.k, w.j)",
                f"lb{nxt} AS (SELECT b.device, b.k, any_value(b.b) - {lr} * sum(g.g) / any_value(nd.n) AS b FROM g{s} g "
                f"JOIN lb{s} b ON b.device = g.device AND b.k = g.k JOIN nd ON nd.device = b.device GROUP BY b.device, b.k)"]
        last = f"{r}_{epochs - 1}"
        records.append(f"""SELECT CAST({r} AS INTEGER) AS round, d.device, CAST(count(*) AS INTEGER) AS num_samples,
            round(avg(-ln(greatest(q.p, 1e-7))), 4) AS train_loss, round(avg(CASE WHEN q.top = d.label THEN 1.0 ELSE 0.0 END), 4) AS train_acc
            FROM (SELECT p.vec_id, max(p.p) FILTER (WHERE p.k = d.label) AS p, arg_max(p.k, (p.p, -p.k)) AS top
                  FROM p{last} p JOIN d USING (vec_id) GROUP BY p.vec_id) q JOIN d USING (vec_id) GROUP BY d.device""")
        ctes += [f"w{r + 1} AS (SELECT l.k, l.j, (any_value(w.w) + sum(l.w)) / (count(*) + 1) AS w FROM lw{r}_{epochs} l "
                 f"JOIN w{r} w ON w.k = l.k AND w.j = l.j GROUP BY l.k, l.j)",
                 f"b{r + 1} AS (SELECT l.k, (any_value(b.b) + sum(l.b)) / (count(*) + 1) AS b FROM lb{r}_{epochs} l "
                 f"JOIN b{r} b ON b.k = l.k GROUP BY l.k)"]
    if result == "records":
        return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL ".join(records)
    return "WITH " + ",\n".join(ctes) + f"""
SELECT 'W' AS param, k, j, round(w, 6) AS value FROM w{rounds} UNION ALL SELECT 'b', k, 0, round(b, 6) FROM b{rounds}"""


@register("g10_federated_run", _run_sql(3, 2, LR, "model"))
def g10_run(spark, sf):
    """Three rounds of two local epochs behind the gate: the final model (version -1)."""
    from kelpie.operators.rounds import run_federated
    run = run_federated(_by_device(spark, sf), TR.SoftmaxRegression(k=K), "device", rounds=3, epochs=2, lr=LR, registered=3)
    return _long_params(run.model())


@register("g10_round_records", _run_sql(3, 2, LR, "records"))
def g10_records(spark, sf):
    """The G09 records of the same run: a row per update used."""
    from kelpie.operators.rounds import run_federated
    run = run_federated(_by_device(spark, sf), TR.SoftmaxRegression(k=K), "device", rounds=3, epochs=2, lr=LR, registered=3)
    return run.records.select("round", "device", "num_samples", "train_loss", "train_acc")


@register("g11_chunked_rounds", _fed_sql(3, 3, LR))
def g11(spark, sf):
    from kelpie.operators.rounds import run_federated
    d = L._with_total(L.permutation_rank(_samples(spark, sf), "vec_id", 11), None).withColumn(
        "device", F.col("vec_id") % 3)
    n = int(d.select("_n").first()["_n"])
    run = run_federated(d, TR.SoftmaxRegression(k=K), "device", rounds=3, epochs=1, lr=LR, part=L.round_chunk("rank", n, 3), parts=3)
    return run.history.select(F.col("wave").alias("round"), "device", "num_data", F.round("loss", 6).alias("loss"),
                              F.round("accuracy", 6).alias("accuracy"))


_ONE_MINIBATCH_EPOCH = f"""
WITH r AS (SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id) - 1 AS pos, count(*) OVER () AS n
           FROM embeddings WHERE label IS NOT NULL),
s AS (SELECT *, pos // ((n + 1) // 2) AS bt FROM r),
x AS (SELECT vec_id, bt, label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS j,
             CAST(unnest(embedding) AS DOUBLE) AS x FROM s),
ks AS (SELECT CAST(range AS INTEGER) AS k FROM range({K})),
n0 AS (SELECT bt, count(*) AS m FROM s GROUP BY bt),
w1 AS (SELECT k, j, -{LR} * sum((1.0 / {K} - CASE WHEN label = k THEN 1 ELSE 0 END) * x) / any_value(m) AS w
       FROM x JOIN n0 USING (bt), ks WHERE bt = 0 GROUP BY k, j),
b1 AS (SELECT k, -{LR} * sum(1.0 / {K} - CASE WHEN label = k THEN 1 ELSE 0 END) / any_value(m) AS b
       FROM s JOIN n0 USING (bt), ks WHERE bt = 0 GROUP BY k),
z AS (SELECT vec_id, w1.k, any_value(label) AS label, sum(x * w) + any_value(b) AS z
      FROM x JOIN w1 USING (j) JOIN b1 ON b1.k = w1.k WHERE bt = 1 GROUP BY vec_id, w1.k),
e AS (SELECT *, exp(z - max(z) OVER (PARTITION BY vec_id)) AS ez FROM z),
d AS (SELECT vec_id, k, ez / sum(ez) OVER (PARTITION BY vec_id) - CASE WHEN label = k THEN 1 ELSE 0 END AS d FROM e),
w2 AS (SELECT d.k, x.j, sum(d.d * x.x) / any_value(m) AS g FROM d JOIN x USING (vec_id) JOIN n0 USING (bt) GROUP BY d.k, x.j),
b2 AS (SELECT k, sum(d) / (SELECT m FROM n0 WHERE bt = 1) AS g FROM d GROUP BY k)
SELECT 'W' AS param, k, j, round(w - {LR} * g, 6) AS value FROM w1 JOIN w2 USING (k, j)
UNION ALL SELECT 'b', k, 0, round(b - {LR} * g, 6) FROM b1 JOIN b2 USING (k)"""


@register("t01_minibatch_epoch", _ONE_MINIBATCH_EPOCH)
def t01_minibatch_epoch(spark, sf):
    """One epoch of two batches (each half of the rows, by id) with plain SGD."""
    from kelpie.operators.train import Sgd, SoftmaxRegression, fit_minibatch
    df = _samples(spark, sf)
    half = (df.where("label IS NOT NULL").count() + 1) // 2
    res = fit_minibatch(df, SoftmaxRegression(k=K), batch=half, order="vec_id", optimizer=Sgd(LR))
    return _params_frame(spark, res.params)


@register("a08_multiclass", _CENTROID_SCORES + """
SELECT count(*) AS n, round(avg(CASE WHEN s.pred = s.label THEN 1.0 ELSE 0.0 END), 6) AS sparse_categorical_accuracy,
       round(avg(-ln(least(greatest(q.p, 1e-7), 1 - 1e-7))), 6) AS sparse_categorical_crossentropy
FROM q JOIN scored s ON s.vec_id = q.vec_id WHERE q.k = s.label""")
def a08_multiclass(spark, sf):
    from kelpie.operators.metrics import evaluate_multiclass
    from kelpie.operators.models import fit_centroids
    from kelpie.operators.serve import score
    from kelpie.plans.q_serving import TEMPERATURE
    em = _samples(spark, sf)
    m = evaluate_multiclass(score(em, fit_centroids(em, temperature=TEMPERATURE)), "label", "values")
    return m.select("n", *[F.round(c, 6).alias(c) for c in m.columns[1:]])
