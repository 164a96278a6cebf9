"""Federated weight-algebra queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kelpie.operators import federated as FD
from kelpie.plans.fixtures import t
from kelpie.plans.registry import register

GLOBAL = "0"


def weights(spark, sf):
    """embeddings as weight rows: model = vec_id % 4 ('0' = global), layer = vec_id div 4."""
    em = t(spark, sf, "embeddings")
    layers = em.select((F.col("vec_id") % 4).alias("m"), F.expr("vec_id div 4").alias("layer"),
                       F.col("embedding").alias("values"), F.when(F.col("vec_id") % 4 == 0, -1).otherwise(3).alias("v"))
    return FD.weights_rows(layers, "m", F.col("v"), "layer", "values")


def _long(df):
    return df.select("layer", F.posexplode("values").alias("pos", "value")) \
        .select(F.col("layer").cast("int").alias("layer"), F.col("pos").cast("int").alias("pos"),
                F.round("value", 6).alias("value"))


_W = """WITH w AS (SELECT CAST(vec_id % 4 AS VARCHAR) AS model_id, CAST(vec_id // 4 AS INTEGER) AS layer,
                  CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, CAST(unnest(embedding) AS DOUBLE) AS v
           FROM embeddings)"""
_DIST = _W + """,
sq AS (SELECT a.model_id AS a, b.model_id AS b, a.layer, sum((a.v - b.v) * (a.v - b.v)) AS s
       FROM w a JOIN w b ON a.layer = b.layer AND a.pos = b.pos AND a.model_id < b.model_id GROUP BY 1, 2, 3),
d AS (SELECT a, b, sum(sqrt(s)) AS distance FROM sq GROUP BY a, b),
sc AS (SELECT model_id, sum(distance) AS score FROM (SELECT a AS model_id, distance FROM d UNION ALL
       SELECT b, distance FROM d) GROUP BY model_id),
ch AS (SELECT model_id FROM sc ORDER BY score, model_id <> '0', model_id LIMIT 1)"""


@register("s23_write_weights", """
SELECT CAST(vec_id % 4 AS VARCHAR) AS model_id, CASE WHEN vec_id % 4 = 0 THEN -1 ELSE 4 END AS version,
       CAST(vec_id // 4 AS INTEGER) AS layer, CAST(len(embedding) AS INTEGER) AS n_values,
       round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS total FROM embeddings""")
def s23(spark, sf):
    w = weights(spark, sf)
    return w.select("model_id", "version", "layer", F.size("values").alias("n_values"),
                    F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@register("s23_weights_control", """
WITH w AS (SELECT CAST(vec_id % 4 AS VARCHAR) AS model_id, CASE WHEN vec_id % 4 = 0 THEN -1 ELSE 4 END AS version, count(*) AS layers
           FROM embeddings GROUP BY 1, 2)
SELECT model_id, 'weights-' || model_id || ':0:0:' || CAST(layers AS VARCHAR) AS topic, CAST(version AS INTEGER) AS version, layers,
       '{"batch":32,"epochs":2}' AS training_settings, CAST(layers * 10 AS BIGINT) AS num_data FROM w""")
def s23_control(spark, sf):
    """Weights written to the table, published layer by layer, and announced by a control row a model."""
    import uuid

    from kelpie.functions.codecs import encode_raw_col
    from kelpie.session import scratch_path
    from kelpie.sources import topics as TP
    path = scratch_path(spark, f"weights-{uuid.uuid4().hex}")
    FD.write_weights(weights(spark, sf), path)
    stored = spark.read.schema(FD.WEIGHTS_SCHEMA).parquet(path)
    log = None
    for m in ("0", "1", "2", "3"):
        one = TP.append_topic(stored.where(F.col("model_id") == m), f"weights-{m}", key=F.col("layer").cast("string").cast("binary"),
                              value=encode_raw_col("values", "float64"), partition=F.lit(0), order="layer",
                              headers=F.array(F.struct(F.lit("version").alias("key"), F.col("version").cast("string").cast("binary").alias("value"))))
        log = one if log is None else log.unionByName(one)
    log = log.withColumn("model_id", F.substring_index("topic", "-", -1)).withColumn("version", F.filter(
        "headers", lambda h: h["key"] == "version")[0]["value"].cast("string").cast("int"))
    c = TP.weights_control(log, "model_id", version=F.col("version"), settings={"batch": 32, "epochs": 2}, num_data=F.col("layers") * 10)
    return c.select("model_id", "topic", "version", "layers", "training_settings", "num_data")


@register("s24_read_weights", """
SELECT CAST(vec_id // 4 AS INTEGER) AS layer, CAST(len(embedding) AS INTEGER) AS n_values, round(CAST(embedding[1] AS DOUBLE), 6) AS first
FROM embeddings WHERE vec_id % 4 = 2""")
def s24(spark, sf):
    r = FD.read_weights(weights(spark, sf), "2", 4)
    return r.select("layer", F.size("values").alias("n_values"), F.round(F.col("values")[0], 6).alias("first"))


@register("g02_fed_avg", _W + " SELECT layer, pos, round(avg(v), 6) AS value FROM w GROUP BY layer, pos")
def g02(spark, sf):
    return _long(FD.fed_avg(weights(spark, sf), GLOBAL))


@register("g03_fed_avg_sequential", _W + """,
n AS (SELECT count(DISTINCT model_id) - 1 AS n FROM w),
r AS (SELECT model_id, CASE WHEN model_id = '0' THEN 0 ELSE dense_rank() OVER (ORDER BY model_id) - 1 END AS i
      FROM (SELECT DISTINCT model_id FROM w))
SELECT layer, pos, round(sum(v * CASE WHEN r.i = 0 THEN pow(2, -n.n) ELSE pow(2, -(n.n - r.i + 1)) END), 6) AS value
FROM w JOIN r USING (model_id), n GROUP BY layer, pos""")
def g03(spark, sf):
    return _long(FD.fed_avg_sequential(weights(spark, sf), GLOBAL))


@register("g05_model_distances", _DIST + " SELECT a, b, round(distance, 6) AS distance FROM d")
def g05(spark, sf):
    d = FD.model_distances(weights(spark, sf))
    return d.select("a", "b", F.round("distance", 6).alias("distance"))


@register("g04_krum", _DIST + """
SELECT w.layer, w.pos, round(w.v, 6) AS value FROM w JOIN ch USING (model_id)""")
def g04(spark, sf):
    return _long(FD.krum(weights(spark, sf), GLOBAL))


@register("g06_aggregate_fedavg_plus", _DIST + """
SELECT w.layer, w.pos, round(w.v, 6) AS value FROM w JOIN ch USING (model_id)""")
def g06(spark, sf):
    return _long(FD.aggregate(weights(spark, sf), "FedAvg+", GLOBAL))


MODEL_REQ_COLS = {
    "model_id": "p_partkey",
    "input_shape": "'(None, ' || CASE p_size % 3 WHEN 0 THEN '28, 28' WHEN 1 THEN '784' ELSE '32, 32, 3' END || ')'",
    "output_shape": "'(None, ' || CAST(p_size % 10 + 1 AS STRING) || ')'",
    "federated_string_id": "CASE WHEN p_size > 45 THEN 'fed' || CAST(p_partkey % 13 AS STRING) END",
    "data_restriction": "'{\"labels\": ' || CAST(p_partkey % 50 AS STRING) || '}'",
    "min_data": "CAST(p_retailprice * 100 AS BIGINT)",
    "framework": "CASE WHEN p_type = 'SMALL' THEN 'pth' ELSE 'tf' END",
    "distributed": "p_size % 5 = 4",
    "incremental": "p_type = 'ECONOMY'",
    "blockchain": "CASE WHEN p_brand = 'Brand#1' THEN '{\"net\": \"x\"}' END",
}


@register("g08_model_requirement", """
SELECT p_partkey AS model_id, CASE p_size % 3 WHEN 0 THEN '28 28' WHEN 1 THEN '784' ELSE '32 32 3' END AS input_shape,
       CAST(p_size % 10 + 1 AS VARCHAR) AS output_shape,
       CASE WHEN p_size > 45 THEN 'fed' || CAST(p_partkey % 13 AS VARCHAR) END AS federated_string_id,
       CAST(p_retailprice * 100 AS BIGINT) AS min_data, CASE WHEN p_type = 'SMALL' THEN 'pth' ELSE 'tf' END AS framework,
       CASE WHEN p_brand = 'Brand#1' THEN '{"net": "x"}' ELSE '{}' END AS blockchain FROM part""")
def g08(spark, sf):
    m = t(spark, sf, "part").selectExpr(*[f"{e} AS {k}" for k, e in MODEL_REQ_COLS.items()])
    r = FD.model_requirement(m)
    return r.select("model_id", "input_shape", "output_shape", "federated_string_id", "min_data", "framework", "blockchain")


METRICS_JSON = ("'{\"training\": {\"loss\": [' || CAST(value / 50.0 AS STRING) || ', ' || CAST(value / 100.0 AS STRING) "
                "|| '], ' || CASE WHEN event_type = 'click' THEN '\"accuracy\"' ELSE '\"binary_accuracy\"' END "
                "|| ': [' || CAST(CAST(get_json_object(props, '$.k') AS INT) / 100.0 AS STRING) || ']}, "
                "\"validation\": {\"loss\": [' || CAST(value / 90.0 AS STRING) || ']}}'")


@register("g09_round_record", """
SELECT event_id AS update_id, round(value / 100.0, 4) AS train_loss,
       round(CAST(json_extract_string(props, '$.k') AS INTEGER) / 100.0, 4) AS train_acc,
       round(value / 90.0, 4) AS val_loss, CAST(NULL AS DOUBLE) AS val_acc,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS num_samples FROM events""")
def g09(spark, sf):
    u = t(spark, sf, "events").selectExpr("event_id AS update_id", f"{METRICS_JSON} AS metrics",
                                          "get_json_object(props, '$.k') AS num_data")
    return FD.round_record(u).drop("num_data")
