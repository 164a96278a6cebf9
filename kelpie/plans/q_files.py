"""File source/sink, prediction-record, model-log and plug-in queries
(S15, S18-S22, X01, X03, X04)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kelpie.functions.features import argmax
from kelpie.operators import federated as FD
from kelpie.operators import train as TR
from kelpie.operators.models import fit_centroids
from kelpie.operators.serve import prediction_records, score
from kelpie.plans.datasets import DATASETS
from kelpie.plans.fixtures import t
from kelpie.plans.q_serving import _CENTROID_SCORES
from kelpie.plans.registry import register
from kelpie.session import scratch_path
from kelpie.sources import files as FS
from kelpie.sources.topics import fed_datasources, model_sources

SENSOR_COLS = {
    "index": "l_orderkey * 10 + l_linenumber",
    "date": "CAST(l_shipdate AS STRING)",
    "Temperature": "l_quantity",
    "Humidity": "l_extendedprice / 1000.0",
    "Light": "l_discount * 100.0",
    "CO2": "l_tax * 1000.0",
    "HumidityRatio": "l_quantity / 50.0",
    "Occupancy": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
}


@register("s18_sensor_csv", """
SELECT l_orderkey * 10 + l_linenumber AS "index",
  round(CAST(CAST(l_quantity AS FLOAT) AS DOUBLE) + CAST(CAST(l_extendedprice / 1000.0 AS FLOAT) AS DOUBLE)
      + CAST(CAST(l_discount * 100.0 AS FLOAT) AS DOUBLE) + CAST(CAST(l_tax * 1000.0 AS FLOAT) AS DOUBLE)
      + CAST(CAST(l_quantity / 50.0 AS FLOAT) AS DOUBLE), 3) AS feature_sum,
  CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS FLOAT) AS label FROM lineitem""")
def s18(spark, sf):
    path = scratch_path(spark, f"csv/sensor-{uuid.uuid4().hex}")
    FS.write_sensor_csv(t(spark, sf, "lineitem").selectExpr(*[f"{e} AS {k}" for k, e in SENSOR_COLS.items()]), path)
    r = FS.read_sensor_csv(spark, path)
    return r.select("index", F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double")), 3)
                    .alias("feature_sum"), "label")


@register("s19_labelled_csv", """
SELECT p_partkey, p_size AS target, 2 AS n_features, round(p_partkey + p_retailprice, 6) AS feature_sum FROM part""")
def s19(spark, sf):
    path = scratch_path(spark, f"csv/part-{uuid.uuid4().hex}")
    t(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_retailprice").write.option("header", True).csv(path)
    from pyspark.sql import types as T
    sch = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
                        T.StructField("p_size", T.IntegerType()), T.StructField("p_retailprice", T.DoubleType())])
    r = FS.read_labelled_csv(spark, path, "p_size", sch)
    return r.select("p_partkey", F.col("p_size").alias("target"), F.size("features").alias("n_features"),
                    F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x), 6).alias("feature_sum"))


_PARK = ("'{\"result\": {\"records\": [{\"poiID\": ' || CAST(user_id AS STRING) || ', \"time\": \"' || "
         "CAST(date_trunc('second', ts) AS STRING) || '\"}, {\"poiID\": ' || CAST(user_id + 1000 AS STRING) || "
         "', \"time\": \"' || CAST(date_trunc('second', ts) AS STRING) || '\"}]}}'")


@register("s20_parking_features", """
WITH r AS (SELECT event_id, user_id AS poi, ts FROM events UNION ALL SELECT event_id, user_id + 1000, ts FROM events)
SELECT event_id, poi AS poiID, CAST(day(ts) AS BIGINT) AS day, CAST(month(ts) AS BIGINT) AS month,
       CAST(year(ts) AS BIGINT) AS year, CAST(hour(ts) AS BIGINT) AS hour, CAST(minute(ts) AS BIGINT) AS minute FROM r""")
def s20(spark, sf):
    ev = t(spark, sf, "events").selectExpr("event_id", f"{_PARK} AS payload")
    f = FS.parking_features(ev).select("event_id", "features")
    c = F.col("features")
    return f.select("event_id", c[0].alias("poiID"), c[1].alias("day"), c[2].alias("month"), c[3].alias("year"),
                    c[4].alias("hour"), c[5].alias("minute"))


@register("s21_prediction_records", _CENTROID_SCORES + " SELECT vec_id, 10 AS n_values, pred FROM scored")
def s21(spark, sf):
    em = t(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("features"), "label")
    m = fit_centroids(em, temperature=10.0)
    s = score(em, m).withColumn("headers", F.array(F.struct(
        F.lit("sample_id").alias("key"), F.encode(F.col("vec_id").cast("string"), "UTF-8").alias("value"))))
    rec = prediction_records(s)
    parsed = rec.select(F.filter("headers", lambda h: h["key"] == "sample_id")[0]["value"].cast("string")
                        .cast("long").alias("vec_id"),
                        F.from_json(F.col("value").cast("string"), "values array<double>")["values"].alias("v"))
    return parsed.select("vec_id", F.size("v").alias("n_values"), argmax("v").alias("pred"))


def _a12_sql():
    from kelpie.plans.q_metrics import ORACLE_A12
    return ORACLE_A12


@register("s22_export_run", _a12_sql())
def s22(spark, sf):
    from kelpie.plans.q_metrics import a12
    path = scratch_path(spark, f"exports/run-{uuid.uuid4().hex}")
    FS.export_run(a12(spark, sf), path)
    back = spark.read.schema("result long, metric string, series string, epoch int, value double").json(path)
    return back


@register("s15_model_sources", """
SELECT CASE p_size % 3 WHEN 0 THEN '28 28' WHEN 1 THEN '784' ELSE '32 32 3' END AS input_shape,
       CAST(p_size % 10 + 1 AS VARCHAR) AS output_shape,
       CASE WHEN p_size > 45 THEN 'fed' || CAST(p_partkey % 13 AS VARCHAR) END AS federated_string_id,
       CAST(p_retailprice * 100 AS BIGINT) AS min_data, CASE WHEN p_type = 'SMALL' THEN 'pth' ELSE 'tf' END AS framework,
       p_size % 5 = 4 AS distributed,
       CASE WHEN p_brand = 'Brand#1' THEN '{"net": "x"}' ELSE '{}' END AS blockchain FROM part""")
def s15(spark, sf):
    from kelpie.plans.q_federated import MODEL_REQ_COLS
    m = t(spark, sf, "part").selectExpr(*[f"{e} AS {k}" for k, e in MODEL_REQ_COLS.items()])
    log = FD.model_requirement(m).select(F.encode("requirement_json", "UTF-8").alias("value"))
    return model_sources(log).select("input_shape", "output_shape", "federated_string_id", "min_data",
                                     "framework", "distributed", "blockchain")


@register("s15_fed_datasources", """
SELECT 'orders-' || o_orderstatus AS topic, 'fed' || CAST(o_custkey % 13 AS VARCHAR) AS federated_string_id,
       o_orderkey AS total_msg, CASE WHEN o_orderkey % 2 = 0 THEN 'RAW' ELSE 'AVRO' END AS input_format,
       o_orderkey % 5 = 0 AS incremental, 0.1::DOUBLE AS validation_rate,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE '{"0": 1.0}' END AS label_weights,
       o_orderkey % 7 = 0 AS announced_now FROM orders""")
def s15_fed_datasources(spark, sf):
    """Federated data log -> datasource rows; a record without a time gets the read time."""
    o = t(spark, sf, "orders")
    rec = o.select(
        F.concat(F.lit("orders-"), "o_orderstatus").alias("topic"),
        F.concat(F.lit("fed"), (F.col("o_custkey") % 13).cast("string")).alias("federated_string_id"),
        F.col("o_orderkey").alias("total_msg"), F.when(F.col("o_orderkey") % 2 == 0, "RAW").otherwise("AVRO").alias("input_format"),
        (F.col("o_orderkey") % 5 == 0).alias("incremental"), F.lit(0.1).alias("validation_rate"),
        F.when(F.col("o_orderkey") % 3 != 0, F.lit('{"0": 1.0}')).alias("label_weights"),
        F.when(F.col("o_orderkey") % 7 != 0, F.lit("2020-01-01T00:00:00.000Z")).alias("timestamp"))
    log = rec.select(F.encode(F.to_json(F.struct(*rec.columns)), "UTF-8").alias("value"))
    return fed_datasources(log).withColumn("announced_now", F.col("timestamp") > F.lit("2021-01-01").cast("timestamp")) \
        .select("topic", "federated_string_id", "total_msg", "input_format", "incremental", "validation_rate", "label_weights",
                "announced_now")


@register("x01_model_registry")
def x01(spark, sf):
    """Every registered model spec fits two epochs on the embeddings data set."""
    ds = DATASETS["embeddings"](spark, sf).training()
    rows = []
    for name in ("softmax_regression", "mlp", "multi_exit"):
        spec = TR.MODEL_SPECS[name]()
        res = TR.fit(ds, spec, epochs=2, lr=0.5)
        rows.append((name, float(res.history[0][3]), float(res.history[-2][3])))
    return spark.createDataFrame(rows, "model string, first_loss double, last_loss double")


@register("x03_dataset_plugin", """
WITH r AS (SELECT vec_id, label, row_number() OVER (ORDER BY md5('13:' || CAST(vec_id AS VARCHAR)), vec_id) - 1 AS rank,
                 count(*) OVER () AS n FROM embeddings),
s AS (SELECT *, floor((1 - (0.0::DOUBLE + 0.2::DOUBLE)) * n) AS tr0, floor(0.2::DOUBLE * n) AS te FROM r)
SELECT label, count(*) AS n FROM s WHERE rank < tr0 + (n - (tr0 + te)) GROUP BY label""")
def x03(spark, sf):
    return DATASETS["embeddings"](spark, sf).training().groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@register("x04_strategy_plugin", """
WITH w AS (SELECT CAST(vec_id % 4 AS VARCHAR) AS model_id, CAST(vec_id // 4 AS INTEGER) AS layer,
                  CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, CAST(unnest(embedding) AS DOUBLE) AS v
           FROM embeddings)
SELECT layer, pos, round(median(v), 6) AS value FROM w GROUP BY layer, pos""")
def x04(spark, sf):
    """A strategy plugged in by name: the median over all models, number by number."""
    from kelpie.plans.q_federated import GLOBAL, _long, weights

    def median(w, _):
        long = w.select("layer", F.posexplode("values").alias("pos", "v")).groupBy("layer", "pos").agg(F.median("v").alias("v"))
        return long.groupBy("layer").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "v"))), lambda s: s["v"]).alias("values"))

    FD.register_strategy("Median", median)
    return _long(FD.aggregate(weights(spark, sf), "Median", GLOBAL))
