"""Codec, feature and topic-source queries (S01-S12, S14-S24 partly, P01-P15, X02)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpie.functions import codecs as C
from kelpie.functions import features as X
from kelpie.plans.fixtures import embeddings_log, events_log, header_value, published_events, t
from kelpie.plans.registry import register
from kelpie.sources import topics as TP

_Q8 = "CAST(floor((CAST(x AS DOUBLE) + 1) * 127.5) AS INTEGER)"


def _quantized(spark, sf):
    em = t(spark, sf, "embeddings")
    return em.select("vec_id", "label", F.transform("embedding", lambda x: F.floor((x.cast("double") + 1) * 127.5)
                                                     .cast("int")).alias("q"), "embedding")


@register("p01_decode_raw", """
SELECT vec_id, label, 8 AS n_rows, 8 AS n_cols, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))), 6) AS total
FROM embeddings""")
def p01(spark, sf):
    log = embeddings_log(spark, sf)
    d = C.decode_raw(log, "float32", "8 8", "int32", "")
    return d.select(header_value("sample_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"),
                    F.size("features").alias("n_rows"), F.size(F.col("features")[0]).alias("n_cols"),
                    F.round(F.aggregate(F.flatten("features"), F.lit(0.0), lambda a, x: a + x.cast("double")), 6).alias("total"))


@register("p01_decode_raw_uint8", f"""
SELECT vec_id, CAST(list_sum(list_transform(embedding, lambda x: {_Q8})) AS BIGINT) AS total,
       list_max(list_transform(embedding, lambda x: {_Q8})) AS top FROM embeddings""")
def p01u(spark, sf):
    q = _quantized(spark, sf).select("vec_id", C.encode_raw_col("q", "uint8").alias("value"))
    d = q.select("vec_id", C.decode_raw_col("value", "uint8").alias("v"))
    return d.select("vec_id", F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"),
                    F.array_max("v").cast("int").alias("top"))


@register("p02_collapse_label", "SELECT vec_id, label FROM embeddings")
def p02(spark, sf):
    log = embeddings_log(spark, sf)
    return log.select(header_value("sample_id").cast("long").alias("vec_id"),
                      C.collapse_label(C.decode_raw_col("key", "int32")).alias("label"))


COPD_SCHEMA = ("{'type': 'record', 'name': 'data', 'fields': [{'name': 'gender', 'type': 'float'}, "
               "{'name': 'age', 'type': 'float'}, {'name': 'smoking', 'type': 'float'}]}")
COPD_LABEL = "{'type': 'record', 'name': 'label', 'fields': [{'name': 'diagnosis', 'type': 'boolean'}]}"


def _copd(spark, sf):
    ev = t(spark, sf, "events")
    return ev.select("event_id", (F.col("user_id") % 2).cast("float").alias("gender"),
                     F.col("value").cast("float").alias("age"),
                     (F.get_json_object("props", "$.k").cast("double") / 100).cast("float").alias("smoking"),
                     (F.col("event_type") == "error").alias("diagnosis"))


@register("p03_decode_avro", """
SELECT event_id, CAST(CAST(user_id % 2 AS FLOAT) AS DOUBLE) AS gender, round(CAST(CAST(value AS FLOAT) AS DOUBLE), 6) AS age,
       round(CAST(CAST(CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 AS FLOAT) AS DOUBLE), 6) AS smoking,
       CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM events""")
def p03(spark, sf):
    enc = C.encode_avro(_copd(spark, sf), ["gender", "age", "smoking"], COPD_SCHEMA, ["diagnosis"], COPD_LABEL)
    d = C.decode_avro(enc.select("event_id", "key", "value"), COPD_SCHEMA, COPD_LABEL)
    f = F.col("features")
    return d.select("event_id", f[0].alias("gender"), F.round(f[1], 6).alias("age"), F.round(f[2], 6).alias("smoking"),
                    F.col("label").cast("double").alias("label"))


@register("s05_encode_avro", "SELECT event_id, 12 AS value_bytes, 1 AS key_bytes FROM events")
def s05(spark, sf):
    enc = C.encode_avro(_copd(spark, sf), ["gender", "age", "smoking"], COPD_SCHEMA, ["diagnosis"], COPD_LABEL)
    return enc.select("event_id", F.length("value").alias("value_bytes"), F.length("key").alias("key_bytes"))


@register("p04_decode_json", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def p04(spark, sf):
    log = events_log(spark, sf)
    d = C.decode_json(log, T.StructType([T.StructField("k", T.IntegerType())]))
    return d.select(header_value("sample_id").cast("long").alias("event_id"), F.col("decoded.k").alias("k"))


@register("p05_decode_telegraf", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def p05(spark, sf):
    ev = t(spark, sf, "events")
    wrapped = ev.select("event_id", F.to_json(F.struct(F.struct(F.col("props").alias("value")).alias("fields"),
                                                       F.lit("sensor").alias("name"))).alias("value"))
    d = C.decode_telegraf(wrapped, "k int")
    return d.select("event_id", F.col("decoded.k").alias("k"))


@register("p06_scale_one_hot", f"""
SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: CAST(CAST({_Q8} / 255.0 AS FLOAT) AS DOUBLE))), 4) AS scaled_sum,
       label AS hot_index, 1.0::DOUBLE AS hot_sum FROM embeddings""")
def p06(spark, sf):
    q = _quantized(spark, sf)
    s = X.flatten_scale("q", 255.0)
    oh = X.one_hot("label", 10)
    return q.select("vec_id", F.round(F.aggregate(s, F.lit(0.0), lambda a, x: a + x.cast("double")), 4).alias("scaled_sum"),
                    (F.array_position(oh, F.lit(1.0)) - 1).cast("int").alias("hot_index"),
                    F.aggregate(oh, F.lit(0.0), lambda a, x: a + x.cast("double")).alias("hot_sum"))


@register("p07_argmax", "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax FROM embeddings")
def p07(spark, sf):
    return t(spark, sf, "embeddings").select("vec_id", X.argmax("embedding").alias("argmax"))


@register("p08_key_to_int", "SELECT event_id, event_id AS key_int, user_id AS user_key FROM events")
def p08(spark, sf):
    ev = t(spark, sf, "events")
    k = ev.select("event_id", "user_id", C.key_bytes("event_id", "int", width=8).alias("k"),
                  C.key_bytes("user_id", "int", width=8).alias("u"))
    return k.select("event_id", C.key_to_int("k").alias("key_int"), C.key_to_int("u").alias("user_key"))


@register("s02_key_bytes", """
SELECT event_id, upper(hex(event_type)) AS type_hex, CASE WHEN user_id < 256 THEN printf('%02X', user_id) END AS user_hex,
       CASE WHEN event_id > 255 THEN 'does not fit 1 byte(s)' END AS id_error FROM events""")
def s02(spark, sf):
    ev = t(spark, sf, "events")
    return ev.select("event_id", F.hex(C.key_bytes("event_type", "str")).alias("type_hex"),
                     F.hex(C.key_bytes("user_id", "int")).alias("user_hex"),
                     C.key_bytes_error("event_id", "int").alias("id_error"))


@register("p09_ms_to_iso", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso FROM events")
def p09(spark, sf):
    ev = t(spark, sf, "events")
    return ev.select("event_id", X.ms_to_iso(F.unix_millis(F.col("ts").cast("timestamp"))).alias("iso"))


_MEAS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("p10_standard_scaling", "WITH s AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS s_{c}" for c in _MEAS)
    + " FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-06-17') SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in _MEAS) + " FROM lineitem, s")
def p10(spark, sf):
    li = t(spark, sf, "lineitem")
    params = X.fit_scaler(li.where(F.col("l_shipdate") < F.lit("1995-06-17").cast("timestamp_ntz")), _MEAS)
    s = X.apply_scaler(li, params)
    return s.select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in _MEAS])


@register("p11_parse_softmax", """
WITH p AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)) AS v FROM embeddings)
SELECT vec_id, CAST(list_position(v, list_max(v)) - 1 AS INTEGER) AS cls, round(list_max(v), 6) AS confidence FROM p""")
def p11(spark, sf):
    em = t(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double") * x.cast("double")).alias("v"))
    c, p = X.parse_prediction("v", "softmax")
    return em.select("vec_id", c.alias("cls"), F.round(p, 6).alias("confidence"))


@register("p11_parse_sigmoid", """
SELECT event_id, CASE WHEN value / 500 > 0.5 THEN 1 ELSE 0 END AS cls,
       round(CASE WHEN value / 500 > 0.5 THEN value / 500 ELSE 1 - value / 500 END, 6) AS confidence FROM events""")
def p11s(spark, sf):
    ev = t(spark, sf, "events").select("event_id", F.array(F.col("value") / 500).alias("v"))
    c, p = X.parse_prediction("v", "sigmoid")
    return ev.select("event_id", c.alias("cls"), F.round(p, 6).alias("confidence"))


_SHAPE = "'(None, ' || CASE p_size % 3 WHEN 0 THEN '28, 28' WHEN 1 THEN '784' ELSE '32, 32, 3' END || ')'"


@register("p12_shape_text", """
SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN '28 28' WHEN 1 THEN '784' ELSE '32 32 3' END AS shape,
       'float32' AS data_type, CASE p_size % 3 WHEN 0 THEN '28 28' WHEN 1 THEN '784' ELSE '32 32 3' END AS data_reshape,
       'uint8' AS label_type FROM part""")
def p12(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", F.expr(_SHAPE).alias("raw"),
                                    F.lit('{"data_type": "uint8", "label_type": "uint8", "data_reshape": "1"}').alias("cfg"))
    p = p.withColumn("shape", X.shape_text("raw")).withColumn("child", X.child_config("cfg", F.col("shape")))
    return p.select("p_partkey", "shape", F.get_json_object("child", "$.data_type").alias("data_type"),
                    F.get_json_object("child", "$.data_reshape").alias("data_reshape"),
                    F.get_json_object("child", "$.label_type").alias("label_type"))


@register("p13_map_names", """
SELECT e.event_id, coalesce(n.n_name, CAST(e.user_id % 30 AS VARCHAR)) AS code_name
FROM events e LEFT JOIN nation n ON n.n_nationkey = e.user_id % 30""")
def p13(spark, sf):
    ev = t(spark, sf, "events").select("event_id", (F.col("user_id") % 30).alias("code"))
    m = X.map_names(ev, "code", t(spark, sf, "nation"), "n_nationkey", "n_name", out="code_name")
    return m.select("event_id", "code_name")


@register("p14_split_metric", """
WITH h AS (SELECT event_id, CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 50 THEN 'val_' || event_type
                                 ELSE event_type END AS metric FROM events)
SELECT event_id, CASE WHEN starts_with(metric, 'val_') THEN 'validation' ELSE 'training' END AS split,
       CASE WHEN starts_with(metric, 'val_') THEN substr(metric, 5) ELSE metric END AS name FROM h""")
def p14(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    h = t(spark, sf, "events").select("event_id", F.when(k < 50, F.concat(F.lit("val_"), "event_type"))
                                      .otherwise(F.col("event_type")).alias("metric"))
    s, n = X.split_metric("metric")
    return h.select("event_id", s.alias("split"), n.alias("name"))


@register("p15_shorten", """
SELECT doc_id, regexp_replace(substr(text, 1, 40), '^\\s+|\\s+$', '', 'g') || '...' AS short FROM documents""")
def p15(spark, sf):
    return t(spark, sf, "documents").select("doc_id", X.shorten("text", 40).alias("short"))


@register("x02_transforms", """
SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * 2)), 6) AS total, label + 1 AS label
FROM embeddings""")
def x02(spark, sf):
    em = t(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("features"), "label")
    d = X.with_transforms(em, lambda c: F.transform(c, lambda x: x.cast("double") * 2), lambda c: c + 1)
    return d.select("vec_id", F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + x), 6).alias("total"), "label")


# ----------------------------------------------------------- topic sources ----

_DENSE = "row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1"


@register("s01_append_topic", f"""
SELECT event_id, CAST(user_id % 4 AS INTEGER) AS partition, {_DENSE} AS "offset", event_type AS key_text,
       CAST(octet_length(encode(props)) AS INTEGER) AS value_bytes FROM events""")
def s01(spark, sf):
    log = events_log(spark, sf)
    return log.select(header_value("sample_id").cast("long").alias("event_id"), "partition", "offset",
                      F.col("key").cast("string").alias("key_text"), F.length("value").alias("value_bytes"))


@register("s03_encode_raw", f"""
SELECT vec_id, array_to_string(list_transform(embedding, lambda x: printf('%02X', {_Q8})), '') AS value_hex,
       printf('%02X000000', label) AS key_hex FROM embeddings""")
def s03(spark, sf):
    q = _quantized(spark, sf)
    e = C.encode_raw(q, "q", "label", "uint8", "int32")
    return e.select("vec_id", F.hex("value").alias("value_hex"), F.hex("key").alias("key_hex"))


@register("s04_infer_format", """
SELECT 'float32' AS data_type, 'int32' AS label_type,
       CASE WHEN min(len(embedding)) = max(len(embedding)) THEN CAST(min(len(embedding)) AS VARCHAR) ELSE 'ragged' END AS data_reshape,
       '1' AS label_reshape FROM embeddings""")
def s04(spark, sf):
    return C.infer_format(t(spark, sf, "embeddings"), "embedding", "label")


def _snapshot_sql():
    return """WITH m AS (SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) / 2 AS mid FROM events),
o AS (SELECT CAST(user_id % 4 AS INTEGER) AS partition, epoch_us(ts) AS us FROM events),
e AS (SELECT partition, count(*) AS "end", count(*) FILTER (WHERE us < (SELECT CAST(mid AS BIGINT) FROM m)) AS prev
      FROM o GROUP BY partition)"""


@register("s06_topic_ranges", _snapshot_sql() + """
SELECT 'events' AS topic, partition, prev AS start, "end", "end" - prev AS n FROM e""")
def s06(spark, sf):
    from kelpie.plans.q_relational import _midpoint_snapshot
    log = published_events(spark, sf)
    return TP.topic_ranges(log, since=_midpoint_snapshot(spark, sf, log))


@register("s07_ranges_to_string", _snapshot_sql() + """
SELECT string_agg('events:' || CAST(partition AS VARCHAR) || ':' || CAST(prev AS VARCHAR) || ':' || CAST("end" AS VARCHAR), ','
                  ORDER BY partition) AS ranges FROM e""")
def s07(spark, sf):
    from kelpie.plans.q_relational import _midpoint_snapshot
    log = published_events(spark, sf)
    return TP.ranges_to_string(TP.topic_ranges(log, since=_midpoint_snapshot(spark, sf, log)))


@register("s07_string_to_ranges", _snapshot_sql() + """
SELECT 'events' AS topic, partition, prev AS start, "end" FROM e""")
def s07p(spark, sf):
    txt = s07(spark, sf)
    return TP.string_to_ranges(txt, "ranges").select("topic", "partition", "start", "end")


_EMB_CTRL = """WITH p AS (SELECT CAST(vec_id % 4 AS INTEGER) AS partition, count(*) AS n FROM embeddings GROUP BY 1)"""


@register("s08_batch_control", _EMB_CTRL + """
SELECT CAST(1 AS BIGINT) AS deployment_id, string_agg('embeddings:' || CAST(partition AS VARCHAR) || ':0:' || CAST(n AS VARCHAR), ',' ORDER BY partition) AS topic,
       CAST(sum(n) AS BIGINT) AS total_msg, false AS incremental, 'RAW' AS input_format, 0.1::DOUBLE AS validation_rate,
       0.2::DOUBLE AS test_rate FROM p""")
def s08(spark, sf):
    c = TP.control_record(TP.topic_ranges(embeddings_log(spark, sf)), deployment_id=1, input_format="RAW",
                          input_config={"data_type": "float32", "label_type": "int32", "data_reshape": "64",
                                        "label_reshape": ""}, validation_rate=0.1, test_rate=0.2)
    return c.select("deployment_id", "topic", "total_msg", "incremental", "input_format", "validation_rate", "test_rate")


@register("s08_control_body", _EMB_CTRL + """
SELECT '0000000000000001' AS key_hex, string_agg('embeddings:' || CAST(partition AS VARCHAR) || ':0:' || CAST(n AS VARCHAR), ',' ORDER BY partition) AS topic,
       CAST(sum(n) AS BIGINT) AS total_msg, 'float32' AS data_type, '64' AS data_reshape, 'embeddings' AS description FROM p""")
def s08_body(spark, sf):
    """The published record itself: key bytes of the deployment and the fields of its JSON body."""
    c = TP.control_record(TP.topic_ranges(embeddings_log(spark, sf)), deployment_id=1, description="embeddings",
                          input_config={"data_type": "float32", "label_type": "int32", "data_reshape": "64", "label_reshape": ""},
                          validation_rate=0.1, test_rate=0.2)
    body = F.col("value").cast("string")
    config = F.get_json_object(body, "$.input_config")
    return TP.control_to_log(c).select(
        F.hex("key").alias("key_hex"), F.get_json_object(body, "$.topic").alias("topic"),
        F.get_json_object(body, "$.total_msg").cast("long").alias("total_msg"), F.get_json_object(config, "$.data_type").alias("data_type"),
        F.get_json_object(config, "$.data_reshape").alias("data_reshape"), F.get_json_object(body, "$.description").alias("description"))


def _pool_log(spark, sf):
    pool = t(spark, sf, "documents").join(t(spark, sf, "labels"), "doc_id", "left_anti")
    return TP.append_unlabelled(pool, "pool", value=F.encode("text", "UTF-8"), partition=F.lit(0), order="doc_id",
                                timestamp=F.lit("2024-01-01").cast("timestamp"))


@register("s09_online_control", """
WITH p AS (SELECT count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
e AS (SELECT CAST(user_id % 4 AS INTEGER) AS partition, count(*) AS n FROM events GROUP BY 1)
SELECT (SELECT string_agg('events:' || CAST(partition AS VARCHAR) || ':0:' || CAST(n AS VARCHAR), ',' ORDER BY partition)
        FROM e) AS topic,
       'pool:0:0:' || CAST(p.n AS VARCHAR) AS unsupervised_topic,
       (SELECT CAST(sum(n) AS BIGINT) FROM e) AS total_msg, true AS incremental FROM p""")
def s09(spark, sf):
    log = events_log(spark, sf)
    c = TP.control_record(TP.topic_ranges(log), deployment_id=2, incremental=True,
                          unsupervised=TP.topic_ranges(_pool_log(spark, sf)))
    return c.select("topic", "unsupervised_topic", "total_msg", "incremental")


@register("s11_append_unlabelled", """
SELECT doc_id, 0 AS partition, row_number() OVER (ORDER BY doc_id) - 1 AS "offset", '00' AS key_hex
FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def s11(spark, sf):
    pool = t(spark, sf, "documents").join(t(spark, sf, "labels"), "doc_id", "left_anti")
    log = TP.append_unlabelled(pool, "pool", value=F.encode("text", "UTF-8"), partition=F.lit(0), order="doc_id",
                               headers=F.array(F.struct(F.lit("sample_id").alias("key"),
                                                        F.encode(F.col("doc_id").cast("string"), "UTF-8").alias("value"))))
    return log.select(header_value("sample_id").cast("long").alias("doc_id"), "partition", "offset",
                      F.hex("key").alias("key_hex"))


@register("s10_publish_federated", """
WITH c AS (SELECT label % 3 AS device, label, count(*) AS cnt FROM embeddings GROUP BY 1, 2),
w AS (SELECT device, label, round(sum(cnt) OVER (PARTITION BY device) / (count(*) OVER (PARTITION BY device) * cnt), 6) AS w FROM c)
SELECT CAST(device AS INTEGER) AS device, CAST(sum(cnt) AS BIGINT) AS total_msg, 'fed' || CAST(device AS VARCHAR) AS federated_string_id,
       string_agg(CAST(label AS VARCHAR) || ':' || CAST(w AS VARCHAR), ',' ORDER BY label) AS label_weights
FROM (SELECT c.device, c.label, c.cnt, w.w FROM c JOIN w USING (device, label)) GROUP BY device""")
def s10(spark, sf):
    _, c = TP.publish_federated(t(spark, sf, "embeddings"), "fed", F.col("label") % 3, "embedding", "label", "vec_id", deployment_id=3,
                                data_type="float32", label_type="int32", restrictions='{"classes": 10}', chunks=2)
    c = c.withColumn("label_weights", F.transform_values("label_weights", lambda k, v: F.round(v, 6)))
    return c.select("device", "total_msg", "federated_string_id", F.array_join(F.transform(
        F.array_sort(F.map_entries(F.col("label_weights").alias("lw"))),
        lambda e: F.concat(e["key"].cast("string"), F.lit(":"), e["value"].cast("string"))), ",").alias("label_weights"))


@register("s12_read_range", f"""
SELECT event_id FROM (SELECT event_id, user_id, {_DENSE} AS o FROM events) WHERE user_id % 4 = 2 AND o >= 100 AND o < 300""")
def s12(spark, sf):
    r = TP.read_range(published_events(spark, sf), "events", 2, 100, 300)
    return r.select(header_value("sample_id").cast("long").alias("event_id"))


@register("s16_replay", """
SELECT CAST(1007 AS BIGINT) AS deployment_id, 'events:' || CAST(7 % 4 AS VARCHAR) || ':' || CAST(min(event_id) AS VARCHAR) || ':'
       || CAST(max(event_id) + 1 AS VARCHAR) AS topic, max(event_id) + 1 - min(event_id) AS total_msg
FROM events WHERE user_id = 7""")
def s16(spark, sf):
    from kelpie.plans.q_relational import user_control_log
    ds = TP.datasources_from_log(user_control_log(spark, sf))
    r = TP.replay(ds, F.lit(7), F.lit(1007).cast("long"))
    return r.select("deployment_id", "topic", "total_msg")


@register("s17_inspect", f"""
SELECT CAST(user_id % 4 AS INTEGER) AS partition, o AS "offset", event_type AS key_text, upper(hex(event_type)) AS key_hex,
       'json' AS value_kind, props AS value_text, CAST(octet_length(encode(props)) AS INTEGER) AS value_bytes
FROM (SELECT *, {_DENSE} AS o FROM events) ORDER BY o, partition LIMIT 20""")
def s17(spark, sf):
    i = TP.inspect(events_log(spark, sf), 20)
    return i.select("partition", "offset", "key_text", "key_hex", "value_kind", "value_text", "value_bytes")
