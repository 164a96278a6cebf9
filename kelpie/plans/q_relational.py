"""Filter and join queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpie.operators import monitor as W
from kelpie.operators import quality as Q
from kelpie.operators import registry as J
from kelpie.plans.fixtures import events_log, header_value, published_events, t
from kelpie.plans.registry import register
from kelpie.session import scratch_path
from kelpie.sources.topics import (control_record, control_records, control_to_log, datasources_from_log,
                                   read_topic, topic_ranges, write_topic)

# Column rules that turn driver tables into registry tables.  The same SQL
# text is evaluated by Spark (selectExpr) and by the DuckDB oracle.
DS_COLS = {
    "ds_id": "o_orderkey",
    "data_reshape": "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '28 28' WHEN '2' THEN '784' "
                    "WHEN '3' THEN '32 32 3' WHEN '4' THEN '64' ELSE '5' END",
    "restrictions": "CASE WHEN o_orderstatus = 'O' THEN '{\"labels\": ' || CAST(o_custkey % 50 AS STRING) || ', \"kind\": \"O\"}' "
                    "ELSE '{\"kind\": \"' || o_orderstatus || '\", \"labels\": ' || CAST(o_custkey % 50 AS STRING) || '}' END",
    "total_msg": "CAST(o_totalprice AS BIGINT)",
    "incremental": "o_orderstatus = 'P'",
    "federated_string_id": "CASE WHEN o_orderpriority = '5-LOW' AND o_custkey % 7 = 0 "
                           "THEN 'fed' || CAST(o_custkey % 13 AS STRING) END",
}
MODEL_COLS = {
    "model_id": "p_partkey",
    "input_shape": "CASE p_size % 5 WHEN 0 THEN '28 28' WHEN 1 THEN '784' WHEN 2 THEN '32 32 3' "
                   "WHEN 3 THEN '64' ELSE '32 32 3 7' END",
    "data_restriction": "'{\"kind\": \"' || CASE p_partkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END "
                        "|| '\", \"labels\": ' || CAST(p_partkey % 50 AS STRING) || '}'",
    "min_data": "CAST(p_retailprice * 100 AS BIGINT)",
    "distributed": "(p_size % 5 = 4 OR p_type = 'SMALL')",
    "blockchain": "CASE WHEN p_brand = 'Brand#1' THEN '{\"net\": \"x\"}' ELSE '{}' END",
    "federated_string_id": "CASE WHEN p_size > 45 THEN 'fed' || CAST(p_partkey % 13 AS STRING) END",
}


def _sel(cols: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {k}" for k, e in cols.items())


def datasources(spark, sf):
    return t(spark, sf, "orders").selectExpr(*[f"{e} AS {k}" for k, e in DS_COLS.items()])


def models(spark, sf):
    return t(spark, sf, "part").selectExpr(*[f"{e} AS {k}" for k, e in MODEL_COLS.items()])


_CASE = ("CASE WHEN NOT m.distributed AND NOT ds.incremental AND m.blockchain = '{}' THEN 1 "
         "WHEN NOT m.distributed AND NOT ds.incremental THEN 5 WHEN NOT m.distributed THEN 2 "
         "WHEN NOT ds.incremental THEN 3 ELSE 4 END")
_MATCH_SQL = f"""WITH ds AS (SELECT {_sel(DS_COLS)} FROM orders),
m0 AS (SELECT {_sel(MODEL_COLS)} FROM part),
m AS (SELECT *, CASE WHEN distributed AND len(string_split(input_shape, ' ')) > 2
              THEN array_to_string(string_split(input_shape, ' ')[1:len(string_split(input_shape, ' ')) - 1], ' ')
              ELSE input_shape END AS eff_shape FROM m0),
a AS (SELECT ds.ds_id, m.model_id, {_CASE} AS "case", true AS by_federated_id
      FROM ds JOIN m ON ds.federated_string_id = m.federated_string_id
      WHERE coalesce(ds.federated_string_id, '') <> '' AND coalesce(m.federated_string_id, '') <> ''),
b AS (SELECT ds.ds_id, m.model_id, {_CASE} AS "case", false AS by_federated_id, ds.total_msg, m.min_data
      FROM ds JOIN m ON ds.data_reshape = m.eff_shape
        AND json_extract_string(ds.restrictions, '$.kind') = json_extract_string(m.data_restriction, '$.kind')
        AND CAST(json_extract(ds.restrictions, '$.labels') AS BIGINT) = CAST(json_extract(m.data_restriction, '$.labels') AS BIGINT)
      WHERE coalesce(ds.federated_string_id, '') = ''),
matches AS (SELECT * FROM a UNION ALL SELECT ds_id, model_id, "case", by_federated_id FROM b
            WHERE "case" IN (2, 4) OR total_msg >= min_data)"""


@register("j01_match", _MATCH_SQL + " SELECT * FROM matches")
def j01(spark, sf):
    return J.match(datasources(spark, sf), models(spark, sf))


@register("j01_match_counts", _MATCH_SQL + """ SELECT ds_id, CAST("case" AS INTEGER) AS "case", count(*) AS n FROM matches GROUP BY 1, 2""")
def j01_counts(spark, sf):
    """How many models each data source matches, without forming the pairs."""
    return J.match_counts(datasources(spark, sf), models(spark, sf)).withColumn("case", F.col("case").cast("int"))


@register("j02_match_by_id", _MATCH_SQL + " SELECT * FROM matches WHERE by_federated_id")
def j02(spark, sf):
    return J.match(datasources(spark, sf), models(spark, sf)).where("by_federated_id")


@register("j03_match_new_models", _MATCH_SQL.replace("FROM orders)", "FROM orders WHERE o_orderstatus <> 'P')")
          + " SELECT * FROM matches")
def j03(spark, sf):
    return J.match_new_models(datasources(spark, sf), models(spark, sf))


@register("j04_training_case", _MATCH_SQL + ' SELECT "case", count(*) AS n FROM matches GROUP BY 1')
def j04(spark, sf):
    return J.match(datasources(spark, sf), models(spark, sf)).groupBy("case").agg(F.count(F.lit(1)).alias("n"))


_DEPLOYMENT_FLAGS = {"distributed": "(p_size % 5 = 4 OR p_type = 'SMALL')", "incremental": "o_orderstatus = 'P'",
                     "federated": "o_orderpriority IN ('1-URGENT', '5-LOW')", "blockchain": "o_custkey % 2 = 0"}


@register("j04_server_case", f"""
WITH r AS (SELECT {", ".join(f"{e} AS {k}" for k, e in _DEPLOYMENT_FLAGS.items())} FROM orders JOIN lineitem ON l_orderkey = o_orderkey
           JOIN part ON p_partkey = l_partkey)
SELECT CAST(CASE WHEN NOT distributed THEN
         CASE WHEN NOT incremental THEN CASE WHEN NOT federated THEN 1 WHEN NOT blockchain THEN 5 ELSE 9 END
              ELSE CASE WHEN NOT federated THEN 2 ELSE 6 END END
       ELSE CASE WHEN NOT incremental THEN CASE WHEN NOT federated THEN 3 ELSE 7 END
            ELSE CASE WHEN NOT federated THEN 4 ELSE 8 END END END AS INTEGER) AS "case", count(*) AS n FROM r GROUP BY 1""")
def j04_server(spark, sf):
    """Every model of every deployment (orders with their line items) by server case."""
    rows = t(spark, sf, "orders").join(t(spark, sf, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey")) \
        .join(t(spark, sf, "part"), F.col("p_partkey") == F.col("l_partkey")) \
        .select(*[F.expr(e).alias(k) for k, e in _DEPLOYMENT_FLAGS.items()])
    return rows.groupBy(J.server_case(*[F.col(k) for k in _DEPLOYMENT_FLAGS]).cast("int").alias("case")).agg(F.count(F.lit(1)).alias("n"))


@register("j05_first_launch", _MATCH_SQL + """,
f AS (SELECT ds.federated_string_id AS fed, x.ds_id, x.model_id,
             row_number() OVER (PARTITION BY ds.federated_string_id ORDER BY x.ds_id, x.model_id) AS rn
      FROM matches x JOIN ds ON ds.ds_id = x.ds_id WHERE x.by_federated_id)
SELECT fed, ds_id, model_id FROM f WHERE rn = 1""")
def j05(spark, sf):
    return J.first_launch_by_id(datasources(spark, sf), models(spark, sf))


@register("j06_expand_results", """
SELECT o.o_orderkey AS deployment, l.l_partkey AS model, 'created' AS status
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey""")
def j06(spark, sf):
    dep = t(spark, sf, "orders").select(F.col("o_orderkey").alias("configuration"), F.col("o_orderkey").alias("deployment"))
    cm = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("configuration"), F.col("l_partkey").alias("model"))
    return J.expand_results(dep, cm, "configuration").select("deployment", "model", "status")


@register("j07_model_chain", """
WITH RECURSIVE m AS (SELECT p_partkey AS id, p_partkey // 2 AS parent FROM part),
roots AS (SELECT p_partkey AS id FROM part),
chain(root, id, depth) AS (SELECT id, id, 0 FROM roots
  UNION ALL SELECT c.root, m.id, c.depth + 1 FROM chain c JOIN m ON m.parent = c.id AND m.id <> m.parent)
SELECT root, id AS model_id, depth FROM chain""")
def j07(spark, sf):
    part = t(spark, sf, "part")
    ms = part.select(F.col("p_partkey").alias("model_id"),
                     F.when(F.col("p_partkey") != F.expr("p_partkey div 2"), F.expr("p_partkey div 2")).alias("father_id"))
    roots = part.select(F.col("p_partkey").alias("model_id"))
    return J.model_chain(spark, ms, roots).select("root", "model_id", F.col("depth").cast("int").alias("depth"))


@register("j08_nested_view", """
SELECT c.c_custkey, c.c_name, o.o_orderkey, o.o_orderstatus,
       row_number() OVER (PARTITION BY c.c_custkey ORDER BY o.o_orderkey) - 1 AS child_idx,
       count(o.o_orderkey) OVER (PARTITION BY c.c_custkey) AS n_children
FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey
UNION ALL SELECT c_custkey, c_name, NULL, NULL, NULL, 0 FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def j08(spark, sf):
    cust = t(spark, sf, "customer").select("c_custkey", "c_name")
    o = t(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus")
    v = J.nested_view(cust, o, "c_custkey", "o_orderkey")
    return v.select("c_custkey", "c_name", "o_orderkey", "o_orderstatus", "child_idx", "n_children")


@register("j09_suggest_input", """
WITH inf AS (SELECT o_orderkey, 'RAW' AS input_format, '{"data_type": "float32"}' AS input_config FROM orders WHERE o_orderstatus = 'F'),
ds AS (SELECT l_orderkey AS o_orderkey, CASE WHEN l_returnflag = 'R' THEN 'AVRO' ELSE 'RAW' END AS input_format,
              '{"data_reshape": "' || CAST(l_linenumber AS VARCHAR) || '"}' AS input_config
       FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC) AS rn FROM lineitem)
       WHERE rn = 1)
SELECT o.o_orderkey, coalesce(inf.input_format, ds.input_format, '') AS input_format,
       coalesce(inf.input_config, ds.input_config, '') AS input_config
FROM orders o LEFT JOIN inf ON inf.o_orderkey = o.o_orderkey LEFT JOIN ds ON ds.o_orderkey = o.o_orderkey""")
def j09(spark, sf):
    o = t(spark, sf, "orders")
    inf = o.where(F.col("o_orderstatus") == "F").select(
        "o_orderkey", F.lit("RAW").alias("input_format"), F.lit('{"data_type": "float32"}').alias("input_config"))
    li = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", "l_linenumber", "l_returnflag")
    last = W.latest(li, "o_orderkey", "l_shipdate", tiebreak="l_linenumber")
    ds = last.select("o_orderkey", F.when(F.col("l_returnflag") == "R", "AVRO").otherwise("RAW").alias("input_format"),
                     F.concat(F.lit('{"data_reshape": "'), F.col("l_linenumber").cast("string"), F.lit('"}')).alias("input_config"))
    return J.suggest_input(o.select("o_orderkey"), inf, ds, "o_orderkey")


@register("j10_deletable", """
SELECT p_partkey, p_partkey IN (SELECT l_partkey FROM lineitem) AS in_use FROM part""")
def j10(spark, sf):
    part = t(spark, sf, "part").select("p_partkey")
    cm = t(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    return J.deletable(part, cm, "p_partkey").withColumn("in_use", F.lit(False)).unionByName(
        J.in_use(part, cm, "p_partkey").withColumn("in_use", F.lit(True)))


@register("j11_remaining", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def j11(spark, sf):
    return J.remaining(t(spark, sf, "documents").select("doc_id"), t(spark, sf, "labels"), "doc_id")


J12_WEIGHTS = {"0": 3.0, "1": 0.6, "x": 2.0, "2": "bad"}


@register("j12_sample_weight", """
SELECT doc_id, quality, CASE quality WHEN 0 THEN 3.0 WHEN 1 THEN 0.6 ELSE 1.0 END::DOUBLE AS weight FROM labels""")
def j12(spark, sf):
    return J.with_sample_weight(t(spark, sf, "labels").select("doc_id", "quality"), J12_WEIGHTS, label="quality")


@register("j13_attach_truth", """
SELECT event_id, event_type AS predicted, event_type AS truth, true AS correct FROM events""")
def j13(spark, sf):
    pred = events_log(spark, sf).select(header_value("sample_id").cast("long").alias("sample_id"),
                                        F.col("key").cast("string").alias("predicted"))
    truth = t(spark, sf, "events").select(F.col("event_id").alias("sample_id"), F.col("event_type").alias("truth"))
    j = J.attach_truth(pred, truth, "sample_id")
    return j.select(F.col("sample_id").alias("event_id"), "predicted", "truth",
                    (F.col("predicted") == F.col("truth")).alias("correct"))


@register("j13_truth_by_position", """
WITH p AS (SELECT event_id, event_type AS predicted, user_id % 3 AS topic,
                  row_number() OVER (PARTITION BY user_id % 3 ORDER BY md5(CAST(event_id AS VARCHAR))) AS i FROM events),
v AS (SELECT o_orderkey, o_orderstatus AS truth, o_custkey % 3 AS topic,
             row_number() OVER (PARTITION BY o_custkey % 3 ORDER BY o_totalprice DESC, o_orderkey) AS i FROM orders)
SELECT p.topic, p.i AS "index", event_id, o_orderkey, predicted, truth FROM p JOIN v ON p.topic = v.topic AND p.i = v.i""")
def j13_position(spark, sf):
    """The i-th prediction of a topic meets its i-th truth; both in an order of their own."""
    pred = t(spark, sf, "events").select((F.col("user_id") % 3).alias("topic"), "event_id", F.col("event_type").alias("predicted"),
                                         F.md5(F.col("event_id").cast("string")).alias("sent"))
    truth = t(spark, sf, "orders").select((F.col("o_custkey") % 3).alias("topic"), "o_orderkey", F.col("o_orderstatus").alias("truth"),
                                          (-F.col("o_totalprice")).alias("rank"))
    j = J.attach_truth_by_position(pred, truth, ["sent"], ["rank", "o_orderkey"], by="topic")
    return j.select("topic", "index", "event_id", "o_orderkey", "predicted", "truth")


def _midpoint_snapshot(spark, sf, log):
    """Ends per partition of what was published before the mid time of the stream."""
    ev = t(spark, sf, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    mid = ev.agg(((F.min(us) + F.max(us)) / 2).cast("long").alias("mid"))
    before = log.withColumn("_g", F.lit(0)).join(F.broadcast(mid.withColumn("_g", F.lit(0))), "_g") \
        .where(F.unix_micros("timestamp") < F.col("mid")).drop("_g", "mid")
    return topic_ranges(before).select("topic", "partition", "end")


@register("j14_control_records", """
WITH m AS (SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) / 2 AS mid FROM events)
SELECT CAST(user_id % 4 AS INTEGER) AS partition, count(*) AS n, min(event_id) AS first_event, max(event_id) AS last_event
FROM events, m WHERE epoch_us(ts) >= CAST(m.mid AS BIGINT) GROUP BY 1""")
def j14(spark, sf):
    log = published_events(spark, sf)
    ranges = topic_ranges(log, since=_midpoint_snapshot(spark, sf, log))
    rec = control_records(ranges.select("topic", "partition", "start", "end"), log)
    eid = header_value("sample_id").cast("long")
    return rec.groupBy("partition").agg(F.count(F.lit(1)).alias("n"), F.min(eid).alias("first_event"),
                                        F.max(eid).alias("last_event"))


@register("j14_pruned_read", """
WITH b AS (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events),
r(tag, s, e) AS (SELECT 'old', lo, lo + (hi - lo) // 10 FROM b UNION ALL SELECT 'new', hi - (hi - lo) // 20, hi + 1 FROM b
                 UNION ALL SELECT 'none', lo, lo FROM b)
SELECT r.tag, CAST(user_id % 4 AS INTEGER) AS partition, count(*) AS n, min(event_id) AS first_event, max(event_id) AS last_event
FROM events JOIN r ON event_id >= r.s AND event_id < r.e GROUP BY 1, 2""")
def j14_pruned(spark, sf):
    """Ranges read from a topic table laid out by offset: only the folders they name are read."""
    bucket = 1 << 14
    path = scratch_path(spark, f"j14-topic-{uuid.uuid4().hex}")
    write_topic(events_log(spark, sf, dense=False), path, bucket=bucket)
    log = read_topic(spark, path, bucketed=True)
    b = t(spark, sf, "events").agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    lo, hi = int(b["lo"]), int(b["hi"])
    ranges = spark.createDataFrame(
        [("events", p, s, e, tag) for p in range(4)
         for tag, s, e in (("old", lo, lo + (hi - lo) // 10), ("new", hi - (hi - lo) // 20, hi + 1), ("none", lo, lo))],
        "topic string, partition int, start long, end long, tag string")
    rec = control_records(ranges, log, bucket)
    return rec.groupBy("tag", "partition").agg(F.count(F.lit(1)).alias("n"), F.min("offset").alias("first_event"),
                                               F.max("offset").alias("last_event"))


def user_control_log(spark, sf):
    """One control record per user (deployment id = user id) over its events."""
    log = events_log(spark, sf, dense=False).withColumn("user_id", header_value("user_id").cast("long"))
    r = log.groupBy("topic", "partition", "user_id").agg(F.min("offset").alias("start"),
                                                          (F.max("offset") + 1).alias("end"),
                                                          F.max("timestamp").alias("ts"))
    ctrl = control_record(r, by=["user_id"], deployment_id="user_id", input_format="RAW",
                          input_config={"data_type": "float32", "data_reshape": "1"},
                          validation_rate=0.1, test_rate=0.1, timestamp=F.col("ts")).drop("user_id")
    return control_to_log(ctrl)


_USER_CONTROL_SQL = """WITH c AS (SELECT user_id AS deployment_id,
  'events:' || CAST(user_id % 4 AS VARCHAR) || ':' || CAST(min(event_id) AS VARCHAR) || ':' || CAST(max(event_id) + 1 AS VARCHAR) AS topic,
  max(event_id) + 1 - min(event_id) AS total_msg, strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS time
  FROM events GROUP BY user_id)"""


@register("s14_datasources_from_log", _USER_CONTROL_SQL + """
SELECT deployment_id, topic, total_msg, 'RAW' AS input_format, 0.1::DOUBLE AS validation_rate, time FROM c""")
def s14(spark, sf):
    ds = datasources_from_log(user_control_log(spark, sf))
    return ds.select("deployment_id", "topic", "total_msg", "input_format", "validation_rate", "time")


@register("f01_for_deployment", _USER_CONTROL_SQL + " SELECT deployment_id, topic, total_msg FROM c WHERE deployment_id = 7")
def f01(spark, sf):
    ctl = Q.for_deployment(user_control_log(spark, sf), 7)
    return datasources_from_log(ctl).select("deployment_id", "topic", "total_msg")


@register("f02_confident", """
SELECT vec_id, round(list_max(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))), 6) AS conf
FROM embeddings WHERE list_max(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) >= 0.1""")
def f02(spark, sf):
    em = t(spark, sf, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double") * x.cast("double")).alias("values"))
    return Q.confident(em, 0.1).select("vec_id", F.round(F.array_max("values"), 6).alias("conf"))


_CORRUPT = "CASE WHEN event_type = 'error' THEN substr(props, 2) ELSE props END"


@register("f03_dead_letter", f"""
WITH v AS (SELECT event_id, {_CORRUPT} AS payload FROM events)
SELECT event_id, CASE WHEN json_valid(payload) THEN CAST(json_extract(payload, '$.k') AS INTEGER) END AS k,
       CASE WHEN json_valid(payload) THEN NULL ELSE 'malformed payload' END AS error FROM v""")
def f03(spark, sf):
    ev = t(spark, sf, "events").select("event_id", F.expr(_CORRUPT).alias("payload"))
    d = Q.with_dead_letter(ev, "payload", T.StructType([T.StructField("k", T.IntegerType())]))
    return d.select("event_id", F.col("decoded.k").alias("k"), "error")


_BAD_SCHEMA = '{"fields": [{"name": "a", "type": "float"}, {"name": "b", "type": "float"}, {"name": "n", "type": "double"}]}'


@register("f03_bad_payloads", """
WITH p AS (SELECT vec_id, f.format, vec_id % 10 AS r, CAST(embedding[1] AS DOUBLE) AS a, CAST(embedding[2] AS DOUBLE) AS b,
                  list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) AS s, len(embedding) AS d
           FROM embeddings, (VALUES ('RAW'), ('AVRO'), ('JSON')) f(format))
SELECT vec_id, format, CASE WHEN r IN (3, 7) THEN NULL WHEN format = 'RAW' THEN round(s, 5) WHEN format = 'AVRO' THEN round(a + b + vec_id, 5)
                            ELSE CAST(vec_id AS DOUBLE) END AS total,
       CASE WHEN r = 7 THEN 'no payload' WHEN r <> 3 THEN NULL
            WHEN format = 'RAW' THEN (4 * d - 1) || ' bytes are no multiple of 4 (float32)'
            WHEN format = 'AVRO' THEN '15 bytes, a record has 16' ELSE 'malformed json' END AS error FROM p""")
def f03_bad(spark, sf):
    """Payloads of every format, a tenth of them cut short and a tenth missing: each bad one alone fails."""
    from kelpie.functions.codecs import encode_avro_col, encode_raw_col, try_decode
    em = t(spark, sf, "embeddings").select("vec_id", "embedding", F.col("embedding")[0].alias("a"), F.col("embedding")[1].alias("b"),
                                           F.col("vec_id").cast("double").alias("n"))
    r = F.col("vec_id") % 10
    payloads = {"RAW": encode_raw_col("embedding", "float32"), "AVRO": encode_avro_col(["a", "b", "n"], _BAD_SCHEMA),
                "JSON": F.to_json(F.struct(F.col("vec_id").alias("k"))).cast("binary")}
    configs = {"RAW": {"data_type": "float32"}, "AVRO": {"data_scheme": _BAD_SCHEMA},
               "JSON": {"schema": T.StructType([T.StructField("k", T.LongType())])}}
    totals = {"RAW": lambda: F.aggregate("decoded", F.lit(0.0), lambda x, y: x + y.cast("double")),
              "AVRO": lambda: F.aggregate("decoded", F.lit(0.0), lambda x, y: x + y), "JSON": lambda: F.col("decoded.k").cast("double")}
    out = None
    for fmt, payload in payloads.items():
        whole = em.withColumn("payload", payload).withColumn("value", F.when(r == 7, F.lit(None)).when(
            r == 3, F.expr("substring(payload, 1, length(payload) - 1)")).otherwise(F.col("payload")))
        d = try_decode(whole, fmt, configs[fmt]).select("vec_id", F.lit(fmt).alias("format"), F.round(totals[fmt](), 5).alias("total"), "error")
        out = d if out is None else out.unionByName(d)
    return out


@register("f04_search", """
SELECT * FROM supplier WHERE lower(CAST(s_suppkey AS VARCHAR)) LIKE '%12%' OR lower(s_name) LIKE '%12%'
  OR lower(CAST(s_nationkey AS VARCHAR)) LIKE '%12%' OR lower(CAST(s_acctbal AS VARCHAR)) LIKE '%12%'""")
def f04(spark, sf):
    return Q.search(t(spark, sf, "supplier"), "12")


_HIST = "CASE WHEN CAST(get_json_object(props, '$.k') AS INT) < 50 THEN 'val_' || event_type ELSE event_type END"


@register("f05_select_metrics", """
SELECT user_id, CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) < 50 THEN 'val_' || event_type ELSE event_type END AS metric,
       event_id FROM events WHERE contains(event_type, 'view') OR contains(event_type, 'click')""")
def f05(spark, sf):
    s = t(spark, sf, "events").select("user_id", F.expr(_HIST).alias("metric"), "event_id")
    return Q.select_metrics(s, ["view", "click"])


DEPLOY_COLS = {
    "deployment_id": "o_orderkey",
    "batch": "CAST(o_custkey % 40 AS INT) - 5",
    "kwargs_fit": "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'epochs=5,shuffle=True' "
                  "WHEN '2' THEN 'epochs = 5 , verbose=0' WHEN '3' THEN 'epochs=5;shuffle' WHEN '4' THEN '' "
                  "ELSE 'steps_per_epoch=100' END",
    "kwargs_val": "CASE o_orderstatus WHEN 'F' THEN 'verbose=1' WHEN 'O' THEN 'bad value' END",
    "optimizer": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'sgd' END",
}
_KW = Q.KWARGS_PATTERN


@register("f06_validate_deployments", f"""
WITH d AS (SELECT {_sel(DEPLOY_COLS)} FROM orders),
e AS (SELECT *, list_filter([CASE WHEN batch <= 0 THEN 'batch size is not positive' END,
   CASE WHEN coalesce(kwargs_fit, '') <> '' AND NOT regexp_matches(kwargs_fit, '{_KW}') THEN 'fit arguments are not name=value pairs' END,
   CASE WHEN coalesce(kwargs_val, '') <> '' AND NOT regexp_matches(kwargs_val, '{_KW}') THEN 'validation arguments are not name=value pairs' END],
   lambda x: x IS NOT NULL) AS errs FROM d)
SELECT deployment_id, batch, coalesce(optimizer, 'adam') AS optimizer, len(errs) = 0 AS valid,
       array_to_string(errs, '|') AS errors FROM e""")
def f06(spark, sf):
    d = t(spark, sf, "orders").selectExpr(*[f"{e} AS {k}" for k, e in DEPLOY_COLS.items()])
    v = Q.validate_deployments(d)
    return v.select("deployment_id", "batch", "optimizer", "valid", F.array_join("errors", "|").alias("errors"))


_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'deployed' ELSE 'stopped' END"


@register("f07_guard", f"""
SELECT o_orderkey, 'delete_result' AS action FROM orders WHERE {_STATUS} IN ('finished', 'stopped')
UNION ALL SELECT o_orderkey, 'stop' FROM orders WHERE {_STATUS} = 'deployed'""")
def f07(spark, sf):
    r = t(spark, sf, "orders").select("o_orderkey", F.expr(_STATUS).alias("status"))
    return Q.guard(r, "delete_result").select("o_orderkey", F.lit("delete_result").alias("action")).unionByName(
        Q.guard(r, "stop").select("o_orderkey", F.lit("stop").alias("action")))


@register("j15_ledger", """
WITH u AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS round, o_orderkey, o_custkey, o_totalprice FROM orders),
g AS (SELECT round, max(o_orderkey) AS update_id FROM u GROUP BY round)
SELECT g.round, g.update_id, u.o_custkey AS account, c.c_name, u.o_totalprice AS metric
FROM g JOIN u ON u.o_orderkey = g.update_id JOIN customer c ON c.c_custkey = u.o_custkey""")
def j15(spark, sf):
    from kelpie.operators.rewards import metrics_by_round
    u = t(spark, sf, "orders").select(F.year("o_orderdate").alias("round"), F.col("o_orderkey").alias("update_id"),
                                      F.col("o_custkey").alias("account"), F.col("o_totalprice").alias("metric"))
    acc = t(spark, sf, "customer").select(F.col("c_custkey").alias("account"), "c_name")
    return metrics_by_round(u, acc)
