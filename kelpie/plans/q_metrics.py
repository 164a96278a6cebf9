"""Aggregation and set-operation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kelpie.operators import metrics as M
from kelpie.operators.sequence import dense_position
from kelpie.plans.fixtures import t
from kelpie.plans.registry import register

R = 6  # decimals compared for computed doubles


def _doc_scores(spark, sf):
    """labels ⋈ documents: truth = quality, score = logistic(ln(n_chars) - 7)."""
    lab = t(spark, sf, "labels")
    doc = t(spark, sf, "documents").select("doc_id", "n_chars")
    j = lab.join(doc, "doc_id")
    return j.withColumn("p", 1.0 / (1.0 + F.exp(-(F.log(F.col("n_chars").cast("double")) - 7.0))))


DOC_SCORES_SQL = """WITH j AS (SELECT l.doc_id, l.quality, l.toxic, d.n_chars,
  1.0 / (1.0 + exp(-(ln(CAST(d.n_chars AS DOUBLE)) - 7.0))) AS p
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


@register("a01_class_counts", """
SELECT vec_id % 3 AS device, label, count(*) AS n,
       round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY vec_id % 3), 4) AS pct
FROM embeddings GROUP BY 1, 2""")
def a01(spark, sf):
    em = t(spark, sf, "embeddings").withColumn("device", F.pmod("vec_id", F.lit(3)))
    return M.class_counts(em, "label", by="device")


@register("a02_class_weights", """
SELECT quality, count(*) AS cnt,
       round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
FROM labels GROUP BY quality""")
def a02(spark, sf):
    w = M.class_weights(t(spark, sf, "labels"), "quality")
    return w.select("quality", "cnt", F.round("weight", R).alias("weight"))


@register("a03_weight_stats", """
WITH w AS (SELECT quality, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS weight
           FROM labels GROUP BY quality),
x AS (SELECT w.weight FROM labels l JOIN w ON l.quality = w.quality)
SELECT round(min(weight), 6) AS min_w, round(max(weight), 6) AS max_w, round(avg(weight), 6) AS mean_w FROM x""")
def a03(spark, sf):
    lab = t(spark, sf, "labels")
    w = M.class_weights(lab, "quality").select("quality", "weight")
    s = M.weight_stats(lab.join(w, "quality"), "weight")
    return s.select(*[F.round(c, R).alias(c) for c in s.columns])


@register("a04_feature_ranges", """
SELECT 'l_quantity' AS feature, min(l_quantity) + 0.0 AS min, max(l_quantity) + 0.0 AS max FROM lineitem
UNION ALL SELECT 'l_extendedprice', min(l_extendedprice) + 0.0, max(l_extendedprice) + 0.0 FROM lineitem
UNION ALL SELECT 'l_discount', min(l_discount) + 0.0, max(l_discount) + 0.0 FROM lineitem
UNION ALL SELECT 'l_tax', min(l_tax) + 0.0, max(l_tax) + 0.0 FROM lineitem""")
def a04(spark, sf):
    r = M.feature_ranges(t(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return r.select("feature", (F.col("min") + 0.0).alias("min"), (F.col("max") + 0.0).alias("max"))  # -0.0 -> 0.0


_CM_SQL = """WITH u AS (SELECT quality AS c FROM labels UNION SELECT toxic FROM labels),
c AS (SELECT quality AS y, toxic AS yhat, count(*) AS n FROM labels GROUP BY 1, 2),
cm AS (SELECT a.c AS y, b.c AS yhat, coalesce(c.n, 0) AS n FROM u a JOIN u b ON true
       LEFT JOIN c ON c.y = a.c AND c.yhat = b.c)"""


@register("a05_confusion_matrix", _CM_SQL + " SELECT y, yhat, n FROM cm")
def a05(spark, sf):
    return M.confusion_matrix(t(spark, sf, "labels"), "quality", "toxic")


@register("a06_confusion_rates", _CM_SQL + """
SELECT y, yhat, n, CASE WHEN sum(n) OVER (PARTITION BY y) > 0
       THEN round_even(n / sum(n) OVER (PARTITION BY y) * 10000, 0) / 10000 END AS rate FROM cm""")
def a06(spark, sf):
    return M.confusion_rates(M.confusion_matrix(t(spark, sf, "labels"), "quality", "toxic"))


@register("a07_binary_cells", """
SELECT CAST(sum(CASE WHEN quality = 0 AND toxic = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
       CAST(sum(CASE WHEN quality = 0 AND toxic = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
       CAST(sum(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
       CAST(sum(CASE WHEN quality = 1 AND toxic = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp FROM labels""")
def a07(spark, sf):
    return M.binary_cells(t(spark, sf, "labels"), "quality", "toxic")


@register("a07_class_report", _CM_SQL + """,
r AS (SELECT CAST(t.y AS VARCHAR) AS cls,
        CASE WHEN p.np > 0 THEN t.n / p.np ELSE 0.0 END AS precision,
        CASE WHEN s.sup > 0 THEN t.n / s.sup ELSE 0.0 END AS recall, s.sup AS support
      FROM (SELECT y, n FROM cm WHERE y = yhat) t
      JOIN (SELECT y, sum(n) AS sup FROM cm GROUP BY y) s ON s.y = t.y
      JOIN (SELECT yhat, sum(n) AS np FROM cm GROUP BY yhat) p ON p.yhat = t.y),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM r),
a AS (SELECT cls, precision, recall, f1, support FROM f
      UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM f
      UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                       sum(f1 * support) / sum(support), sum(support) FROM f)
SELECT cls, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM a""")
def a07r(spark, sf):
    return M.class_report(M.confusion_matrix(t(spark, sf, "labels"), "quality", "toxic"))


@register("a08_evaluate", DOC_SCORES_SQL + """,
b AS (SELECT p AS s, sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS pos,
             sum(CASE WHEN quality = 0 THEN 1 ELSE 0 END) AS neg FROM j GROUP BY p),
c AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM b),
a AS (SELECT (sum(pos * below) + 0.5 * sum(pos * neg)) / NULLIF(sum(pos) * sum(neg), 0) AS auc FROM c),
m AS (SELECT
  avg(CASE WHEN (CASE WHEN p > 0.5 THEN 1.0 ELSE 0.0 END) = quality THEN 1.0 ELSE 0.0 END) AS binary_accuracy,
  sum(CASE WHEN (CASE WHEN p > 0.5 THEN 1.0 ELSE 0.0 END) = quality THEN 1.0 ELSE 0.0 END * (1 + toxic)) / sum(1 + toxic)
    AS weighted_binary_accuracy,
  sum(CASE WHEN p > 0.5 THEN 1.0 ELSE 0.0 END * quality) / NULLIF(sum(CASE WHEN p > 0.5 THEN 1.0 ELSE 0.0 END), 0) AS precision,
  sum(CASE WHEN p > 0.5 THEN 1.0 ELSE 0.0 END * quality) / NULLIF(sum(quality), 0) AS recall,
  avg(abs(quality - p)) AS mae, avg((quality - p) * (quality - p)) AS mse,
  avg(-(quality * ln(least(greatest(p, 1e-7), 1 - 1e-7)) + (1 - quality) * ln(1 - least(greatest(p, 1e-7), 1 - 1e-7))))
    AS binary_crossentropy FROM j)
SELECT round(binary_accuracy, 6) AS binary_accuracy, round(weighted_binary_accuracy, 6) AS weighted_binary_accuracy,
       round(precision, 6) AS precision, round(recall, 6) AS recall, round(mae, 6) AS mae, round(mse, 6) AS mse,
       round(binary_crossentropy, 6) AS binary_crossentropy, round(auc, 6) AS auc FROM m, a""")
def a08(spark, sf):
    d = _doc_scores(spark, sf).withColumn("w", 1 + F.col("toxic"))
    e = M.evaluate(d, "quality", "p", weight="w")
    return e.select(*[F.round(c, R).alias(c) for c in e.columns])


@register("a09_round_series", """
SELECT user_id AS "update", event_type AS metric, 'training' AS split, arg_max(value, event_id) AS value,
       max(event_id) AS last_epoch FROM events GROUP BY 1, 2""")
def a09(spark, sf):
    h = t(spark, sf, "events").select(F.col("user_id").alias("update"), F.col("event_type").alias("metric"),
                                       F.lit("training").alias("split"), F.col("event_id").alias("epoch"), "value")
    return M.round_series(h)


_EXIT_METRIC = "concat(event_type, '_', CASE WHEN value > 100 THEN 'accuracy' ELSE 'loss' END)"


@register("a10_split_exits", f"""
WITH h AS (SELECT {_EXIT_METRIC} AS metric FROM events),
x AS (SELECT CASE WHEN contains(metric, 'view') THEN 'view' WHEN contains(metric, 'click') THEN 'click'
                  WHEN contains(metric, 'purchase') THEN 'purchase' END AS exit, metric FROM h)
SELECT exit, CASE WHEN exit IS NULL THEN NULL ELSE replace(metric, exit || '_', '') END AS exit_metric,
       count(*) AS n FROM x GROUP BY 1, 2""")
def a10(spark, sf):
    h = t(spark, sf, "events").select(F.expr(_EXIT_METRIC).alias("metric"))
    return M.split_exits(h, ["view", "click", "purchase"]).groupBy("exit", "exit_metric") \
        .agg(F.count(F.lit(1)).alias("n"))


@register("a11_merge_partial", """
WITH p AS (SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS acct FROM orders
           WHERE o_orderstatus = 'F' GROUP BY o_custkey)
SELECT c.c_custkey, c.c_name, coalesce(p.acct, c.c_acctbal) AS c_acctbal, c.c_mktsegment
FROM customer c LEFT JOIN p ON p.o_custkey = c.c_custkey""")
def a11(spark, sf):
    cust = t(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    patch = t(spark, sf, "orders").where(F.col("o_orderstatus") == "F").groupBy("o_custkey").agg(
        F.max_by("o_totalprice", "o_orderkey").alias("c_acctbal")).withColumnRenamed("o_custkey", "c_custkey")
    return M.merge_partial(cust, patch, "c_custkey", ["c_acctbal"])


@register("a11_append_history", """
WITH m AS (SELECT CAST(user_id AS VARCHAR) || ':' || event_type AS series, event_id, value,
                  event_id <= (SELECT (min(event_id) + max(event_id)) // 2 FROM events) AS early FROM events),
v AS (SELECT series, event_id, value, row_number() OVER (PARTITION BY series ORDER BY event_id) - 1 AS e FROM m WHERE early),
c AS (SELECT series, event_id, value, row_number() OVER (PARTITION BY series ORDER BY event_id) - 1 AS e FROM m WHERE NOT early),
n AS (SELECT series, count(*) AS na FROM v GROUP BY series)
SELECT series, event_id, value, e AS epoch FROM v
UNION ALL SELECT c.series, c.event_id, c.value, c.e + coalesce(n.na, 0) FROM c LEFT JOIN n USING (series)""")
def a11h(spark, sf):
    """Every event is an epoch of its user's metric; the later half of the ids is a second fit that goes on."""
    ev = t(spark, sf, "events").withColumn("series", F.concat_ws(":", F.col("user_id").cast("string"), "event_type"))
    half = ev.agg(F.expr("(min(event_id) + max(event_id)) div 2").alias("half"))
    ev = ev.join(F.broadcast(half))      # one row
    return M.append_history_long(ev.where("event_id <= half"), ev.where("event_id > half"), "series", "event_id") \
        .select("series", "event_id", "value", "epoch")


_HIST = "CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) < 50 THEN 'val_' || event_type ELSE event_type END"


ORACLE_A12 = f"""
WITH h AS (SELECT user_id AS result, {_HIST} AS metric, event_id, value FROM events),
e AS (SELECT result, metric, row_number() OVER (PARTITION BY result, metric ORDER BY event_id) - 1 AS epoch, value FROM h),
s AS (SELECT result, CASE WHEN metric LIKE 'val\\_%' ESCAPE '\\' THEN substr(metric, 5) ELSE metric END AS metric,
             CASE WHEN metric LIKE 'val\\_%' ESCAPE '\\' THEN 'val' ELSE 'train' END AS series,
             CAST(epoch + 1 AS INTEGER) AS epoch, value FROM e)
SELECT * FROM s WHERE (result, metric) IN (SELECT result, metric FROM s WHERE series = 'train')"""


@register("a12_chart_series", ORACLE_A12)
def a12(spark, sf):
    ev = t(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    h = ev.select(F.col("user_id").alias("result"),
                  F.when(k < 50, F.concat(F.lit("val_"), "event_type")).otherwise(F.col("event_type")).alias("metric"),
                  "event_id", "value")
    h = dense_position(h, ["result", "metric"], "event_id", name="epoch")
    return M.chart_series(h.drop("event_id"))


@register("a13_inference_summary", DOC_SCORES_SQL + """
SELECT count(*) AS n, CAST(sum(CASE WHEN quality = CASE WHEN p > 0.5 THEN 1 ELSE 0 END THEN 1 ELSE 0 END) AS BIGINT) AS correct,
       round(avg(CASE WHEN quality = CASE WHEN p > 0.5 THEN 1 ELSE 0 END THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       CAST(sum(CASE WHEN p > 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS positives, round(avg(p), 6) AS mean_score FROM j""")
def a13(spark, sf):
    d = _doc_scores(spark, sf).withColumn("pred", (F.col("p") > 0.5).cast("int"))
    s = M.inference_summary(d, "quality", "pred", "p")
    return s.select("n", "correct", F.round("accuracy", R).alias("accuracy"), "positives",
                    F.round("mean_score", R).alias("mean_score"))


@register("a14_rounds_map", """
WITH r AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS round, o_custkey AS account FROM orders)
SELECT round, account, row_number() OVER (PARTITION BY round ORDER BY account) - 1 AS idx,
       count(*) OVER (PARTITION BY round) AS n_devices FROM r""")
def a14(spark, sf):
    o = t(spark, sf, "orders").select(F.year("o_orderdate").alias("round"), F.col("o_custkey").alias("account")).distinct()
    return M.rounds_map(o, "round", "account").select("round", "account", "idx", "n_devices")


@register("a15_device_totals", """
SELECT CASE WHEN grouping(user_id) = 1 THEN 'ALL' ELSE CAST(user_id AS VARCHAR) END AS device, count(*) AS n
FROM events GROUP BY ROLLUP (user_id)""")
def a15(spark, sf):
    return M.device_totals(t(spark, sf, "events").withColumnRenamed("user_id", "device"), "device")


@register("a16_config_facts", """
SELECT l.l_orderkey AS configuration,
       string_agg(DISTINCT p.p_brand, ',' ORDER BY p.p_brand) AS frameworks,
       count(DISTINCT p.p_brand) AS n_frameworks, bool_or(p.p_size > 40) AS any_distributed
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1""")
def a16(spark, sf):
    part = t(spark, sf, "part").withColumn("dist", F.col("p_size") > 40)
    cm = t(spark, sf, "lineitem").withColumnRenamed("l_partkey", "p_partkey")
    return M.config_facts(cm, part, "l_orderkey", "p_partkey", "p_brand", "dist")


@register("u01_concat_sets", """
SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal, 'supplier' AS kind FROM supplier
UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, 'customer' FROM customer""")
def u01(spark, sf):
    s = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                         F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"),
                                         F.lit("supplier").alias("kind"))
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                         F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
                                         F.lit("customer").alias("kind"))
    return M.concat_sets(s, c)


@register("u02_grow", """
SELECT doc_id, quality AS label, 'labelled' AS origin FROM labels
UNION ALL SELECT doc_id, CASE WHEN n_chars > 5000 THEN 1 ELSE 0 END, 'pseudo' FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def u02(spark, sf):
    lab = t(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"), F.lit("labelled").alias("origin"))
    pool = t(spark, sf, "documents").join(t(spark, sf, "labels"), "doc_id", "left_anti")
    pseudo = pool.select("doc_id", (F.col("n_chars") > 5000).cast("int").alias("label"), F.lit("pseudo").alias("origin"))
    return M.grow(lab, pseudo)


@register("u03_participants", "SELECT DISTINCT o_custkey FROM orders")
def u03(spark, sf):
    return M.participants_set(t(spark, sf, "orders"), "o_custkey")


@register("u03_label_universe", "SELECT quality AS label FROM labels UNION SELECT toxic FROM labels")
def u03b(spark, sf):
    return M.label_universe(t(spark, sf, "labels"), "quality", "toxic")
