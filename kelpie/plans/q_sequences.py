"""Split, batching, sampling and window queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kelpie.operators import monitor as W
from kelpie.operators import splits as L
from kelpie.plans.fixtures import header_value, published_events, t
from kelpie.plans.registry import register


def _positions(spark, sf):
    """events read as one topic slice: position = partition prefix + offset."""
    log = published_events(spark, sf)
    return L.log_position(log).select(header_value("sample_id").cast("long").alias("event_id"), "pos")


_POS = """WITH p AS (SELECT event_id, row_number() OVER (ORDER BY user_id % 4, event_id) - 1 AS pos,
                  count(*) OVER () AS n FROM events)"""


@register("l01_split_ordered", _POS + """
SELECT event_id, CASE
  WHEN pos < floor((1 - (0.1::DOUBLE + 0.2::DOUBLE)) * n) THEN 'train'
  WHEN pos < floor((1 - (0.1::DOUBLE + 0.2::DOUBLE)) * n) + floor(0.2::DOUBLE * n) THEN 'test'
  ELSE 'validation' END AS split FROM p""")
def l01(spark, sf):
    return L.split_ordered(_positions(spark, sf), 0.1, 0.2, pos="pos").select("event_id", "split")


@register("l02_split_batch", _POS + """,
b AS (SELECT event_id, pos, floor(pos / 1000) AS batch FROM p),
c AS (SELECT *, count(*) OVER (PARTITION BY batch) AS nb, min(pos) OVER (PARTITION BY batch) AS p0 FROM b)
SELECT event_id, CAST(batch AS BIGINT) AS batch, CASE WHEN pos - p0 < floor((1 - 0.25::DOUBLE) * nb) THEN 'train'
  WHEN floor(0.25::DOUBLE * nb) > 0 THEN 'validation' ELSE 'unused' END AS split FROM c""")
def l02(spark, sf):
    p = _positions(spark, sf).withColumn("batch", L.batch_id("pos", 1000))
    return L.split_batch(p, 0.25, pos="pos", by="batch").select("event_id", "batch", "split")


_RANK = """WITH r AS (SELECT vec_id, label, row_number() OVER (ORDER BY md5('{seed}:' || CAST(vec_id AS VARCHAR)), vec_id) - 1 AS rank,
                 count(*) OVER () AS n FROM embeddings)"""


@register("l03_split_random", _RANK.format(seed=42) + """,
s AS (SELECT *, floor((1 - (0.1::DOUBLE + 0.2::DOUBLE)) * n) AS tr0, floor(0.1::DOUBLE * n) AS va,
             floor(0.2::DOUBLE * n) AS te FROM r)
SELECT vec_id, CASE WHEN rank < tr0 + (n - (tr0 + va + te)) THEN 'train'
                    WHEN rank < tr0 + (n - (tr0 + va + te)) + va THEN 'validation' ELSE 'test' END AS split FROM s""")
def l03(spark, sf):
    return L.split_random(t(spark, sf, "embeddings"), "vec_id", 0.1, 0.2, seed=42).select("vec_id", "split")


@register("l04_split_device", _POS + """,
c AS (SELECT event_id, pos, n, CAST(least(floor(pos / floor(n / 3)), 2) AS INTEGER) AS round FROM p),
d AS (SELECT *, pos - min(pos) OVER (PARTITION BY round) AS rel FROM c)
SELECT event_id, round, CASE WHEN rel < floor((1 - 0.2::DOUBLE) * n) THEN 'train' ELSE 'validation' END AS split FROM d""")
def l04(spark, sf):
    p = L._with_total(_positions(spark, sf), None)
    p = p.withColumn("round", L.round_chunk("pos", F.col("_n"), 3))
    # position inside the READ chunk; the size rule still uses the full total
    p = p.withColumn("rel", F.col("pos") - F.floor(F.col("_n") / 3) * F.col("round"))
    return L.split_device(p, F.col("_n"), 0.2, pos="rel").select("event_id", "round", "split")


@register("l05_round_chunk", _POS + """
SELECT event_id, CAST(least(floor(pos / floor(n / 3)), 2) AS INTEGER) AS round FROM p""")
def l05(spark, sf):
    p = L._with_total(_positions(spark, sf), None)
    return p.select("event_id", L.round_chunk("pos", F.col("_n"), 3).alias("round"))


@register("l06_batch_id", _POS + " SELECT event_id, CAST(floor(pos / 256) AS BIGINT) AS batch FROM p")
def l06(spark, sf):
    return _positions(spark, sf).select("event_id", L.batch_id("pos", 256).alias("batch"))


@register("l07_share_out", _RANK.format(seed=7) + """
SELECT vec_id, CASE WHEN rank < 200 THEN 'inference'
                    WHEN rank - 200 < floor((n - 200) * 0.6::DOUBLE) THEN 'device1' ELSE 'device2' END AS share FROM r""")
def l07(spark, sf):
    return L.share_out(t(spark, sf, "embeddings"), "vec_id", 200, [0.6, 0.4], seed=7).select("vec_id", "share")


@register("l08_sample_k", """
SELECT vec_id, label FROM embeddings ORDER BY md5('3:' || CAST(vec_id AS VARCHAR)), vec_id LIMIT 50""")
def l08(spark, sf):
    return L.sample_k(t(spark, sf, "embeddings").select("vec_id", "label"), "vec_id", 50, seed=3)


@register("l08_head", _POS + " SELECT event_id, pos FROM p ORDER BY pos LIMIT 20")
def l08h(spark, sf):
    return L.head(_positions(spark, sf), 20, "pos")


@register("l09_shuffle", """
SELECT vec_id, md5('5:2:' || CAST(vec_id AS VARCHAR)) AS shuffle_key FROM embeddings""")
def l09(spark, sf):
    return L.shuffle(t(spark, sf, "embeddings").select("vec_id"), "vec_id", seed=5, epoch=2)


@register("w01_running_share", """
SELECT event_id, event_type,
  floor(row_number() OVER (PARTITION BY event_type ORDER BY event_id) / row_number() OVER (ORDER BY event_id) * 10000 + 0.5) / 10000 AS share,
  row_number() OVER (ORDER BY event_id) AS seen FROM events""")
def w01(spark, sf):
    ev = t(spark, sf, "events").select("event_id", "event_type")
    return W.running_share(ev, "event_type", "event_id")


@register("w02_last_statuses", """
SELECT conv_id, turn, role, lag(role, 1) OVER w AS prev_1, lag(role, 2) OVER w AS prev_2,
       lag(role, 3) OVER w AS prev_3, lag(role, 4) OVER w AS prev_4
FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def w02(spark, sf):
    c = t(spark, sf, "conversations").select("conv_id", "turn", "role")
    return W.last_statuses(c, "conv_id", "turn", "role", 4)


_CLASSES = ["click", "error", "purchase", "signup", "view"]


def _leader_sql():
    cnt = ",\n".join(f"  floor(sum(CASE WHEN event_type = '{c}' THEN 1 ELSE 0 END) OVER w / "
                     f"row_number() OVER w * 10000 + 0.5) / 10000 AS s_{c}" for c in _CLASSES)
    best = "greatest(" + ", ".join(f"s_{c}" for c in _CLASSES) + ")"
    lead = "CASE " + " ".join(f"WHEN s_{c} = {best} THEN '{c}'" for c in _CLASSES) + " END"
    return f"""WITH c AS (SELECT user_id, event_id, row_number() OVER w AS seen,
{cnt}
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
l AS (SELECT user_id, event_id, seen, {lead} AS leader FROM c),
e AS (SELECT *, lag(leader) OVER (PARTITION BY user_id ORDER BY event_id) AS prev FROM l)
SELECT user_id, event_id, leader, (prev IS NULL OR prev <> leader OR seen % 10 = 0) AS emit FROM e"""


@register("w03_leader_changes", _leader_sql())
def w03(spark, sf):
    ev = t(spark, sf, "events").select("user_id", "event_id", "event_type")
    # the monitor's configured class list: the distinct classes of the stream (a small categorical)
    classes = sorted(r[0] for r in ev.select("event_type").distinct().collect())
    return W.leader_changes(ev, "event_type", "event_id", classes, by="user_id", window=10) \
        .select("user_id", "event_id", "leader", "emit")


@register("w04_regression_series", """
SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS point, generate_subscripts(embedding, 1) - 1 AS i,
       unnest(embedding) AS value FROM embeddings""")
def w04(spark, sf):
    em = t(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("values"))
    return W.regression_series(em, "vec_id").select("vec_id", "point", F.col("i").cast("long").alias("i"), "value")


@register("w05_improvements", """
WITH RECURSIVE s AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
r AS (SELECT user_id, rn, value AS ref, false AS emit, value, event_id, CAST(NULL AS DOUBLE) AS prevref FROM s WHERE rn = 1
      UNION ALL
      SELECT s.user_id, s.rn,
             CASE WHEN s.value <> r.ref AND s.value - r.ref >= 5.0 THEN s.value ELSE r.ref END,
             (s.value <> r.ref AND s.value - r.ref >= 5.0), s.value, s.event_id, r.ref
      FROM r JOIN s ON s.user_id = r.user_id AND s.rn = r.rn + 1)
SELECT CAST(user_id AS VARCHAR) AS key, event_id AS "order", value, prevref AS reference FROM r WHERE emit""")
def w05(spark, sf):
    return W.improvements(t(spark, sf, "events"), "user_id", "event_id", "value", change="up", d=5.0)


@register("w06_latest", """
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1""")
def w06(spark, sf):
    return W.latest(t(spark, sf, "orders"), "o_custkey", "o_orderdate", tiebreak="o_orderkey")
