"""Ledger and reward queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kelpie.operators import rewards as RW
from kelpie.plans.fixtures import t
from kelpie.plans.registry import register

REGISTERED = 3
WALLET = 5000.0

# events as federated updates: federation = user_id % 5, account = event_type,
# num_data = props.k, training / validation loss from value.
UPDATE_COLS = {
    "update_id": "event_id",
    "federation": "user_id % 5",
    "account": "event_type",
    "num_data": "CAST(get_json_object(props, '$.k') AS BIGINT)",
    "train_loss": "value / 100.0",
    "val_loss": "CASE WHEN event_type <> 'error' THEN value / 90.0 END",
}


def updates(spark, sf):
    return t(spark, sf, "events").selectExpr(*[f"{e} AS {k}" for k, e in UPDATE_COLS.items()])


def ledger(spark, sf):
    u = RW.fifo_position(updates(spark, sf), "federation", "update_id")
    r = RW.assign_round(u, "federation", REGISTERED)
    r = RW.with_prev_loss(r)
    r = RW.contribution_total(r, "federation", "account", "update_id", "num_data")
    return RW.rewards(r)


_U = """WITH u AS (SELECT event_id AS update_id, user_id % 5 AS federation, event_type AS account,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS num_data, value / 100.0 AS train_loss,
        CASE WHEN event_type <> 'error' THEN value / 90.0 END AS val_loss FROM events),
f AS (SELECT *, row_number() OVER (PARTITION BY federation ORDER BY update_id) AS fifo,
             count(*) OVER (PARTITION BY federation) AS n FROM u)"""
_R = _U + """,
r AS (SELECT * EXCLUDE (n), CAST(floor((fifo - 1) / 3) AS BIGINT) AS round FROM f WHERE fifo <= floor(n / 3) * 3),
last AS (SELECT federation, round + 1 AS round, arg_max_null(train_loss, fifo) AS pt, arg_max_null(val_loss, fifo) AS pv
         FROM r GROUP BY federation, round),
p AS (SELECT r.*, l.pt, l.pv FROM r LEFT JOIN last l ON l.federation = r.federation AND l.round = r.round),
w7 AS (SELECT *,
  CASE WHEN round < 1 THEN train_loss WHEN val_loss IS NOT NULL AND pv IS NOT NULL THEN val_loss ELSE train_loss END AS current_loss,
  CASE WHEN round < 1 THEN 'inf'::DOUBLE WHEN val_loss IS NOT NULL AND pv IS NOT NULL THEN pv ELSE pt END AS previous_loss FROM p),
d8 AS (SELECT *, num_data - coalesce(lag(num_data) OVER (PARTITION BY federation, account ORDER BY fifo), 0) AS delta FROM w7),
w8 AS (SELECT * EXCLUDE (delta), sum(delta) OVER (PARTITION BY federation ORDER BY fifo
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS contributions FROM d8),
g12 AS (SELECT *, CASE WHEN current_loss / previous_loss >= 0 AND current_loss / previous_loss <= 0.5 THEN 1.0::DOUBLE
                       WHEN current_loss / previous_loss > 0.75 AND current_loss / previous_loss <= 1.0 THEN 0.5::DOUBLE
                       WHEN current_loss / previous_loss > 1.0 AND current_loss / previous_loss <= 1.5 THEN 1.0::DOUBLE / 3.0::DOUBLE
                       ELSE 0.0::DOUBLE END * 100 * num_data / NULLIF(contributions, 0) AS reward FROM w8),
g13 AS (SELECT update_id, account, CAST(floor(reward) AS BIGINT) AS tokens FROM g12)"""


@register("w09_fifo_position", _U + " SELECT update_id, federation, fifo FROM f")
def w09(spark, sf):
    return RW.fifo_position(updates(spark, sf), "federation", "update_id").select("update_id", "federation", "fifo")


@register("g07_assign_round", _R + " SELECT update_id, round FROM r")
def g07(spark, sf):
    u = RW.fifo_position(updates(spark, sf), "federation", "update_id")
    return RW.assign_round(u, "federation", REGISTERED).select("update_id", "round")


@register("w07_prev_loss", _R + """
SELECT update_id, round, round(current_loss, 6) AS current_loss, round(previous_loss, 6) AS previous_loss FROM w7""")
def w07(spark, sf):
    u = RW.fifo_position(updates(spark, sf), "federation", "update_id")
    r = RW.with_prev_loss(RW.assign_round(u, "federation", REGISTERED))
    return r.select("update_id", "round", F.round("current_loss", 6).alias("current_loss"),
                    F.round("previous_loss", 6).alias("previous_loss"))


@register("w08_contribution_total", _R + " SELECT update_id, CAST(contributions AS BIGINT) AS contributions FROM w8")
def w08(spark, sf):
    u = RW.fifo_position(updates(spark, sf), "federation", "update_id")
    r = RW.assign_round(u, "federation", REGISTERED)
    return RW.contribution_total(r, "federation", "account", "update_id", "num_data").select("update_id", "contributions")


@register("g12_rewards", _R + " SELECT update_id, round(reward, 6) AS reward FROM g12")
def g12(spark, sf):
    return ledger(spark, sf).select("update_id", F.round("reward", 6).alias("reward"))


@register("g13_book_tokens", _R + " SELECT update_id, account, tokens FROM g13")
def g13(spark, sf):
    return RW.book_tokens(ledger(spark, sf))


@register("g14_payout", _R + f""",
per AS (SELECT account, sum(tokens) AS tokens FROM g13 GROUP BY account),
tot AS (SELECT sum(tokens) AS t FROM per)
SELECT account, CAST(tokens AS BIGINT) AS tokens,
       round(tokens * CASE WHEN t > {WALLET} THEN {WALLET}::DOUBLE / t ELSE 1.0 END, 6) AS payout FROM per, tot""")
def g14(spark, sf):
    p = RW.payout(RW.book_tokens(ledger(spark, sf)), WALLET)
    return p.select("account", "tokens", F.round("payout", 6).alias("payout"))


@register("a17_ledger_totals", _R + """
SELECT account, count(*) AS updates, CAST(sum(tokens) AS BIGINT) AS tokens FROM g13 GROUP BY account""")
def a17(spark, sf):
    return RW.ledger_totals(RW.book_tokens(ledger(spark, sf)))
