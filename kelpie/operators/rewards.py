"""Reward accounting over the update ledger.

The ledger is an append-only table of updates
``(federation, update_id, fifo order, round, account, num_data, losses)``.
Every map the contract keeps becomes a join; every running quantity is a
blocked prefix computation, so a federation holding a third of the updates
is still spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpie.operators.sequence import DEFAULT_BLOCK, blocked_lag, dense_position, running_sum
from kelpie.session import cut_lineage

# Reward bands over current_loss / previous_loss, base reward.
BASE_REWARD = 100
REWARD_BANDS = [  # (low exclusive, high inclusive, factor); the first band includes 0
    (None, 0.5, 1.0),
    (0.75, 1.0, 0.5),
    (1.0, 1.5, 1.0 / 3.0),
]


# ------------------------------------------------------------------ W09 ----

def fifo_position(updates: DataFrame, federation: str, order: str, tiebreak: list[str] | None = None,
                  block: int = DEFAULT_BLOCK, name: str = "fifo") -> DataFrame:
    """n-th update of a federation is consumed n-th (1-based); ``<name>_total``
    carries the federation's update count (from the same block table)."""
    d = dense_position(updates, federation, order, block=block, name=name, tiebreak=tiebreak or [],
                       with_total=True)
    return d.withColumn(name, F.col(name) + 1)


# ------------------------------------------------------------------ G07 ----

def assign_round(updates: DataFrame, federation: str, registered: int, fifo: str = "fifo") -> DataFrame:
    """Round = floor((fifo-1)/k); the incomplete last round is held back.
    ``registered = -1`` aggregates each model alone (round = fifo - 1)."""
    if registered == -1:
        return updates.withColumn("round", (F.col(fifo) - 1).cast("long"))
    if f"{fifo}_total" in updates.columns:
        d = updates.withColumn("_n", F.col(f"{fifo}_total"))
    else:
        n = updates.groupBy(federation).agg(F.count(F.lit(1)).alias("_n"))
        d = updates.join(n, federation)  # one row per federation: AQE broadcasts it after measuring
    complete = F.floor(F.col("_n") / F.lit(registered)) * F.lit(registered)
    return d.where(F.col(fifo) <= complete).withColumn("round", F.floor((F.col(fifo) - 1) / F.lit(registered)).cast("long")) \
            .drop("_n")


# ------------------------------------------------------------------ W07 ----

def with_prev_loss(rounds: DataFrame, federation: str = "federation", round_col: str = "round",
                   fifo: str = "fifo", train: str = "train_loss", val: str = "val_loss") -> DataFrame:
    """Attach (current_loss, previous_loss): each update of round r is compared
    with the LAST update used in round r-1 (validation loss when both have one,
    else training loss on both sides); round 0 compares with +inf."""
    # (federation, round) groups hold at most the registered devices: no hot key;
    # one exchange serves both the per-round table and the join back
    rounds = rounds.repartition(federation, round_col)
    last = rounds.groupBy(federation, round_col).agg(
        F.max_by(F.struct(F.col(train).alias("pt"), F.col(val).alias("pv")), F.col(fifo)).alias("_p"))
    prev = last.select(federation, (F.col(round_col) + 1).alias(round_col), "_p")
    j = rounds.join(prev, [federation, round_col], "left")
    both_val = F.col(val).isNotNull() & F.col("_p.pv").isNotNull()
    first = F.col(round_col) < 1
    cur = F.when(first, F.col(train)).when(both_val, F.col(val)).otherwise(F.col(train))
    prv = F.when(first, F.lit(float("inf"))).when(both_val, F.col("_p.pv")).otherwise(F.col("_p.pt"))
    return j.withColumn("current_loss", cur).withColumn("previous_loss", prv).drop("_p")


# ------------------------------------------------------------------ W08 ----

def contribution_total(updates: DataFrame, federation: str, account: str, order: str, size: str,
                       block: int = DEFAULT_BLOCK, materialize: bool = True) -> DataFrame:
    """Known contributions so far: Σ over accounts of their latest data size up
    to and including this update = running sum of (size - previous size of the
    same account) in federation order.

    Three blocked passes read the input; with ``materialize`` it is written
    once to the shared checkpoint folder so the passes do not recompute the
    upstream ledger steps (column pruning defeats exchange reuse there).
    """
    if materialize:
        updates = cut_lineage(updates)
    d = dense_position(updates, [federation, account], order, block=block, name="_apos")
    d = blocked_lag(d, [federation, account], "_apos", {"_prev": (size, 1)}, block=block)
    d = d.withColumn("_delta", F.col(size) - F.coalesce(F.col("_prev"), F.lit(0)))
    d = running_sum(d, federation, order, "_delta", "contributions", block=block)
    return d.drop("_apos", "_prev", "_delta")


# ------------------------------------------------------------------ G12 ----

def reward_factor(ratio) -> F.Column:
    r = F.col(ratio) if isinstance(ratio, str) else ratio
    expr = F.lit(0.0)
    for lo, hi, f in reversed(REWARD_BANDS):
        cond = (r >= 0) & (r <= hi) if lo is None else (r > lo) & (r <= hi)
        expr = F.when(cond, F.lit(f)).otherwise(expr)
    return expr


def rewards(updates: DataFrame, size: str = "num_data", contributions: str = "contributions") -> DataFrame:
    """Band of current/previous loss x 100 x own size / known contributions."""
    ratio = F.try_divide(F.col("current_loss"), F.col("previous_loss"))
    # no known contribution yet -> no reward (the reference would divide by zero)
    return updates.withColumn("reward", F.try_divide(reward_factor(ratio) * F.lit(BASE_REWARD) * F.col(size),
                                                     F.col(contributions)))


# ------------------------------------------------------------------ G13 ----

def book_tokens(rewards_df: DataFrame, update: str = "update_id", seq: str = "fifo",
                account: str = "account") -> DataFrame:
    """Whole tokens (truncated); one booking per update (the first one wins)."""
    first = rewards_df.groupBy(update).agg(F.min_by(F.struct(F.col(account).alias("account"),
                                                             F.floor(F.col("reward")).cast("long").alias("tokens")),
                                                    F.col(seq)).alias("_b"))
    return first.select(update, "_b.account", "_b.tokens")


# ------------------------------------------------------------------ G14 ----

def payout(bookings: DataFrame, wallet: float, account: str = "account") -> DataFrame:
    """Sum per participant; a short wallet scales every payout by wallet / total."""
    per = bookings.groupBy(account).agg(F.sum("tokens").alias("tokens"))
    per = cut_lineage(per)      # read twice: once for its total
    total = per.agg(F.sum("tokens")).first()[0]     # one number
    j = per.withColumn("_tot", F.lit(total).cast("long"))
    factor = F.when(F.col("_tot") > F.lit(wallet), F.lit(float(wallet)) / F.col("_tot")).otherwise(F.lit(1.0))
    return j.select(account, "tokens", (F.col("tokens") * factor).alias("payout"))


# ------------------------------------------------------------------ A17 ----

def ledger_totals(bookings: DataFrame, account: str = "account") -> DataFrame:
    """Queue size (updates booked) and tokens per account."""
    return bookings.groupBy(account).agg(F.count(F.lit(1)).alias("updates"), F.sum("tokens").alias("tokens"))


# ------------------------------------------------------------------ J15 ----

def metrics_by_round(updates: DataFrame, accounts: DataFrame, round_col: str = "round",
                     update: str = "update_id", account: str = "account") -> DataFrame:
    """round -> global model (last update used) -> that update -> its metrics and account."""
    g = updates.groupBy(round_col).agg(F.max(update).alias(update))
    return g.join(updates.drop(round_col), update).join(accounts, account)


def participants(updates: DataFrame, round_col: str = "round", account: str = "account") -> DataFrame:
    return updates.select(round_col, account).distinct()
