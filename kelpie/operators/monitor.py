"""Sequence and window operators of the live monitor and the trainers
(W01-W06).  Groups are never handed to one task whole: positions and
running counts come from the blocked helpers in :mod:`kelpie.operators.sequence`.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpie.functions.features import round_js
from kelpie.operators.sequence import (DEFAULT_BLOCK, blocked_lag, dense_position, laid_by_range, range_position,
                                       range_running_max)
from kelpie.session import cut_lineage


def _keys(by) -> list[str]:
    return [] if by is None else ([by] if isinstance(by, str) else list(by))


# ------------------------------------------------------------------ W01 ----

def running_share(df: DataFrame, label: str, order: str, by=None, decimals: int = 4,
                  unknown: str = "unknown") -> DataFrame:
    """Share of the row's class among all rows so far (4 decimals).

    total so far = position in the group + 1, class so far = position in
    (group, class) + 1, both from blocked prefix counts.
    """
    keys = _keys(by)
    d = df.withColumn("_cls", F.coalesce(F.col(label).cast("string"), F.lit(unknown)))
    d = dense_position(d, keys, order, name="_tot")
    d = dense_position(d, [*keys, "_cls"], order, name="_cnt")
    return d.withColumn("share", round_js((F.col("_cnt") + 1) / (F.col("_tot") + 1), decimals)) \
            .withColumn("seen", F.col("_tot") + 1).drop("_tot", "_cnt", "_cls")


# ------------------------------------------------------------------ W02 ----

def last_statuses(df: DataFrame, key, order: str, status: str, k: int = 4) -> DataFrame:
    """The current status and the k before it (``prev_1`` .. ``prev_k``)."""
    keys = _keys(key)
    d = dense_position(df, keys, order, name="_pos")
    return blocked_lag(d, keys, "_pos", {f"prev_{i}": (status, i) for i in range(1, k + 1)}).drop("_pos")


# ------------------------------------------------------------------ W03 ----

def leader_changes(df: DataFrame, label: str, order: str, classes: Sequence, by=None,
                   window: int = 0, decimals: int = 4, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Emit when the leading class (highest share so far, first in ``classes`` on
    ties) changes, or when the running total is a multiple of ``window``.

    Running counts of every class: per-block class counts -> prefix over
    blocks (small table) + running counts inside the block.
    """
    keys = _keys(by)
    d = dense_position(df, keys, order, name="pos", block=block)
    # read by the block table, the join back and the lag pass: materialize once
    d = cut_lineage(d.withColumn("_blk", F.floor(F.col("pos") / F.lit(block)).cast("long")))
    ind = {c: (F.col(label) == F.lit(c)).cast("long") for c in classes}
    bc = d.groupBy(*keys, "_blk").agg(*[F.sum(v).alias(f"_b{i}") for i, v in enumerate(ind.values())])
    wb = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy("_blk") \
        .rowsBetween(Window.unboundedPreceding, -1)
    base = bc.select(*keys, "_blk", *[F.coalesce(F.sum(f"_b{i}").over(wb), F.lit(0)).alias(f"_base{i}")
                                      for i in range(len(classes))])
    d = d.join(base, [*keys, "_blk"])
    wr = Window.partitionBy(*keys, "_blk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    for i, c in enumerate(classes):
        d = d.withColumn(f"_c{i}", F.col(f"_base{i}") + F.sum(ind[c]).over(wr))
    tot = F.col("pos") + 1
    shares = [round_js(F.col(f"_c{i}") / tot, decimals) for i in range(len(classes))]
    best = F.greatest(*shares) if len(shares) > 1 else shares[0]
    leader = F.lit(None).cast("string")
    for i in reversed(range(len(classes))):
        leader = F.when(shares[i] == best, F.lit(str(classes[i]))).otherwise(leader)
    d = d.withColumn("leader", leader).withColumn("leader_share", best)
    d = d.drop("_blk", *[f"_base{i}" for i in range(len(classes))], *[f"_c{i}" for i in range(len(classes))])
    d = blocked_lag(d, keys, "pos", {"_prev": ("leader", 1)}, block=block)
    emit = F.col("_prev").isNull() | (F.col("_prev") != F.col("leader"))
    if window:
        emit = emit | (F.pmod(tot, F.lit(window)) == 0)
    return d.withColumn("emit", emit).drop("_prev")


# ------------------------------------------------------------------ W04 ----

def regression_series(pred: DataFrame, order: str, values: str = "values", by=None) -> DataFrame:
    """Each output dimension i gets points numbered 0, 1, 2 ... in arrival order."""
    keys = _keys(by)
    d = dense_position(pred, keys, order, name="point")
    return d.select(*keys, order, "point", F.posexplode(values).alias("i", "value"))


# ------------------------------------------------------------------ W05 ----

_RATCHET_OUT = T.StructType([T.StructField("key", T.StringType()), T.StructField("order", T.LongType()),
                             T.StructField("value", T.DoubleType()), T.StructField("reference", T.DoubleType())])


def _ratchet_frame(ks, os_, vs, rs) -> pd.DataFrame:
    return pd.DataFrame({"key": pd.Series(ks, dtype=object), "order": pd.Series(os_, dtype="int64"),
                         "value": pd.Series(vs, dtype="float64"), "reference": pd.Series(rs, dtype="float64")})


def _moved(d: float):
    """Emission test against the reference for a rise of at least ``d``; an equal
    value never counts.  For d >= 0 it is monotone in x."""
    if d > 0:
        return lambda x, r: x - r >= d
    if d == 0:
        return lambda x, r: x > r
    return lambda x, r: x != r and x - r >= d


# steps of a block function: the reference r becomes ``out`` of the first step whose ``thr`` has moved from r
_FAN = 16


def _first_moved(v: np.ndarray, r: np.ndarray, d: float) -> np.ndarray:
    """For each reference the first place in the rising values ``v`` that has moved (len(v): none)."""
    moved, n = _moved(d), len(v)
    at = np.searchsorted(v, r + d)
    while True:     # r + d is rounded: the rule itself decides
        back = (at > 0) & moved(v[np.maximum(at - 1, 0)], r) if n else np.zeros(len(r), bool)
        on = (at < n) & ~moved(v[np.minimum(at, n - 1)], r) & ~back if n else np.zeros(len(r), bool)
        if not (back.any() or on.any()):
            return at
        at = at - back + on


def _apply(thr: np.ndarray, out: np.ndarray, r: np.ndarray, d: float) -> np.ndarray:
    at = _first_moved(thr, r, d)
    return np.where(at < len(thr), out[np.minimum(at, len(thr) - 1)], r) if len(thr) else r


def _merged(thr: np.ndarray, out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring steps that lead to one reference become one."""
    keep = np.ones(len(thr), bool)
    keep[:-1] = out[1:] != out[:-1]
    return thr[keep], out[keep]


def _block_steps(v: np.ndarray, before: float | None, d: float) -> tuple[np.ndarray, np.ndarray]:
    """The function of a block of rising values.  A reference that enters lies within ``d`` below
    ``before``, the greatest value so far (None: the first value is the reference), so only
    the records up to the first that has moved from ``before`` can be the first taken."""
    nxt = _first_moved(v, v, d)
    end = np.append(np.where(nxt < len(v), nxt, np.arange(len(v))), len(v))[:len(v)]
    while True:     # follow the chain to its last record, twice as far each time
        further = end[end]
        if np.array_equal(further, end):
            break
        end = further
    if before is None:
        return v[:1], v[end[:1]]
    n = min(len(v), int(_first_moved(v, np.array([before]), d)[0]) + 1)
    return _merged(v[:n], v[end[:n]])


def _compose(parts: list[tuple[np.ndarray, np.ndarray]], before: float | None, d: float) -> tuple[np.ndarray, np.ndarray]:
    """One function for consecutive blocks."""
    moved, thr, out, closed = _moved(d), [], [], False
    for t, o in parts:
        out = [_apply(t, o, x, d) for x in out]
        if not closed:
            n = len(t)
            if before is not None and n:
                n = min(n, int(_first_moved(t, np.array([before]), d)[0]) + 1)
                closed = bool(moved(t[n - 1], before))
            else:
                closed = before is None
            thr.append(t[:n])
            out.append(o[:n])
    return _merged(np.concatenate(thr), np.concatenate(out))


def improvements(df: DataFrame, key: str, order: str, value: str, change: str = "up",
                 d: float = 0.05, block: int = DEFAULT_BLOCK) -> DataFrame:
    """Improvement ratchet: the first value is the reference; a later value is
    emitted (and becomes the reference) when it differs and moved by at least
    ``d`` in the ``change`` direction.  Null and NaN values are no measurements:
    they are passed over, as are rows without a key.

    Exact and parallel even for a key holding a third of the rows, for d >= 0:

    1. every reference is greater than all values before it, so only such records
       matter.  They are found by a running maximum over range partitions; for most keys
       few are left;
    2. a key's records are cut into blocks of ``block``.  A block is a monotone step function
       from the reference that enters to the one that leaves; functions are composed in a tree of
       ``_FAN`` blocks at a time, and the references are handed down the same tree;
    3. each block emits its chain from its reference, in one pass over sorted partitions.

    A function has at most as many steps as records lie within ``d`` above what was the greatest value
    before the block, and steps with one result are merged.  ``down`` runs the same on negated values.
    ``d < 0`` (where the accepted moves are not monotone) uses the plain sorted fold.
    """
    if d < 0:
        return _improvements_fold(df, key, order, value, change, d)
    sign = 1.0 if change == "up" else -1.0
    src = df.select(F.col(key).cast("string").alias("key"), F.col(order).cast("long").alias("order"),
                    (F.col(value).cast("double") * F.lit(sign)).alias("v")).where("key IS NOT NULL AND v IS NOT NULL AND NOT isnan(v)")
    src = laid_by_range(src, "key", ["order", "v"])
    records = range_running_max(src, "key", ["order", "v"], "v", "top").where("top IS NULL OR v > top")
    records = cut_lineage(range_position(records, "key", ["order", "v"]).withColumn("blk", F.floor(F.col("pos") / block).cast("long"))
                          .select("key", "blk", "order", "v", "top"))
    last = records.agg(F.max("blk")).first()[0] or 0
    if last:
        entries = _entries(records, int(last), d)
        records = records.join(entries, ["key", "blk"], "left")
    else:
        records = records.withColumn("r_in", F.lit(None).cast("double"))
    moved = _moved(d)

    def emit(batches):
        here, ref = None, None
        for pdf in batches:
            ks, os_, vs, rs = [], [], [], []
            key_, blk, o, v, r_in = (pdf[c].to_numpy() for c in ("key", "blk", "order", "v", "r_in"))
            change_at = np.flatnonzero((key_[1:] != key_[:-1]) | (blk[1:] != blk[:-1])) + 1
            for a, b in zip([0, *change_at], [*change_at, len(v)]):
                if a == b:
                    continue
                if here != (key_[a], blk[a]):
                    here, ref = (key_[a], blk[a]), (None if np.isnan(r_in[a]) else r_in[a])
                if ref is None:     # the key's first value is the reference, not an emission
                    ref = v[a]
                part = v[a:b]
                i = int(_first_moved(part, np.array([ref]), d)[0])
                while i < len(part):
                    ks.append(key_[a]), os_.append(o[a + i]), vs.append(part[i] * sign), rs.append(ref * sign)
                    ref = part[i]
                    if i + 1 < len(part) and moved(part[i + 1], ref):
                        i += 1
                    else:
                        i = int(_first_moved(part, np.array([ref]), d)[0])
            yield _ratchet_frame(ks, os_, vs, rs)

    return records.repartition("key", "blk").sortWithinPartitions("key", "blk", "v").mapInPandas(emit, _RATCHET_OUT)


_STEPS = "key string, blk long, top double, thr array<double>, out array<double>"


def _entries(records: DataFrame, last: int, d: float) -> DataFrame:
    """(key, blk, r_in): the reference that enters each block but a key's first, for keys of several blocks."""

    def before(x):
        return None if x is None or np.isnan(x) else float(x)

    def steps(pdf):
        pdf = pdf.sort_values("v")
        thr, out = _block_steps(pdf["v"].to_numpy(), before(pdf["top"].iloc[0]), d)
        return pd.DataFrame({"key": pdf["key"].iloc[:1], "blk": pdf["blk"].iloc[:1], "top": pdf["top"].iloc[:1],
                             "thr": [thr], "out": [out]}, index=pdf.index[:1])

    def composed(pdf):
        pdf = pdf.sort_values("blk")
        thr, out = _compose(list(zip(pdf["thr"], pdf["out"])), before(pdf["top"].iloc[0]), d)
        return pd.DataFrame({"key": pdf["key"].iloc[:1], "blk": pdf["blk"].iloc[:1] // _FAN, "top": pdf["top"].iloc[:1],
                             "thr": [thr], "out": [out]}, index=pdf.index[:1])

    def hand_down(pdf):
        pdf = pdf.sort_values("blk")
        r, r_in = before(pdf["r_in"].iloc[0]), []
        for thr, out in zip(pdf["thr"], pdf["out"]):
            r_in.append(r)
            r = float(out[0]) if r is None else float(_apply(thr, out, np.array([r]), d)[0])
        return pd.DataFrame({"key": pdf["key"], "blk": pdf["blk"], "r_in": pd.Series(r_in, dtype="float64", index=pdf.index)})

    long = records.where("blk > 0").select("key").distinct()
    level = cut_lineage(records.join(long, "key", "left_semi").groupBy("key", "blk").applyInPandas(steps, _STEPS))
    levels = [level]
    while last >= _FAN:
        level = cut_lineage(level.groupBy("key", F.floor(F.col("blk") / _FAN)).applyInPandas(composed, _STEPS))
        levels.append(level)
        last //= _FAN
    entered = level.select("key", F.lit(0).cast("long").alias("up"), F.lit(None).cast("double").alias("r_in")).distinct()
    for level in reversed(levels):
        below = level.withColumn("up", F.floor(F.col("blk") / _FAN)).join(entered, ["key", "up"])
        down = below.groupBy("key", "up").applyInPandas(hand_down, "key string, blk long, r_in double")
        entered = down.select("key", F.col("blk").alias("up"), "r_in")
    return entered.withColumnRenamed("up", "blk")


def _improvements_fold(df: DataFrame, key: str, order: str, value: str, change: str, d: float) -> DataFrame:
    """Sequential form (used for d < 0): rows hash-partitioned by key and
    sorted; each task streams its Arrow batches carrying (key, reference)."""
    moved, sign = _moved(d), 1.0 if change == "up" else -1.0
    src = df.select(F.col(key).cast("string").alias("key"), F.col(order).cast("long").alias("order"),
                    (F.col(value).cast("double") * F.lit(sign)).alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    src = src.repartition("key").sortWithinPartitions("key", "order")

    def fold(batches):
        cur_key, ref = None, None
        for pdf in batches:
            out_k, out_o, out_v, out_r = [], [], [], []
            for k, o, v in zip(pdf["key"].tolist(), pdf["order"].tolist(), pdf["v"].tolist()):
                if k != cur_key:
                    cur_key, ref = k, v
                    continue
                if moved(v, ref):
                    out_k.append(k)
                    out_o.append(o)
                    out_v.append(v * sign)
                    out_r.append(ref * sign)
                    ref = v
            yield _ratchet_frame(out_k, out_o, out_v, out_r)

    return src.mapInPandas(fold, _RATCHET_OUT)


# ------------------------------------------------------------------ W06 ----

def latest(df: DataFrame, key, time: str, tiebreak: str | None = None) -> DataFrame:
    """Latest row per key (newest time, then highest ``tiebreak``) by ``max_by``:
    a partial aggregate per task, no sort of the group."""
    keys = _keys(key)
    rest = [c for c in df.columns if c not in keys]
    ordering = F.struct(F.col(time), F.col(tiebreak)) if tiebreak else F.col(time)
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), ordering).alias("_r"))
    return agg.select(*keys, *[F.col("_r")[c].alias(c) for c in rest])
