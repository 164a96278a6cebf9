"""Aggregations: class balance, weights, confusion matrices, scored metrics,
metric histories, summaries and set operations (A01-A15, U01-U03).

Every aggregate is a plain ``groupBy``/``agg`` so Spark combines partial
results per task before the shuffle (a hot class costs one partial row per
task, not a hot reducer).  Shares and ranks run over the aggregated table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpie.functions.features import round_np
from kelpie.operators.models import EPS
from kelpie.operators.sequence import laid_by_range, range_running_sum
from kelpie.session import cut_lineage


def _by(by) -> list[str]:
    return [] if by is None else ([by] if isinstance(by, str) else list(by))


def _share_window(by: list[str]) -> Window:
    return Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))


# ------------------------------------------------------------------ A01 ----

def class_counts(df: DataFrame, label: str = "label", by=None, decimals: int = 4) -> DataFrame:
    """Count and percent per class (per device when ``by`` is given)."""
    by = _by(by)
    c = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))
    # the window runs over the (groups x classes) table, not over the rows
    return c.withColumn("pct", F.round(F.col("n") * 100.0 / F.sum("n").over(_share_window(by)), decimals))


# ------------------------------------------------------------------ A02 ----

def class_weights(df: DataFrame, label: str = "label", by=None) -> DataFrame:
    """Inverse-frequency weights ``n / (k * count)`` (k = classes present in the group)."""
    by = _by(by)
    c = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("cnt"))
    w = _share_window(by)
    return c.withColumn("weight", F.sum("cnt").over(w) / (F.count(F.lit(1)).over(w) * F.col("cnt")))


# ------------------------------------------------------------------ A03 ----

def weight_stats(df: DataFrame, weight: str = "weight") -> DataFrame:
    """min / max / mean of the sample weights over ALL rows."""
    w = F.col(weight).cast("double")
    return df.agg(F.min(w).alias("min_w"), F.max(w).alias("max_w"), F.avg(w).alias("mean_w"))


# ------------------------------------------------------------------ A04 ----

def feature_ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """min / max per feature in one pass, returned in long form."""
    aggs = []
    for c in cols:
        aggs += [F.min(F.col(c).cast("double")).alias(f"mn_{c}"), F.max(F.col(c).cast("double")).alias(f"mx_{c}")]
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"mn_{c}").alias("min"), F.col(f"mx_{c}").alias("max"))
        for c in cols])).alias("f")).select("f.*")


# ------------------------------------------------------------------ A05 ----

def confusion_matrix(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Long-form matrix over the sorted union of truth and prediction labels, zero-filled.

    The label universe is one aggregated row (distinct classes); the k x k grid
    is generated from it by two explodes, then the counts are left-joined.
    """
    counts = df.groupBy(F.col(y).alias("y"), F.col(yhat).alias("yhat")).agg(F.count(F.lit(1)).alias("n"))
    uni = counts.select(F.explode(F.array("y", "yhat")).alias("c")).where(F.col("c").isNotNull()) \
        .agg(F.sort_array(F.collect_set("c")).alias("u"))
    grid = uni.select(F.explode("u").alias("y"), "u").select("y", F.explode("u").alias("yhat"))
    return grid.join(counts, ["y", "yhat"], "left").select("y", "yhat", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def confusion_pivot(cm: DataFrame) -> DataFrame:
    """Display form: one row per truth label, one column per predicted label."""
    return cm.groupBy("y").pivot("yhat").agg(F.first("n")).orderBy("y")


# ------------------------------------------------------------------ A06 ----

def confusion_rates(cm: DataFrame, decimals: int = 4) -> DataFrame:
    """Row-normalised matrix; null when the truth row is empty."""
    tot = F.sum("n").over(Window.partitionBy("y"))
    return cm.withColumn("rate", F.when(tot > 0, round_np(F.col("n") / tot, decimals)))


# ------------------------------------------------------------------ A07 ----

def binary_cells(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """TN / FP / FN / TP of a 0/1 problem in one aggregation."""
    a, p = F.col(y).cast("int"), F.col(yhat).cast("int")
    return df.agg(
        F.sum(((a == 0) & (p == 0)).cast("long")).alias("tn"),
        F.sum(((a == 0) & (p == 1)).cast("long")).alias("fp"),
        F.sum(((a == 1) & (p == 0)).cast("long")).alias("fn"),
        F.sum(((a == 1) & (p == 1)).cast("long")).alias("tp"))


def class_report(cm: DataFrame, decimals: int = 6) -> DataFrame:
    """precision / recall / f1 / support per class plus macro and weighted averages
    (zero division gives 0), computed from the long confusion matrix."""
    tp = cm.where(F.col("y") == F.col("yhat")).select(F.col("y").alias("cls"), F.col("n").alias("tp"))
    sup = cm.groupBy(F.col("y").alias("cls")).agg(F.sum("n").alias("support"))
    pred = cm.groupBy(F.col("yhat").alias("cls")).agg(F.sum("n").alias("npred"))
    r = tp.join(sup, "cls").join(pred, "cls")
    prec = F.when(F.col("npred") > 0, F.col("tp") / F.col("npred")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    r = r.select(F.col("cls").cast("string").alias("cls"), prec.alias("precision"), rec.alias("recall"),
                 F.col("support").cast("long").alias("support"))
    r = r.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                  2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                     .otherwise(0.0))
    tot = r.agg(F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
                (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
                (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"),
                F.sum("support").alias("s"))
    avgs = tot.select(F.explode(F.array(
        F.struct(F.lit("macro avg").alias("cls"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("s").alias("support"), F.col("mf").alias("f1")),
        F.struct(F.lit("weighted avg").alias("cls"), F.col("wp").alias("precision"), F.col("wr").alias("recall"),
                 F.col("s").alias("support"), F.col("wf").alias("f1")))).alias("a")).select("a.*")
    out = r.unionByName(avgs)
    return out.select("cls", *[F.round(c, decimals).alias(c) for c in ("precision", "recall", "f1")], "support")


# ------------------------------------------------------------------ A08 ----

def evaluate(df: DataFrame, y: str, p: str, weight: str | None = None, threshold: float = 0.5) -> DataFrame:
    """Binary metrics (0/1 truth, score p): accuracy/binary accuracy (also
    sample-weighted), precision, recall, MAE, MSE, binary cross-entropy with p
    clipped to [1e-7, 1-1e-7], and ROC AUC with ties counted half.

    One pass over the rows: everything decomposes over distinct scores, so the
    rows are grouped by score once (positives, negatives and their weights,
    partial aggregation per task) and every metric is computed from that table.
    """
    yy = F.col(y).cast("int")
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    by_score = df.groupBy(F.col(p).cast("double").alias("s")).agg(
        F.sum((yy == 1).cast("long")).alias("pos"), F.sum((yy == 0).cast("long")).alias("neg"),
        F.sum(F.when(yy == 1, w).otherwise(0.0)).alias("wpos"), F.sum(F.when(yy == 0, w).otherwise(0.0)).alias("wneg"))
    by_score = cut_lineage(by_score)   # read by the metric sums and the AUC prefix sums
    s = F.col("s")
    hat = s > F.lit(threshold)
    pc = F.least(F.greatest(s, F.lit(EPS)), F.lit(1 - EPS))
    n = F.sum(F.col("pos") + F.col("neg"))
    base = by_score.agg(
        (F.sum(F.when(hat, F.col("pos")).otherwise(F.col("neg"))) / n).alias("binary_accuracy"),
        (F.sum(F.when(hat, F.col("wpos")).otherwise(F.col("wneg"))) / F.sum(F.col("wpos") + F.col("wneg")))
        .alias("weighted_binary_accuracy"),
        F.try_divide(F.sum(F.when(hat, F.col("pos")).otherwise(0)).cast("double"),
                     F.sum(F.when(hat, F.col("pos") + F.col("neg")).otherwise(0))).alias("precision"),
        F.try_divide(F.sum(F.when(hat, F.col("pos")).otherwise(0)).cast("double"), F.sum("pos")).alias("recall"),
        (F.sum(F.col("pos") * F.abs(1 - s) + F.col("neg") * F.abs(s)) / n).alias("mae"),
        (F.sum(F.col("pos") * (1 - s) * (1 - s) + F.col("neg") * s * s) / n).alias("mse"),
        (F.sum(-(F.col("pos") * F.log(pc)) - F.col("neg") * F.log(1 - pc)) / n).alias("binary_crossentropy"))
    a = _auc_from_scores(by_score).withColumn("_g", F.lit(0))
    # both sides are global aggregates (exactly one row): a proven-size broadcast
    return base.withColumn("_g", F.lit(0)).join(F.broadcast(a), "_g").drop("_g")


def evaluate_multiclass(df: DataFrame, label: str, values: str, weight: str | None = None) -> DataFrame:
    """Metrics of class probabilities (``values``, one per class) against an integer
    label: rows, sparse categorical accuracy (the first of equal maxima is the
    prediction) and cross-entropy with probabilities clipped to [1e-7, 1 - 1e-7].
    One aggregation; rows without a label, or whose label is no class, are left out."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    y = F.col(label).cast("int")
    src = df.where(y.isNotNull() & (y >= 0) & (y < F.size(values)))
    hit = (F.array_position(values, F.array_max(values)) - 1 == y).cast("double")
    p = F.least(F.greatest(F.element_at(values, y + 1).cast("double"), F.lit(EPS)), F.lit(1 - EPS))
    return src.agg(F.count(F.lit(1)).alias("n"), (F.sum(hit * w) / F.sum(w)).alias("sparse_categorical_accuracy"),
                   (F.sum(-F.log(p) * w) / F.sum(w)).alias("sparse_categorical_crossentropy"))


def auc(df: DataFrame, y: str, p: str) -> DataFrame:
    """Exact ROC AUC without a global sort (see :func:`_auc_from_scores`)."""
    yy = F.col(y).cast("int")
    by_score = df.groupBy(F.col(p).cast("double").alias("s")).agg(
        F.sum((yy == 1).cast("long")).alias("pos"), F.sum((yy == 0).cast("long")).alias("neg"))
    return _auc_from_scores(by_score)


def _auc_from_scores(by_score: DataFrame) -> DataFrame:
    """AUC from (score, pos, neg): the negatives below each score are a running sum over range partitions of
    the distinct scores, which follow the data however close the scores lie; ties count half."""
    b = range_running_sum(laid_by_range(by_score.select("s", "pos", "neg"), None, ["s"]), None, ["s"], "neg", "below")
    return b.agg(F.try_divide(F.sum(F.col("pos") * F.col("below")) + 0.5 * F.sum(F.col("pos") * F.col("neg")),
                              F.sum("pos") * F.sum("neg")).alias("auc"))


# ------------------------------------------------------------------ A09 ----

def round_series(history: DataFrame, update: str = "update", metric: str = "metric", split: str = "split",
                 epoch: str = "epoch", value: str = "value") -> DataFrame:
    """Last-epoch value of each metric per received update (= per round)."""
    return history.groupBy(update, metric, split).agg(
        F.max_by(F.col(value), F.col(epoch)).alias("value"), F.max(epoch).alias("last_epoch"))


# ------------------------------------------------------------------ A10 ----

def split_exits(history: DataFrame, names: Sequence[str], metric: str = "metric") -> DataFrame:
    """Multi-exit history: the sub-model name inside a metric name picks the exit;
    the ``<name>_`` prefix is removed from the metric.  The first listed name
    that occurs wins."""
    m = F.col(metric)
    exit_col = F.lit(None).cast("string")
    rest = F.lit(None).cast("string")
    for n in reversed(list(names)):
        hit = m.contains(n)
        exit_col = F.when(hit, F.lit(n)).otherwise(exit_col)
        rest = F.when(hit, F.regexp_replace(m, F.lit(n + "_"), F.lit(""))).otherwise(rest)
    return history.withColumn("exit", exit_col).withColumn("exit_metric", rest)


def exit_test_index(exit_idx: int, k: int, n_exits: int) -> int:
    """Index of test metric k of exit x in the flat evaluate() list (loss first)."""
    return exit_idx + 1 + k * n_exits


# ------------------------------------------------------------------ A11 ----

def append_history(a: Column | str, b: Column | str) -> Column:
    """Later fits extend earlier per-epoch metric lists (column form, for lists
    that are already bounded rows, e.g. one result's epochs)."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    empty = F.array().cast("array<double>")
    return F.concat(F.coalesce(ca, empty), F.coalesce(cb, empty))


def append_history_long(earlier: DataFrame, later: DataFrame, key: str, order: str,
                        value: str = "value") -> DataFrame:
    """A11 in long form: the later fit's epochs continue after the earlier fit's.

    epoch = position inside the fit (blocked) + number of earlier epochs of the
    key, so no history is gathered into one row however long it is.
    """
    from kelpie.operators.sequence import dense_position
    a = dense_position(earlier.select(key, order, value), key, order, name="epoch", with_total=True)
    n_a = a.select(key, F.col("epoch_total").alias("_na")).distinct()
    b = dense_position(later.select(key, order, value), key, order, name="epoch")
    b = b.join(n_a, key, "left").withColumn("epoch", F.col("epoch") + F.coalesce(F.col("_na"), F.lit(0))).drop("_na")
    return a.drop("epoch_total").unionByName(b)


def merge_partial(row: DataFrame, patch: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Partial update: given patch fields replace the stored ones, the rest stay."""
    p = patch.select(key, *[F.col(c).alias(f"_p_{c}") for c in cols])
    j = row.join(p, key, "left")
    return j.select(*[F.coalesce(F.col(f"_p_{c}"), F.col(c)).alias(c) if c in cols else F.col(c)
                      for c in row.columns])


# ------------------------------------------------------------------ A12 ----

def chart_series(history: DataFrame, result: str = "result", metric: str = "metric",
                 epoch: str = "epoch", value: str = "value") -> DataFrame:
    """Per metric a training series and, when the training metric exists, its
    ``val_`` twin, as (epoch from 1, value) points.  ``history`` is long form
    (one row per result, metric, 0-based epoch), so no list is collected."""
    m = F.col(metric)
    is_val = m.startswith("val_")
    h = history.select(result, F.when(is_val, F.substring(m, 5, 1 << 30)).otherwise(m).alias(metric),
                       F.when(is_val, F.lit("val")).otherwise(F.lit("train")).alias("series"),
                       (F.col(epoch) + 1).cast("int").alias("epoch"), F.col(value).alias("value"))
    train_keys = h.where(F.col("series") == "train").select(result, metric).distinct()
    return h.join(train_keys, [result, metric], "left_semi")


# ------------------------------------------------------------------ A13 ----

def inference_summary(df: DataFrame, y: str, pred: str, score: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"),
                  F.sum((F.col(y) == F.col(pred)).cast("long")).alias("correct"),
                  F.avg((F.col(y) == F.col(pred)).cast("double")).alias("accuracy"),
                  F.sum((F.col(pred) == 1).cast("long")).alias("positives"),
                  F.avg(F.col(score).cast("double")).alias("mean_score"))


# ------------------------------------------------------------------ A14 ----

def rounds_map(round_metrics: DataFrame, round_col: str = "round", sort_key: str = "account") -> DataFrame:
    """Per round its device rows in ``sort_key`` order, as (round, index, row) —
    long form with the device count, so a busy round is not one giant row."""
    from kelpie.operators.sequence import dense_position
    return dense_position(round_metrics, round_col, sort_key, name="idx", with_total=True) \
        .withColumnRenamed("idx_total", "n_devices")


# ------------------------------------------------------------------ A15 ----

def device_totals(df: DataFrame, device: str) -> DataFrame:
    """Samples per device and the overall total (device ``ALL``) via ROLLUP."""
    r = df.rollup(device).agg(F.count(F.lit(1)).alias("n"), F.grouping(device).alias("_g"))
    return r.select(F.when(F.col("_g") == 1, F.lit("ALL")).otherwise(F.col(device).cast("string")).alias(device), "n")


# ------------------------------------------------------------------ A16 ----

def config_facts(config_models: DataFrame, models: DataFrame, config: str, model: str,
                 framework: str, distributed: str) -> DataFrame:
    """Per configuration: distinct frameworks and whether any model is distributed."""
    m = models.select(F.col(model).alias("_m"), F.col(framework).alias("framework"),
                      F.col(distributed).alias("distributed"))
    j = config_models.select(F.col(config).alias("configuration"), F.col(model).alias("_m")).join(m, "_m")
    return j.groupBy("configuration").agg(
        F.array_join(F.sort_array(F.collect_set("framework")), ",").alias("frameworks"),
        F.count_distinct("framework").alias("n_frameworks"),
        F.bool_or("distributed").alias("any_distributed"))


# ------------------------------------------------------------- U01-U03 ----

def concat_sets(*dfs: DataFrame) -> DataFrame:
    """Bag union by column name (no distinct)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def grow(train: DataFrame, pseudo: DataFrame) -> DataFrame:
    """Labelled ∪ pseudo-labelled rows for the next self-training round."""
    return train.unionByName(pseudo, allowMissingColumns=True)


def participants_set(df: DataFrame, account: str) -> DataFrame:
    return df.select(account).distinct()


def label_universe(df: DataFrame, y: str, yhat: str) -> DataFrame:
    return df.select(F.col(y).alias("label")).union(df.select(F.col(yhat).alias("label"))).distinct()
