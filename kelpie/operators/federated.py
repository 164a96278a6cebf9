"""Federated weight algebra on a weights table.

Weights table: ``(model_id, version, layer INT, shape ARRAY<INT>, values ARRAY<DOUBLE>)``,
one row per model layer.  Aggregation runs per (layer, chunk): every layer is
cut into fixed-size chunks, the participating models' chunks meet in one
row (bounded by models x chunk), and element-wise results are computed with
array expressions — a 10M-parameter layer is spread over many tasks, and no
row ever holds a whole model.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpie.functions.features import shape_text

CHUNK = 1024

WEIGHTS_SCHEMA = "model_id string, version int, layer int, shape array<int>, values array<double>"


def weights_rows(layers: DataFrame, model_id: Column | str, version: Column | int, layer: str = "layer",
                 values: str = "values", shape: Column | None = None) -> DataFrame:
    """One row per layer; the device answers ``version + 1`` and the final
    version ``-1`` stays ``-1``."""
    v = F.lit(version) if isinstance(version, int) else version
    mid = F.col(model_id) if isinstance(model_id, str) else model_id
    vals = F.transform(values, lambda x: x.cast("double"))
    return layers.select(
        mid.cast("string").alias("model_id"),
        F.when(v == -1, F.lit(-1)).otherwise(v + 1).cast("int").alias("version"),
        F.col(layer).cast("int").alias("layer"),
        (shape if shape is not None else F.array(F.size(values).cast("int"))).alias("shape"),
        vals.alias("values"))


def write_weights(weights: DataFrame, path: str) -> None:
    weights.write.mode("append").partitionBy("model_id", "version").parquet(path)


def read_weights(weights: DataFrame, model_id: str, version: int) -> DataFrame:
    """The layers of one model version, ordered by layer index (rows, not one list)."""
    return weights.where((F.col("model_id") == model_id) & (F.col("version") == version)).orderBy("layer")


def _chunks(weights: DataFrame, arrival: Column | None = None) -> DataFrame:
    """(model_id, layer, chunk, vals, arrival) with ``vals`` a slice of at most CHUNK elements."""
    n = F.size("values")
    return weights.select(
        "model_id", "layer", (F.lit(0) if arrival is None else arrival).alias("arrival"),
        F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(n / CHUNK).cast("int") - 1, F.lit(0)))).alias("chunk"),
        "values").select("model_id", "layer", "chunk", "arrival",
                         F.slice("values", F.col("chunk") * CHUNK + 1, CHUNK).alias("vals"))


def _assemble(chunked: DataFrame, col: str = "vals") -> DataFrame:
    """Chunks back to one array per layer (bounded by the layer size)."""
    return chunked.groupBy("layer").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("chunk", col))), lambda s: s[col])).alias("values"))


def _model_order(weights: DataFrame, global_id: str) -> DataFrame:
    """Index of every model: global first (0), devices in arrival order."""
    ids = weights.select("model_id").distinct()
    return ids.select("model_id", F.when(F.col("model_id") == global_id, F.lit(0)).otherwise(F.lit(1)).alias("_g"))


def _elementwise_mean(arrs: Column) -> Column:
    """Mean of an array of equal-length arrays, element by element."""
    first = arrs[0]
    summed = F.aggregate(F.slice(arrs, 2, 1 << 30), first,
                         lambda acc, a: F.zip_with(acc, a, lambda x, y: x + y))
    return F.transform(summed, lambda x: x / F.size(arrs))


def fed_avg(weights: DataFrame, global_id: str) -> DataFrame:
    """Element-wise mean per layer over the global model and all devices;
    without devices the global model is returned unchanged."""
    c = _chunks(weights)
    agg = c.groupBy("layer", "chunk").agg(
        F.sort_array(F.collect_list(F.struct((F.col("model_id") != global_id).alias("dev"), "model_id", "vals")))
        .alias("m"))
    avg = agg.select("layer", "chunk", _elementwise_mean(F.transform("m", lambda s: s["vals"])).alias("vals"))
    return _assemble(avg)


def _arrival(weights: DataFrame, order: str) -> Column:
    """Sort value of a model's arrival: the column ``order`` itself, or for text ids
    their natural order ("2" before "10", "d2" before "d10")."""
    if isinstance(weights.schema[order].dataType, T.StringType):
        return F.struct(F.length(F.col(order)).alias("n"), F.col(order).alias("id"))
    return F.struct(F.col(order).alias("n"), F.lit("").alias("id"))


def fed_avg_sequential(weights: DataFrame, global_id: str, order: str = "model_id") -> DataFrame:
    """Each arriving model is averaged with the running global:
    result = Σ_i w_i · 2^-(n-i+1) + global · 2^-n (i = 1..n in arrival order).
    ``order`` names the arrival column (number or time); without one, models
    arrive in the natural order of their ids."""
    c = _chunks(weights, _arrival(weights, order))
    agg = c.groupBy("layer", "chunk").agg(
        F.sort_array(F.collect_list(F.struct((F.col("model_id") != global_id).alias("dev"),
                                             F.col("arrival").alias("o"), "model_id", "vals"))).alias("m"))
    # m[0] is the global model (dev=false sorts first); devices follow in arrival order
    seq = F.aggregate(F.slice("m", 2, 1 << 30), F.col("m")[0]["vals"],
                      lambda acc, s: F.zip_with(acc, s["vals"], lambda x, y: (x + y) / 2))
    return _assemble(agg.select("layer", "chunk", seq.alias("vals")))


def model_distances(weights: DataFrame) -> DataFrame:
    """distance(i, j) = Σ over layers of the L2 norm of the difference.

    Per (layer, chunk) the m participating chunks are compared in-row (m is
    the number of models in the round); squared partial sums are added per
    (layer, pair), then sqrt per layer and a sum over layers.
    """
    c = _chunks(weights)
    per = c.groupBy("layer", "chunk").agg(F.sort_array(F.collect_list(F.struct("model_id", "vals"))).alias("m"))
    m = F.col("m")
    idx = F.sequence(F.lit(0), F.size(m) - 1)
    pairs = F.flatten(F.transform(idx, lambda i: F.transform(
        F.filter(idx, lambda j: j > i),
        lambda j: F.struct(m[i]["model_id"].alias("a"), m[j]["model_id"].alias("b"),
                           F.aggregate(F.zip_with(m[i]["vals"], m[j]["vals"], lambda x, y: (x - y) * (x - y)),
                                       F.lit(0.0), lambda acc, z: acc + z).alias("sq")))))
    sq = per.select("layer", F.explode(pairs).alias("p")).select("layer", "p.a", "p.b", "p.sq")
    per_layer = sq.groupBy("layer", "a", "b").agg(F.sqrt(F.sum("sq")).alias("d"))
    return per_layer.groupBy("a", "b").agg(F.sum("d").alias("distance"))


def krum_choice(weights: DataFrame, global_id: str, order: str = "model_id") -> DataFrame:
    """G04 choice: the model with the least summed distance to all others
    (global first, then devices in arrival order, see :func:`fed_avg_sequential`; first on ties)."""
    d = model_distances(weights)
    both = d.select(F.col("a").alias("model_id"), "distance").unionByName(d.select(F.col("b").alias("model_id"), "distance"))
    arrived = weights.groupBy("model_id").agg(F.min(_arrival(weights, order)).alias("arrival"))
    score = both.groupBy("model_id").agg(F.sum("distance").alias("score")).join(arrived, "model_id")
    first = F.struct("score", (F.col("model_id") != global_id).alias("dev"), "arrival", "model_id")
    return score.agg(F.min_by("model_id", first).alias("model_id"))


def krum(weights: DataFrame, global_id: str) -> DataFrame:
    """Krum; fewer than two devices -> FedAvg; none -> the global model."""
    n_dev = weights.where(F.col("model_id") != global_id).select("model_id").distinct().count()
    if n_dev == 0:
        return weights.where(F.col("model_id") == global_id).select("layer", "values")
    if n_dev < 2:
        return fed_avg(weights, global_id)
    chosen = krum_choice(weights, global_id)
    return weights.join(F.broadcast(chosen), "model_id", "left_semi").select("layer", "values")  # one-row side


STRATEGIES: dict[str, Callable[[DataFrame, str], DataFrame]] = {}


def register_strategy(name: str, fn: Callable[[DataFrame, str], DataFrame]) -> None:
    """Aggregation plug-in: a function (weights, global_id) -> (layer, values)."""
    STRATEGIES[name] = fn


register_strategy("FedAvg", fed_avg)
register_strategy("FedAvg+", krum)
register_strategy("Krum", krum)

# Strategies that can be selected but have no implementation.
UNIMPLEMENTED = ("FedOpt", "FedAdagrad", "FedAdam", "FedYogi")


def aggregate(weights: DataFrame, strategy: str, global_id: str) -> DataFrame:
    """Dispatch by strategy name."""
    if strategy in UNIMPLEMENTED:
        raise NotImplementedError(f"aggregation strategy {strategy} is selectable but not implemented")
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown aggregation strategy {strategy}")
    return STRATEGIES[strategy](weights, global_id)


def model_requirement(models: DataFrame) -> DataFrame:
    """Requirement record of a model: shapes as text, federated id,
    restriction, minimum data, framework and flags (plus its JSON text)."""
    out = models.select(
        "model_id",
        shape_text("input_shape").alias("input_shape"), shape_text("output_shape").alias("output_shape"),
        "federated_string_id", "data_restriction", F.col("min_data").cast("long").alias("min_data"),
        "framework", "distributed", "incremental",
        F.coalesce(F.col("blockchain"), F.lit("{}")).alias("blockchain"))
    body = F.struct(
        F.struct("input_shape", "output_shape").alias("model_format"),
        F.struct("federated_string_id", "data_restriction", "min_data").alias("federated_params"),
        "framework", "distributed", "incremental", "blockchain")
    return out.withColumn("requirement_json", F.to_json(body))


def round_record(updates: DataFrame, metrics: str = "metrics", decimals: int = 4) -> DataFrame:
    """Last loss and accuracy (else binary_accuracy) of training and
    validation from the metrics JSON, 4 decimals, samples as int when possible."""
    sch = "training map<string,array<double>>, validation map<string,array<double>>"
    m = F.from_json(F.col(metrics), sch)

    def last(split: str, name: str) -> Column:
        return F.element_at(F.element_at(m[split], F.lit(name)), -1)

    def acc(split: str) -> Column:
        return F.coalesce(last(split, "accuracy"), last(split, "binary_accuracy"))

    return updates.select(
        "*",
        F.round(last("training", "loss"), decimals).alias("train_loss"),
        F.round(acc("training"), decimals).alias("train_acc"),
        F.round(last("validation", "loss"), decimals).alias("val_loss"),
        F.round(acc("validation"), decimals).alias("val_acc"),
        F.col("num_data").try_cast("int").alias("num_samples")).drop(metrics)
