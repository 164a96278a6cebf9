"""Filters and predicates (F01-F07): routing, confidence, dead letters,
search, metric selection, deployment validation and life-cycle guards."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpie.functions.codecs import key_to_int

# Argument text accepted for fit/evaluate keyword arguments.
KWARGS_PATTERN = r"^[A-Za-z0-9-_]*[ ]*=[ ]*[A-Za-z0-9-_]*[ ]*(,[ ]*[A-Za-z0-9-_]*[ ]*=[ ]*[A-Za-z0-9-_]*[ ]*)*$"

# Deployment defaults filled when a field is missing.
DEPLOYMENT_DEFAULTS = {
    "batch": 1,
    "optimizer": "adam",
    "learning_rate": 0.001,
    "loss": "sparse_categorical_crossentropy",
    "metrics": "sparse_categorical_accuracy",
    "stream_timeout": 60000,
    "improvement": 0.05,
    "unsupervised_rounds": 5,
    "confidence": 0.9,
    "agg_rounds": 15,
    "min_data": 1000,
    "registered_devices": -1,
}


def for_deployment(control: DataFrame, deployment_id: int, key: str = "key") -> DataFrame:
    """control rows addressed to this deployment (null keys never match)."""
    return control.where(key_to_int(key) == F.lit(deployment_id))


def confident(df: DataFrame, threshold: float = 0.9, values: str = "values") -> DataFrame:
    """rows whose top probability reaches the confidence threshold."""
    return df.where(F.array_max(values) >= F.lit(threshold))


def with_dead_letter(df: DataFrame, value: str, schema: T.StructType, out: str = "decoded") -> DataFrame:
    """decode JSON without failing the job; ``error`` is set on bad rows.

    PERMISSIVE parsing with a corrupt-record column marks malformed payloads;
    route with ``where(error is null)`` / ``where(error is not null)`` to the
    main and the dead-letter sink (both read one persisted frame).
    """
    txt = F.col(value).cast("string")
    full = T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", T.StringType())])
    parsed = F.from_json(txt, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    d = df.withColumn("_parsed", parsed)
    bad = txt.isNull() | F.col("_parsed._corrupt_record").isNotNull()
    return d.withColumn(out, F.when(~bad, F.struct(*[F.col("_parsed")[f.name].alias(f.name) for f in schema.fields]))) \
            .withColumn("error", F.when(bad, F.lit("malformed payload"))).drop("_parsed")


def search(df: DataFrame, text: str, cols: Sequence[str] | None = None) -> DataFrame:
    """any column contains ``text`` (case-insensitive substring)."""
    cols = list(cols or df.columns)
    needle = F.lit(text.lower())
    cond = reduce(lambda a, b: a | b,
                  [F.coalesce(F.lower(F.col(c).cast("string")).contains(needle), F.lit(False)) for c in cols])
    return df.where(cond)


def select_metrics(series: DataFrame, names: Sequence[str], name: str = "metric") -> DataFrame:
    """series whose name contains a selected metric (``val_`` twins come along)."""
    arr = F.array(*[F.lit(n) for n in names])
    return series.where(F.exists(arr, lambda n: F.col(name).contains(n)))


def validate_deployments(df: DataFrame, model_code: Column | None = None) -> DataFrame:
    """rule columns -> ``errors`` array (empty = valid), defaults filled."""
    checks = [
        F.when(F.col("batch") <= 0, F.lit("batch size is not positive")),
        F.when((F.coalesce(F.col("kwargs_fit"), F.lit("")) != "") & ~F.col("kwargs_fit").rlike(KWARGS_PATTERN),
               F.lit("fit arguments are not name=value pairs")),
        F.when((F.coalesce(F.col("kwargs_val"), F.lit("")) != "") & ~F.col("kwargs_val").rlike(KWARGS_PATTERN),
               F.lit("validation arguments are not name=value pairs")),
    ]
    if model_code is not None:
        checks.append(F.when(F.col("incremental") & F.col("indefinite") & ~F.col("distributed")
                             & ~model_code.contains(F.col("monitoring_metric")),
                             F.lit("the model has no such metric to monitor")))
    out = df.withColumn("errors", F.filter(F.array(*checks), lambda e: e.isNotNull()))
    for k, v in DEPLOYMENT_DEFAULTS.items():
        if k in df.columns:
            out = out.withColumn(k, F.coalesce(F.col(k), F.lit(v)))
    return out.withColumn("valid", F.size("errors") == 0)


def guard(df: DataFrame, action: str, status: str = "status") -> DataFrame:
    """rows an action may touch."""
    s = F.col(status)
    if action == "delete_result":
        return df.where(s.isin("finished", "stopped"))
    if action == "stop":
        return df.where(s == "deployed")
    if action == "distributed_models":
        return df.where(F.col("distributed"))
    if action == "root_models":
        return df.where(F.col("father_id").isNull())
    raise ValueError(f"unknown action {action}")
