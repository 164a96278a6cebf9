"""Scoring, tiered routing and prediction records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpie.functions.codecs import encode_raw_col
from kelpie.functions.features import argmax


def score(df: DataFrame, model, features: str = "features", out: str = "values") -> DataFrame:
    """Decode → predict → values array; same code for batch and ``readStream`` frames."""
    if hasattr(model, "apply"):
        return model.apply(df, features, out)
    return df.withColumn(out, model.values(F.col(features)))


def route(scored: DataFrame, limit: float, values: str = "values",
          hidden: Column | str | None = None) -> tuple[DataFrame, DataFrame]:
    """(final, upper).  Final when ``max(values) >= limit``; the rest go to the
    next tier with the hidden vector (or the input) as float32 RAW bytes."""
    conf = F.array_max(values)
    final = scored.where(conf >= F.lit(limit))
    h = F.col(hidden) if isinstance(hidden, str) else hidden
    upper = scored.where(~(conf >= F.lit(limit)) | conf.isNull())
    if h is not None:
        upper = upper.withColumn("value", encode_raw_col(h, "float32"))
    return final, upper


def with_tier(scored: DataFrame, limit: float, values: str = "values") -> DataFrame:
    """T11 as one frame: ``tier`` = final | upper (used when both sinks share a batch)."""
    return scored.withColumn("tier", F.when(F.array_max(values) >= F.lit(limit), F.lit("final"))
                             .otherwise(F.lit("upper")))


def prediction_records(scored: DataFrame, values: str = "values") -> DataFrame:
    """``{"values":[...]}`` JSON payload; key and headers pass through."""
    cols = [c for c in ("key", "headers") if c in scored.columns]
    return scored.select(*cols, F.encode(F.to_json(F.struct(F.col(values).alias("values"))), "UTF-8").alias("value"))


def predicted_class(values: str = "values") -> Column:
    return argmax(F.col(values))
