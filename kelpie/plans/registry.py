"""Query catalogue: every operator ID maps to a Spark builder and, when the
result is SQL-expressible, the DuckDB oracle text that must give the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def prepare(spark: SparkSession) -> None:
    """Session facts every query relies on: UTC session time (the tables hold
    zone-less timestamps) and a checkpoint folder (the cluster's shared one,
    or a private one when unset, as in tests)."""
    from kelpie.session import ensure_checkpoint_dir, ship_package
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return run
    return deco
