"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpie.plans import registry
from kelpie.session import read_table, scratch_path

__all__ = ["aside", "columns", "new_folder", "not_null_text", "parallelism", "prepare", "read_table", "unique_names",
           "write_and_read"]


# Texts reach Python in batches of about so many bytes, whatever their number or length
BATCH_BYTES = 4 << 20
_ARROW_BYTES, _ARROW_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def prepare(spark: SparkSession) -> None:
    """What every query relies on (see :func:`kelpie.plans.registry.prepare`), and
    Arrow batches bounded by bytes unless the session sets a bound of its own."""
    registry.prepare(spark)
    if spark.conf.get(_ARROW_BYTES) == _ARROW_DEFAULT:
        spark.conf.set(_ARROW_BYTES, str(BATCH_BYTES))


def unique_names(df: DataFrame, reserved: tuple[str, ...] = (), keep: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with every column name unique without regard to case.

    The first column spelled exactly like a name of ``keep`` has that name.  Any
    other that occurs again, or that the operator wants for its own output
    (``reserved``), gets ``_in`` (``_in2``, ...) appended.  So input columns that
    clash with an operator's columns are carried along, not lost."""
    kept = {k: df.columns.index(k) for k in keep if k in df.columns}
    taken = {r.lower() for r in (*reserved, *kept)}
    names = []
    for i, c in enumerate(df.columns):
        name, k = c, 1
        while name.lower() in taken and kept.get(name) != i:
            name = f"{c}_in" if k == 1 else f"{c}_in{k}"
            k += 1
        taken.add(name.lower())
        names.append(name)
    return df if names == df.columns else df.toDF(*names)


def aside(df: DataFrame, *needed: str) -> DataFrame:
    """``df`` with the needed columns under their names and all others under names
    that nothing clashes with; ``.toDF(*df.columns)`` gives the names back."""
    first = {n: df.columns.index(n) for n in needed}
    return df.toDF(*[c if first.get(c) == i else f"_aside{i}" for i, c in enumerate(df.columns)])


def columns(df: DataFrame, **types: str) -> DataFrame:
    """Exactly the named columns, cast to the given types, whatever else the
    input holds.  Of names that differ in case only, the exact one wins, then
    the first; a column that is missing becomes null."""
    cols = df.columns
    plain = df.toDF(*[f"_c{i}" for i in range(len(cols))])
    out = []
    for name, kind in types.items():
        at = next((i for i, c in enumerate(cols) if c == name),
                  next((i for i, c in enumerate(cols) if c.lower() == name.lower()), None))
        source = F.lit(None) if at is None else F.col(f"_c{at}")
        out.append(source.cast(kind).alias(name))
    return plain.select(*out)


def not_null_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return scratch_path(spark, f"kelpie-llm/{name}-{uuid.uuid4().hex[:12]}")


def write_and_read(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: the
    lineage is cut and the rows survive the loss of any executor."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    w = df.write.option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
    return spark.read.schema(schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    """The session's shuffle partitions: the number of parallel pieces the
    cluster's owner has asked for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
