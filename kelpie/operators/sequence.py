"""Order-dependent helpers that never put a whole group into one task.

Every helper splits a group into blocks of the ordering key, does the small
per-block bookkeeping on an aggregated table (one row per block), and runs
the row-level window over ``(group, block)`` only.  A key holding a third of
all rows is therefore spread over many tasks; the per-block table grows with
``rows / block`` and goes through a normal (AQE-chosen) join.

The input is hash-partitioned by ``(group, block)`` once; the block counts,
the join back and the window all read that one exchange (Spark reuses it),
so chaining helpers does not recompute their inputs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpie.session import cut_lineage

DEFAULT_BLOCK = 1 << 16


def _cols(by: str | Sequence[str] | None) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def _prefix_window(by: list[str], blk: str) -> Window:
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return w.orderBy(blk).rowsBetween(Window.unboundedPreceding, -1)


def dense_position(df: DataFrame, by, order: str, block: int = DEFAULT_BLOCK,
                   name: str = "pos", tiebreak: Sequence[str] = (), with_total: bool = False) -> DataFrame:
    """0-based position of each row inside its group ordered by ``order``.

    ``order`` must be integral (offsets, ids, epoch micros).  Exact: position =
    rows of earlier blocks (prefix count table) + rank inside the block.
    ``with_total`` adds ``<name>_total`` = rows in the group (from the same table).
    """
    by = _cols(by)
    blk = "_kp_blk"
    d = df.withColumn(blk, F.floor(F.col(order) / F.lit(block)).cast("long")).repartition(*by, blk)
    counts = d.groupBy(*by, blk).agg(F.count(F.lit(1)).alias("_kp_n"))
    cols = [*by, blk, F.coalesce(F.sum("_kp_n").over(_prefix_window(by, blk)), F.lit(0)).alias("_kp_base")]
    if with_total:
        tw = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
        cols.append(F.sum("_kp_n").over(tw).alias(f"{name}_total"))
    prefix = counts.select(*cols)
    d = d.join(prefix, on=[*by, blk])
    w2 = Window.partitionBy(*by, blk).orderBy(order, *tiebreak)
    return d.withColumn(name, (F.col("_kp_base") + F.row_number().over(w2) - 1).cast("long")) \
            .drop(blk, "_kp_base")


def running_sum(df: DataFrame, by, order: str, value: Column | str, name: str,
                block: int = DEFAULT_BLOCK, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Inclusive running sum of ``value`` per group in ``order`` (blocked prefix sums)."""
    by = _cols(by)
    v = F.col(value) if isinstance(value, str) else value
    blk = "_kr_blk"
    d = df.withColumn(blk, F.floor(F.col(order) / F.lit(block)).cast("long")).withColumn("_kr_v", v) \
        .repartition(*by, blk)
    sums = d.groupBy(*by, blk).agg(F.sum("_kr_v").alias("_kr_s"))
    prefix = sums.select(*by, blk, F.sum("_kr_s").over(_prefix_window(by, blk)).alias("_kr_base"))
    d = d.join(prefix, on=[*by, blk])
    w2 = Window.partitionBy(*by, blk).orderBy(order, *tiebreak) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = F.coalesce(F.col("_kr_base"), F.lit(0).cast(d.schema["_kr_v"].dataType))
    return d.withColumn(name, base + F.sum("_kr_v").over(w2)).drop(blk, "_kr_base", "_kr_v")


def blocked_lag(df: DataFrame, by, pos: str, cols: dict[str, tuple[str, int]],
                block: int = DEFAULT_BLOCK) -> DataFrame:
    """``lag`` over a DENSE position column without a per-group window.

    ``cols`` maps output name -> (source column, k).  Blocks hold ``block``
    consecutive positions; the last ``max k`` rows of every block are also
    emitted into the next block as ghosts (one ``explode``, no self-union), so
    each lag is found inside its own block.
    """
    by = _cols(by)
    kmax = max(k for _, k in cols.values())
    if kmax >= block:
        raise ValueError("lag distance must be smaller than the block")
    blk = F.floor(F.col(pos) / F.lit(block)).cast("long")
    tail = F.pmod(F.col(pos), F.lit(block)) >= block - kmax
    copies = F.when(tail, F.array(F.struct(blk.alias("b"), F.lit(False).alias("g")),
                                  F.struct((blk + 1).alias("b"), F.lit(True).alias("g")))) \
        .otherwise(F.array(F.struct(blk.alias("b"), F.lit(False).alias("g"))))
    both = df.withColumn("_kl", F.explode(copies)) \
        .withColumn("_kl_blk", F.col("_kl.b")).withColumn("_kl_ghost", F.col("_kl.g")).drop("_kl")
    w = Window.partitionBy(*by, "_kl_blk").orderBy(pos)
    for out, (src, k) in cols.items():
        both = both.withColumn(out, F.lag(src, k).over(w))
    return both.where(~F.col("_kl_ghost")).drop("_kl_blk", "_kl_ghost")


# ------------------------------------------------- any order key: by range ----

PART = "_kp_part"


def laid_by_range(df: DataFrame, by, order: Sequence[str]) -> DataFrame:
    """``df`` range-partitioned by (group, order) and materialised, with the partition's number in
    ``PART``.  Works for any sortable order, dense or not: hashes, epoch micros, texts.  A group
    of any size spreads over as many partitions as it fills; only rows that tie in the whole
    order stay together."""
    keys = [*_cols(by), *order]
    return cut_lineage(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(PART, F.spark_partition_id()))


def _before_parts(by: list[str]) -> Window:
    """Earlier partitions of a group: a row a partition, so no group is long."""
    return (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy(PART) \
        .rowsBetween(Window.unboundedPreceding, -1)


def range_position(laid: DataFrame, by, order: Sequence[str], name: str = "pos", with_total: bool = False) -> DataFrame:
    """0-based position in the group of rows that :func:`laid_by_range` has laid out: rows of the group in
    earlier partitions plus the rank inside the partition.  Rows may have been filtered since."""
    by = _cols(by)
    counts = laid.groupBy(*by, PART).agg(F.count(F.lit(1)).alias("_kp_n"))
    cols = [*by, PART, F.coalesce(F.sum("_kp_n").over(_before_parts(by)), F.lit(0)).alias("_kp_base")]
    if with_total:
        cols.append(F.sum("_kp_n").over(Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).alias(f"{name}_total"))
    out = laid.join(counts.select(*cols), on=[*by, PART])
    inside = Window.partitionBy(*by, PART).orderBy(*order)
    return out.withColumn(name, (F.col("_kp_base") + F.row_number().over(inside) - 1).cast("long")).drop("_kp_base")


def range_running_max(laid: DataFrame, by, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Greatest ``value`` of the group's rows before each row (null for the first), as :func:`range_position`."""
    by = _cols(by)
    tops = laid.groupBy(*by, PART).agg(F.max(value).alias("_kp_top"))
    base = tops.select(*by, PART, F.max("_kp_top").over(_before_parts(by)).alias("_kp_base"))
    out = laid.join(base, on=[*by, PART])
    inside = Window.partitionBy(*by, PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return out.withColumn(name, F.greatest(F.col("_kp_base"), F.max(value).over(inside))).drop("_kp_base")


def range_running_sum(laid: DataFrame, by, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Sum of ``value`` over the group's rows before each row (0 for the first), as :func:`range_position`."""
    by = _cols(by)
    sums = laid.groupBy(*by, PART).agg(F.sum(value).alias("_kp_sum"))
    base = sums.select(*by, PART, F.coalesce(F.sum("_kp_sum").over(_before_parts(by)), F.lit(0)).alias("_kp_base"))
    out = laid.join(base, on=[*by, PART])
    inside = Window.partitionBy(*by, PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return out.withColumn(name, F.col("_kp_base") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("_kp_base")
