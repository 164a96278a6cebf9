"""Exact splits, batching and sampling.

Positions are computed without a global ``row_number()``: contiguous topic
offsets give positions by arithmetic over a per-partition count table, and
random permutations rank rows inside md5 hash buckets plus bucket prefix
counts.  The only single-partition step runs over those small count tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelpie.operators.sequence import dense_position

HASH_BUCKET_HEX = 8          # md5 prefix used as bucket: 2^32 ordered buckets
HASH_BLOCK = 1 << 16         # buckets per block -> 65536 blocks


def _pos_from_ranges(log: DataFrame, contiguous: bool) -> DataFrame:
    if contiguous:
        # offsets are gap-free inside a partition: position = prefix + (offset - start)
        per = log.groupBy("topic", "partition").agg(F.min("offset").alias("_start"), F.count(F.lit(1)).alias("_n"))
        w = Window.orderBy("topic", "partition").rowsBetween(Window.unboundedPreceding, -1)
        per = per.select("topic", "partition", "_start", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_pre"))
        j = log.join(per, ["topic", "partition"])
        return j.withColumn("pos", (F.col("_pre") + F.col("offset") - F.col("_start")).cast("long")) \
                .drop("_start", "_pre")
    d = dense_position(log, ["topic", "partition"], "offset", name="_ppos")
    per = d.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("topic", "partition").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("topic", "partition", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_pre"))
    return d.join(per, ["topic", "partition"]).withColumn("pos", F.col("_pre") + F.col("_ppos")).drop("_pre", "_ppos")


def log_position(log: DataFrame, contiguous: bool = True) -> DataFrame:
    """Read order of a topic slice: partition by partition, offset by offset."""
    return _pos_from_ranges(log, contiguous)


def split_sizes(n: Column, validation_rate: float, test_rate: float) -> tuple[Column, Column, Column]:
    """(train, validation, test) sizes with the reference's double arithmetic + truncation."""
    train = F.floor(F.lit(1 - (validation_rate + test_rate)) * n).cast("long")
    val = F.floor(F.lit(float(validation_rate)) * n).cast("long")
    test = F.floor(F.lit(float(test_rate)) * n).cast("long")
    return train, val, test


def _with_total(df: DataFrame, total: int | None) -> DataFrame:
    if total is not None:
        return df.withColumn("_n", F.lit(int(total)).cast("long"))
    n = df.agg(F.count(F.lit(1)).alias("_n")).withColumn("_g", F.lit(0))
    return df.withColumn("_g", F.lit(0)).join(F.broadcast(n), "_g").drop("_g")  # one-row side


def split_ordered(log: DataFrame, validation_rate: float, test_rate: float, total: int | None = None,
                  contiguous: bool = True, pos: str | None = None) -> DataFrame:
    """First rows train; then test; ALL the rest validation when both rates > 0;
    with one rate > 0 it takes all the rest; with both sizes 0 the rest is unused."""
    d = log if pos else log_position(log, contiguous)
    p = F.col(pos or "pos")
    d = _with_total(d, total)
    tr, va, te = split_sizes(F.col("_n"), validation_rate, test_rate)
    split = (F.when(p < tr, "train")
             .when((va > 0) & (te > 0) & (p < tr + te), "test")
             .when((va > 0) & (te > 0), "validation")
             .when(va > 0, "validation")
             .when(te > 0, "test")
             .otherwise("unused"))
    return d.withColumn("split", split).drop("_n")


def split_batch(df: DataFrame, validation_rate: float, pos: str = "pos", by: str | Sequence[str] | None = None) -> DataFrame:
    """Per micro-batch (``by``) the first floor((1-v)·n) rows train, the rest
    validation when floor(v·n) > 0, otherwise unused."""
    keys = [by] if isinstance(by, str) else list(by or [])
    cnt = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(pos).alias("_p0")) if keys else None
    if cnt is None:
        d = _with_total(df, None).withColumn("_p0", F.lit(0))
    else:
        d = df.join(cnt, keys)
    rel = F.col(pos) - F.col("_p0")
    tr = F.floor(F.lit(1 - validation_rate) * F.col("_n"))
    va = F.floor(F.lit(float(validation_rate)) * F.col("_n"))
    return d.withColumn("split", F.when(rel < tr, "train").when(va > 0, "validation").otherwise("unused")) \
            .drop("_n", "_p0")


def split_device(df: DataFrame, total: int | Column, validation_rate: float, pos: str = "pos") -> DataFrame:
    """First floor((1-v)·total) rows of the READ slice train, the rest validation;
    ``total`` is the full data set size even when only a chunk is read."""
    tot = F.lit(total) if isinstance(total, int) else total
    tr = F.floor(F.lit(1 - validation_rate) * tot)
    return df.withColumn("split", F.when(F.col(pos) < tr, "train").otherwise("validation"))


def round_chunk(pos: Column | str, total: int | Column, chunks: int) -> Column:
    """Round of a row: chunk size floor(total/chunks); the last round takes the rest."""
    p = F.col(pos) if isinstance(pos, str) else pos
    tot = F.lit(total) if isinstance(total, int) else total
    size = F.floor(tot / F.lit(chunks))
    return F.least(F.floor(p / size), F.lit(chunks - 1)).cast("int")


def batch_id(pos: Column | str, n: int) -> Column:
    """Batches of n consecutive samples."""
    p = F.col(pos) if isinstance(pos, str) else pos
    return F.floor(p / F.lit(n)).cast("long")


# --------------------------------------------------------- permutations ----

def shuffle_key(id_col: str, seed: int | str, epoch: int | None = None) -> Column:
    parts = [F.lit(str(seed))] + ([F.lit(str(epoch))] if epoch is not None else []) + [F.col(id_col).cast("string")]
    return F.md5(F.concat_ws(":", *parts))


def permutation_rank(df: DataFrame, id_col: str, seed: int | str, name: str = "rank",
                     with_total: bool = False, rows: int | None = None) -> DataFrame:
    """0-based rank of each row in the seeded permutation ``order by md5(seed:id), id``.

    md5 spreads rows evenly over 2^32 ordered buckets; the rank is the row
    count of earlier buckets (small aggregated table) plus the rank inside the
    bucket block, so no task sees more than its block.  ``rows``, where it is
    known, makes the blocks so narrow that each holds about a million rows at
    most; without it there are 65,536 blocks, which is that for 6.9e10 rows.
    ``with_total`` adds ``<name>_total`` (row count) from the same bucket table.
    """
    key = shuffle_key(id_col, seed)
    d = df.withColumn("_h", key).withColumn("_hb", F.conv(F.substring("_h", 1, HASH_BUCKET_HEX), 16, 10).cast("long"))
    block = min(HASH_BLOCK, max(1, (1 << 52) // rows)) if rows else HASH_BLOCK
    return dense_position(d, None, "_hb", block=block, name=name, tiebreak=["_h", id_col],
                          with_total=with_total).drop("_h", "_hb")


def split_random(df: DataFrame, id_col: str, validation_rate: float, test_rate: float, seed: int) -> DataFrame:
    """Exact random split; the rounding rest goes to train."""
    d = permutation_rank(df, id_col, seed, with_total=True).withColumnRenamed("rank_total", "_n")
    n = F.col("_n")
    tr, va, te = split_sizes(n, validation_rate, test_rate)
    tr = tr + (n - (tr + va + te))
    split = F.when(F.col("rank") < tr, "train").when(F.col("rank") < tr + va, "validation").otherwise("test")
    return d.withColumn("split", split).drop("_n")


def share_out(df: DataFrame, id_col: str, holdout: int, fractions: Sequence[float], seed: int) -> DataFrame:
    """Seeded shuffle, the first ``holdout`` rows for inference, the rest cut
    into devices by cumulative fractions (truncated, last device takes the rest)."""
    d = permutation_rank(df, id_col, seed, with_total=True).withColumnRenamed("rank_total", "_n")
    rest = F.col("_n") - F.lit(holdout)
    idx = F.col("rank") - F.lit(holdout)
    share = F.lit(f"device{len(fractions)}")
    cum = 0.0
    bounds = []
    for f in fractions[:-1]:
        cum += f
        bounds.append(cum)
    for i in reversed(range(len(bounds))):
        share = F.when(idx < F.floor(rest * F.lit(bounds[i])), F.lit(f"device{i + 1}")).otherwise(share)
    return d.withColumn("share", F.when(F.col("rank") < holdout, F.lit("inference")).otherwise(share)).drop("_n")


def sample_k(df: DataFrame, id_col: str, k: int, seed: int) -> DataFrame:
    """K rows without replacement, reproducible: top-k by md5 key (TakeOrdered)."""
    return df.withColumn("_h", shuffle_key(id_col, seed)).orderBy("_h", id_col).limit(k).drop("_h")


def head(df: DataFrame, n: int, order: str) -> DataFrame:
    """First n rows in read order (the limit is the feature)."""
    return df.orderBy(order).limit(n)


def shuffle(df: DataFrame, id_col: str, seed: int, epoch: int, partitions: int | None = None) -> DataFrame:
    """Per-epoch shuffle: hash repartition on the md5 key, sort inside partitions."""
    key = shuffle_key(id_col, seed, epoch)
    d = df.withColumn("shuffle_key", key)
    d = d.repartition(partitions, "shuffle_key") if partitions else d.repartition("shuffle_key")
    return d.sortWithinPartitions("shuffle_key")
