"""Sharding: a two-pass external shuffle.

Pass 1 scatters the rows uniformly into memory-sized buckets by a seeded hash.
Pass 2 applies a Fisher-Yates permutation to each bucket and writes it.  Only
DataFrame functions run: Spark's ``shuffle`` array function is a Fisher-Yates
shuffle, and it permutes the positions 0..n-1 of a bucket rather than its rows,
so no bucket is ever gathered into one value.  The row with the i-th smallest
hash of the bucket goes to the i-th entry of the permutation.

The buckets, one behind the other, form one uniformly shuffled sequence of all
rows.  Shard s holds the positions from floor(s N / S) on, so the row counts of
any two shards differ by one at most (the ``rows`` law).

Every step is a function of the seed and of stored rows: a row is known by its
key, its file and its place in the file.  A task that runs again after an
executor is lost therefore puts every row where it was before.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kelpie.llm.common import new_folder, parallelism, unique_names, write_and_read

BUCKET_BYTES = 64 << 20
OUT = ("shard", "slot")


def _stored(df: DataFrame, key: str, text: str) -> DataFrame:
    """The rows with the columns ``_ks_file`` and ``_ks_row`` that tell equal rows apart.
    A frame that is not read from files is written to the shared folder first."""
    where = ("_metadata.file_name", "_metadata.row_index")
    kept = unique_names(df, OUT, (key, text))
    try:
        if "_metadata" in {c.lower() for c in df.columns}:
            raise AnalysisException("a column of that name hides the files' metadata")
        marked = kept.select("*", F.col(where[0]).alias("_ks_file"), F.col(where[1]).alias("_ks_row"))
        marked.schema  # noqa: B018  (analysis happens here)
        return marked
    except AnalysisException:
        stored = write_and_read(kept.withColumnRenamed("_metadata", "_metadata_in"), "shard-input")
        return stored.select("*", F.col(where[0]).alias("_ks_file"), F.col(where[1]).alias("_ks_row"))


def write_shards(df: DataFrame, shards: int = 8, seed: int = 20, key: str = "doc_id", text: str = "text",
                 bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write all rows of ``df`` into ``shards`` shuffled shards; return the written rows.

    The result holds the input's columns and ``shard`` (0..shards-1) and ``slot``
    (gapless from 0 in each shard, in written order).  Input columns of these
    names come back with ``_in`` appended.  Null keys and null or empty texts
    are ordinary values; equal rows are told apart by their place in the
    stored files, so a row that makes up a third of the table scatters over
    all buckets; an empty table gives no rows.
    """
    spark = df.sparkSession
    rows = _stored(df, key, text)
    digest = F.xxhash64(F.lit(seed), F.col(key), F.col("_ks_file"), F.col("_ks_row"))
    total = rows.agg(F.count(F.lit(1)).alias("n"),
                     F.coalesce(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 1), F.lit(0)).alias("b")).first()
    n_buckets = max(parallelism(spark), -(-int(total["b"]) // bucket_bytes))
    bucket = F.pmod(digest, F.lit(n_buckets)).cast("int")

    # one row per bucket: its size, its first position in the whole sequence, its permutation
    sizes = rows.select(bucket.alias("_ks_bucket")).groupBy("_ks_bucket").agg(F.count(F.lit(1)).alias("_ks_n"))
    before = Window.orderBy("_ks_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = write_and_read(
        sizes.select("_ks_bucket", "_ks_n", F.coalesce(F.sum("_ks_n").over(before), F.lit(0)).alias("_ks_base")),
        "shard-buckets")
    perms = write_and_read(
        bases.repartition(n_buckets, "_ks_bucket").sortWithinPartitions("_ks_bucket")
        .select("_ks_bucket", "_ks_base",
                F.shuffle(F.sequence(F.lit(0), (F.col("_ks_n") - 1).cast("int")), F.lit(seed)).alias("_ks_perm")),
        "shard-permutations")

    in_bucket = Window.partitionBy("_ks_bucket").orderBy("_ks_hash", "_ks_file", "_ks_row")
    scattered = rows.withColumn("_ks_hash", digest).withColumn("_ks_bucket", bucket) \
        .repartition(n_buckets, "_ks_bucket") \
        .withColumn("_ks_i", F.row_number().over(in_bucket))
    rank = F.col("_ks_base") + F.element_at("_ks_perm", F.col("_ks_i"))
    n = int(total["n"])
    placed = scattered.join(perms, "_ks_bucket").withColumn("_ks_rank", rank) \
        .withColumn("shard", F.expr(f"cast(((_ks_rank + 1) * {shards} - 1) div {max(1, n)} as int)"))
    first = F.expr(f"(cast(shard as long) * {n}) div {shards}")
    placed = placed.withColumn("slot", (F.col("_ks_rank") - first).cast("long")) \
        .drop("_ks_hash", "_ks_bucket", "_ks_i", "_ks_base", "_ks_perm", "_ks_rank", "_ks_file", "_ks_row")

    path = new_folder(spark, "shards")
    placed.sortWithinPartitions("shard", "slot").write.option("compression", "zstd").partitionBy("shard").parquet(path)
    return spark.read.schema(placed.schema).parquet(path)
