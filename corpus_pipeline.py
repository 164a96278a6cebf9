"""The corpus pipeline: from raw documents to packed training sequences.

Each stage is ``(name, function)``; a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's docs.  All but the last return the columns of ``documents``.

1. quality_rules  documents that fail the limits or the trained verdict go
2. simhash        one document of each group of near copies stays
3. secret_scan    spans of secrets are replaced by a mark; every document stays
4. mixing         each document's text becomes what the mix takes of it
5. packing        pieces of sequences of 2048 ids
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Models, hashes and tokenizers have no SQL form; tests compare with a plain version.
ORACLE_SQL = None


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` of texts that a stage has changed."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from kelpie.llm.common import prepare, read_table
    from kelpie.llm.quality import filter_documents, train

    prepare(spark)
    return filter_documents(docs, train(docs, read_table(spark, sf_dir, "labels")))


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from kelpie.llm.common import prepare
    from kelpie.llm.simhash import keep_one

    prepare(spark)
    return keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from kelpie.llm.common import prepare
    from kelpie.llm.secret_scan import redact

    prepare(spark)
    return _with_length(redact(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from kelpie.llm.common import prepare
    from kelpie.llm.mixing import Mix

    prepare(spark)
    return _with_length(Mix(docs).documents())


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from kelpie.llm.common import prepare
    from kelpie.llm.packing import pack
    from kelpie.llm.tokenizing import public_path

    prepare(spark)
    return pack(docs, public_path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("simhash", simhash), ("secret_scan", secret_scan), ("mixing", mixing),
          ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    from kelpie.llm.common import prepare, read_table, write_and_read

    prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_and_read(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
