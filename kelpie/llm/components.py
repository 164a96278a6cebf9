"""Connected components of a link table, by alternating star steps.

Each round points nodes to smaller neighbours with two aggregations and two
joins; no node's neighbours are gathered anywhere, and the joins' hot keys are
left to Spark's skew splitting.  The links of a round are written to the shared
folder, so lineage stays short and a lost executor costs one round at most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelpie.llm.common import write_and_read


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every linked node that isn't its component's smallest.

    ``links`` has the columns a and b (long, not null); order, direction,
    repeats and links of a node to itself don't matter."""
    edges = write_and_read(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                           .distinct(), "links")
    before = _state(edges)
    while before[0]:
        # every larger neighbour of a node is linked to the node's smallest neighbour
        nearest = edges.select(F.col("b").alias("u"), F.col("a").alias("v")) \
            .unionByName(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))) \
            .groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
        large = edges.join(nearest, edges["b"] == nearest["u"]).select("a", F.col("m").alias("b")).distinct()
        large = write_and_read(large, "large-star")
        # the smaller neighbours of a node, and the node, are linked to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least.withColumnRenamed("a", "u"), F.col("a") == F.col("u")) \
            .where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        edges = write_and_read(small, "small-star")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
