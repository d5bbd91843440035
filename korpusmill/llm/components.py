"""Connected components by alternating star contractions, one stored table a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from korpusmill.session import shared_folder, store


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b: bigint, not null); the root is the component's smallest node.

    Each round moves every node's larger neighbours, then its smaller ones, to
    the smallest node nearby. Rounds grow with the logarithm of the longest
    path. Nodes with many edges meet only in map-side minima and in joins that
    Spark can split. Loops and repeated edges do no harm.
    """
    spark = edges.sparkSession
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = store(edges.where("a <> b").select(low.alias("a"), high.alias("b")).distinct(), shared_folder(spark, "edges"))
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b").distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        moved = large.join(least, "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        small = moved.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()
        edges = store(small, shared_folder(spark, "edges"))
        before, state = state, _state(edges)
        if state == before:
            break
    rooted = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return rooted.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()
