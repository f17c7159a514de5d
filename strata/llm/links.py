"""Connected components of links, for near-duplicate joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a long, b long); component is the smallest node reachable.

    Alternates two steps until nothing changes: every node's larger neighbours are linked to its smallest neighbour, then
    every node's smaller ones. Each round is written to the shared folder; links never outgrow their number at the start.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("low", "a"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = written(large.where("a <> b").distinct(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a")
        small = small.select("a", F.col("low").alias("b")).union(small.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")))
        edges = written(small.distinct(), "links")
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 2**31), F.sum(F.xxhash64("b", "a") % 2**31)).first()
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
