"""Connected components of a link table, as Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.shared import staged


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); component is the smallest node reached.

    Alternates the "large star" and "small star" steps of the published
    MapReduce algorithm: each step links a node's neighbours to the smallest
    of them, so a chain halves and a hub never gathers its neighbours in one
    row. Each round is staged. Empty links give an empty result.
    """
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if seen == mark:
            break
        mark = seen
    out = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return out.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
