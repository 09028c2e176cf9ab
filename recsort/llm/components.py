"""Connected components by alternating star steps.

A large star links every larger neighbour of a node to the smallest node next
to it, a small star links a node and its smaller neighbours to the smallest of
them; repeated, each component becomes a star around its smallest node. The
minima are partial aggregates and are checkpointed before they are joined
back, so that a node with a third of all links is split by AQE's skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node that has a link, label the smallest node of its component; links may repeat."""
    edges = (links.filter(F.col(a) != F.col(b))
             .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct().checkpoint())
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).checkpoint()
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).checkpoint()
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct().checkpoint()
        low = large.groupBy("u").agg(F.min("v").alias("m")).checkpoint()
        small = large.join(low, "u")
        edges = (small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct().checkpoint())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
