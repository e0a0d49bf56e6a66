"""Connected components of links, by stars; no node's links meet in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from savora.session import stage


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node with a link; ``links`` are ``a, b``. The root is the smallest node.

    Alternates large and small stars until nothing changes: each node points its larger neighbours, then its
    smaller ones, to the smallest neighbour. Minima are combined before the shuffle; each round is stored.
    """
    a, b = F.col("a"), F.col("b")
    edges = links.where(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    edges = stage(edges, "edges")
    before = None
    while (now := _mark(edges)) != before:
        before = now
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = large.where("hi != lo").distinct()
        lowest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        turned = large.join(lowest, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        edges = stage(turned.unionByName(lowest.withColumnRenamed("m", "lo")).distinct(), "edges")
    roots = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.unionByName(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


def _mark(edges: DataFrame) -> tuple:
    low = F.xxhash64("hi", "lo").bitwiseAND(F.lit((1 << 40) - 1))
    return tuple(edges.agg(F.count("*"), F.sum(low.cast("decimal(38,0)"))).first())
