"""Connected components of a table of links, by rounds of stars kept in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import release, stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that a link names; the component is its smallest node.

    Each round links the larger neighbours of every node, then the node and its smaller neighbours, to the smallest of them, until a
    round changes nothing (a number of rounds that grows with the logarithm of the longest path). A hub's many links are summed
    before they are shuffled, and the joins are such as Spark splits when a key is large. Links with nulls and of a node to itself
    are left out."""
    edges = stored(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before, start = None, edges
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # larger neighbours to the smallest one
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # now v < u in all: u and its smaller neighbours to the smallest one
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(small).where("u <> v").distinct()
        old, edges = start, stored(edges, "stars")
        release(old)
        start = edges
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if before == now:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select(F.col("v"), F.col("v")).distinct())
