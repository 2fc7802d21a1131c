"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provisio.llm.store import store


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node that is reachable), for every node with a link.

    ``links``: columns ``a`` and ``b`` of the same ordered type, in any order. Each round hangs the
    larger neighbours of a node, then its smaller ones, on the smallest; the rounds grow with the
    logarithm of the longest path. Nodes with very many links are aggregated before the shuffle,
    and the joins with one row per node leave it to Spark to split a hot node.
    """
    a, b = F.col("a"), F.col("b")
    edges = store(links.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(b.alias("a"), a.alias("b")))
        smallest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.join(smallest, "a").filter(b > a).select(b.alias("a"), F.col("low").alias("b")).distinct()
        large = store(large, "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        joined = large.join(low, "a")
        small = joined.select("a", F.col("low").alias("b")).unionByName(joined.select(b.alias("a"), F.col("low").alias("b")))
        edges = store(small.filter(a != b).distinct(), "small-star")
        seen = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if seen == before:
            break
        before = seen
    return edges.select(a.alias("node"), b.alias("component")).unionByName(edges.select(b.alias("node"), b.alias("component")).distinct())
