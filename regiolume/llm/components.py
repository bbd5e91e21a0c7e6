"""Connected components of a graph of links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiolume.session import discard, stage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links ``a, b``; the root is the smallest node within reach.

    Large-star and small-star steps in turn: each node's larger neighbours are hung on its smallest one, then
    its smaller ones. The number of rounds grows with the logarithm of the nodes. A node's neighbours are never gathered:
    the smallest is an aggregate, joined back. Every round is a staged table, so its lineage is one read.
    """
    a, b = F.col("a"), F.col("b")
    edges = links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = stage(edges, "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        first = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        hung = both.where("v > u").join(first, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        hung = stage(hung, "hung")
        least = stage(hung.groupBy("u").agg(F.min("v").alias("m")), "least")
        met = hung.join(least, "u")
        old, edges = edges, met.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(edges.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        discard(old, first, hung, least)
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
