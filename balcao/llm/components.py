"""Connected components of a graph given as edges, without gathering any node's edges.

Alternating stars: every node points its larger neighbours, then its smaller ones, to the
smallest node it knows. Only minima are aggregated, so a node with very many edges costs a
partial aggregate and a join that Spark can split. The number of rounds grows with the
logarithm of the longest path; each is written out, which also cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from balcao.sources.staging import staged


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(pairs: DataFrame, point_self: bool) -> DataFrame:
    """Point the neighbours ``v`` of each ``u`` (and ``u`` itself) to the smallest of them."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    pointed = pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if point_self:
        pointed = pointed.unionByName(least.select("u", F.col("m").alias("v")))
    return pointed.where("u <> v").distinct()


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Edges written out, with a digest that is taken while they are written."""
    seen = Observation("edges")
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    table = staged(edges.observe(seen, F.count(F.lit(1)).alias("n"), digest.alias("s")), "edges")
    return table, (seen.get["n"], seen.get["s"])


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node) of every node with an edge.

    ``edges`` has columns ``u`` and ``v`` of one integer type; repeated edges, both directions
    and edges of a node with itself do not matter. No edges give an empty result.
    """
    edges, before = _written(edges.select("u", "v").where("u <> v").distinct())
    while before[0]:
        both = _both_ways(edges)
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Larger neighbours go to the smallest of all.
        larger = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Smaller neighbours and the node itself go to the smallest of the smaller.
        edges, after = _written(_star(larger.where("u <> v"), point_self=True))
        if after == before:
            break
        before = after
    ends = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return ends.unionByName(roots.join(ends.select("node"), "node", "left_anti"))
