"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemart.llm.common import drop_staged, stage


def large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("node"), F.least("u", "m").alias("m"))
    return edges.join(least, F.col("v") == F.col("node")).select("u", F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def staged_with_sums(edges: DataFrame) -> tuple[DataFrame, dict]:
    """The edges as a written table, with their number and a sum of their hashes, taken while they are written."""
    sums = Observation()
    kept = stage(edges.observe(sums, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("hash")), "edges")
    return kept, sums.get


def components(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """(node, label) of all nodes that have a link to another; the label is the smallest node.

    A hub is one row per neighbour; its minimum is taken before the shuffle and
    the join that hands it out is one that adaptive execution splits. Each
    round is one written table, so a lost executor costs one round at most; no links, no
    rounds. Nulls and links from a node to itself are left out.
    """
    a, b = F.col(left), F.col(right)
    edges, before = staged_with_sums(
        pairs.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    while before["n"]:
        moved, after = staged_with_sums(small_star(large_star(edges)))
        drop_staged(edges)
        edges = moved
        if after == before:
            break
        before = after
    labels = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labels.unionByName(labels.select(F.col("label").alias("node"), "label")).distinct()
