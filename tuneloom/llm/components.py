"""Connected components of a graph that stays on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .tables import stored


def components(edges: DataFrame) -> DataFrame:
    """node, root: every node with an edge to another one, with the smallest
    node it can reach. ``edges`` has the columns a and b, in any order; loops
    and repeated edges do no harm; null ends are dropped.

    Large stars and small stars take turns: a node first hands its larger
    neighbours to the smallest node it knows, then its smaller ones, until only
    stars are left. Every round is written to the shared folder, so the plan
    stays short; neighbours are never gathered, only their minimum is, and that
    is aggregated before the shuffle. A hub's edges are one side of an inner
    join whose other side has one row for each node: adaptive execution splits
    them.
    """
    larger, smaller = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    now = stored(edges.where("a <> b").select(larger, smaller).distinct(), "edges")
    before, after = None, _state(now)
    while after != before:
        now = stored(_small_star(_large_star(now)), "stars")
        before, after = after, _state(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple:
    """Numbers that tell one set of edges from another."""
    check = F.sum(F.xxhash64("v", "u") % 1_000_000_007)
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), check).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("least"))
    return (
        both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    moved = edges.join(least, "u").where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.union(least.select("u", F.col("least").alias("v"))).distinct()
