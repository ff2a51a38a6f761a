"""Connected components of a graph of numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squadlake.llm.common import kept


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (a, b): the least node it can reach.

    Large-star and small-star steps in turn, each a minimum by node and a join, until links no
    longer change; the number of rounds grows with the logarithm of the longest path. Minima are
    taken before rows move, and a node with very many links is split in the join, so no task
    holds a component.
    """
    edges = kept(links.where(F.col("a") != F.col("b")).select("a", "b").distinct())
    seen = None
    while True:
        edges = kept(_small_star(_large_star(edges)))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
        if now == seen:
            break
        seen = now
    stars = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    roots = edges.select(F.col("b").alias("node")).distinct().join(stars.select("node"), "node", "left_anti")
    return stars.unionByName(roots.select("node", F.col("node").alias("root")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return (
        both.join(least, "a").where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    return (
        down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            least.select("a", F.col("least").alias("b"))
        )
        .where(F.col("a") != F.col("b")).distinct()
    )
