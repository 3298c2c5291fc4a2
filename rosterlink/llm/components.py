"""Connected components by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..store import settled


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is linked to the least of the node and its neighbours."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return (both.join(least, "a").where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("least").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node's smaller neighbours, and the node, are linked to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").where(F.col("b") != F.col("least")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its least reachable node, for every node of the pairs ``a, b``.

    Pairs may repeat, stand either way round, or link a node with itself; pairs
    with a null are left out, and no pairs give no rows. A hub is a large group
    of one key: its minimum is aggregated before the shuffle, and the joins are
    left to skew splitting. Each round is written to the shared folder.
    """
    a, b = edges.columns
    pairs = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(F.col(a).isNotNull() & F.col(b).isNotNull())
    loops = pairs.where("a = b").select(F.col("a").alias("node"), F.col("b").alias("component"))
    loops = settled(loops.distinct())
    stars = settled(pairs.where("a <> b").distinct())
    while True:
        # Stars are done when every node has one smaller neighbour that has none itself.
        ends = stars.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
            stars.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
        open_nodes = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        if not open_nodes.where((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("into") == 1))).limit(1).count():
            break
        stars = settled(_small_star(_large_star(stars)))
    named = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return named.unionByName(roots).unionByName(loops).groupBy("node").agg(F.min("component").alias("component"))
