"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import discard, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the smallest of node and neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("low"))
    low = low.select("n", F.least("n", "low").alias("low"))
    return (both.filter("v > u").join(low, F.col("u") == F.col("n"))
            .select(F.col("v").alias("u"), F.col("low").alias("v")).filter("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, are linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("low"))
    return (down.join(low, F.col("u") == F.col("n"))
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("low").alias("v")),
                                      F.struct("u", F.col("low").alias("v")))).alias("e"))
            .select("e.*").filter("u != v").distinct())


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v: long, not null) to (``node``, ``component``), the smallest node reached.

    Each round shuffles edges only: the smallest neighbour of a node is a partial
    aggregate, and a node of very high degree is split by the skew join, so no task
    holds a whole neighbourhood. Rounds go on until the edges stop changing (their number
    grows with the logarithm of the longest path); each is written to the shared
    folder. Self-loops and repeated edges do no harm; isolated nodes are not returned.
    """
    now = stored(edges.select("u", "v").filter("u != v").distinct(), "cc")
    state = None
    while True:
        new = stored(_small_star(_large_star(now)), "cc")
        discard(now)
        now = new
        # Order-free fingerprint of the edges; counts detect what a sum might miss.
        stat = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(stat) == state:
            break
        state = tuple(stat)
    low = now.groupBy("u").agg(F.min("v").alias("v"))
    stars = low.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(low.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
