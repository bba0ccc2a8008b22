"""Connected components of an edge table by alternating hooks and pointer jumps, all in joins (no graph on the driver)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id reachable over ``edges`` (a, b), for every id that has an edge.

    Large-star and small-star steps: neighbours above a node are tied to its
    smallest neighbour, then those below.  Both keep the number of edges, and
    the rounds grow with the logarithm of a component's size, not its length.
    Every node of a star meets only its own smallest neighbour, so a hub with
    many neighbours is an aggregate and a skewed join, never a list.
    """
    def tied(e: DataFrame, upward: bool) -> DataFrame:
        """Each u's neighbours above u (or those below, and u itself) tied to the least of u and its neighbours."""
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        if not upward:
            both = both.where("v < u")
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        j = both.join(low, "u")
        out = j.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")) if upward else \
            j.where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.where("a != b").distinct()

    e = stash(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    for _ in range(most_rounds):
        nxt = stash(tied(tied(e, True), False))
        # done when every node hangs on one root and no root hangs on another
        roots = nxt.select(F.col("b").alias("r")).distinct()
        open_ = nxt.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a").union(
            nxt.join(roots, nxt["a"] == roots["r"], "left_semi").select("a")).limit(1).count()
        e = nxt
        if not open_:
            break
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
