"""Connected components by alternating star joins; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carrymark.llm.common import join_groups, stored


def _downward(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger node ``u`` to the smaller ``v``."""
    return edges.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    """Link each node's larger neighbours to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"),
                                  F.count_if(F.col("v") > F.col("u")).alias("size"))
    return _downward(join_groups(both.filter("v > u"), least, "u", "size", total).select(
        F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("size"))
    return _downward(join_groups(edges, least, "u", "size", total)
                     .select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .unionByName(least.select("u", F.col("m").alias("v"))))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); the root is the smallest node.

    Ends when every edge leads to a root, which the star operations reach after
    about log(n) rounds; each round is stored. A hub's edges stay where they are and
    its smallest neighbour is sent to them. No edges give no rows.
    """
    edges, seen = stored(_downward(edges), "edges"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()
        if state == seen:
            break
        seen = state
        larger = stored(_large_star(edges, state[0]), "edges")
        edges = stored(_small_star(larger, larger.count()), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
