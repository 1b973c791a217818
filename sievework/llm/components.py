"""Connected components of an edge table by alternating large-star and small-star rounds.

Both stars keep the components and pull every node towards its smallest neighbour; the number of
rounds grows with the logarithm of the longest path.  No round gathers a component: each works on
single edges, and the minimum of a node's neighbours is aggregated before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievework.common import cut


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on edges (a > b): link neighbours on one side of a node to its minimum."""
    if large:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    linked = both.join(least, "a")
    if large:
        moved = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of comparable ids to ``(node, root)``, root the smallest id that node reaches.

    Nodes without an edge to another node are left out.  Empty edges give an empty table.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (state["n"], state["h"]) == seen or not state["n"]:
            break
        seen = (state["n"], state["h"])
        edges = cut(_star(cut(_star(edges, True)), False))
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
