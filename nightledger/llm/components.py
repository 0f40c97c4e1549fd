"""Connected components by alternating large-star and small-star steps, all in shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.llm.common import saved

#: Bytes of an edge.
EDGE = 16


def _star(edges: DataFrame, large: bool, size: int) -> DataFrame:
    """Hang the larger (large star) or the smaller (small star) neighbours of each node on its smallest neighbour.

    The smallest neighbours are written out before the join, so that both of its sides
    are plain shuffles and adaptive execution can split a node with very many edges.
    """
    around = edges
    if large:
        around = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = saved(around.groupBy("u").agg(F.min("v").alias("w")), "star", size).select("u", F.least("u", "w").alias("w"))
    hung = around.join(least, "u")
    if large:
        hung = hung.filter("v > u").select(F.col("v").alias("u"), F.col("w").alias("v"))
    else:
        hung = hung.select(F.col("v").alias("u"), F.col("w").alias("v")).union(least.select("u", F.col("w").alias("v")))
    return hung.filter("u != v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether each node has one edge to a smaller one, or only edges to larger ones: all components are stars."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("below"), F.lit(1).alias("above"))
    )
    both = ends.groupBy("x").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return both.filter("below > 1 or (below > 0 and above > 0)").isEmpty()


def components(edges: DataFrame, rounds: int = 60, most: int | None = None) -> DataFrame:
    """(id, component) of all nodes in edges (a, b), of which there are `most` at most: the smallest node that can be reached.

    Each round writes its edges out. It ends when each node hangs on the smallest
    node of its component; the rounds needed grow with the logarithm of the longest path.
    """
    down = edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = saved(down.distinct(), "edges", most if most is None else EDGE * most)
    # A large star takes each edge from both ends; neither star adds edges but the one of a node to its smallest neighbour.
    size = 4 * EDGE * now.count()
    for _ in range(rounds):
        if _settled(now):
            stars = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
            return stars.union(stars.select(F.col("component").alias("id"), "component").distinct())
        now = saved(_star(_star(now, large=True, size=size), large=False, size=size), "edges", size)
    raise RuntimeError("components did not settle")
