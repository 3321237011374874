"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import stored


#: Edges that a task of a round takes at least, so that a small graph has few tasks.
EDGES_A_TASK = 200_000


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Link the larger neighbours of each node to its smallest neighbour or itself."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    linked = both.where("v > u").join(least, "u").coalesce(tasks)
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Link the smaller neighbours of each node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").coalesce(tasks)
    moved = F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
    return linked.select(F.inline(moved)).where("u > v").distinct().coalesce(tasks)


def components(edges: DataFrame, a: str, b: str, most_rounds: int = 60) -> DataFrame:
    """(node, component_id) of every node that has an edge to another node.

    component_id is the smallest id that can be reached.  Edges may repeat, run either
    way and join a node to itself; null ends are left out.  Every round is stored, and
    the rounds end when the star edges no longer change.  A node with very many
    neighbours is reduced by an aggregate and joined again; its neighbours are never
    gathered.
    """
    now = stored(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    mark = None
    for _ in range(most_rounds):
        got = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if got == mark or not got[0]:
            break
        mark = got
        tasks = max(4, got[0] // EDGES_A_TASK)
        now = stored(_small_star(_large_star(now, tasks), tasks))
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component_id"))
    return nodes.union(now.select(F.col("v").alias("node"), F.col("v").alias("component_id"))).distinct()
