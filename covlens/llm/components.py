"""Connected components by alternating large-star and small-star.

Edges are (u, v) pairs of ids.  A large-star joins every larger neighbour of a node to the node's smallest neighbour, a
small-star every smaller neighbour; alternating them ends, after about log^2 of the longest path, in stars around each
component's smallest id.  Every step is one aggregation with map-side partials, whose result is written, and one join with
it on the node: broadcast while the nodes are few, else a join of two shuffles, in which a node with a third of all edges
is split like any skewed key.  Each step's edges are written before the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covlens.llm.store import written


#: Nodes (16 bytes each) are broadcast while there are at most this many.
MAX_BROADCAST_NODES = 1_000_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    joined = both.join(F.broadcast(least) if least.count() <= MAX_BROADCAST_NODES else least, "u")
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = (joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(least.select("u", F.col("m").alias("v"))))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """`node`, `component` (smallest id of its component) of every node with an edge.  `edges`: `u`, `v`, bigint; null
    ends and loops are left out, repeated edges count once, an empty table has no nodes."""
    now = written(edges.where("u is not null and v is not null and u <> v").select("u", "v"), "edges")
    before = None
    for _ in range(most_rounds):
        now = written(_star(now, True), "large-star")
        now = written(_star(now, False), "small-star")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    else:
        raise RuntimeError(f"components not settled after {most_rounds} rounds")
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
