"""Duplicate clusters (A14 across both keys): items that share a url or a
content hash, directly or through other items, form one group.

Every item holds at most one url and one content hash, so it is an edge
between two key vertices, and the groups are the connected components of the
(url, hash) links.  Links, not items, take part in the rounds: copies of an
article give one link.  Each round hooks every vertex to its smallest
neighbour, flattens the trees by pointer doubling and contracts the links to
the roots, which at least halves the vertices that still have links, so a
chain of n keys takes log2(n) rounds and not n.

A key that holds a third of all items is reduced map-side (min per vertex,
distinct links); in the joins the looked-up side has one row per vertex, so
AQE can split the hot side.  Rounds are cut with reliable checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def _hook(links: DataFrame) -> DataFrame:
    """(node, root): every vertex points to its smallest neighbour, or to
    itself where it is smaller; then pointers are doubled until flat."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    tree = (both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
            .select("node", F.least("node", "root").alias("root")).checkpoint())
    while True:
        up = tree.select(F.col("node").alias("root"), F.col("root").alias("_up"))
        nxt = tree.join(up, "root").select("node", F.col("_up").alias("root"), (F.col("_up") != F.col("root")).alias("_moved"))
        nxt = nxt.checkpoint()
        tree = nxt.drop("_moved")
        if nxt.filter("_moved").isEmpty():
            return tree


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every vertex of the links (a, b): root is the same
    for all vertices of a component (one of its vertices).  Links of a vertex
    to itself give that vertex alone; NULL ends are no links."""
    ensure_checkpoint_dir(links.sparkSession)
    ends = links.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL").distinct().checkpoint()
    roots = ends.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("root"))
    rest = ends.filter("a <> b")
    while not rest.isEmpty():
        tree = _hook(rest)
        step = tree.select(F.col("node").alias("root"), F.col("root").alias("_to"))
        roots = (roots.join(step, "root", "left")
                 .select("node", F.coalesce("_to", "root").alias("root")).checkpoint())
        a = tree.select(F.col("node").alias("a"), F.col("root").alias("_a"))
        b = tree.select(F.col("node").alias("b"), F.col("root").alias("_b"))
        rest = (rest.join(a, "a").join(b, "b").filter("_a <> _b")
                .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct().checkpoint())
    return roots


def duplicate_clusters(items: DataFrame) -> DataFrame:
    """One row per item: id, keep_id (the group's earliest ingested item, then
    the smallest id), kept (id = keep_id), n_items and n_platforms of the
    group.  Empty and NULL keys link nothing; an item with neither key, or
    whose keys no other item has, is a group of its own."""
    def key(column: str, mark: str):
        return F.when(F.coalesce(F.col(column), F.lit("")) != "", F.concat(F.lit(mark), F.col(column)))

    rows = items.select("id", "platform", "ingested_at", key("url", "u:").alias("_u"), key("content_hash", "h:").alias("_h"))
    roots = components(rows.select(F.col("_u").alias("a"), F.col("_h").alias("b")))
    at = F.coalesce(F.col("_u"), F.col("_h"), F.concat(F.lit("i:"), F.col("id")))
    rows = (rows.select("id", "platform", "ingested_at", at.alias("node")).join(roots, "node", "left")
            .select("id", "platform", "ingested_at", F.coalesce("root", "node").alias("root")))
    groups = rows.groupBy("root").agg(
        F.min_by("id", F.struct("ingested_at", "id")).alias("keep_id"), F.count(F.lit(1)).alias("n_items"),
        F.size(F.collect_set("platform")).cast("long").alias("n_platforms"))
    return rows.join(groups, "root").select("id", "keep_id", (F.col("id") == F.col("keep_id")).alias("kept"),
                                            "n_items", "n_platforms")
