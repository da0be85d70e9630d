"""Connected components by contracting the graph, without any unbounded group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplelog.llm.frames import cut, drop_cut


def _jumped(parents: DataFrame) -> DataFrame:
    """Each node's last ancestor: pointers of (node, root) are doubled until none moves."""
    while True:
        up = parents.select(F.col("node").alias("root"), F.col("root").alias("next"))
        moved = parents.join(up, "root", "left").select(
            "node",
            F.coalesce("next", "root").alias("root"),
            (F.coalesce("next", "root") != F.col("root")).alias("moved"),
        )
        moved = cut(moved, "jump")
        drop_cut(parents)
        parents = moved.select("node", "root")
        if moved.where("moved").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of the links (a, b); root is the least node it can reach.

    In a round, each node points to its least neighbour if that is less, pointers are followed to
    their ends, and the links are redrawn between the ends; links within one end vanish. The graph
    shrinks with each round. Least neighbours are partial aggregates, so a node may have any number
    of links.
    """
    links = cut(links.where("a <> b").distinct(), "links")
    roots = None
    while not links.isEmpty():
        both = links.select(F.col("a").alias("node"), "b").union(links.select("b", "a"))
        least = both.groupBy("node").agg(F.min("b").alias("least"))
        parents = _jumped(cut(least.select("node", F.least("node", "least").alias("root")), "parents"))
        if roots is None:
            roots = parents
        else:
            up = parents.select(F.col("node").alias("root"), F.col("root").alias("next"))
            roots = cut(roots.join(up, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "roots")
        of = lambda name: parents.select(F.col("node").alias(name), F.col("root").alias(f"{name}2"))
        redrawn = links.join(of("a"), "a").join(of("b"), "b").where("a2 <> b2")
        redrawn = redrawn.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
        shorter = cut(redrawn.distinct(), "links")
        drop_cut(links)
        links = shorter
    if roots is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
