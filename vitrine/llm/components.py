"""Connected components of a table of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vitrine.session import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the least neighbour: the larger ones, or the rest and the node."""
    both = edges if not large else edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    hung = both.join(least, "a")
    if large:
        hung = hung.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        hung = (hung.select(F.col("b").alias("a"), F.col("least").alias("b"))
                .union(least.select("a", F.col("least").alias("b"))))
    return hung.filter(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link in ``links`` (a, b).

    The component is the least node reachable.  Loops and repeated links do no
    harm; an empty table gives an empty table.  Every step is a partial
    aggregate and a join, so no node's neighbours are brought together, and is
    written to the shared folder: a lost executor re-reads it.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = cut_lineage(edges.filter(F.col("a") != F.col("b")).distinct())
    mark = None
    while True:
        edges = cut_lineage(_star(_star(edges, True), False))
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == mark:
            break
        mark = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select("b", "b").distinct())
