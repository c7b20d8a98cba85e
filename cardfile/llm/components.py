"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardfile.session import materialize


def _largest_down(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour. ``edges`` is a written table."""
    both = edges.union(edges.select("b", "a"))
    low = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")), "low")
    return both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("low").alias("a"), "b")


def _smaller_down(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them; ``a`` is the smaller end of each edge."""
    edges = materialize(edges, "edges")
    low = materialize(edges.groupBy("b").agg(F.min("a").alias("low")), "low")
    moved = edges.join(low, "b").where(F.col("a") != F.col("low")).select(F.col("low").alias("a"), F.col("a").alias("b"))
    return moved.union(low.select(F.col("low").alias("a"), "b"))


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (the smallest node that is reachable) for every node of the edges (``a``, ``b``).

    Rounds go on until no edge changes; each is written to the shared folder. Nodes with many edges meet the join
    as a written table, so adaptive execution can split them, and minima are combined before the shuffle.
    Edges with a null end and loops are ignored; loops alone give no node.
    """
    edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges, before = materialize(edges, "edges"), None
    while True:
        edges = materialize(_smaller_down(_largest_down(edges)).where("a <> b").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            break
        before = now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        edges.select("a", "a").distinct()
    )
