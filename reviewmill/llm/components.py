"""Connected components by alternating large and small stars, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.sources.workspace import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round: neighbours (``v``) of a node (``u``) are linked to the least node around it.

    A large star moves the neighbours above the node, a small one the node and those below it. The
    least neighbour comes from an aggregate with partial sums and goes back by a join, which can be
    split if a node has very many neighbours.
    """
    around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = around.join(least, "u").where(F.col("v") > F.col("u") if large else F.lit(True)).select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """``node, root`` of every node that an edge ``(u, v)`` of longs names; the root is the least node.

    The rounds end when the edges no longer change; each is written, so lineage does not grow.
    """
    edges = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, before = materialise(edges, name), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        edges = materialise(_star(_star(edges, large=True), large=False), name)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
