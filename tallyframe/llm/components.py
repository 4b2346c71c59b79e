"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import written


def _lowest(both: DataFrame) -> DataFrame:
    """Each node's lowest neighbour (or itself), joined back to its neighbours: a, b, low."""
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("low"))
    return both.join(low, both["a"] == low["node"]).select("a", "b", "low")


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for every node of ``edges`` (columns a, b; orderable).

    Every step shuffles rows of two ids; the edge table never grows, and about
    log(nodes) steps are needed.  Loops and repeated edges are allowed; rows
    with a null end are left out.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        # Large star: a node's larger neighbours move to its lowest neighbour.
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moved = _lowest(both).where("b > a and b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        # Small star: a node and its smaller neighbours move to the lowest of them.
        near = _lowest(moved)
        edges = written(near.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
                        .unionAll(near.select("a", F.col("low").alias("b"))).distinct(), "edges")
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long"))).first())
        if state == before:
            break
        before = state
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionAll(edges.select(F.col("b"), F.col("b")).distinct())
