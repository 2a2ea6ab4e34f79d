"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docfold.llm import shared


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b: two columns of one orderable type); root is the least node of the component.

    Large-star / small-star contraction: every round links each node to the least neighbour it knows, until all edges
    point at roots. The number of rounds follows the logarithm of the longest chain; each round is two aggregations
    with map-side combine and two joins on one row per node. An empty edge list gives an empty result.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = shared.written(edges, "edges")
    while True:
        large = _star(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), larger=True)
        small = shared.written(_star(large, larger=False), "edges")
        # done when every node has one edge, to a node without any
        several = small.groupBy("a").count().where("count > 1").limit(1).count()
        inner = 0 if several else small.join(small.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count()
        edges = small
        if not several and not inner:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Link the neighbours of each node (only the larger ones, or the others) to the least of its neighbours and itself."""
    least = edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    linked = edges.join(least, "a")
    if larger:
        out = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()
