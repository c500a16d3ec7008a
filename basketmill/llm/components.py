"""Connected components of a graph of numbered nodes, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketmill.operators.staging import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
    linked = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return linked.filter("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("root"))
    linked = down.join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    own = least.select("a", F.col("root").alias("b"))
    return linked.unionByName(own).filter("a != b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge to another one; the root is its component's smallest node.

    `edges` has two long columns a and b, in any direction, repeats and loops allowed; edges with a null are left out.
    Each round is written to the shared folder. Two rows of sums per round reach the driver.
    """
    a, b = edges.columns
    edges = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    edges = stage(edges.filter("a != b").distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
        if state == before or not state["n"]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        edges = stage(_small_star(_large_star(edges)), "edges", edges)
