"""Connected components of a graph too large for one machine, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floeframe.llm.common import Scratch, written


def flattened(parents: DataFrame, keep: Scratch) -> DataFrame:
    """(node, parent) with every parent the root of its tree: paths halve in each round."""
    while True:
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("top"))
        parents = keep(parents.join(above, "parent", "left").select("node", F.coalesce("top", "parent").alias("parent"), (F.coalesce("top", "parent") != F.col("parent")).alias("moved")), "parents")
        if parents.where("moved").limit(1).count() == 0:
            return parents.drop("moved")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of edges (a, b): the smallest node that it can reach.

    Each round sends every node to its smallest neighbour, if that is smaller, and joins what hangs together; at
    least every second node of what is left goes. Neighbours are aggregated before they are shuffled, so a node
    that a third of all edges share is no hot key. Rounds are written down, so that lost executors cost one round.
    """
    keep = Scratch(edges.sparkSession, "components")
    left = keep(edges.where("a <> b").select("a", "b").distinct(), "edges")
    labels = None
    while left.limit(1).count():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = flattened(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("parent")), keep)
        if labels is None:
            labels = parents.select("node", F.col("parent").alias("component"))
        else:
            step = parents.select(F.col("node").alias("component"), "parent")
            labels = keep(labels.join(step, "component", "left").select("node", F.coalesce("parent", "component").alias("component")), "labels")
        for side in ("a", "b"):
            left = left.join(parents.select(F.col("node").alias(side), F.col("parent").alias(f"{side}_top")), side, "left")
        left = keep(left.select(F.col("a_top").alias("a"), F.col("b_top").alias("b")).where("a <> b").distinct(), "edges")
    found = written(labels if labels is not None else left.select(F.col("a").alias("node"), F.col("b").alias("component")), "components")
    keep.drop()
    return found
