"""Connected components by contraction, with linear work a round and nothing on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Workspace


def components(work: Workspace, edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node that links reach.

    Each round sends a node to its smallest neighbour, follows that pointer once more, and keeps only the
    edges whose ends still differ, renamed to their new nodes. A chain at least halves a round, so the
    number of rounds grows with the logarithm of the longest chain. Minima are combined before the
    shuffle, so a node with very many links is one row a task.
    """
    labels = None
    edges = work.save(edges.select("a", "b").where("a <> b").distinct())
    first = edges
    while not edges.isEmpty():
        both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        parent = work.save(
            both.groupBy(F.col("e.a").alias("node")).agg(F.min("e.b").alias("low"))
            .select("node", F.least("node", "low").alias("parent"))
        )
        up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        jumped = work.save(parent.join(up, "parent").select("node", F.col("grand").alias("component")))
        if labels is None:
            labels = jumped
        else:
            step = jumped.select(F.col("node").alias("component"), F.col("component").alias("next"))
            labels = work.save(
                labels.join(step, "component", "left").select("node", F.coalesce("next", "component").alias("component"))
            )
        left = jumped.select(F.col("node").alias("a"), F.col("component").alias("ca"))
        right = jumped.select(F.col("node").alias("b"), F.col("component").alias("cb"))
        edges = work.save(
            edges.join(left, "a").join(right, "b").where("ca <> cb")
            .select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct()
        )
    if labels is None:
        return first.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
