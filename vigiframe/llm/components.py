"""Connected components of an edge table, without bringing it to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigiframe.llm.common import staged


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of the edges; the root is the least node of its component.

    Minimum labels spread along the edges, and every round also jumps to the label's own label, so the rounds
    grow with the logarithm of the longest path. Labels are written each round; only a count of changed rows
    reaches the driver. Hubs are plain join keys that adaptive execution may split; minima combine map-side.
    """
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("to")).where("node <> to and node is not null and to is not null")
    both = staged(both.union(both.select(F.col("to").alias("node"), F.col("node").alias("to"))).distinct())
    labels = staged(both.groupBy("node").agg(F.min("to").alias("m")).select("node", F.least("node", "m").alias("root")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "to"), "to").groupBy("node").agg(F.min("root").alias("near"))
        step = labels.join(near, "node", "left").select("node", F.col("root").alias("old"), F.least("root", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("root").alias("far"))
        step = step.join(jump, "next", "left").select("node", "old", F.least("next", "far").alias("root"))
        step = staged(step)
        labels = step.select("node", "root")
        if step.where("root <> old").isEmpty():
            return labels
