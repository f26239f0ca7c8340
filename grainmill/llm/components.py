"""Connected components of a table of links, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b): the smallest node that it is connected to.

    Each round takes the smallest label among a node and its neighbours, then the label of that label, so long chains halve. Labels
    are written each round; only the number of changes comes to the driver. No links give no rows.
    """
    both = links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct()
    both = stored(both.toDF("a", "b"), "links")
    labels = stored(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("least"))
        moved = labels.join(near, labels.node == near.a).select("node", F.least("label", "least").alias("label"), F.col("label").alias("old"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
        moved = moved.join(up, "label").select("node", F.least("label", "above").alias("label"), "old")
        moved = stored(moved, "labels")
        labels = moved.select("node", "label")
        if moved.where("label <> old").isEmpty():
            return labels
