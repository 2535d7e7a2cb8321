"""Connected components of a graph given as edges, by spreading the smallest id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.session import shared_folder


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of the edges (a, b), whose label is the smallest node of the component.

    Each round takes the smallest label among a node's neighbours and then the label of that label, so chains close in
    a number of rounds about the logarithm of their length. Rounds are checkpointed; only their change count is
    collected. No edges give no rows.
    """
    shared_folder(edges.sparkSession)
    both = edges.select("a", "b").union(edges.select("b", "a")).filter("a != b").distinct().checkpoint()
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")).checkpoint()
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("_near")), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("_near").alias("_near"))
        )
        closer = labels.join(near, "node").select("node", F.col("label").alias("_old"), F.least("label", "_near").alias("label"))
        ahead = labels.select(F.col("node").alias("label"), F.col("label").alias("_ahead"))
        jumped = closer.join(ahead, "label").select("node", "_old", F.least("label", "_ahead").alias("label")).checkpoint()
        labels = jumped.select("node", "label")
        if jumped.filter("label != _old").isEmpty():
            return labels
