"""Connected components by labels that travel along links and jump along labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.session import settle


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): label is the smallest node that can be reached.

    In each round a node takes the smallest label among its neighbours' and then the label of its label,
    so that long chains shorten by halves. Rounds are written down; only the number of changes is counted.
    """
    both = settle(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = settle(both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("seen"))
        taken = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.least("label", "seen").alias("step"), F.col("label").alias("old")
        )
        taken = settle(taken, "labels")
        goal = taken.select(F.col("node").alias("step"), F.col("step").alias("label"))
        jumped = settle(taken.join(goal, "step").select("node", "label", "old"), "labels")
        labels = jumped.select("node", "label")
        if jumped.where("label <> old").isEmpty():
            return labels
