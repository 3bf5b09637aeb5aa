"""Connected components of an edge table, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.staging import staged


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (least node reachable) for every end of an edge ``a``, ``b``.

    Each round takes the least label among a node's neighbours, then the label's
    own label, so the number of rounds grows with the logarithm of the longest
    path. Rounds are written tables; nothing but a counter reaches the driver.
    """
    links = staged(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    labels = staged(
        links.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component"))
    )
    while True:
        near = (
            links.join(labels, links["b"] == labels["node"])
            .groupBy("a")
            .agg(F.min("component").alias("near"))
        )
        least = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("label")
        )
        step = staged(least)
        target = step.select(F.col("node").alias("target"), F.col("label").alias("further"))
        following = staged(
            step.join(target, F.col("label") == F.col("target"))
            .select("node", "old", F.least("label", "further").alias("component"))
        )
        labels = following.select("node", "component")
        if following.where(F.col("old") != F.col("component")).isEmpty():
            return labels
