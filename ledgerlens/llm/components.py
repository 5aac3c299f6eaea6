"""Connected components of a link table: least labels and pointer jumping, step by step
stored. Nothing of the links or labels is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): label is the least node reachable.
    A hub's many links meet in partial minima and in joins that can be split."""
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "cc-links")
    labels = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label"))
    labels = stored(labels, "cc-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("m"))
        low = labels.join(near.select(F.col("a").alias("node"), "m"), "node").select("node", F.col("label").alias("old"), F.least("label", "m").alias("low"))
        up = labels.select(F.col("node").alias("low"), F.col("label").alias("up"))
        step = stored(low.join(up, "low").select("node", "old", F.least("low", "up").alias("label")), "cc-labels")
        labels = step.select("node", "label")
        if not step.where(F.col("old") != F.col("label")).limit(1).count():
            return labels
