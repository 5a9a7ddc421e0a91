"""Connected components of a link table by minimum labels and pointer jumping; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwell.llm.common import checkpoint


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): label is the smallest node that links reach.

    Each round takes the smallest label among neighbours (min() pre-aggregates, so a hub is no hot task), then jumps to
    the label's own label; labels only fall, so the loop ends when no label fell. A chain of n links takes about
    log n rounds, stars take two. No links: no rows.
    """
    both = links.select(F.col("a"), F.col("b")).union(links.select(F.col("b"), F.col("a")))
    labels = checkpoint(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("low"))
        low = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("old"), F.least("label", "low").alias("label"))
        low = checkpoint(low)
        own = low.select(F.col("node").alias("at"), F.col("label").alias("further"))
        labels = checkpoint(low.join(own, low["label"] == own["at"]).select("node", "old", F.least("label", "further").alias("label")))
        if labels.where("label <> old").limit(1).count() == 0:
            return labels.select("node", "label")
        labels = labels.select("node", "label")
