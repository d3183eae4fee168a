"""Connected components over links, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from serieslake.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """One row per linked node: node, component (its smallest node). ``links`` has a and b.

    Each round a node takes the smallest label among its neighbours, then the label of that
    label, so long chains halve. Minima combine before the shuffle, and the joins' hot keys (hubs)
    can be split, as both sides are read from the shared folder. Ends when no label changes.
    """
    both = links.select(F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(
        links.select(F.col("b").alias("src"), F.col("a").alias("dst"))
    )
    both = cut_lineage(both.where("src != dst").distinct(), "edges")
    labels = cut_lineage(
        both.groupBy(F.col("dst").alias("node"))
        .agg(F.min("src").alias("component"))
        .select("node", F.least("node", "component").alias("component")),
        "labels",
    )
    while True:
        heard = (
            both.join(labels.withColumnRenamed("node", "src"), "src")
            .groupBy(F.col("dst").alias("node"))
            .agg(F.min("component").alias("heard"))
        )
        lower = cut_lineage(
            labels.join(heard, "node").select(
                "node", F.col("component").alias("old"), F.least("component", "heard").alias("component")
            ),
            "labels",
        )
        parents = lower.select(F.col("node").alias("component"), F.col("component").alias("parent"))
        jumped = cut_lineage(
            lower.join(parents, "component").select("node", "old", F.col("parent").alias("component")),
            "labels",
        )
        labels = jumped.select("node", "component")
        if jumped.where("component != old").isEmpty():
            return labels
