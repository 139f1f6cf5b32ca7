"""Connected components of an edge table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import stored


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); a component is its least node.

    Each round is grouped and joined on executors and written to the shared folder; the
    driver sees one count of changed labels a round.
    """
    edges = stored(
        links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        .union(links.select("b", "a"))
        .distinct(),
        "edges",
    )
    labels = stored(
        edges.groupBy("u").agg(F.min("v").alias("least")).select(
            F.col("u").alias("node"), F.least("u", "least").alias("component")
        ),
        "labels",
    )
    while True:
        near = (
            edges.join(labels, F.col("v") == F.col("node"))
            .groupBy("u")
            .agg(F.min("component").alias("near"))
        )
        lower = labels.join(near, F.col("node") == F.col("u")).select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("to")
        )
        root = labels.select(F.col("node").alias("at"), F.col("component").alias("jump"))
        after = stored(
            lower.join(root, F.col("to") == F.col("at"), "left").select(
                "node", "before", F.least("to", F.coalesce("jump", "to")).alias("component")
            ),
            "labels",
        )
        labels = after.select("node", "component")
        if after.where("before != component").isEmpty():
            return labels
