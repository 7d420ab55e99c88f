"""Connected components over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierbed.llm.storage import saved


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges(a, b)``; the label is the component's least node.

    Each round takes the least label among a node and its neighbours, then the label of that
    label, so rounds grow with the logarithm of a component's width. Every round is a table in
    the shared folder.
    """
    both = saved(
        edges.select("a", "b").union(edges.select("b", "a")).filter(F.col("a") != F.col("b")).distinct(),
        "graph-edges",
    )
    labels = saved(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        .select("node", F.least("node", "m").alias("label")),
        "graph-labels",
    )
    while True:
        near = (
            both.join(labels, F.col("b") == F.col("node"))
            .groupBy(F.col("a").alias("at"))
            .agg(F.min("label").alias("seen"))
        )
        lower = labels.join(near, F.col("node") == F.col("at")).select(
            "node", F.least("label", "seen").alias("low"), F.col("label").alias("old")
        )
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("further"))
        after = saved(
            lower.join(jump, F.col("low") == F.col("via")).select(
                "node", F.least("low", "further").alias("label"), "old"
            ),
            "graph-labels",
        )
        changed = after.filter(F.col("label") != F.col("old")).limit(1).count()
        labels = after.drop("old")
        if not changed:
            return labels
