"""Connected components of a graph given as rows of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timepoint.llm.common import durable


def components(links: DataFrame) -> DataFrame:
    """Per node of ``links`` (a, b): node and component, the smallest node it reaches.

    Each round takes the smallest label among a node and its neighbours, then the label of
    that label, so a chain halves with every round. A node with very many links costs one
    row per task in the aggregate, and its join is one that Spark can split. The driver
    sees the number of changes only. No links give no rows.
    """
    both = durable(
        links.filter(F.col("a") != F.col("b"))
        .select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("l"))
        .select("l.a", "l.b")
        .distinct()
    )
    labels = durable(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("component"))
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        lowered = durable(
            labels.join(near, "node").select(
                "node", F.least("component", "near").alias("to"), F.col("component").alias("was")
            )
        )
        ends = lowered.select(F.col("node").alias("to"), F.col("to").alias("end"))
        labels = durable(
            lowered.join(ends, "to").select("node", F.least("to", "end").alias("component"), "was")
        )
        changed = labels.filter(F.col("component") != F.col("was")).limit(1).count()
        labels = labels.drop("was")
        if not changed:
            return labels
