"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlag.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``a, b``: the smallest node it reaches.

    Each round a node takes the smallest label among its neighbours, then the
    label of that label, so long paths halve. Labels are stored every round;
    minima are taken before rows move, so a node with very many links costs one
    row per task. Ends when no label changes.
    """
    both = materialize(
        edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    own = F.least(F.min("b"), F.col("node")).alias("label")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(own))
    while True:
        around = both.join(labels.withColumnRenamed("node", "b"), "b")
        seen = around.groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(seen.withColumnRenamed("a", "node"), "node").select(
            "node", "label", F.least("label", "near").alias("next")
        )
        lower = materialize(lower)
        jump = lower.select(F.col("node").alias("next"), F.col("next").alias("far"))
        further = F.least("next", "far").alias("label")
        moved = materialize(lower.join(jump, "next").select("node", F.col("label").alias("old"), further))
        labels = moved.select("node", "label")
        if moved.where("old <> label").isEmpty():
            return labels
