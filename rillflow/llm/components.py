"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.scratch import saved


def components(links: DataFrame) -> DataFrame:
    """Each node of ``links`` (a, b) with the smallest node it reaches: (node, component).

    Every round a node takes the smallest label among its neighbours and then that label's own
    label, so chains halve. Each round is written to the shared folder; they end when no label
    changes. An empty table gives an empty one; a link from a node to itself is harmless.
    """
    spark = links.sparkSession
    both = saved(spark, links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("component")
    )
    labels = saved(spark, labels, "labels")
    while True:
        nearest = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy("a").agg(F.min("component").alias("seen"))
        )
        joined = labels.join(nearest, labels["node"] == nearest["a"]).select(
            "node", "component", F.least("component", "seen").alias("better")
        )
        up = labels.select(F.col("node").alias("better"), F.col("component").alias("jump"))
        moved = saved(spark, joined.join(up, "better", "left").select(
            "node", F.least("better", "jump").alias("component"),
            (F.least("better", "jump") < F.col("component")).alias("changed"),
        ), "labels")
        labels = moved.select("node", "component")
        if moved.where("changed").isEmpty():
            return labels
