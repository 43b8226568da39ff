"""Connected components of stored tables of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.llm.common import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """Connected components of a stored table of edges a, b: node, root (the smallest node of its component); stored.

    Nodes may have any type that has an order. Each round takes the smallest label around a node, hands it to the
    node's former root as well, and follows the new labels one step, so chains shrink by a factor per
    round. Every round is stored, and what it replaces is deleted.
    """
    both = stored(edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other"))), "links")
    labels = stored(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root")), "labels")
    while True:
        around = both.join(labels.select(F.col("node").alias("other"), "root"), "other").groupBy("node").agg(F.min("root").alias("seen"))
        offered = labels.join(around, "node").select("node", "root", F.least("root", "seen").alias("seen"))
        told = stored(
            offered.select("node", F.col("seen").alias("root")).unionByName(offered.select(F.col("root").alias("node"), F.col("seen").alias("root")))
            .groupBy("node").agg(F.min("root").alias("root")), "labels-told"
        )
        jump = told.select(F.col("node").alias("root"), F.col("root").alias("next"))
        newer = stored(told.join(jump, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "labels")
        changed = newer.join(labels.withColumnRenamed("root", "old"), "node").where("root <> old").limit(1).count()
        discard(told, labels)
        labels = newer
        if not changed:
            discard(both)
            return labels
