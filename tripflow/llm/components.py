"""Connected components of an edge table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): label is the smallest node reachable.

    Every round takes the smallest label among the neighbours and then the label of
    that label; all rounds are tables in shared storage, and the driver only
    sees whether any label changed.
    """
    both = stage(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "edges",
    )
    labels = stage(
        both.groupBy("a").agg(F.min("b").alias("_b")).select(
            F.col("a").alias("node"), F.least("a", "_b").alias("label")
        ),
        "labels",
    )
    while True:
        spread = (
            both.join(labels, F.col("b") == F.col("node"))
            .groupBy("a")
            .agg(F.min("label").alias("_near"))
            .withColumnRenamed("a", "_a")
        )
        lowered = labels.join(spread, F.col("node") == F.col("_a"), "left").select(
            "node", F.col("label").alias("_old"), F.least("label", F.coalesce("_near", "label")).alias("label")
        )
        lowered = stage(lowered, "labels-near")
        up = lowered.select(F.col("node").alias("_up"), F.col("label").alias("_upper"))
        jumped = stage(
            lowered.join(up, F.col("label") == F.col("_up")).select(
                "node", F.least("label", "_upper").alias("label"), "_old"
            ),
            "labels",
        )
        changed = jumped.where("label < _old").limit(1).count()
        labels = jumped.select("node", "label")
        if not changed:
            return labels
