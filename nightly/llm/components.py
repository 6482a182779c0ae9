"""Connected components of a link table by label propagation with pointer jumping, without leaving the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from nightly.session import materialize


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (a, b): the smallest node reachable.

    Each round takes the smallest label among a node and its neighbours and then the label's own label; a chain of n links
    needs about log n rounds. Rounds are written to the shared folder, so a lost executor costs at most one of them.
    """
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = materialize(both, "links")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnsRenamed({"node": "b", "label": "_near"}), "b").groupBy(F.col("a").alias("node")).agg(F.min("_near").alias("_near"))
        step = labels.join(near, "node").select("node", F.least("label", "_near").alias("label"), F.col("label").alias("_old"))
        step = materialize(step, "labels")
        top = step.select(F.col("node").alias("label"), F.col("label").alias("_top"))
        jumped = materialize(step.join(top, "label").select("node", F.col("_top").alias("label"), "_old"), "labels")
        labels = jumped.select("node", "label")
        if jumped.where(F.col("label") != F.col("_old")).isEmpty():
            return labels
