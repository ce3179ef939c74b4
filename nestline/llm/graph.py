"""Connected components of links by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from nestline.sources.scratch import written


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b): the smallest node that it is connected with.

    Each round takes the least label among the neighbours, then the label of the label, so that the rounds
    grow with the logarithm of the longest chain. Links and labels stay in tables; only the number of
    changed labels comes to the driver.
    """
    ways = written(links.select("a", "b").union(links.select("b", "a")).toDF("node", "other"), "ways")
    labels = written(ways.groupBy("node").agg(F.least("node", F.min("other")).alias("label")), "labels")
    while True:
        near = (ways.join(labels.select(F.col("node").alias("other"), F.col("label").alias("seen")), "other")
                .groupBy("node").agg(F.min("seen").alias("seen")))
        lower = written(labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "seen").alias("label")),
                        "labels")
        onward = lower.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = written(lower.join(onward, "label").select("node", "old", F.least("label", "next").alias("label")), "labels")
        labels = jumped.select("node", "label")
        if jumped.where("label < old").isEmpty():
            return labels
