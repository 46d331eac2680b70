"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rinkframe.llm.store import keep


def components(edges: DataFrame) -> DataFrame:
    """``id, label`` for every end of the edges ``a, b``; the label is the smallest id
    that can be reached.

    Every round takes the smallest label among a node's neighbours and then follows
    labels one step further, so long chains halve. Each round is written to the shared
    folder; only the count of changes comes to the driver.
    """
    both = keep(
        edges.select(F.col("a").alias("id"), F.col("b").alias("to"))
        .unionByName(edges.select(F.col("b").alias("id"), F.col("a").alias("to"))).distinct(), "edges")
    labels = keep(both.groupBy("id").agg(F.min("to").alias("m"))
                  .select("id", F.least("id", "m").alias("label")), "labels")
    while True:
        seen = (both.join(labels.select(F.col("id").alias("to"), F.col("label").alias("other")), "to")
                .groupBy("id").agg(F.min("other").alias("other")))
        nearer = labels.join(seen, "id").select("id", "label", F.least("label", "other").alias("near"))
        step = nearer.join(
            labels.select(F.col("id").alias("near"), F.col("label").alias("further")), "near"
        ).select("id", F.col("label").alias("was"), F.least("near", "further").alias("label"))
        step = keep(step, "labels")
        labels = step.select("id", "label")
        if step.filter("label <> was").isEmpty():
            return labels
