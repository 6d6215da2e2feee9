"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netwatch.llm.tasks import discard, saved


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node that it is joined to, for each node of edges ``(a, b)``.

    Labels fall to the smallest one nearby, then to the label of that label, so that a chain halves in each
    round. Rounds end when no label changes. Each one is written to the shared folder, and the one before removed.
    """
    both = saved(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels, F.col("b") == F.col("node"))
            .groupBy("a")
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, F.col("node") == F.col("a"), "left").select(
            "node", "label", F.least("label", F.col("near")).alias("next")
        )
        of_label = labels.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
        new = saved(
            lower.join(of_label, F.col("next") == F.col("_node"), "left").select(
                "node",
                F.least("next", "_label").alias("label"),
                (F.least("next", "_label") != F.col("label")).alias("changed"),
            ),
            "labels",
        )
        discard(labels)
        labels = new.select("node", "label")
        if new.filter("changed").isEmpty():
            discard(both)
            return labels
