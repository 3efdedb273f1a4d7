"""Connected components of an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertalk.sources.scratch import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: the smallest node that each node of ``a, b`` is connected with.

    Every round takes the smallest label among a node and its neighbours, then the label's
    own label, so that long chains shorten by a factor; grouped minima combine before the
    shuffle, so a node with very many neighbours is no single task's work. Rounds end when
    no label changes; each reads the table that the round before has written.
    """
    both = edges.select("a", "b").unionAll(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    )
    both = stored(both.filter("a <> b").distinct(), "edges")
    labels = stored(
        both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"),
        "labels",
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        step = labels.join(near, "node").select(
            "node", F.least("label", "near").alias("next"), F.col("label").alias("before")
        )
        step = stored(step, "step")
        jump = step.select(F.col("node").alias("next"), F.col("next").alias("beyond"))
        after = stored(
            step.join(jump, "next").select("node", F.col("beyond").alias("label"), "before"),
            "labels",
        )
        # One number: how many labels changed.
        changed = after.filter(F.col("label") != F.col("before")).limit(1).count()
        labels = after.select("node", "label")
        if changed == 0:
            return labels
