"""Connected components of a graph given as pairs of long values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.session import written


def components(pairs: DataFrame) -> DataFrame:
    """Columns `node`, `label` for the nodes of `pairs` (a, b): the smallest node of the component.

    Labels spread to neighbours and are then replaced by the labels of their labels, until none
    changes. Every round is written to the shared folder, so a lost executor repeats one round at
    most, and so that joins on a node with very many neighbours can be split.
    """
    spread = written(pairs.select("a", "b").union(pairs.select("b", "a")).distinct(), "links")
    labels = written(spread.groupBy(F.col("a").alias("node")).agg(
        F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        near = (spread.join(labels, spread.a == labels.node).groupBy(F.col("b").alias("node"))
                .agg(F.min("label").alias("near")))
        moved = written(labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")), "labels")
        further = moved.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = written(moved.join(further, "label").select(
            "node", "old", F.least("label", "further").alias("label")), "labels")
        labels = new.select("node", "label")
        if new.filter("old != label").isEmpty():
            return labels
