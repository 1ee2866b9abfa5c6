"""Connected components of a table of links, by smallest neighbour labels and pointer jumps."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import written


def components(links: DataFrame) -> DataFrame:
    """node and label (the smallest node of its component) of every node in ``links`` (a, b).

    A round takes the smallest label among a node's neighbours and then its label's label, so a
    chain shortens by half and more each time. Every round is written, which cuts its lineage.
    Minima are reduced before they are shuffled; the joins have one row per node on one side, so
    a node with very many links can be split by adaptive execution.
    """
    pairs = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pairs = written(pairs.distinct(), "links")
    labels = written(pairs.groupBy(F.col("a").alias("node")).agg(
        F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        near = pairs.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(
            F.min("label").alias("near"))
        step = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("at"), F.col("label").alias("further"))
        moved = written(step.join(jump, F.col("low") == F.col("at"), "left").select(
            "node", "old", F.least("low", "further").alias("label")), "labels")
        labels = moved.select("node", "label")
        if moved.where("label <> old").limit(1).count() == 0:
            return labels
