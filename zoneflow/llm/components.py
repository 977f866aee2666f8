"""Connected components of a graph given as edges, by joins over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.session import write_table


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of `edges` (a, b); comp is the smallest node its links reach.

    Each round a node takes the smallest label around it, then the label of its
    label, so long chains shorten fast. Rounds are stored tables: a lost
    executor costs one round at most. Labels meet in a partial minimum before
    the shuffle, and a node with very many links is split by the skewed join.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = write_table(both.where("a <> b").distinct(), "links")
    labels = write_table(
        links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("comp"))
        .select("node", F.least("node", "comp").alias("comp")), "labels")
    while True:
        around = (
            links.join(labels.select(F.col("node").alias("b"), "comp"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        )
        near = labels.join(around, "node").select(
            "node", F.col("comp").alias("was"), F.least("comp", "near").alias("hop"))
        step = labels.select(F.col("node").alias("hop"), F.col("comp").alias("beyond"))
        labels = write_table(
            near.join(step, "hop").select("node", "was", F.least("hop", "beyond").alias("comp")), "labels")
        if labels.where("comp <> was").isEmpty():
            return labels.select("node", "comp")
