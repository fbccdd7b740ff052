"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.shared import stored


def _roots(parents: DataFrame) -> DataFrame:
    """Parents replaced by the roots above them, by doubling."""
    while True:
        above = parents.select(F.col("node").alias("at"), F.col("parent").alias("above"))
        next_up = stored(parents.join(above, F.col("parent") == F.col("at"), "left").select(
            "node", F.coalesce("above", "parent").alias("parent"),
            (F.coalesce("above", "parent") != F.col("parent")).alias("moved")), "parents")
        parents = next_up.drop("moved")
        if next_up.filter("moved").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of links (a, b): label is the smallest node that
    can be reached.

    Each round hooks every node to its smallest neighbour, replaces nodes by the roots
    of these trees and keeps the links between different roots; every tree that has a
    link left has a neighbour, so the number of nodes at least halves.  Links, nodes and
    labels stay in tables; only whether a table is empty comes to the driver.
    """
    links = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter(
        "a <> b").distinct(), "links")
    labels = None
    while labels is None or not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = _roots(stored(both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.min("b"), F.col("node")).alias("parent")), "parents"))
        if labels is None:
            labels = parents.withColumnRenamed("parent", "label")
        else:
            over = parents.select(F.col("node").alias("label"), F.col("parent").alias("above"))
            labels = stored(labels.join(over, "label", "left").select(
                "node", F.coalesce("above", "label").alias("label")), "labels")
        of_a = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        of_b = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        links = stored(links.join(of_a, "a").join(of_b, "b").select(
            F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).filter("a <> b").distinct(), "links")
    return labels
