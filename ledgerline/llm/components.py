"""Connected components of an edge table: hooking, pointer jumping, contraction.

Every round is joins and aggregates on Spark, written to the shared
checkpoint folder; only one count per step reaches the driver. A round meets
only the edges that the rounds before it left between different components.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label): each node of ``edges`` (a, b) with the smallest node it
    is connected to. Hot nodes only meet in partial aggregates and in inner
    or left joins, which adaptive execution splits."""
    left = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    labels = None
    while True:
        roots = _roots(left)
        if labels is None:
            labels = roots
        else:
            far = roots.select(F.col("node").alias("label"), F.col("label").alias("far"))
            labels = stored(labels.join(far, "label", "left").select("node", F.coalesce("far", "label").alias("label")), "cc")
        # What is left of the edges lies between the roots.
        left = left.join(roots.select(F.col("node").alias("a"), F.col("label").alias("x")), "a").join(
            roots.select(F.col("node").alias("b"), F.col("label").alias("y")), "b").filter("x <> y")
        left = stored(left.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "cc-edges")
        if left.isEmpty():
            return labels


def _roots(edges: DataFrame) -> DataFrame:
    """(node, label): the trees that arise where each node of ``edges``
    (a <= b) hooks to its smallest neighbour, unless that is larger than
    itself; the label is the tree's root, its smallest node."""
    both = edges.select(F.col("b").alias("node"), F.col("a").alias("label")).union(
        edges.select(F.col("a").alias("node"), F.col("a").alias("label")))
    labels = both.groupBy("node").agg(F.min("label").alias("label"))
    while True:
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        step = stored(labels.join(jump, "label").select("node", F.col("label").alias("old"), F.col("far").alias("label")), "cc")
        labels = step.select("node", "label")
        if step.filter("old <> label").isEmpty():
            return labels
