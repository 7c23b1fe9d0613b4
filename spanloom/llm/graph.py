"""Connected components over edge tables, with labels kept in stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import dropped, stored


def _roots(spark: SparkSession, pointers: DataFrame) -> DataFrame:
    """Follow pointers (node, root), each to a smaller node, until every root is final."""
    while True:
        ahead = pointers.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
        jumped = pointers.join(ahead, F.col("root") == F.col("_n"), "left").select(
            "node", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("_moved")
        )
        jumped = stored(spark, jumped, "roots")
        moved = jumped.filter("_moved").limit(1).count()
        pointers = jumped.drop("_moved")
        if not moved:
            return pointers


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); a component's id is its smallest node.

    In each round every node or merged group points to its smallest neighbour, the trees are
    flattened by pointer jumping and the edges between different groups carry on, so
    the rounds grow with the logarithm of a component's size, not with its diameter.
    """
    edges = edges.filter("a <> b").select("a", "b")
    edges = stored(spark, edges.union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(spark, edges.select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node")), "labels")
    while edges.limit(1).count():
        smallest = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).filter("root < node")
        roots = _roots(spark, stored(spark, smallest, "pointers"))
        moved = labels.join(roots.select(F.col("node").alias("component"), "root"), "component", "left")
        new_labels = stored(spark, moved.select("node", F.coalesce("root", "component").alias("component")), "labels")
        left = roots.select(F.col("node").alias("a"), F.col("root").alias("_ra"))
        right = roots.select(F.col("node").alias("b"), F.col("root").alias("_rb"))
        merged = (
            edges.join(left, "a", "left")
            .join(right, "b", "left")
            .select(F.coalesce("_ra", "a").alias("a"), F.coalesce("_rb", "b").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        new_edges = stored(spark, merged, "edges")
        dropped(spark, edges)
        dropped(spark, labels)
        edges, labels = new_edges, new_labels
    return labels
