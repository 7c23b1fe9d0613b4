"""Greedy choices settled on Spark in rounds instead of one task's loop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.operators.scratch import dropped, settled


def kept_greedily(spark: SparkSession, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, kept) for the ``nodes`` (id): a node goes when a kept node with an edge (qid, sid) to it stands before it.

    Edges lead from a node to nodes that come earlier in one total order. In each round every node
    whose earlier partners are all decided is decided, so it ends after as many rounds as the longest chain
    of undecided partners; decided nodes' edges leave.
    """
    edges = settled(spark, edges.select("qid", "sid").distinct())
    held = settled(spark, edges.select(F.col("qid").alias("id")).distinct())
    state = nodes.select("id").distinct().join(held.withColumn("_h", F.lit(True)), "id", "left")
    state = settled(spark, state.select("id", F.when(F.col("_h").isNull(), True).alias("kept")))
    while state.filter("kept IS NULL").limit(1).count():
        before = state
        over = edges.join(state.select(F.col("id").alias("sid"), "kept"), "sid")  # a partner that is no node counts for nothing
        over = over.groupBy(F.col("qid").alias("id")).agg(F.bool_or(F.coalesce("kept", F.lit(False))).alias("_in"), F.bool_or(F.col("kept").isNull()).alias("_open"))
        state = state.join(over, "id", "left").select(
            "id", F.coalesce("kept", F.when(F.col("_in"), False), F.when(~F.coalesce("_open", F.lit(False)), True)).alias("kept")
        )
        state = settled(spark, state)
        fewer = settled(spark, edges.join(state.filter("kept IS NULL").select(F.col("id").alias("qid")), "qid", "left_semi"))
        for done in (edges, before):
            dropped(spark, done)
        edges = fewer
    return state
