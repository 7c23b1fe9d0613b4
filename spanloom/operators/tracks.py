"""Binned density tracks: coverage, smoothing, run-length merging and binning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanloom.operators.intervals import clipped, reduce_intervals
from spanloom.operators.ordered import halo, neighbour, running, totalled


def density(df: DataFrame, lengths: DataFrame, step: int) -> DataFrame:
    """(seqid, start_pos, end_pos, score): covered share of fixed bins; empty bins score 0, the last one is short."""
    cover = clipped(reduce_intervals(df), step).groupBy("seqid", "bin").agg(F.sum(F.col("end_pos") - F.col("start_pos") + 1).alias("bp"))
    bins = lengths.select("seqid", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / step))).alias("bin"))
    rows = bins.join(cover, ["seqid", "bin"], "left")
    start, end = F.col("bin") * step + 1, F.least((F.col("bin") + 1) * step, F.col("length"))
    score = F.coalesce("bp", F.lit(0)) / (end - start + 1)
    return rows.select("seqid", start.alias("start_pos"), end.alias("end_pos"), F.round(score, 9).alias("score"))


def _numbered(track: DataFrame) -> DataFrame:
    """Tiles with their number ``_place`` from 0 on their sequence."""
    return running(track, ["seqid"], "start_pos", ["start_pos"], F.lit(1), "_place").withColumn("_place", F.col("_place") - 1)


def smoothed(track: DataFrame, before: int = 4, after: int = 5) -> DataFrame:
    """Running mean over ten tiles with zeros beyond the ends."""
    rows = halo(_numbered(track), ["seqid"], "_place", before, after)
    order = W.partitionBy("seqid", "_block").orderBy("_place").rowsBetween(-before, after)
    rows = rows.withColumn("score", F.round(F.sum("score").over(order) / (before + after + 1), 9))
    return rows.filter("_own").select(*track.columns)


def smoothed_inside(track: DataFrame, n: int = 10) -> DataFrame:
    """The same without the first and last n-1 tiles; tracks shorter than n stay as they are."""
    counts = track.groupBy("seqid").agg(F.count(F.lit(1)).alias("_count"))
    rows = halo(_numbered(track), ["seqid"], "_place", 4, n - 5).join(counts, "seqid")
    mean = F.sum("score").over(W.partitionBy("seqid", "_block").orderBy("_place").rowsBetween(-4, n - 5)) / n
    inner = F.col("_place").between(n - 1, F.col("_count") - n)
    score = F.when(F.col("_count") < n, F.col("score")).when(inner, mean)
    return rows.withColumn("score", F.round(score, 9)).filter("_own").select(*track.columns)


def run_lengths(track: DataFrame) -> DataFrame:
    """Neighbouring tiles with exactly equal scores merged."""
    rows = neighbour(track, ["seqid"], "start_pos", ["start_pos"], ["score", "end_pos"], "_prev")
    same = (F.col("_prev.score") == F.col("score")) & (F.col("_prev.end_pos") + 1 == F.col("start_pos"))
    rows = running(rows, ["seqid"], "start_pos", ["start_pos"], F.when(same, 0).otherwise(1), "_run")
    merged = rows.groupBy("seqid", "_run").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"), F.first("score").alias("score"))
    return merged.drop("_run")


def rebinned(track: DataFrame, lengths: DataFrame, width: int) -> DataFrame:
    """Mean score in wider bins, weighted by bases; negative means count as 0."""
    cut = clipped(track, width).withColumn("_w", F.col("end_pos") - F.col("start_pos") + 1)
    sums = cut.groupBy("seqid", "bin").agg(F.sum(F.col("score") * F.col("_w")).alias("_s"), F.sum("_w").alias("_w"))
    return sums.select("seqid", "bin", F.round(F.greatest(F.lit(0.0), F.col("_s") / F.col("_w")), 6).alias("score"))


def summed(tracks: DataFrame) -> DataFrame:
    """Sum of tracks with equal tiles, at most 1."""
    return tracks.groupBy("seqid", "start_pos", "end_pos").agg(F.round(F.least(F.lit(1.0), F.sum("score")), 6).alias("score"))


def axis(spark: SparkSession, lengths: DataFrame) -> DataFrame:
    """Sequences side by side, longest first: offset and midpoint in Mb; dealt by ranges of the order."""
    rows = totalled(spark, lengths, [F.col("length").desc(), F.col("seqid")], "length", "offset")
    return rows.select("seqid", "length", "offset", F.round((F.col("offset") + F.col("length") / 2) / 1e6, 3).alias("mid_mb"))
