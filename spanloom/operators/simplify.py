"""Line simplification of ordered tracks in rounds over open segments.

A round finds the farthest point of every open segment in one aggregate and either closes the segment or
splits it there, for all segments of all tracks at once. Segments that have become short are
finished in one task each, so no task holds a long track.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.operators.ordered import running
from spanloom.operators.scratch import dropped, settled
from spanloom.operators.sweep import local

#: Points of a segment that one task finishes at once.
SHORT = 50_000


def far_points(x: np.ndarray, y: np.ndarray, epsilon: float) -> np.ndarray:
    """Which points of one segment stay, its two ends among them."""
    keep = np.zeros(len(x), bool)
    keep[[0, -1]] = True
    stack = [(0, len(x) - 1)]
    while stack:
        a, b = stack.pop()
        if b - a < 2:
            continue
        away = np.abs(y[a + 1 : b] - (y[a] + (x[a + 1 : b] - x[a]) / (x[b] - x[a]) * (y[b] - y[a])))
        far = int(away.argmax())
        if away[far] > epsilon:
            keep[a + 1 + far] = True
            stack += [(a, a + 1 + far), (a + 1 + far, b)]
    return keep


def simplified(spark: SparkSession, track: DataFrame, epsilon: float, short: int = SHORT) -> DataFrame:
    """Rows (track, x, y) whose points lie more than ``epsilon`` beside the line of what else stays.

    Ramer-Douglas-Peucker with vertical distances, the first of equally far points. Null or NaN y stay and part
    lines; both ends of each line stay. x is unique in a track. With ``epsilon`` of 0 or less all rows stay.
    """
    if epsilon <= 0:
        return track
    rows = track.select("track", F.col("x").cast("double").alias("x"), F.nanvl(F.col("y").cast("double"), F.lit(None).cast("double")).alias("y"))
    gap = F.when(F.col("y").isNull(), 1).otherwise(0)
    rows = settled(spark, running(rows, ["track"], "x", ["x"], gap, "_line"))
    gaps, points = rows.filter("y IS NULL"), rows.filter("y IS NOT NULL")
    point = F.struct("x", "y")
    ends = points.groupBy("track", "_line").agg(F.min_by(point, "x").alias("_a"), F.max_by(point, "x").alias("_b"), F.count(F.lit(1)).alias("_n"))
    ends = settled(spark, ends)
    kept = [gaps.select("track", "x", "y")] + [ends.select("track", f"{e}.x", f"{e}.y") for e in ("_a",)]
    kept.append(ends.filter("_n > 1").select("track", "_b.x", "_b.y"))
    # Points strictly inside open segments, with the segment's ends.
    inner = (F.col("x") > F.col("_a.x")) & (F.col("x") < F.col("_b.x"))
    open_ = settled(spark, points.join(ends, ["track", "_line"]).filter(inner).select("track", "x", "y", "_a", "_b", "_n"))
    while True:
        few = open_.filter(F.col("_n") <= short)
        kept.append(_finished(few, epsilon))
        many = open_.filter(F.col("_n") > short)
        if not many.limit(1).count():
            break
        a, b = F.col("_a"), F.col("_b")
        away = F.abs(F.col("y") - (a["y"] + (F.col("x") - a["x"]) / (b["x"] - a["x"]) * (b["y"] - a["y"])))
        far = many.withColumn("_d", away).groupBy("track", F.col("_a.x").alias("_ax")).agg(F.max(F.struct(F.col("_d").alias("d"), (-F.col("x")).alias("o"), "y")).alias("_f"))
        far = settled(spark, far.filter(F.col("_f.d") > epsilon).select("track", "_ax", (-F.col("_f.o")).alias("_x"), F.col("_f.y").alias("_y")))
        kept.append(far.select("track", F.col("_x").alias("x"), F.col("_y").alias("y")))
        middle = F.struct(F.col("_x").alias("x"), F.col("_y").alias("y"))
        left = F.col("x") < F.col("_x")
        rest = many.withColumn("_ax", F.col("_a.x")).join(far, ["track", "_ax"]).filter("x <> _x")
        rest = rest.select("track", "x", "y", F.when(left, F.col("_a")).otherwise(middle).alias("_a"), F.when(left, middle).otherwise(F.col("_b")).alias("_b"))
        rest = settled(spark, rest)
        sizes = rest.groupBy("track", F.col("_a.x").alias("_ax")).agg(F.count(F.lit(1)).alias("_n"))
        nearer = settled(spark, rest.withColumn("_ax", F.col("_a.x")).join(sizes, ["track", "_ax"]).drop("_ax"))
        dropped(spark, rest)
        open_ = nearer
    out = kept[0]
    for more in kept[1:]:
        out = out.unionByName(more)
    return out


def _finished(points: DataFrame, epsilon: float) -> DataFrame:
    """What stays of the inner points of short segments."""
    rows = points.select("track", F.col("_a.x").alias("_ax"), F.col("_a.y").alias("_ay"), F.col("_b.x").alias("_bx"), F.col("_b.y").alias("_by"), "x", "y")

    def fold(table: pa.Table) -> pa.Table:
        ends = [table.column(c)[0].as_py() for c in ("_ax", "_ay", "_bx", "_by")]
        x = np.concatenate(([ends[0]], table.column("x").to_numpy(), [ends[2]]))
        y = np.concatenate(([ends[1]], table.column("y").to_numpy(), [ends[3]]))
        keep = far_points(x, y, epsilon)[1:-1]
        return table.take(pa.array(np.flatnonzero(keep))).select(["track", "x", "y"])

    return local(rows, ["track", "_ax"], ["x"], fold, "track string, x double, y double")
