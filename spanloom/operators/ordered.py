"""Values along ordered rows without one task for a whole sequence.

Rows are dealt by (keys, bin of a position). What passes from one bin to the next (the last row, a
running sum or maximum) is found from one row for each bin, and joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanloom.operators.scratch import settled

#: Positions in a bin.
STRETCH = 1 << 17


def _binned(df: DataFrame, position: str, size: int) -> DataFrame:
    return df.withColumn("_bin", F.floor(F.col(position) / F.lit(size)).cast("long"))


def _same(keys: Sequence[str]) -> Column:
    """Equality of the keys of this row and of the summary row, where null keys are equal too."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return out


def _with_summary(rows: DataFrame, bins: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    keys = [*keys, "_bin"]
    bins = bins.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *columns)
    return rows.join(bins, _same(keys)).drop(*[f"_k_{k}" for k in keys])


def neighbour(
    df: DataFrame, keys: Sequence[str], position: str, order: Sequence[str], columns: Sequence[str], name: str, ahead: bool = False, size: int = STRETCH
) -> DataFrame:
    """``df`` with the struct ``name`` of ``columns`` of the row before (or after) in order, null at the ends.

    ``order`` begins with ``position`` and is total within the keys.
    """
    keys = list(keys)
    rows = _binned(df, position, size).withColumn("_v", F.struct(*columns))
    inside = W.partitionBy(*keys, "_bin").orderBy(*order)
    pick = F.min_by if ahead else F.max_by
    bins = rows.groupBy(*keys, "_bin").agg(pick("_v", F.struct(*order)).alias("_edge"))
    along = W.partitionBy(*keys).orderBy("_bin")
    bins = bins.withColumn("_next", (F.lead if ahead else F.lag)("_edge").over(along))
    rows = rows.withColumn("_own", (F.lead if ahead else F.lag)("_v").over(inside))
    rows = _with_summary(rows, bins, keys, ["_next"])
    return rows.withColumn(name, F.coalesce("_own", "_next")).drop("_v", "_own", "_next", "_bin")


def running(
    df: DataFrame, keys: Sequence[str], position: str, order: Sequence[str], value: Column, name: str,
    kind: str = "sum", before: bool = False, size: int = STRETCH,
) -> DataFrame:
    """``df`` with the running sum, max or min ``name`` of ``value`` up to this row, or up to the one before."""
    keys = list(keys)
    fold = {"sum": F.sum, "max": F.max, "min": F.min}[kind]
    join = {"sum": lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)), "max": F.greatest, "min": F.least}[kind]
    rows = _binned(df, position, size).withColumn("_v", value)
    bins = rows.groupBy(*keys, "_bin").agg(fold("_v").alias("_all"))
    along = W.partitionBy(*keys).orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    bins = bins.withColumn("_past", fold("_all").over(along))
    inside = W.partitionBy(*keys, "_bin").orderBy(*order).rowsBetween(W.unboundedPreceding, -1 if before else 0)
    rows = rows.withColumn("_own", fold("_v").over(inside))
    rows = _with_summary(rows, bins, keys, ["_past"])
    return rows.withColumn(name, join(F.col("_own"), F.col("_past"))).drop("_v", "_own", "_past", "_bin")


def islands(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "island", size: int = STRETCH) -> DataFrame:
    """``df`` with a number, by the keys, of the run of overlapping rows (start_pos, end_pos) a row is in."""
    rows = running(df, keys, "start_pos", order, F.col("end_pos"), "_reach", "max", before=True, size=size)
    fresh = F.coalesce((F.col("start_pos") > F.col("_reach")).cast("long"), F.lit(1))
    return running(rows, keys, "start_pos", order, fresh, name, size=size).drop("_reach")


def halo(df: DataFrame, keys: Sequence[str], place: str, before: int, after: int, block: int = 4096) -> DataFrame:
    """Rows with ``_block``, and copies (``_own`` false) of those within reach of the next blocks' rows.

    ``place`` numbers the rows of a key without gaps; a window over (keys, _block) then sees
    ``before`` rows before and ``after`` rows after each own row.
    """
    own = F.floor(F.col(place) / block)
    low, high = F.floor((F.col(place) - after) / block), F.floor((F.col(place) + before) / block)
    rows = df.withColumn("_block", F.explode(F.array_distinct(F.array(low, own, high))))
    return rows.withColumn("_own", F.col("_block") == own)


def placed(spark: SparkSession, df: DataFrame, order: Sequence[str], name: str = "place") -> DataFrame:
    """``df`` with each row's place (from 1) in one total order of any columns.

    Rows are dealt by ranges of the order, stored once, and numbered inside their range behind the rows of the ranges
    before it; rows that are equal in all of ``order`` take places in any order.
    """
    ranges = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    rows = settled(spark, ranges)
    counts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # one row a range
    rows = rows.withColumn(name, F.row_number().over(W.partitionBy("_range").orderBy(*order)))
    rows = rows.join(counts.select("_range", before.alias("_before")), "_range")
    return rows.withColumn(name, (F.col(name) + F.col("_before")).cast("long")).drop("_range", "_before")


def totalled(spark: SparkSession, df: DataFrame, order: Sequence[str | Column], value: str, name: str) -> DataFrame:
    """``df`` with the sum ``name`` of ``value`` over all rows before each one in a total order, by ranges as :func:`placed`."""
    rows = settled(spark, df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sums = rows.groupBy("_range").agg(F.sum(value).alias("_sum"))
    before = F.sum("_sum").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1))  # one row a range
    inside = F.sum(value).over(W.partitionBy("_range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("_own", inside).join(sums.select("_range", before.alias("_before")), "_range")
    zero = F.lit(0).cast("long")
    return rows.withColumn(name, F.coalesce("_own", zero) + F.coalesce("_before", zero)).drop("_range", "_own", "_before")


def placed_within(spark: SparkSession, df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "place") -> DataFrame:
    """As :func:`placed`, counted anew for each value of the keys."""
    keys = list(keys)
    rows = placed(spark, df, [*keys, *order], name)
    first = rows.groupBy(*keys).agg((F.min(name) - 1).alias("_first"))
    rows = _with_summary(rows.withColumn("_bin", F.lit(0)), first.withColumn("_bin", F.lit(0)), keys, ["_first"])
    return rows.withColumn(name, F.col(name) - F.col("_first")).drop("_first", "_bin")
