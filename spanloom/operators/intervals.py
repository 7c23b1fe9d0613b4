"""Interval set algebra on rows with seqid, start_pos, end_pos (1-based, closed).

Long sequences don't become single tasks: rows are dealt by (seqid, bin) with fixed bins, work
happens inside bins, and only what touches a bin's border is stitched afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanloom.operators.scratch import settled
from spanloom.operators.sweep import SWEEP_BIN, disjoined, uncovered, widest

#: Bases in a bin of one-row-per-bin work; a feature longer than that is present in several bins.
BIN = 1 << 17
#: Bases in a bin of pairwise work: candidates are square in a bin's rows, so it is near the width of features.
PAIR_BIN = 1 << 12


def _bin(position: Column | str, size: int) -> Column:
    position = F.col(position) if isinstance(position, str) else position
    return F.floor((position - 1) / F.lit(size)).cast("long")


def in_bins(df: DataFrame, size: int = BIN, name: str = "bin") -> DataFrame:
    """Every feature once for each bin that it reaches."""
    return df.withColumn(name, F.explode(F.sequence(_bin("start_pos", size), _bin("end_pos", size))))


def clipped(df: DataFrame, size: int = BIN) -> DataFrame:
    """Features cut at bin borders, with their bin."""
    cut = in_bins(df, size)
    return cut.withColumn("start_pos", F.greatest("start_pos", F.col("bin") * size + 1)).withColumn(
        "end_pos", F.least("end_pos", (F.col("bin") + 1) * size)
    )


def reduce_intervals(df: DataFrame, keys: Sequence[str] = ("seqid",), size: int = BIN) -> DataFrame:
    """Union of the intervals of each key: overlapping and adjacent ones become one.

    Islands are found inside (key, bin). One that fills a bin up to its border joins the one
    that begins there; these few islands alone are ordered over a whole key.
    """
    keys = list(keys)
    pieces = clipped(df.select(*keys, "start_pos", "end_pos"), size)
    order = W.partitionBy(*keys, "bin").orderBy("start_pos", "end_pos")
    reach = F.max("end_pos").over(order.rowsBetween(W.unboundedPreceding, -1))
    pieces = pieces.withColumn("_new", F.coalesce((F.col("start_pos") > reach + 1).cast("int"), F.lit(1)))
    pieces = pieces.withColumn("_island", F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    islands = pieces.groupBy(*keys, "bin", "_island").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"))
    left = F.col("start_pos") == F.col("bin") * size + 1
    right = F.col("end_pos") == (F.col("bin") + 1) * size
    islands = islands.withColumn("_l", left).withColumn("_r", right).drop("_island")
    inner = islands.filter("NOT _l AND NOT _r").select(*keys, "start_pos", "end_pos")
    border = islands.filter("_l OR _r")
    along = W.partitionBy(*keys).orderBy("start_pos")
    starts = ~(F.col("_l") & F.coalesce(F.lag("end_pos").over(along) == F.col("start_pos") - 1, F.lit(False)))
    border = border.withColumn("_new", starts.cast("int"))
    border = border.withColumn("_chain", F.sum("_new").over(along.rowsBetween(W.unboundedPreceding, 0)))
    border = border.groupBy(*keys, "_chain").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"))
    return inner.unionByName(border.select(*keys, "start_pos", "end_pos"))


def overlap_join(a: DataFrame, b: DataFrame, size: int = PAIR_BIN, within: bool = False) -> DataFrame:
    """All pairs of overlapping rows on one seqid; strand is ignored.

    Columns of ``a`` and ``b`` get the suffixes _a and _b, and ``overlap_bp`` is added. A pair that
    meets in several bins is emitted in the bin of its later start only. ``within`` keeps
    pairs whose a lies inside b.
    """
    left = in_bins(a, size).toDF(*[f"{c}_a" for c in a.columns], "bin")
    right = in_bins(b, size).toDF(*[f"{c}_b" for c in b.columns], "_bin")
    later = F.greatest("start_pos_a", "start_pos_b")
    meets = (F.col("start_pos_a") <= F.col("end_pos_b")) & (F.col("start_pos_b") <= F.col("end_pos_a"))
    if within:
        meets = (F.col("start_pos_a") >= F.col("start_pos_b")) & (F.col("end_pos_a") <= F.col("end_pos_b"))
    on = (F.col("seqid_a") == F.col("seqid_b")) & (F.col("bin") == F.col("_bin")) & meets & (F.col("bin") == _bin(later, size))
    joined = left.join(right, on).drop("bin", "_bin")
    return joined.withColumn("overlap_bp", F.least("end_pos_a", "end_pos_b") - later + 1)


def overlapping(a: DataFrame, b: DataFrame, key: str, size: int = PAIR_BIN, within: bool = False, seqids: bool = False) -> DataFrame:
    """The keys of rows of ``a`` that overlap (or lie within) any row of ``b``, once each; with ``seqids`` beside their seqid."""
    left = in_bins(a.select(F.col(key), "seqid", F.col("start_pos").alias("_s"), F.col("end_pos").alias("_e")).withColumnsRenamed({"_s": "start_pos", "_e": "end_pos"}), size)
    right = in_bins(b.select("seqid", "start_pos", "end_pos"), size).toDF("_seqid", "_s", "_e", "_bin")
    meets = (F.col("start_pos") <= F.col("_e")) & (F.col("_s") <= F.col("end_pos"))
    if within:
        meets = (F.col("start_pos") >= F.col("_s")) & (F.col("end_pos") <= F.col("_e"))
    on = (F.col("seqid") == F.col("_seqid")) & (F.col("bin") == F.col("_bin")) & meets
    return left.join(right, on, "left_semi").select(key, *(["seqid"] if seqids else [])).distinct()


def overlap_semi(a: DataFrame, b: DataFrame, key: str, size: int = PAIR_BIN, within: bool = False) -> DataFrame:
    """Rows of ``a`` that overlap any row of ``b``."""
    return a.join(overlapping(a, b, key, size, within), key, "left_semi")


def overlap_anti(a: DataFrame, b: DataFrame, key: str, size: int = PAIR_BIN, within: bool = False) -> DataFrame:
    """Rows of ``a`` that overlap no row of ``b``."""
    return a.join(overlapping(a, b, key, size, within), key, "left_anti")


def self_overlaps(df: DataFrame, key: str, size: int = PAIR_BIN) -> DataFrame:
    """Overlapping pairs of different rows of one table, each pair once (smaller key first)."""
    return overlap_join(df, df, size).filter(F.col(f"{key}_a") < F.col(f"{key}_b"))


def best_parent(children: DataFrame, parents: DataFrame, child: str, parent: str, size: int = SWEEP_BIN) -> DataFrame:
    """(child, parent, overlap_bp): the parent with the widest intersection, ties to the smaller key of any type."""
    place = ("seqid", "start_pos", "end_pos")
    found = widest(children.select(F.col(child).alias("child"), *place), parents.select(F.col(parent).alias("parent"), *place), size)
    best = F.min(F.struct((-F.col("overlap_bp")).alias("w"), F.col("parent").alias("p"))).alias("best")
    return found.groupBy("child").agg(best).select("child", F.col("best.p").alias("parent"), (-F.col("best.w")).alias("overlap_bp"))


def segments(df: DataFrame, keys: Sequence[str] = ("seqid",), size: int = PAIR_BIN) -> DataFrame:
    """Atomic segments between all borders of the features of a key, gaps included."""
    keys = list(keys)
    points = df.select(*keys, F.explode(F.array("start_pos", F.col("end_pos") + 1)).alias("pos")).distinct()
    points = points.withColumn("bin", _bin("pos", size))
    inside = W.partitionBy(*keys, "bin").orderBy("pos")
    # The last border of a bin is followed by the first one of the next bin that has any.
    heads = points.groupBy(*keys, "bin").agg(F.min("pos").alias("_head"))
    heads = heads.select(*keys, "bin", F.lead("_head").over(W.partitionBy(*keys).orderBy("bin")).alias("_next"))
    points = points.withColumn("_lead", F.lead("pos").over(inside)).join(heads, [*keys, "bin"])
    end = F.coalesce("_lead", "_next") - 1
    return points.select(*keys, F.col("pos").alias("start_pos"), end.alias("end_pos")).filter("end_pos IS NOT NULL")


def disjoin(df: DataFrame, key: str, size: int = SWEEP_BIN) -> DataFrame:
    """(seqid, start_pos, end_pos, members, depth): atomic segments with the sorted keys that cover them."""
    return disjoined(df, key, size=size)


def trim(
    lower: DataFrame, higher: DataFrame, key: str, min_len: int = 50, size: int = SWEEP_BIN, reduced: bool = False
) -> DataFrame:
    """``lower`` without what ``higher`` covers, cut at all borders, columns of the first source.

    Follows the tier rule: on a seqid where no lower row meets a higher one, rows stay as they
    are. Elsewhere the pieces come from the disjoint segments of lower and higher rows, take the
    columns of the covering lower row with the smallest key, and are dropped under ``min_len``
    bases when that row was trimmed; trimmed rows lose their strand. ``reduced`` says that
    ``higher`` already holds disjoint regions. Rows with equal keys count as one.
    """
    spark = lower.sparkSession
    high = higher.select("seqid", "start_pos", "end_pos") if reduced else settled(spark, reduce_intervals(higher))
    hit = settled(spark, overlapping(lower, high, key, seqids=True))  # read three times below
    seqids = hit.select("seqid").distinct()
    untouched = lower.join(seqids, "seqid", "left_anti")
    marks = hit.select(F.col(key), F.lit(True).alias("_trimmed")).distinct()
    marked = lower.join(seqids, "seqid", "left_semi").join(marks, key, "left").withColumn("_trimmed", F.coalesce("_trimmed", F.lit(False)))
    found = uncovered(marked, high.join(seqids, "seqid", "left_semi"), key, size)
    found = found.filter(~F.col("_trimmed") | (F.col("end_pos") - F.col("start_pos") + 1 >= min_len))
    if "strand" in lower.columns:
        found = found.withColumn("strand", F.when(F.col("_trimmed"), F.lit("*")).otherwise(F.col("strand")))
    return found.select(*lower.columns).unionByName(untouched.select(*lower.columns))


def pieces(df: DataFrame, holes: str) -> DataFrame:
    """Rows without the disjoint ``holes`` (sorted array of s, e; null: none), and ``_cut``: whether there were any."""
    none = F.array().cast("array<struct<s:bigint,e:bigint>>")
    rows = df.withColumn(holes, F.coalesce(F.col(holes).cast("array<struct<s:bigint,e:bigint>>"), none))
    starts = F.concat(F.array(F.col("start_pos").cast("long")), F.transform(holes, lambda h: h["e"] + 1))
    ends = F.concat(F.transform(holes, lambda h: h["s"] - 1), F.array(F.col("end_pos").cast("long")))
    free = F.filter(F.arrays_zip(starts.alias("s"), ends.alias("e")), lambda p: p["s"] <= p["e"])
    rows = rows.withColumn("_cut", F.size(holes) > 0).withColumn("_p", F.explode(free))
    return rows.withColumn("start_pos", F.col("_p.s")).withColumn("end_pos", F.col("_p.e")).drop("_p", holes)


def subtract(a: DataFrame, b: DataFrame, key: str, size: int = PAIR_BIN) -> DataFrame:
    """Pieces of each row of ``a`` that ``b`` doesn't cover, with all columns of ``a``."""
    pairs = overlap_join(a.select(F.col(key).alias("k"), "seqid", "start_pos", "end_pos"), reduce_intervals(b), size)
    holes = F.array_sort(F.collect_list(F.struct(F.col("start_pos_b").alias("s"), F.col("end_pos_b").alias("e"))))
    cuts = pairs.groupBy(F.col("k_a").alias(key)).agg(holes.alias("_holes"))
    return pieces(a.join(cuts, key, "left"), "_holes").select(*a.columns)


def covered_bp(df: DataFrame, keys: Sequence[str] = ("seqid",), size: int = BIN) -> DataFrame:
    """Bases of the union of each key's intervals; a sum over bins without ordering a whole key."""
    return reduce_intervals(df, keys, size).groupBy(*keys).agg(F.sum(F.col("end_pos") - F.col("start_pos") + 1).alias("bp"))


def merged_bed(df: DataFrame, size: int = BIN) -> DataFrame:
    """Merged regions as 0-based half-open rows."""
    return reduce_intervals(df, size=size).select("seqid", (F.col("start_pos") - 1).alias("start0"), F.col("end_pos").alias("end0"))
