"""Sequence expressions: strands, parts, headers and wrapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanloom.operators.intervals import reduce_intervals
from spanloom.operators.ordered import placed, running
from spanloom.operators.scratch import dropped, settled


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def end_region(seq: Column, side: str, length: int = 30) -> Column:
    """The first (``start``) or last (``end``) bases of a sequence."""
    return F.substring(seq, 1, length) if side == "start" else F.right(seq, F.lit(length))


def monomer(seq: Column) -> Column:
    """First half of a dimer."""
    return F.substring(seq, F.lit(1), F.floor(F.length(seq) / 2).cast("int"))


def header_name(header: Column) -> Column:
    return F.substring_index(header, "#", 1)


def header_class(header: Column) -> Column:
    """Class after the first '#', without what follows a blank."""
    return F.when(header.contains("#"), F.regexp_extract(header, r"#(\S*)", 1))


def last_header_class(header: Column) -> Column:
    return F.when(header.contains("#"), F.substring_index(header, "#", -1))


def without_revcomp(identifier: Column) -> Column:
    return F.regexp_replace(identifier, "_revcomp$", "")


def header_group(header: Column) -> Column:
    """Last blank-separated word of a header without its end suffix."""
    return F.regexp_replace(F.element_at(F.split(F.trim(header), r"\s+"), -1), "_(5|3)prime$", "")


def wrapped(seq: Column, width: int = 80) -> Column:
    """Lines of ``width`` bases."""
    return F.regexp_replace(F.regexp_replace(seq, f"(.{{{width}}})", "$1\n"), "\n$", "")


def n_runs(parts: DataFrame, least: int = 10) -> DataFrame:
    """Runs of at least ``least`` N as 0-based half-open rows (name, start0, end0).

    ``parts`` are rows (name, part, offset, seq) as :func:`in_parts` and the part reader give them. Each part is
    searched by itself; only runs that touch a part's first or last base meet those of the next parts, and a run
    goes on over as many parts as it fills. Lower-case n counts too.
    """
    gaps = F.arrays_zip(F.split("seq", "[Nn]+", -1).alias("gap"), F.regexp_extract_all(F.col("seq"), F.lit("[Nn]+"), 0).alias("run"))
    rows = parts.select("name", "part", "offset", F.length("seq").alias("_size"), F.posexplode(gaps).alias("i", "g"))
    rows = rows.select("name", "part", "offset", "_size", "i", F.length("g.gap").alias("_gap"), F.coalesce(F.length("g.run"), F.lit(0)).alias("_run"))
    before = W.partitionBy("name", "part").orderBy("i").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("_at", F.coalesce(F.sum(F.col("_gap") + F.col("_run")).over(before), F.lit(0)) + F.col("_gap")).filter("_run > 0")
    border = (F.col("_at") == 0) | (F.col("_at") + F.col("_run") == F.col("_size"))
    start = F.col("offset") + F.col("_at")
    inner = rows.filter(~border).select("name", start.alias("start0"), (start + F.col("_run")).alias("end0"))
    touching = rows.filter(border).select(F.col("name").alias("seqid"), (start + 1).alias("start_pos"), (start + F.col("_run")).alias("end_pos"))
    joined = reduce_intervals(touching).select(F.col("seqid").alias("name"), (F.col("start_pos") - 1).alias("start0"), F.col("end_pos").alias("end0"))
    return inner.unionByName(joined).filter(F.col("end0") - F.col("start0") >= least)


def oriented(identifier: Column, seq: Column, strand: Column) -> tuple[Column, Column]:
    """Id and sequence in the strand's direction: minus ones reversed and complemented, their ids marked."""
    minus = strand == "-"
    return F.when(minus, F.concat(identifier, F.lit("_revcomp"))).otherwise(identifier), F.when(minus, reverse_complement(seq)).otherwise(seq)


def in_parts(sequences: DataFrame, size: int = 1 << 20) -> DataFrame:
    """Sequences (name, seq) as rows (name, part, offset, seq) of at most ``size`` bases."""
    count = F.greatest(F.lit(1), F.ceil(F.length("seq") / size)).cast("int")
    rows = sequences.select("name", "seq", F.explode(F.sequence(F.lit(0), count - 1)).alias("part"))
    offset = F.col("part").cast("long") * size
    return rows.select("name", F.col("part").cast("long").alias("part"), offset.alias("offset"), F.substring(F.col("seq"), (offset + 1).cast("int"), F.lit(size)).alias("seq"))


def subsequences(regions: DataFrame, parts: DataFrame, key: str, size: int = 1 << 20) -> DataFrame:
    """Regions (seqid, start_pos, end_pos, unique ``key``, ...) with the bases of their closed interval.

    ``parts`` are those of :func:`in_parts`, all but the last of ``size`` bases: a region meets only the
    parts that it touches, so no whole sequence is moved. Positions beyond a sequence give no bases.
    """
    touched = F.sequence(F.floor((F.greatest(F.col("start_pos"), F.lit(1)) - 1) / size), F.floor((F.greatest(F.col("end_pos"), F.lit(1)) - 1) / size))
    rows = regions.select(key, "seqid", "start_pos", "end_pos", F.explode(touched).alias("_part"))
    rows = rows.join(parts.select(F.col("name").alias("seqid"), F.col("part").alias("_part"), "offset", F.col("seq").alias("_seq")), ["seqid", "_part"])
    begin = F.greatest(F.col("start_pos") - F.col("offset"), F.lit(1)).cast("int")
    end = F.least(F.col("end_pos") - F.col("offset"), F.length("_seq")).cast("int")
    cut = F.substring(F.col("_seq"), begin, F.greatest(end - begin + 1, F.lit(0)))
    found = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_part", cut.alias("s")))).alias("_all"))
    joined = F.array_join(F.transform("_all", lambda x: x["s"]), "")
    return regions.join(found.select(key, joined.alias("bases")), key)


def chunk_plan(df: DataFrame, name: str, length: str, chunk: int, overlap: int) -> DataFrame:
    """Equal parts of sequences longer than two chunks: (name, part, offset, size); neighbours overlap."""
    parts = F.when(F.col(length) > 2 * chunk, F.floor(F.col(length) / chunk)).otherwise(F.lit(1)).cast("long")
    rows = df.select(F.col(name).alias("name"), F.col(length).cast("long").alias("_len"), parts.alias("_n"))
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    begin = F.floor(F.col("part") * F.col("_len") / F.col("_n")).cast("long")
    end = F.floor((F.col("part") + 1) * F.col("_len") / F.col("_n")).cast("long")
    return rows.select("name", "part", begin.alias("offset"), (F.least(F.col("_len"), end + overlap) - begin).alias("size"))


def chunk_remap(hits: DataFrame, plan: DataFrame) -> DataFrame:
    """Hits on parts (name, part, start_pos, end_pos, ...) in coordinates of the whole sequence."""
    at = plan.select("name", "part", F.col("offset").alias("_o"))
    moved = hits.join(at, ["name", "part"])
    return moved.withColumn("start_pos", F.col("start_pos") + F.col("_o")).withColumn("end_pos", F.col("end_pos") + F.col("_o")).drop("_o", "part")


def packed_in_order(spark: SparkSession, df: DataFrame, order: list[str], size: str, capacity: int) -> DataFrame:
    """``df`` with ``bin`` (from 0): rows in order fill a bin until the next one would push it over ``capacity``.

    A row of more than the capacity has a bin of its own. Each row's successor, the first row that no longer
    fits into a bin begun with it, is looked up among the running sums. Which rows begin bins is then
    found by pointer doubling: a round doubles the bins known, so rounds grow with the logarithm of their
    number and no task reads all rows. Sizes below 1 count as 0.
    """
    rows = placed(spark, df.withColumn("_size", F.greatest(F.col(size).cast("long"), F.lit(0))), order, "_at")
    rows = settled(spark, running(rows, [], "_at", ["_at"], F.col("_size"), "_sum").withColumn("_before", F.col("_sum") - F.col("_size")))
    # The first row whose sum exceeds what was before plus the capacity; negated, so a running minimum looks ahead.
    ask = F.col("_before") + capacity
    kind = "struct<_at:bigint,_before:bigint>"
    points = rows.select((-F.col("_sum")).alias("_p"), F.lit(0).alias("_o"), F.struct("_at", "_before").cast(kind).alias("_v"), F.lit(None).cast(kind).alias("_of"))
    probes = rows.select((-ask).alias("_p"), F.lit(-1).alias("_o"), F.lit(None).cast(kind).alias("_v"), F.struct("_at", "_before").cast(kind).alias("_of"))
    seen = running(points.unionByName(probes), [], "_p", ["_p", "_o"], F.col("_v"), "_next", "min", before=True, size=1 << 24)
    # Where only empty rows come before it, even a row of more than the capacity goes into the bin.
    then = F.col("_next._at") + F.when(F.col("_next._before") == F.col("_of._before"), 1).otherwise(0)
    found = seen.filter("_of IS NOT NULL").select(F.col("_of._at").alias("node"), then.alias("next"))
    jump = settled(spark, found.filter("next IS NOT NULL"))
    starts = settled(spark, rows.filter("_at = 1").select(F.col("_at").alias("node")))
    while True:
        more = settled(spark, starts.join(jump, "node").select(F.col("next").alias("node")).join(starts, "node", "left_anti"))
        if not more.limit(1).count():
            break
        starts = settled(spark, starts.union(more))
        ahead = jump.select(F.col("node").alias("next"), F.col("next").alias("_then"))
        further = settled(spark, jump.join(ahead, "next").select("node", F.col("_then").alias("next")))
        dropped(spark, jump)
        jump = further
    marked = rows.join(starts.select(F.col("node").alias("_at"), F.lit(1).alias("_first")), "_at", "left")
    out = running(marked, [], "_at", ["_at"], F.coalesce("_first", F.lit(0)), "bin")
    return out.select(*df.columns, (F.col("bin") - 1).alias("bin"))
