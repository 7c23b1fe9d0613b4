"""Writers of feature tables, sequence libraries and tracks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.labels import sanitised
from spanloom.functions.sequences import wrapped
from spanloom.operators.ordered import totalled
from spanloom.operators.report import buckets
from spanloom.operators.scratch import settled
from spanloom.sources.files import write_placed
from spanloom.sources.ranges import packed_blocks
from spanloom.sources.writer import write_buckets


def gff3_column(df: DataFrame, attributes: list[str], source: str = "source_tool") -> Column:
    """The feature line of a row as one expression."""
    attrs = F.concat_ws(";", *[F.when(F.col(a).isNotNull(), F.concat(F.lit(f"{a}="), F.col(a).cast("string"))) for a in attributes])
    kind = F.col("type") if "type" in df.columns else F.lit("repeat_region")
    strand = F.when(F.col("strand").isin("+", "-"), F.col("strand")).otherwise(".")
    fields = (F.coalesce("seqid", F.lit(".")), F.coalesce(source, F.lit(".")), kind, F.col("start_pos"), F.col("end_pos"), F.lit("."), strand, F.lit("."), F.when(attrs == "", ".").otherwise(attrs))
    return F.concat_ws("\t", *[f.cast("string") for f in fields])


def feature_line(df: DataFrame) -> Column:
    """The line of a row as the feature reader gives it (seqid, type, start_pos, end_pos, strand, attrs, ...)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(".")) if c in df.columns else F.lit(".")
    pairs = F.array_sort(F.transform(F.map_entries("attrs"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    attrs = F.when(F.coalesce(F.size("attrs"), F.lit(0)) > 0, F.array_join(pairs, ";")).otherwise(".")
    return F.concat_ws("\t", *[text(c) for c in ("seqid", "source", "type", "start_pos", "end_pos", "score", "strand", "phase")], attrs)


VERSION = "##gff-version 3"
PLACE = ["seqid", "start_pos", "end_pos"]


def write_gff3(df: DataFrame, path: str, attributes: list[str], source: str = "source_tool") -> None:
    """Feature files in order of place, each with the version line first; an empty table has one file with that line."""
    rows = df.select(F.lit("features").alias("bucket"), *PLACE, gff3_column(df, attributes, source).alias("value"))
    write_buckets(rows, path, PLACE, VERSION, ".gff3", always=("features",))


def write_features(df: DataFrame, path: str) -> None:
    """Rows as the feature reader gives them, written so that it reads them back."""
    write_buckets(df.select(F.lit("features").alias("bucket"), *PLACE, feature_line(df).alias("value")), path, PLACE, VERSION, ".gff3", always=("features",))


def write_by_name(df: DataFrame, path: str, name: str, attributes: list[str], prefix: str | None = None) -> None:
    """A feature file for each name (made file-safe); rows without a name are left out."""
    rows = df.filter(F.coalesce(F.col(name), F.lit("")) != "")
    if prefix:
        rows = rows.filter(F.col(name).startswith(prefix))
    named = rows.select(sanitised(F.col(name)).alias("bucket"), *PLACE, gff3_column(rows, attributes).alias("value"))
    write_buckets(named, path, PLACE, VERSION, ".gff3")


#: Roll-ups that have a file even where nothing belongs to them.
ROLLUPS = ("Mobile_elements", "Simple_repeats", "Low_complexity", "rDNA", "All_Ty1_Copia", "All_Ty3_Gypsy")


def write_by_class(df: DataFrame, path: str, attributes: list[str]) -> None:
    """A feature file for each class and roll-up of an annotation's level-1 rows (see :func:`report.buckets`)."""
    rows = buckets(df)
    named = rows.select("bucket", *PLACE, gff3_column(rows, attributes).alias("value"))
    write_buckets(named, path, PLACE, VERSION, ".gff3", always=ROLLUPS)


def write_fasta(df: DataFrame, path: str, header: str = "header", seq: str = "seq", width: int = 80) -> None:
    df.select(F.concat(F.lit(">"), F.col(header), F.lit("\n"), wrapped(F.col(seq), width)).alias("value")).write.text(path)


def _laid_out(df: DataFrame, width: int) -> DataFrame:
    lines = F.concat(F.lit(">"), "name", F.lit("\n"), wrapped(F.col("seq"), width), F.when(F.length("seq") > 0, "\n").otherwise(""))
    return df.select("name", F.length("seq").cast("long").alias("length"), lines.cast("binary").alias("value"))


def _at(df: DataFrame) -> DataFrame:
    """Rows with ``at``: the bytes of all values before them in order of name."""
    rows = df.withColumn("_bytes", F.octet_length("value").cast("long"))
    return settled(df.sparkSession, totalled(df.sparkSession, rows, ["name"], "_bytes", "at").drop("_bytes"))


def write_indexed(df: DataFrame, path: str, width: int = 60) -> None:
    """Sequences (name, seq) as one plain file ``path`` in order of name, and its index ``path``.fai.

    Where a record begins follows from the bytes of those before it, so the index needs no second look at the file.
    """
    rows = _at(_laid_out(df, width))
    write_placed(rows, path)
    bases = F.least(F.col("length"), F.lit(width))
    index = F.concat_ws("\t", "name", "length", F.col("at") + F.octet_length("name") + 2, bases, bases + 1)
    write_placed(_at(rows.select("name", F.concat(index, F.lit("\n")).cast("binary").alias("value"))), f"{path}.fai")


def write_packed(df: DataFrame, path: str, width: int = 60) -> None:
    """Sequences (name, seq) as one block-packed file in order of name; its blocks can be unpacked one by one."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [packed_blocks(v) for v in batch.column("value").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(packed, pa.binary())], ["name", "value"])

    rows = _at(_laid_out(df, width).select("name", "value").mapInArrow(pack, "name string, value binary"))
    end = rows.agg(F.coalesce(F.max(F.col("at") + F.octet_length("value")), F.lit(0)).alias("at")).select("at", F.lit(packed_blocks(b"")).alias("value"))
    write_placed(rows.select("at", "value").unionByName(end), path)


def write_track(df: DataFrame, path: str) -> None:
    """A track as 0-based half-open text rows in order."""
    rows = df.repartitionByRange("seqid", "start_pos").sortWithinPartitions("seqid", "start_pos")
    rows.select(F.concat_ws("\t", "seqid", F.col("start_pos") - 1, "end_pos", "score").alias("value")).write.text(path)
