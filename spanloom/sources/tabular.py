"""Readers of annotation, alignment and sequence files; missing and empty files give empty tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from spanloom.functions import labels
from spanloom.sources.files import listed, located
from spanloom.sources.ranges import kind_of, read_lines

GFF3 = "seqid string, source string, type string, start_pos long, end_pos long, score double, strand string, phase string, attrs map<string,string>"
HITS_12 = "qseqid string, sseqid string, pident double, length long, mismatch long, gapopen long, qstart long, qend long, sstart long, send long, evalue double, bitscore double"
HITS_11 = "qseqid string, sseqid string, pident double, length long, qstart long, qend long, evalue double, bitscore double, qlen long, slen long, qcovs double"
HITS_8 = "qseqid string, sseqid string, pident double, length long, qlen long, slen long, qstart long, qend long"


def _lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Text lines, none for a path that doesn't exist."""
    try:
        return spark.read.options(**options).text(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "value string")


def attributes(text: Column) -> Column:
    """``k=v;k=v`` as a map: split at the first '='; parts without one are dropped, the last of a key wins."""
    parts = F.filter(F.transform(F.split(text, ";"), lambda p: F.trim(p)), lambda p: p.contains("="))
    pairs = F.transform(parts, lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), F.regexp_replace(p, "^[^=]*=", "").alias("v")))
    # Of repeated keys the last one stays: a pair goes when its key comes again.
    last = F.filter(pairs, lambda x, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda y: y["k"] == x["k"]))
    return F.map_from_entries(last)


def read_gff3(spark: SparkSession, path: str) -> DataFrame:
    """Feature rows; comments, blank lines, short rows and rows without integer coordinates are left out."""
    rows = _lines(spark, path).select(F.regexp_replace("value", "\r$", "").alias("v")).filter("v <> '' AND v NOT LIKE '#%'")
    c = F.split("v", "\t")
    rows = rows.select(c.alias("c")).filter("size(c) = 9")

    def text(i: int) -> Column:
        return F.nullif(F.col("c")[i], F.lit("."))

    rows = rows.select(
        F.col("c")[0].alias("seqid"), text(1).alias("source"), text(2).alias("type"),
        F.col("c")[3].try_cast("long").alias("start_pos"), F.col("c")[4].try_cast("long").alias("end_pos"),
        F.col("c")[5].try_cast("double").alias("score"), F.col("c")[6].alias("strand"), text(7).alias("phase"), attributes(F.col("c")[8]).alias("attrs"),
    )
    return rows.filter("start_pos IS NOT NULL AND end_pos IS NOT NULL")


def read_fasta(spark: SparkSession, path: str, upper: bool = False) -> DataFrame:
    """(header, name, seq): one row per record, wrapped lines joined; records are split by Spark itself."""
    rows = _lines(spark, path, lineSep="\n>").select(F.regexp_replace("value", "^>", "").alias("v")).filter("trim(v) <> ''")
    header = F.regexp_replace(F.substring_index("v", "\n", 1), "\r$", "")
    seq = F.regexp_replace(F.when(F.contains("v", F.lit("\n")), F.regexp_replace("v", "^[^\n]*\n", "")).otherwise(""), r"[\r\n\s]+", "")
    return rows.select(header.alias("header"), F.regexp_extract(header, r"^(\S*)", 1).alias("name"), (F.upper(seq) if upper else seq).alias("seq"))


def _ordered_lines(spark: SparkSession, path: str, check: str | None = None) -> DataFrame:
    """(file, split, line, value): lines with what orders them, file parts by their first byte and lines inside a part.

    Where any file of the path is packed, or what files begin with is checked, each file is read by what its first bytes
    say it is; plain ones are read by Spark itself.
    """
    packed = False
    for name, _ in listed(path):
        system, place = located(name)
        with system.open_input_file(place) as file:
            packed = packed or kind_of(file.read(18)) != "plain"
    if packed or check:
        return read_lines(spark, path, check).select("file", "split", "line", "value")
    rows = _lines(spark, path)
    if "_metadata" not in str(rows.columns) and not rows.inputFiles():
        return rows.select(F.lit("").alias("file"), F.lit(0).cast("long").alias("split"), F.lit(0).cast("long").alias("line"), "value")
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("line"), "value")


def read_sequence_parts(spark: SparkSession, path: str, size: int = 1 << 20, upper: bool = False, check: str | None = None) -> DataFrame:
    """(name, header, part, offset, seq): records in parts of ``size`` bases, however long a record is.

    A name is the header up to its first blank. Lines are read by Spark's own file parts: a line belongs to the last
    header before it, in its part or carried over from the parts before, and lies behind the bases that its record has
    had so far, so no task holds a whole record. Packed files are known by their first bytes, whatever their names. With
    ``check`` every file must begin with that text, as ``>``. A record without bases gives no row.
    """
    rows = _ordered_lines(spark, path, check).withColumn("value", F.regexp_replace("value", r"\s+$", ""))
    head = F.col("value").startswith(">")
    rows = rows.select("file", "split", "line", "value", head.alias("_head"), F.when(head, 0).otherwise(F.length("value")).cast("long").alias("_size"))
    own = W.partitionBy("file", "split").orderBy("line")
    upto = own.rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("_title", F.last(F.when(F.col("_head"), F.struct("file", "split", "line", "value")), ignorenulls=True).over(upto))
    rows = rows.withColumn("_sum", F.sum("_size").over(upto))
    rows = rows.withColumn("_from", F.last(F.when(F.col("_head"), F.col("_sum")), ignorenulls=True).over(upto))
    # One row for each file part: its last header and the bases behind it (all its bases where it has none).
    ends = rows.groupBy("file", "split").agg(
        F.max("_title").alias("_last"), F.max(F.when(F.col("_head"), F.col("_sum"))).alias("_mark"), F.max("_sum").alias("_total")
    )
    along = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    tail = F.col("_total") - F.coalesce("_mark", F.lit(0))
    ends = ends.withColumn("_tail", tail).withColumn("_before", F.sum("_tail").over(along))
    ends = ends.withColumn("_open", F.last("_last", ignorenulls=True).over(along))
    base = F.last(F.when(F.col("_last").isNotNull(), F.coalesce(F.col("_before"), F.lit(0))), ignorenulls=True).over(along)
    ends = ends.withColumn("_carried", F.coalesce(F.col("_before"), F.lit(0)) - F.coalesce(base, F.lit(0)))
    rows = rows.join(ends.select("file", "split", "_open", "_carried"), ["file", "split"]).filter("NOT _head AND _size > 0")
    title = F.coalesce("_title", "_open")
    begin = F.col("_sum") - F.col("_size") - F.coalesce("_from", F.lit(0)) + F.when(F.col("_title").isNull(), F.col("_carried")).otherwise(0)
    lines = rows.select(title.alias("t"), begin.alias("b"), (F.upper("value") if upper else F.col("value")).alias("v")).filter("t IS NOT NULL")
    spread = lines.withColumn("part", F.explode(F.sequence(F.floor(F.col("b") / size), F.floor((F.col("b") + F.length("v") - 1) / size))))
    low = F.greatest(F.col("part") * size - F.col("b"), F.lit(0))
    high = F.least((F.col("part") + 1) * size - F.col("b"), F.length("v"))
    piece = F.substring(F.col("v"), (low + 1).cast("int"), (high - low).cast("int"))
    parts = spread.groupBy("t", "part").agg(F.array_sort(F.collect_list(F.struct("b", piece.alias("s")))).alias("_all"))
    header = F.substring(F.col("t.value"), 2, 1 << 30)
    seq = F.array_join(F.transform("_all", lambda x: x["s"]), "")
    return parts.select(F.regexp_extract(header, r"^(\S*)", 1).alias("name"), header.alias("header"), "part", (F.col("part") * size).alias("offset"), seq.alias("seq"))


def part_lengths(parts: DataFrame) -> DataFrame:
    """(seqid, length) from the rows of :func:`read_sequence_parts`."""
    return parts.groupBy(F.col("name").alias("seqid")).agg(F.max(F.col("offset") + F.length("seq")).alias("length"))


def read_lengths(spark: SparkSession, path: str) -> DataFrame:
    """(seqid, length) of an index file with five columns."""
    c = F.split("value", "\t")
    return _lines(spark, path).select(c[0].alias("seqid"), F.get(c, F.lit(1)).try_cast("long").alias("length")).filter("length IS NOT NULL")


def sequence_lengths(sequences: DataFrame) -> DataFrame:
    return sequences.select(F.col("name").alias("seqid"), F.length("seq").cast("long").alias("length"))


def read_hits(spark: SparkSession, path: str, schema: str = HITS_12) -> DataFrame:
    """Tab-separated alignment hits; reversed query or subject ranges are turned round."""
    fields = T._parse_datatype_string(schema).fields
    c = F.split("value", "\t")
    rows = _lines(spark, path).filter("value <> '' AND value NOT LIKE '#%'").filter(F.size(c) == len(fields))
    rows = rows.select(*[c[i].try_cast(f.dataType).alias(f.name) for i, f in enumerate(fields)])
    for a, b in (("qstart", "qend"), ("sstart", "send")):
        if a in rows.columns:
            rows = rows.withColumn("_lo", F.least(a, b)).withColumn(b, F.greatest(a, b)).withColumn(a, F.col("_lo")).drop("_lo")
    return rows


def read_repeat_hits(spark: SparkSession, path: str) -> DataFrame:
    """(seqid, start_pos, end_pos, repeat, class): five columns of a white-space table; header lines fail the casts."""
    c = F.split(F.trim("value"), r"\s+")
    rows = _lines(spark, path).filter(F.size(c) >= 11)
    rows = rows.select(c[4].alias("seqid"), c[5].try_cast("long").alias("start_pos"), c[6].try_cast("long").alias("end_pos"), c[9].alias("repeat"), c[10].alias("class"))
    return rows.filter("start_pos IS NOT NULL AND end_pos IS NOT NULL")


def read_superfamilies(spark: SparkSession, path: str) -> DataFrame:
    """(trc, sf): the first cluster token and the first all-digit token of each line, in any order or quoting."""
    tokens = F.transform(F.split(F.regexp_replace("value", '"', ""), r"[,;\t\s]+"), lambda t: F.trim(t))
    trc = F.get(F.filter(tokens, lambda t: t.rlike(r"^TRC_\S+$")), F.lit(0))
    number = F.get(F.filter(tokens, lambda t: t.rlike("^[0-9]+$")), F.lit(0))
    return _lines(spark, path).select(trc.alias("trc"), F.concat(F.lit("SF"), number).alias("sf")).filter("trc IS NOT NULL AND sf IS NOT NULL")


def read_rdna(spark: SparkSession, path: str) -> DataFrame:
    """(trc, class) of cluster types 45S and 5S; the first line of a cluster, by file and place, wins."""
    c = F.split("value", "\t")
    kind = F.upper(F.trim(F.get(c, F.lit(1))))
    label = F.when(kind == "45S", "rDNA/45S_rDNA").when(kind == "5S", "rDNA/5S_rDNA")
    rows = _ordered_lines(spark, path).select(F.trim(c[0]).alias("trc"), label.alias("class"), F.struct("file", "split", "line").alias("_i"))
    return rows.filter("class IS NOT NULL").groupBy("trc").agg(F.min_by("class", "_i").alias("class"))


#: Numbers of a rule's benchmark table.
BENCHMARK = ("s", "max_rss", "max_vms", "max_uss", "max_pss", "io_in", "io_out", "mean_load", "cpu_time")


def read_benchmarks(spark: SparkSession, path: str) -> DataFrame:
    """(rule, hms, BENCHMARK) of all rule tables of a path, slowest first; the rule is the file's name.

    Each file's own header names its columns, in any order; what isn't a number, as '-', is null.
    """
    lines = read_lines(spark, path).filter("value <> ''")
    heads = lines.filter("split = 0 AND line = 0").select("file", F.split("value", "\t").alias("_names"))
    rows = lines.filter("split > 0 OR line > 0").join(heads, "file").withColumn("_v", F.split("value", "\t"))
    held = F.map_from_entries(F.filter(F.arrays_zip("_names", "_v"), lambda x: x["_names"].isNotNull()))
    at = lambda c: F.try_element_at(held, F.lit(c))
    rule = F.regexp_extract("file", r"([^/]+?)(?:\.[^./]*)?$", 1)
    rows = rows.select(rule.alias("rule"), at("h:m:s").alias("hms"), *[at(c).try_cast("double").alias(c) for c in BENCHMARK])
    return rows.orderBy(F.col("s").desc(), "rule")


def _with_header(spark: SparkSession, path: str, required: tuple[str, ...], schema: str) -> DataFrame:
    """A tab-separated table with a header line, as text columns; empty where the file or a column is missing."""
    try:
        rows = spark.read.option("header", True).option("sep", "\t").option("quote", "").csv(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return spark.createDataFrame([], schema)
    return rows if set(required) <= set(rows.columns) else spark.createDataFrame([], schema)


def read_monomer_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(trc, size) of every array; the modal size of a cluster follows from :func:`report.modal_monomer`."""
    rows = _with_header(spark, path, ("TRC_ID", "monomer_size"), "TRC_ID string, monomer_size string")
    size = F.col("monomer_size").try_cast("double").cast("long")
    return rows.select(F.col("TRC_ID").alias("trc"), size.alias("size")).filter("trc IS NOT NULL AND size IS NOT NULL")


def _by_place(spark: SparkSession, path: str, names: tuple[str, str], more: int = 0) -> DataFrame:
    """The first columns of a tab-separated table whatever its header calls them; the header fails the cast of the second."""
    c = F.split(F.regexp_replace("value", '"', ""), "\t")
    rows = _lines(spark, path).filter(F.size(c) == 2 + more)
    second = [F.get(c, F.lit(i + 1)).try_cast("double").alias(n) for i, n in enumerate(names[1:])]
    return rows.select(F.get(c, F.lit(0)).alias(names[0]), *second).filter(F.col(names[1]).isNotNull())


def read_element_counts(spark: SparkSession, path: str) -> DataFrame:
    """(path, count) of a summary of elements by class, in the underscore dialect."""
    rows = _by_place(spark, path, ("raw_name", "count"))
    return rows.select(labels.canonicalise(F.col("raw_name"), F.lit("DANTE_TIR")).alias("path"), F.col("count").cast("long").alias("count"))


def read_composition(spark: SparkSession, path: str) -> DataFrame:
    """(type, bp, pct) of a table of repeat types."""
    return _by_place(spark, path, ("type", "bp", "pct"), more=1)


def read_vocabulary(spark: SparkSession, path: str) -> labels.Vocabulary:
    """The controlled vocabulary of a settings file: class paths, special classes, buckets, aliases and prefixes.

    The file is small. It has top-level sections whose entries are ``- value`` or ``key: value`` lines, indented by
    two blanks; the prefixes are pairs of ``underscore`` and ``canonical`` anywhere below the dialects.
    """
    text = "\n".join(r["value"] for r in spark.read.option("wholetext", True).text(path).collect())
    found: dict[str, list[tuple[str, str]]] = {}
    section, flats, paths = "", [], []

    def plain(value: str) -> str:
        value = value.strip()
        if value[:1] in "'\"" and value[:1]:
            return value[1 : value.index(value[0], 1)]
        return value.split(" #")[0].strip()

    for line in text.splitlines():
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        if not line[0].isspace():
            section = line.split(":")[0].strip()
            continue
        entry, depth = line.strip(), len(line) - len(line.lstrip())
        key, _, value = entry.removeprefix("- ").partition(": ")
        if section == "tool_dialects":
            if key == "underscore":
                flats.append(plain(value))
            elif key == "canonical":
                paths.append(plain(value))
        elif entry.startswith("- "):
            found.setdefault(section, []).append((plain(entry[2:]), ""))
        elif depth == 2:
            name, _, value = entry.partition(":") if not entry.startswith(("'", '"')) else (plain(entry), "", entry.partition(": ")[2])
            found.setdefault(section, []).append((plain(name), plain(value)))
    if "classifications" not in found:
        raise ValueError(f"no section 'classifications' in {path}")
    prefixes = sorted(zip(flats, paths), key=lambda x: -len(x[0]))
    special = tuple(v or k for k, v in found.get("special_classes", []))
    names = [tuple(k for k, _ in found.get(s, [])) for s in ("classifications", "aggregation_buckets")]
    return labels.Vocabulary(names[0], special, names[1], tuple(found.get("leaf_aliases", [])), tuple(prefixes))
