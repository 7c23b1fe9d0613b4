"""Grouped statistics and roll-ups of annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanloom.functions import labels
from spanloom.operators.intervals import covered_bp


def _width():
    return F.col("end_pos") - F.col("start_pos") + 1


def grouped_names(df: DataFrame) -> DataFrame:
    """Level-1 rows (id, name, classification, ...) with ``group``: rDNA by class, satellites and simple repeats in one each, else the name.

    Rows without ids all count as level 1.
    """
    if "id" in df.columns:
        df = df.filter(F.col("id").isNull() | F.col("id").startswith("UA_L1_"))
    name = F.when(F.col("classification").startswith("rDNA"), F.col("classification")).otherwise(F.col("name"))
    group = F.when(name.rlike("^(TRC_|Satellite)"), "Tandem_repeats").when(name.contains("Simple_repeat"), "Simple_repeat").otherwise(name)
    return df.withColumn("group", group)


def summary_stats(df: DataFrame, lengths: DataFrame) -> DataFrame:
    """(name, total_bp, percent) of :func:`grouped_names`, as a share of the genome."""
    genome = lengths.agg(F.sum("length").alias("_g"))
    rows = grouped_names(df).groupBy(F.col("group").alias("name")).agg(F.sum(_width()).alias("total_bp"))
    return rows.crossJoin(F.broadcast(genome)).select("name", "total_bp", F.round(F.col("total_bp") * 100.0 / F.col("_g"), 9).alias("percent"))


def category_bp(df: DataFrame) -> DataFrame:
    """Union bases of each category on each sequence, one column for each category."""
    names = [c for _, c in labels.CATEGORIES] + ["Other repeats"]
    rows = covered_bp(df.withColumn("category", labels.repeat_category(F.col("classification"))), ("seqid", "category"))
    wide = rows.groupBy("seqid").pivot("category", names).agg(F.sum("bp"))
    return wide.select("seqid", *[F.coalesce(F.col(f"`{n}`"), F.lit(0)).alias(labels_key(n)) for n in names])


def labels_key(name: str) -> str:
    return name.lower().replace(" ", "_").replace("/", "_")


def class_rollup(df: DataFrame) -> DataFrame:
    """For every node of the class tree: own and subtree features and bases, depth, whether it is a leaf."""
    rows = df.groupBy("classification").agg(F.count(F.lit(1)).alias("n"), F.sum(_width()).alias("bp"))
    nodes = rows.select("classification", "n", "bp", F.explode(labels.ancestors(F.col("classification"))).alias("node"))
    own = F.col("node") == F.col("classification")
    out = nodes.groupBy("node").agg(
        F.sum(F.when(own, F.col("n")).otherwise(0)).alias("own_n"), F.sum(F.when(own, F.col("bp")).otherwise(0)).alias("own_bp"),
        F.sum("n").alias("total_n"), F.sum("bp").alias("total_bp"), F.max((~own).cast("int")).alias("_inner"),
    )
    return out.select("node", F.size(F.split("node", "/")).alias("level"), "own_n", "own_bp", "total_n", "total_bp", (F.col("_inner") == 0).alias("leaf"))


def composition(df: DataFrame, lengths: DataFrame, least: int) -> DataFrame:
    """(place, seq, category, fraction): covered share by category of every sequence of ``least`` bases, and of all shorter ones together.

    Bars follow by their whole covered share, the fullest first, ties by name; ``Other`` comes last.
    """
    names = F.when(F.col("length") >= least, F.col("seqid")).otherwise("Other")
    shown = lengths.select("seqid", "length", names.alias("seq"))
    sizes = shown.groupBy("seq").agg(F.sum("length").alias("_len"))
    labelled = df.withColumn("category", labels.repeat_category(F.col("classification")))
    bases = covered_bp(labelled, ("seqid", "category")).join(shown.select("seqid", "seq"), "seqid").groupBy("seq", "category").agg(F.sum("bp").alias("bp"))
    rows = sizes.join(bases, "seq", "left").withColumn("fraction", F.coalesce("bp", F.lit(0)) / F.col("_len"))
    bars = rows.groupBy("seq").agg(F.sum("fraction").alias("_all"))
    place = F.row_number().over(W.orderBy(F.col("seq") == "Other", F.col("_all").desc(), "seq"))  # one row a bar
    rows = rows.join(bars.select("seq", place.alias("place")), "seq").filter("category IS NOT NULL")
    return rows.select("place", "seq", "category", F.round("fraction", 9).alias("fraction"))


# Fixed value: the order of the top classes.
TOP_ORDER = ("Class_I", "Class_II", "rDNA", "rDNA_45S", "rDNA_5S", "Tandem_repeats", "Simple_repeat", "Low_complexity", "Unknown")
# End of fixed value.


def class_table(sizes: DataFrame, genome: int, counts: DataFrame | None = None, members: DataFrame | None = None, lines: int | None = None) -> DataFrame:
    """Rows of the class tree in display order: (place, path, label, row_type, depth, bp, percent, elements, tandem_members).

    ``sizes`` are (type, bp). A node with children gives a row ``total`` of its subtree and, where it has bases of its
    own, ``unspecified``; one without gives ``leaf`` with the element count of ``counts`` (path, count) and the number of
    elements in tandem arrays of ``members`` (path, count). ``lines``, where above 0, is the count of the first path that ends
    in LINE, in place of any other. Top classes have a fixed order,
    others follow by size; below, subtrees follow by size, ties by name. The tree has as many rows as there are classes.
    """
    own = sizes.groupBy(F.col("type").alias("path")).agg(F.sum("bp").alias("own"))
    above = own.select("own", F.explode(labels.ancestors(F.col("path"))).alias("path"), (F.col("path")).alias("_leaf"))
    nodes = above.groupBy("path").agg(F.sum("own").alias("total"), F.sum(F.when(F.col("path") == F.col("_leaf"), F.col("own")).otherwise(0)).alias("own"), F.bool_or(F.col("path") != F.col("_leaf")).alias("inner"))
    depth = F.size(F.split("path", "/")) - 1
    top = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(x) for x in TOP_ORDER]), F.col("path")), F.lit(0)), F.lit(len(TOP_ORDER) + 1))
    step = F.struct(F.when(depth == 0, top).otherwise(0).alias("o"), (-F.col("total")).alias("s"), F.col("path").alias("p"))
    keyed = nodes.select("path", step.alias("_step"))
    trail = nodes.select(F.col("path").alias("_node"), F.posexplode(labels.ancestors(F.col("path"))).alias("_i", "path")).join(keyed, "path")
    order = trail.groupBy(F.col("_node").alias("path")).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_step"))), lambda x: x["_step"]).alias("_order"))
    rows = nodes.join(order, "path")
    kinds = F.array_compact(F.array(
        F.when(F.col("inner"), F.struct(F.lit("total").alias("row_type"), F.lit(0).alias("_k"), depth.alias("depth"), F.col("total").alias("bp"))),
        F.when(F.col("inner") & (F.col("own") > 0), F.struct(F.lit("unspecified").alias("row_type"), F.lit(1).alias("_k"), (depth + 1).alias("depth"), F.col("own").alias("bp"))),
        F.when(~F.col("inner"), F.struct(F.lit("leaf").alias("row_type"), F.lit(0).alias("_k"), depth.alias("depth"), F.col("own").alias("bp"))),
    ))
    rows = rows.withColumn("x", F.explode(kinds))
    for given, name in ((counts, "elements"), (members, "tandem_members")):
        found = rows.limit(0).select("path", F.lit(0).cast("long").alias(name)) if given is None else given.groupBy("path").agg(F.sum("count").alias(name))
        rows = rows.join(found, "path", "left")
    if lines:
        first = nodes.filter(F.col("path").endswith("LINE")).agg(F.min("path").alias("_line"))
        rows = rows.crossJoin(F.broadcast(first))
        rows = rows.withColumn("elements", F.when(F.col("path") == F.col("_line"), F.lit(lines).cast("long")).otherwise(F.col("elements")))
    # A node's own bases come behind its total and before its children.
    place = F.row_number().over(W.orderBy("_order", "x._k"))
    return rows.select(
        place.alias("place"), "path", F.element_at(F.split("path", "/"), -1).alias("label"), "x.row_type", F.col("x.depth").cast("int").alias("depth"), F.col("x.bp").alias("bp"),
        F.round(F.col("x.bp") / genome * 100, 9).alias("percent"), *[F.when(F.col("x.row_type") == "leaf", F.col(c)).alias(c) for c in ("elements", "tandem_members")],
    )


def modal_monomer(sizes: DataFrame) -> DataFrame:
    """(trc, monomer): the most frequent size, ties to the smaller."""
    counts = sizes.groupBy("trc", "size").agg(F.count(F.lit(1)).alias("n"))
    first = W.partitionBy("trc").orderBy(F.col("n").desc(), "size")
    return counts.withColumn("_r", F.row_number().over(first)).filter("_r = 1").select("trc", F.col("size").alias("monomer"))


def satellite_coverage(track: DataFrame, top: int) -> DataFrame:
    """Covered bases of the clusters with most of them, by sequence: (trc, seqid, bp, share)."""
    rows = track.groupBy("trc", "seqid").agg(F.sum(F.col("score") * _width()).alias("bp"))
    best = rows.groupBy("trc").agg(F.sum("bp").alias("_t")).orderBy(F.col("_t").desc(), "trc").limit(top)
    return rows.join(best, "trc").select("trc", "seqid", F.round("bp", 3).alias("bp"), F.round(F.col("bp") / F.col("_t"), 9).alias("share"))


def tool_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("source_tool", "classification").agg(F.count(F.lit(1)).alias("n"), F.sum(_width()).alias("bp"))


def report_cards(sizes: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row: genome size in Mb, sequences, and shares of the genome of all repeats and of four subtrees of ``sizes`` (type, bp)."""
    def share(path: str) -> Column:
        return F.sum(F.when((F.col("type") == path) | F.col("type").startswith(f"{path}/"), F.col("bp")).otherwise(0))

    parts = {"repeats": F.sum("bp"), "ltr": share("Class_I/LTR"), "class_ii": share("Class_II"), "line": share("Class_I/LINE"), "tandem": share("Tandem_repeats")}
    sums = sizes.agg(*[v.alias(k) for k, v in parts.items()])
    genome = lengths.agg(F.sum("length").alias("_g"), F.count(F.lit(1)).alias("sequences"))
    rows = sums.crossJoin(F.broadcast(genome))
    return rows.select((F.col("_g") / 1e6).alias("genome_mb"), "sequences", *[F.round(F.coalesce(F.col(k), F.lit(0)) / F.col("_g") * 100, 9).alias(f"{k}_percent") for k in parts])


def shown_sequences(lengths: DataFrame, least_chart: int, least_track: int, tracks: int) -> DataFrame:
    """(seqid, length, chart, track): sequences long enough for each kind of figure, of tracks the longest ``tracks``, ties to the smaller name."""
    long_ = lengths.filter(F.col("length") >= least_track).orderBy(F.col("length").desc(), "seqid").limit(tracks)
    rows = lengths.join(long_.select("seqid", F.lit(True).alias("_t")), "seqid", "left")
    return rows.select("seqid", "length", (F.col("length") >= least_chart).alias("chart"), F.coalesce("_t", F.lit(False)).alias("track"))


def other_sequences(lengths: DataFrame, least_chart: int) -> DataFrame:
    """One row: number and bases of the sequences that are too short for a chart of their own."""
    short = F.col("length") < least_chart
    return lengths.agg(F.count(F.when(short, 1)).alias("n_other"), F.coalesce(F.sum(F.when(short, F.col("length"))), F.lit(0)).alias("other_bp"))


def element_stats(elements: DataFrame) -> DataFrame:
    """(path, count, bp) of complete LTR elements (rank, final_classification, start_pos, end_pos)."""
    good = elements.filter(labels.complete_rank(F.col("rank")))
    path = labels.canonicalise(F.col("final_classification"), F.lit("DANTE_LTR"))
    return good.groupBy(path.alias("path")).agg(F.count(F.lit(1)).alias("count"), F.sum(_width()).alias("bp"))


def tandem_stats(containers: DataFrame) -> DataFrame:
    """(path, tr_members, tr_arrays) of tandem containers (classification, structure, copy_number); a copy number that is none counts 0."""
    chains = containers.filter("structure = 'LTR_RT_TR'")
    copies = F.coalesce(F.col("copy_number").try_cast("long"), F.lit(0))
    return chains.groupBy(F.col("classification").alias("path")).agg(F.sum(copies).alias("tr_members"), F.count(F.lit(1)).alias("tr_arrays"))


def structural_summary(elements: DataFrame) -> DataFrame:
    """(source_tool, regions, mb) of the structure-based tools."""
    rows = elements.filter("source_tier = 1")
    return rows.groupBy("source_tool").agg(F.count(F.lit(1)).alias("regions"), F.round(F.sum(_width()) / 1e6, 6).alias("mb"))


def sunburst(sizes: DataFrame, genome: int) -> DataFrame:
    """(id, label, parent, value, percent): nodes of the class tree with their own bases, the root Repeats and what is no repeat."""
    own = sizes.groupBy(F.col("type").alias("id")).agg(F.sum("bp").alias("value"))
    nodes = own.select(F.explode(labels.ancestors(F.col("id"))).alias("id")).distinct().join(own, "id", "left")
    up = F.when(F.col("id").contains("/"), F.regexp_replace("id", "/[^/]+$", "")).otherwise("Repeats")
    rows = nodes.select("id", F.element_at(F.split("id", "/"), -1).alias("label"), up.alias("parent"), F.coalesce("value", F.lit(0)).alias("value"))
    total = own.agg(F.coalesce(F.sum("value"), F.lit(0)).alias("t"))
    root = total.select(F.lit("Repeats").alias("id"), F.lit("Repeats").alias("label"), F.lit("").alias("parent"), F.lit(0).cast("long").alias("value"))
    rest = total.select(F.lit("Non-repetitive").alias("id"), F.lit("Non-repetitive").alias("label"), F.lit("").alias("parent"), F.greatest(F.lit(0), F.lit(genome) - F.col("t")).alias("value"))
    return rows.unionByName(root).unionByName(rest).withColumn("percent", F.round(F.col("value") / genome * 100, 9))


def chart_series(rows: DataFrame, series: str, order: list[str], fields: list[str]) -> DataFrame:
    """(series, spec): for each series one JSON object of arrays, one for each field, in order; series are figures of bounded size."""
    points = F.array_sort(F.collect_list(F.struct(*order, *[F.col(f).alias(f"_{f}") for f in fields])))
    found = rows.groupBy(series).agg(points.alias("_p"))
    arrays = [F.col("_p").getField(f"_{f}").alias(f) for f in fields]
    return found.select(F.col(series).alias("series"), F.to_json(F.struct(*arrays)).alias("spec"))


def satellite_bars(coverage: DataFrame, lengths: DataFrame) -> DataFrame:
    """(place, seqid, label, trc, fraction): stacked bars of clusters' covered fraction of each sequence, fullest first.

    ``coverage`` are (trc, seqid, bp), such as those of :func:`satellite_coverage`; ties go by seqid. A bar's label has its
    sequence's length in Mb; every cluster has a part in every bar, if only of 0.
    """
    known = coverage.groupBy("seqid", "trc").agg(F.sum("bp").alias("bp")).join(lengths.select("seqid", "length"), "seqid")
    sums = known.groupBy("seqid", "length").agg(F.sum("bp").alias("_all"))
    place = F.row_number().over(W.orderBy((F.col("_all") / F.col("length")).desc(), "seqid"))  # one row a bar
    bars = sums.select("seqid", "length", place.alias("place"))
    # Bars are bounded by what a figure shows: clusters are the top ones, sequences those of the figure.
    rows = bars.crossJoin(F.broadcast(known.select("trc").distinct())).join(known.select("seqid", "trc", "bp"), ["seqid", "trc"], "left")
    label = F.format_string("%s (%.1f Mb)", "seqid", F.col("length") / 1e6)
    return rows.select("place", "seqid", label.alias("label"), "trc", F.round(F.coalesce("bp", F.lit(0)) / F.col("length"), 9).alias("fraction"))


# Fixed value: the lineages that have a track, in order.
LINEAGE_TRACKS = ("Ale", "Alesia", "Angela", "Bianca", "Bryco", "Gymco-I", "Gymco-II", "Gymco-III", "Gymco-IV", "Ikeros", "Ivana", "Lyco", "Osser", "SIRE", "TAR", "Tork", "Chlamyvir", "chromo-unclass", "CRM", "Galadriel", "Reina", "Tcn1", "Tekay", "Athila", "Ogre", "Retand", "TatI", "TatII", "TatIII", "Phygy", "Selgy")
# End of fixed value.


def lineage_tracks(files: DataFrame, resolution: str) -> DataFrame:
    """(place, label, file) of the track files (file) of known LTR lineages at a resolution such as 100k."""
    name = F.element_at(F.split("file", "/"), -1)
    end = f"_{resolution}.bw"
    label = F.regexp_extract(name, rf"([^.]*)_{resolution}\.bw$", 1)
    known = F.array(*[F.lit(x) for x in LINEAGE_TRACKS])
    rows = files.filter(name.contains("LTR.Ty") & name.endswith(end)).withColumn("label", label).withColumn("_p", F.array_position(known, label)).filter("_p > 0")
    return rows.select(F.row_number().over(W.orderBy("_p", "file")).alias("place"), "label", "file")


def cluster_tracks(files: DataFrame, resolution: str, monomers: DataFrame, most: int = 20) -> DataFrame:
    """(place, label, file) of the first ``most`` clusters' track files, by number; labels name the monomer (trc, monomer) where it is known."""
    end = f"_{resolution}.bw"
    name = F.element_at(F.split("file", "/"), -1)
    rows = files.filter(name.endswith(end)).withColumn("trc", F.regexp_replace(name, rf"_{resolution}\.bw$", ""))
    rows = rows.withColumn("_n", F.regexp_replace("trc", "TRC_", "").try_cast("double")).filter("_n IS NOT NULL").orderBy("_n", "file").limit(most)
    rows = rows.join(monomers.select("trc", "monomer"), "trc", "left")
    label = F.when(F.col("monomer").isNotNull(), F.concat("trc", F.lit(" ("), F.col("monomer").cast("string"), F.lit("bp)"))).otherwise(F.col("trc"))
    return rows.select(F.row_number().over(W.orderBy("_n", "file")).alias("place"), label.alias("label"), "file")


def collapsed_rdna(df: DataFrame) -> DataFrame:
    """Class totals (classification, n, bp) with rDNA subunits folded into their family."""
    label = F.col("classification")
    family = F.when(label.rlike("^rDNA/[^/]+/"), F.regexp_extract(label, "^(rDNA/[^/]+)", 1)).otherwise(label)
    return df.groupBy(family.alias("classification")).agg(F.count(F.lit(1)).alias("n"), F.sum(_width()).alias("bp"))


def buckets(df: DataFrame) -> DataFrame:
    """Level-1 rows once for each output bucket: that of their :func:`grouped_names`, and the roll-ups they belong to."""
    rows = grouped_names(df)
    group = F.col("group")
    structure = F.col("structure") == "LTR_RT_TR" if "structure" in df.columns else F.lit(False)
    rules = (
        ("Mobile_elements", group.startswith("Class")),
        ("Simple_repeats", group.startswith("Simple_repeat")),
        ("Low_complexity", group.startswith("Low_complexity")),
        ("rDNA", group.startswith("rDNA")),
        ("All_Ty1_Copia", group.contains("copia")),
        ("All_Ty3_Gypsy", group.contains("gypsy")),
        ("Class_II.Subclass_1.TIR", group.contains("Class_II/Subclass_1/TIR")),
        ("LTR_RT_TR", structure),
    )
    names = F.array(F.replace(group, F.lit("/"), F.lit(".")), *[F.when(test, F.lit(name)) for name, test in rules])
    return rows.withColumn("bucket", F.explode(F.array_distinct(F.filter(names, lambda n: n.isNotNull()))))


def benchmark_stats(df: DataFrame) -> DataFrame:
    """(rule, s, cpu_time, load, slowest) of rule timings and their sum as the rule ``total``; load is CPU over wall time."""
    top = df.agg(F.max("s").alias("_m"), F.sum("s").alias("_s"), F.sum("cpu_time").alias("_c"))
    load = F.when(F.col("s") > 0, F.round(F.col("cpu_time") / F.col("s"), 6))
    rows = df.crossJoin(F.broadcast(top)).select("rule", "s", "cpu_time", load.alias("load"), (F.col("s") == F.col("_m")).alias("slowest"))
    total = top.select(F.lit("total").alias("rule"), F.col("_s").alias("s"), F.col("_c").alias("cpu_time")).select("rule", "s", "cpu_time", load.alias("load"), F.lit(False).alias("slowest"))
    return rows.unionByName(total)
