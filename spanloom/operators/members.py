"""Joins between elements, their members, children, libraries and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanloom.functions import labels
from spanloom.functions import sequences as sq
from spanloom.operators import intervals as iv
from spanloom.operators.ordered import running
from spanloom.operators.sweep import contained


def member_split(elements: DataFrame, containers: DataFrame) -> DataFrame:
    """Elements with ``member``: whether any container lists their id in its comma-separated members."""
    listed = containers.select(F.explode(F.split("members", ",")).alias("_m")).distinct()
    joined = elements.join(listed, F.col("id").cast("string") == F.col("_m"), "left")
    return joined.withColumn("member", F.col("_m").isNotNull()).drop("_m")


OUTCOMES = ("has_child", "none", "several", "unparseable", "class_differs", "taken")


def exactly_one_match(
    parents: DataFrame, children: DataFrame, candidates: DataFrame, parent_source: str = "DANTE_TIR", candidate_source: str = "DANTE"
) -> DataFrame:
    """(fid, outcome, candidate): which parent takes a candidate that lies inside it on its strand.

    A parent takes one only when it has no child yet, exactly one candidate lies within, and the classes, each made
    canonical by the rules of its source, are equal. The outcome names what decided; ``unparseable`` is a class
    that is null or empty or that its source's rules can't read. A parent without a strand takes from both.
    """
    found = contained(parents, candidates).groupBy("fid").agg(F.sum("n").alias("_n"), F.min_by(F.struct(F.col("one").alias("fid_a"), F.col("class").alias("classification_a")), "one").alias("_one"))
    has = children.select(F.col("parent").alias("fid")).distinct().withColumn("_has", F.lit(True))
    rows = parents.join(found, "fid", "left").join(has, "fid", "left")
    own = labels.canonicalise(F.col("classification"), F.lit(parent_source))
    its = labels.canonicalise(F.col("_one.classification_a"), F.lit(candidate_source))
    outcome = (
        F.when(F.coalesce("_has", F.lit(False)), "has_child")
        .when(F.col("_n").isNull(), "none")
        .when(F.col("_n") > 1, "several")
        .when(own.isNull() | its.isNull(), "unparseable")
        .when(own == its, "taken")
        .otherwise("class_differs")
    )
    rows = rows.withColumn("outcome", outcome)
    return rows.select("fid", "outcome", F.when(F.col("outcome") == "taken", F.col("_one.fid_a")).alias("candidate"))


def outcome_counts(matches: DataFrame, name: str = "enrichment") -> tuple[DataFrame, Observation]:
    """``matches`` of :func:`exactly_one_match` and what counts them while they pass, without a job of its own.

    Counts: total, already (with a child), injected, zero (no candidate), anomalies (all else).
    """
    seen = Observation(name)
    is_ = lambda *names: F.count_if(F.col("outcome").isin(*names))
    counted = matches.observe(
        seen, F.count(F.lit(1)).alias("total"), is_("has_child").alias("already"), is_("taken").alias("injected"), is_("none").alias("zero"),
        is_("several", "unparseable", "class_differs").alias("anomalies"),
    )
    return counted, seen


def injected_children(matches: DataFrame, parents: DataFrame, candidates: DataFrame, note: str = "DANTE_TIR_enriched", attrs: str = "attrs") -> DataFrame:
    """The candidates that were taken, as child rows: their own columns, with Parent and Source in their attributes.

    ``parents`` (fid, id) name the parents; a former Parent of the candidate gives way.
    """
    taken = matches.filter("outcome = 'taken'").select("fid", "candidate").join(parents.select("fid", F.col("id").cast("string").alias("_parent")), "fid")
    rows = candidates.join(taken.select(F.col("candidate").alias("fid"), "_parent"), "fid")
    kept = F.map_filter(F.coalesce(F.col(attrs), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))), lambda k, v: ~k.isin("Parent", "Source"))
    added = F.create_map(F.lit("Parent"), F.col("_parent"), F.lit("Source"), F.lit(note))
    return rows.withColumn(attrs, F.map_concat(kept, added)).drop("_parent")


def merge_fallback(primary: DataFrame, fallback: DataFrame, children: DataFrame, source: str) -> DataFrame:
    """Primary rows with the fallback elements that overlap none of them, and those elements' children.

    Rows are (id, seqid, start_pos, end_pos, source, parent, group_id, status). A child belongs to an element by its
    id, parent or group id. What is added takes ``source``, and the status partial where it has none.
    """
    spare = iv.overlap_anti(fallback, primary, "id")
    names = spare.select(F.col("id").alias("_of")).union(spare.select("group_id")).filter("_of IS NOT NULL").distinct()
    keyed = children.withColumn("_key", F.explode(F.array_distinct(F.array_compact(F.array("id", "parent", "group_id")))))
    own = keyed.join(names, keyed["_key"] == names["_of"], "left_semi").drop("_key").distinct()
    added = spare.unionByName(own).withColumn("source", F.lit(source)).withColumn("status", F.coalesce("status", F.lit("partial")))
    return primary.unionByName(added.select(*primary.columns))


def _conflicts(hits: DataFrame) -> DataFrame:
    return hits.filter(~labels.is_compatible(F.col("qclass"), F.col("sclass")))


def class_conflicts(representatives: DataFrame, hits: DataFrame) -> DataFrame:
    """(qid, dropped) of every representative: it goes when any hit's class is not compatible with its own."""
    bad = _conflicts(hits).select("qid").distinct().withColumn("_bad", F.lit(True))
    return representatives.join(bad, "qid", "left").select("qid", F.coalesce("_bad", F.lit(False)).alias("dropped"))


def conflict_audit(representatives: DataFrame, hits: DataFrame) -> DataFrame:
    """(qid, status, sid, sclass): one row for a kept representative, one for each subject that makes one go."""
    bad = _conflicts(hits).select("qid", "sid", "sclass").distinct()
    rows = representatives.join(bad, "qid", "left")
    return rows.select("qid", F.when(F.col("sid").isNull(), "kept").otherwise("dropped").alias("status"), "sid", "sclass")


def by_multiplicity(elements: DataFrame, counts: DataFrame, least: int) -> DataFrame:
    """Elements whose multiplicity, 1 where it is missing or no number, reaches ``least``."""
    n = F.coalesce(F.col("multiplicity").cast("string").try_cast("long"), F.lit(1))
    return elements.join(counts.filter(n >= least).select("id"), "id", "left_semi")


def selected(rows: DataFrame, ids: DataFrame, attrs: str = "attrs") -> DataFrame:
    """Feature rows whose ID, else Parent, else Group_ID is wanted; rows without any of them pass."""
    key = F.coalesce(*[F.try_element_at(attrs, F.lit(k)) for k in ("ID", "Parent", "Group_ID")])
    rows = rows.withColumn("_key", key)
    wanted = ids.select(F.col(ids.columns[0]).cast("string").alias("_key")).distinct()
    return rows.filter("_key IS NULL").unionByName(rows.join(wanted, "_key", "left_semi").select(*rows.columns)).drop("_key")


def cleaned(df: DataFrame) -> DataFrame:
    """Named hits made disjoint: (id, seqid, start_pos, end_pos, strand, classification, names).

    Rows of one name that touch are joined first (strands apart). Each segment lists its names in the order of
    the joined rows (by seqid and name, then place) and takes the positional ancestor of them, found once for each
    distinct list; strands are listed likewise, and the id is the class and the seqid.
    """
    named = iv.reduce_intervals(df, ("seqid", "strand", "classification"))
    named = named.withColumn("k", F.struct("classification", "start_pos", "end_pos", "strand"))
    parts = iv.disjoin(named, "k").select("seqid", "start_pos", "end_pos", "members")
    names = F.array_distinct(F.transform("members", lambda m: m["classification"]))
    strands = F.array_distinct(F.transform("members", lambda m: m["strand"]))
    rows = parts.select("seqid", "start_pos", "end_pos", names.alias("_names"), F.array_join(strands, "|").alias("strand"))
    combos = rows.select("_names").distinct().withColumn("classification", labels.lca_positional(F.col("_names")))
    rows = rows.join(combos, "_names")
    return rows.select(F.concat_ws("_", "classification", "seqid").alias("id"), "seqid", "start_pos", "end_pos", "strand", "classification", F.array_join("_names", "|").alias("names"))


def satellite_names(df: DataFrame, known: DataFrame) -> DataFrame:
    """Clusters (trc, rdna_type, ...) with their class: by their own rDNA type, else the looked-up one, else Satellite/TideCluster/<cluster>."""
    rows = df.join(known.groupBy("trc").agg(F.min("class").alias("_c")), "trc", "left")
    own = F.when(F.col("rdna_type") == "45S", "rDNA/45S_rDNA").when(F.col("rdna_type") == "5S", "rDNA/5S_rDNA")
    return rows.withColumn("classification", F.coalesce(own, "_c", F.concat(F.lit("Satellite/TideCluster/"), "trc"))).drop("_c")


def looked_up(df: DataFrame, table: DataFrame, key: str, value: str, default: Column) -> DataFrame:
    """``df`` with ``value`` of the lookup table (key, value), or the default; of repeated keys the smallest value counts."""
    found = table.groupBy(key).agg(F.min(value).alias("_v"))
    return df.join(found, key, "left").withColumn(value, F.coalesce("_v", default)).drop("_v")


def dimer_of(elements: DataFrame, dimers: DataFrame) -> DataFrame:
    """Elements (id, strand, ...) with the sequence stored under their id, which is marked on the minus strand."""
    key = F.when(F.col("strand") == "-", F.concat("id", F.lit("_revcomp"))).otherwise(F.col("id"))
    return elements.withColumn("_key", key).join(dimers.select(F.col("name").alias("_key"), "seq"), "_key", "left").drop("_key")


def dimer_monomers(dimers: DataFrame) -> DataFrame:
    """(trc, monomer) from a library (name, seq) of doubled monomers: half of a cluster's longest dimer."""
    length = F.length(F.regexp_replace("seq", r"\s", ""))
    return dimers.groupBy(sq.header_name(F.col("name")).alias("trc")).agg((F.max(length) / 2.0).alias("monomer"))


def joined_libraries(main: DataFrame, short: DataFrame, old: str = "TRC_", new: str = "TRC_S_", columns: tuple[str, ...] = ("header",)) -> DataFrame:
    """Records or features of two cluster runs; the short run's clusters are renamed, so that no name is used twice."""
    renamed = short.withColumns({c: F.replace(F.col(c), F.lit(old), F.lit(new)) for c in columns})
    return main.unionByName(renamed)


def without_hits(library: DataFrame, hits: DataFrame, key: str, query: str = "qid") -> DataFrame:
    """Library records without any hit."""
    return library.join(hits.select(F.col(query).alias(key)).distinct(), key, "left_anti")


def all_pairs(ends: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs (qid, sid, query, ref) of the ends (keys, id, seq) of one class, each pair once, smaller id first."""
    a = ends.select(*keys, F.col("id").alias("qid"), F.col("seq").alias("query"))
    b = ends.select(*keys, F.col("id").alias("sid"), F.col("seq").alias("ref"))
    return a.join(b, keys).filter("qid < sid")


def candidate_pairs(ends: DataFrame, keys: list[str], candidates: DataFrame, most: int = 100) -> DataFrame:
    """As :func:`all_pairs` for classes of fewer than ``most`` ends; of larger ones only the pairs of ``candidates`` (qid, sid), in either order."""
    sizes = ends.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    sized = ends.join(sizes, keys)
    few = all_pairs(sized.filter(F.col("_n") < most).drop("_n"), keys)
    large = sized.filter(F.col("_n") >= most)
    wanted = candidates.select(F.least("qid", "sid").alias("qid"), F.greatest("qid", "sid").alias("sid")).filter("qid < sid").distinct()
    a = large.select(*keys, F.col("id").alias("qid"), F.col("seq").alias("query"))
    b = large.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("id").alias("sid"), F.col("seq").alias("ref"))
    pairs = wanted.join(a, "qid").join(b, "sid")
    for k in keys:
        pairs = pairs.filter(F.col(k).eqNullSafe(F.col(f"_{k}")))
    return few.unionByName(pairs.select(*few.columns))


def canonical_headers(df: DataFrame, source: str | None = None, header: str = "header", vocab: labels.Vocabulary = labels.STANDARD) -> DataFrame:
    """Headers ``name#class rest`` with the class made canonical; others stay. ``rewritten`` says which changed."""
    form = r"^([^#\s]+)#(\S+)(.*)$"
    old = F.regexp_extract(header, form, 2)
    new = labels.canonicalise(old, F.lit(source) if source else None, vocab)
    whole = F.concat(F.regexp_extract(header, form, 1), F.lit("#"), new, F.regexp_extract(header, form, 3))
    rows = df.withColumn("rewritten", F.col(header).rlike(form) & (new != old))
    return rows.withColumn(header, F.when(F.col("rewritten"), whole).otherwise(F.col(header)))


def canonical_attribute(df: DataFrame, name: str, source: str | None = None, attrs: str = "attrs", vocab: labels.Vocabulary = labels.STANDARD) -> DataFrame:
    """Feature rows with one attribute made canonical where they have it; ``rewritten`` says which changed."""
    old = F.try_element_at(attrs, F.lit(name))
    new = labels.canonicalise(old, F.lit(source) if source else None, vocab)
    swapped = F.transform_values(attrs, lambda k, v: F.when(k == name, new).otherwise(v))
    rows = df.withColumn("rewritten", F.coalesce(new != old, F.lit(False)))
    return rows.withColumn(attrs, F.when(F.col("rewritten"), swapped).otherwise(F.col(attrs)))


def attribute_values(df: DataFrame, name: str, attrs: str = "attrs") -> DataFrame:
    """(value) of one attribute of the rows that have it."""
    return df.select(F.try_element_at(attrs, F.lit(name)).alias("value")).filter("value IS NOT NULL")


def header_classes(df: DataFrame, header: str = "header") -> DataFrame:
    """(value): the class of every header that has one."""
    return df.select(F.regexp_extract(header, r"^[^#\s]+#(\S+)", 1).alias("value")).filter("value <> ''")


def clean_names(df: DataFrame, attrs: str = "attrs") -> DataFrame:
    """Rows whose Name attribute is their class, made canonical."""
    label = labels.canonicalise(F.try_element_at(attrs, F.lit("Final_Classification")))
    kept = F.map_filter(attrs, lambda k, v: k != "Name")
    return df.withColumn(attrs, F.when(label.isNotNull(), F.map_concat(kept, F.create_map(F.lit("Name"), label))).otherwise(F.col(attrs)))


def matching(library: DataFrame, pattern: str, header: str = "header") -> DataFrame:
    """Records whose header matches a regular expression."""
    return library.filter(F.col(header).rlike(pattern))


def second_subclass_library(elements: DataFrame, custom: DataFrame | None = None, pattern: str = "Class_II/Subclass_1") -> DataFrame:
    """Records (header, seq): those of a custom library whose header matches, then the found elements."""
    return elements if custom is None else matching(custom, pattern).unionByName(elements)


def representatives(library: DataFrame, wanted: DataFrame) -> DataFrame:
    """Records (name, seq) that are wanted (id, class), with the header ``id#class``."""
    rows = library.select(F.col("name").alias("id"), "seq").join(wanted.select("id", "class"), "id")
    return rows.select(F.concat_ws("#", "id", "class").alias("header"), "seq")


def reduced_library(contigs: DataFrame, singlets: DataFrame, reps: DataFrame) -> DataFrame:
    """The parts of a reduced library in order: (part, class, place, header, seq).

    Parts hold (class, idx, header, seq). Classes are numbered in alphabetical order over all parts; contigs become
    ``<header>_<number>#<class>``. Order: contigs, singlets, representatives; inside each by class, then idx.
    """
    parts = [t.select("class", "idx", "header", "seq", F.lit(i).alias("part")) for i, t in enumerate((contigs, singlets, reps))]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    classes = rows.select("class").distinct().withColumn("_number", F.row_number().over(W.orderBy("class")))  # one row a class
    rows = rows.join(classes, "class")
    header = F.when(F.col("part") == 0, F.concat(F.col("header"), F.lit("_"), F.col("_number").cast("string"), F.lit("#"), F.col("class"))).otherwise(F.col("header"))
    counts = rows.groupBy("part", "class").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("part", "class").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = running(rows.withColumn("header", header), ["part", "class"], "idx", ["idx", "header"], F.lit(1), "_place")
    rows = rows.join(counts.select("part", "class", before.alias("_before")), ["part", "class"])
    return rows.select("part", "class", (F.col("_before") + F.col("_place")).alias("place"), "header", "seq")


def strand_regions(df: DataFrame, sequences: DataFrame, key: str, size: int = 1 << 20) -> DataFrame:
    """Bases of regions in the direction of their strand: (key, name, bases); names of minus ones are marked."""
    rows = sq.subsequences(df, sequences, key, size)
    name, bases = sq.oriented(F.col(key).cast("string"), F.col("bases"), F.col("strand"))
    return rows.select(key, name.alias("name"), bases.alias("bases"))


def repeat_name(repeat: Column, kind: Column) -> Column:
    """Name of a repeat hit: its class, the motif added for simple repeats, the family's stem where unspecified."""
    return F.when(kind == "Simple_repeat", F.concat(kind, F.lit("/"), repeat)).when(kind == "Unspecified", F.regexp_replace(repeat, "__.+", "")).otherwise(kind)


def other_separator(label: Column, old: str, new: str) -> Column:
    """Swap separators; the new one's former occurrences become '_' first."""
    return F.replace(F.replace(label, F.lit(new), F.lit("_")), F.lit(old), F.lit(new))
