"""Registered queries of the annotation operators, each with its SQL oracle where SQL expresses it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.functions import labels as lb
from spanloom.functions import sequences as sq
from spanloom.operators import hits as ht
from spanloom.operators import intervals as iv
from spanloom.operators import members as mb
from spanloom.operators import patterns as pt
from spanloom.operators import report as rp
from spanloom.operators import resolve as rs
from spanloom.operators import alignment as al
from spanloom.operators import seeds as sd
from spanloom.operators import simplify as si
from spanloom.operators import ordered as od
from spanloom.operators import scratch
from spanloom.operators import tracks as tr
from spanloom.operators.sweep import depths
from spanloom.plans import statements as st
from spanloom.plans.fixtures import view, with_views
from spanloom.plans.statements import islands
from spanloom.sources import bigwig, ranges, sinks, tabular
from spanloom.sources import tiers as tl
from spanloom.sources.writer import write_buckets

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, *views: str) -> Callable[[Query], Query]:
    """Register a query under its function's name, with SQL over the named views."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            head, rest = (with_views(*views) if views else ""), sql.strip()
            # A statement that begins with WITH goes on in the list of views.
            if rest.startswith("WITH RECURSIVE ") and head:
                head, rest = head.replace("WITH ", "WITH RECURSIVE ", 1), rest.replace("RECURSIVE ", "", 1)
            ORACLES[f.__name__] = f"{head.rstrip()},\n{rest.removeprefix('WITH ')}" if head and rest.startswith("WITH ") else head + rest
        return f

    return register


FEATURES = "(SELECT *, start_pos AS s, end_pos AS e FROM fx_features)"
SMALL = "(SELECT *, start_pos AS s, end_pos AS e FROM fx_small)"


# Interval algebra


@query(f"SELECT seqid, s AS start_pos, e AS end_pos FROM {islands(FEATURES)}", "fx_features")
def reduce(spark, sf):
    return iv.reduce_intervals(view(spark, sf, "fx_features"))


@query(f"SELECT seqid, classification, s AS start_pos, e AS end_pos FROM {islands(FEATURES, 'seqid, classification')}", "fx_features")
def reduce_by_name(spark, sf):
    return iv.reduce_intervals(view(spark, sf, "fx_features"), ("seqid", "classification"))


@query(f"SELECT seqid, s - 1 AS start0, e AS end0 FROM {islands(FEATURES)}", "fx_features")
def bed_merge(spark, sf):
    return iv.merged_bed(view(spark, sf, "fx_features"))


@query(f"""SELECT seqid, CAST(sum(e - s + 1) AS BIGINT) AS bp, round(sum(e - s + 1) / max(length), 9) AS fraction
    FROM {islands(FEATURES)} JOIN fx_seqs USING (seqid) GROUP BY seqid""", "fx_features", "fx_seqs")
def coverage_frac(spark, sf):
    bp = iv.covered_bp(view(spark, sf, "fx_features"))
    return bp.join(view(spark, sf, "fx_seqs"), "seqid").select("seqid", "bp", F.round(F.col("bp") / F.col("length"), 9).alias("fraction"))


@query(f"SELECT CAST(sum(e - s + 1) AS BIGINT) AS bp FROM {islands(FEATURES)}", "fx_features")
def union_bp(spark, sf):
    return iv.covered_bp(view(spark, sf, "fx_features")).agg(F.sum("bp").alias("bp"))


def _halves(spark, sf):
    small = view(spark, sf, "fx_small")
    return small.filter("source_tier <= 2"), small.filter("source_tier > 2")


PAIRS = """FROM fx_small a JOIN fx_small b ON a.seqid = b.seqid AND a.source_tier <= 2 AND b.source_tier > 2
    AND a.start_pos <= b.end_pos AND b.start_pos <= a.end_pos"""


@query(f"SELECT a.fid AS fid_a, b.fid AS fid_b, least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos) + 1 AS overlap_bp {PAIRS}", "fx_small")
def ovl_join(spark, sf):
    return iv.overlap_join(*_halves(spark, sf)).select("fid_a", "fid_b", "overlap_bp")


@query(f"SELECT DISTINCT a.fid, a.seqid, a.start_pos {PAIRS}", "fx_small")
def ovl_semi(spark, sf):
    a, b = _halves(spark, sf)
    return iv.overlap_semi(a, b, "fid").select("fid", "seqid", "start_pos")


@query(f"SELECT fid, seqid, start_pos FROM fx_small WHERE source_tier <= 2 AND fid NOT IN (SELECT a.fid {PAIRS})", "fx_small")
def ovl_anti(spark, sf):
    a, b = _halves(spark, sf)
    return iv.overlap_anti(a, b, "fid").select("fid", "seqid", "start_pos")


@query("""SELECT a.fid AS fid_a, b.fid AS fid_b FROM fx_small a JOIN fx_small b ON a.seqid = b.seqid AND a.source_tier <= 2
    AND b.source_tier > 2 AND a.start_pos >= b.start_pos AND a.end_pos <= b.end_pos""", "fx_small")
def within_join(spark, sf):
    return iv.overlap_join(*_halves(spark, sf), within=True).select("fid_a", "fid_b")


@query("""SELECT a.fid AS fid_a, b.fid AS fid_b, a.classification AS class_a, b.classification AS class_b,
    least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos) + 1 AS overlap_bp
    FROM fx_small a JOIN fx_small b ON a.seqid = b.seqid AND a.fid < b.fid AND a.start_pos <= b.end_pos AND b.start_pos <= a.end_pos
    WHERE a.classification NOT IN ('Simple_repeat', 'Low_complexity') AND b.classification NOT IN ('Simple_repeat', 'Low_complexity')""", "fx_small")
def self_ovl(spark, sf):
    rows = view(spark, sf, "fx_small").filter("classification NOT IN ('Simple_repeat', 'Low_complexity')")
    return iv.self_overlaps(rows, "fid").select("fid_a", "fid_b", F.col("classification_a").alias("class_a"), F.col("classification_b").alias("class_b"), "overlap_bp")


@query(f"""SELECT child, parent, overlap_bp FROM (SELECT a.fid AS child, b.fid AS parent,
    least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos) + 1 AS overlap_bp,
    row_number() OVER (PARTITION BY a.fid ORDER BY least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos) DESC, b.fid) AS r {PAIRS}) WHERE r = 1""", "fx_small")
def best_parent(spark, sf):
    a, b = _halves(spark, sf)
    return iv.best_parent(a, b, "fid", "fid")


_segments_sql = st.segments


@query(f"""SELECT g.seqid, g.s AS start_pos, g.e AS end_pos, string_agg(CAST(f.fid AS VARCHAR), ',' ORDER BY f.fid) AS members, count(*) AS depth
    FROM {_segments_sql('fx_small')} g JOIN fx_small f ON f.seqid = g.seqid AND f.start_pos <= g.s AND f.end_pos >= g.e
    WHERE g.e IS NOT NULL GROUP BY ALL""", "fx_small")
def disjoin_revmap(spark, sf):
    rows = iv.disjoin(view(spark, sf, "fx_small"), "fid")
    return rows.withColumn("members", F.array_join(F.col("members").cast("array<string>"), ","))


@query(f"""SELECT g.seqid, g.s AS start_pos, g.e AS end_pos, count(*) AS depth
    FROM {_segments_sql('fx_small')} g JOIN fx_small f ON f.seqid = g.seqid AND f.start_pos <= g.s AND f.end_pos >= g.e
    WHERE g.e IS NOT NULL GROUP BY ALL""", "fx_small")
def segment_depth(spark, sf):
    return depths(view(spark, sf, "fx_small"))


@query(f"""WITH low AS (SELECT * FROM fx_small WHERE source_tier > 2), high AS (SELECT * FROM fx_small WHERE source_tier <= 2),
    hit AS (SELECT DISTINCT l.fid, l.seqid FROM low l JOIN high h ON h.seqid = l.seqid AND h.start_pos <= l.end_pos AND l.start_pos <= h.end_pos),
    cover AS (SELECT seqid, s AS start_pos, e AS end_pos FROM {islands("(SELECT *, start_pos AS s, end_pos AS e FROM high)")}),
    every AS (SELECT seqid, start_pos, end_pos FROM low UNION ALL SELECT * FROM cover),
    seg AS (SELECT * FROM {_segments_sql('every')} WHERE e IS NOT NULL),
    piece AS (SELECT g.seqid, g.s, g.e, min(l.fid) AS fid FROM seg g JOIN low l ON l.seqid = g.seqid AND l.start_pos <= g.s AND l.end_pos >= g.e
        WHERE NOT EXISTS (SELECT 1 FROM cover c WHERE c.seqid = g.seqid AND c.start_pos <= g.s AND c.end_pos >= g.e) GROUP BY ALL)
    SELECT p.fid, p.seqid, p.s AS start_pos, p.e AS end_pos, l.classification FROM piece p JOIN low l USING (fid)
    WHERE p.fid NOT IN (SELECT fid FROM hit) OR p.e - p.s + 1 >= 50""", "fx_small")
def trim(spark, sf):
    high, low = _halves(spark, sf)
    return iv.trim(low, high, "fid").select("fid", "seqid", "start_pos", "end_pos", "classification")


@query(f"""WITH low AS (SELECT * FROM fx_small WHERE source_tier > 2), high AS (SELECT * FROM fx_small WHERE source_tier <= 2),
    cover AS (SELECT seqid, s AS start_pos, e AS end_pos FROM {islands("(SELECT *, start_pos AS s, end_pos AS e FROM high)")}),
    cut AS (SELECT l.fid, l.seqid, l.start_pos AS ls, l.end_pos AS le, c.start_pos AS cs, c.end_pos AS ce FROM low l LEFT JOIN cover c
        ON c.seqid = l.seqid AND c.start_pos <= l.end_pos AND l.start_pos <= c.end_pos),
    piece AS (SELECT fid, seqid, ls AS s, coalesce(cs - 1, le) AS e FROM (SELECT *, row_number() OVER (PARTITION BY fid ORDER BY cs) AS r FROM cut) WHERE r = 1
        UNION ALL SELECT fid, seqid, ce + 1, coalesce(lead(cs) OVER (PARTITION BY fid ORDER BY cs) - 1, le) FROM cut WHERE cs IS NOT NULL)
    SELECT fid, seqid, s AS start_pos, e AS end_pos FROM piece WHERE s <= e""", "fx_small")
def subtract(spark, sf):
    high, low = _halves(spark, sf)
    return iv.subtract(low, high, "fid").select("fid", "seqid", "start_pos", "end_pos")


@query("""WITH l AS (SELECT sid, max(slen) AS length FROM fx_hits GROUP BY sid),
    h AS (SELECT sid, greatest(sstart, 1) AS s, least(send, length) AS e, length FROM fx_hits JOIN l USING (sid)),
    d AS (SELECT sid, p, sum(d) AS d FROM (SELECT sid, s AS p, 1 AS d FROM h WHERE s <= e UNION ALL SELECT sid, e + 1, -1 FROM h WHERE s <= e UNION ALL SELECT sid, 1, 0 FROM l UNION ALL SELECT sid, length + 1, 0 FROM l) GROUP BY ALL),
    r AS (SELECT sid, p AS s, lead(p) OVER (PARTITION BY sid ORDER BY p) - 1 AS e, sum(d) OVER (PARTITION BY sid ORDER BY p) AS depth FROM d),
    f AS (SELECT *, CASE WHEN lag(depth) OVER (PARTITION BY sid ORDER BY s) = depth THEN 0 ELSE 1 END AS n FROM r WHERE e IS NOT NULL),
    g AS (SELECT *, sum(n) OVER (PARTITION BY sid ORDER BY s ROWS UNBOUNDED PRECEDING) AS k FROM f)
    SELECT sid, min(s) AS start_pos, max(e) AS end_pos, CAST(min(depth) AS BIGINT) AS depth FROM g GROUP BY sid, k""", "fx_hits")
def pos_coverage(spark, sf):
    hits = view(spark, sf, "fx_hits")
    return ht.hit_depth(hits, hits.groupBy("sid").agg(F.max("slen").alias("length")))


# Labels


@query("SELECT DISTINCT final_classification AS raw, replace(replace(replace(final_classification, 'Ty1/copia', 'Ty1_copia'), 'Ty3/gypsy', 'Ty3_gypsy'), '|', '/') AS canonical FROM fx_ltr", "fx_ltr")
def canon_dante(spark, sf):
    return view(spark, sf, "fx_ltr").select(F.col("final_classification").alias("raw")).distinct().withColumn("canonical", lb.canon_piped(F.col("raw")))


_FLAT = "replace(cls, '/', '_')"


_NAMED = "(SELECT c_custkey AS id, cls, concat(replace(cls, '/', '_'), CASE WHEN c_custkey % 3 = 0 THEN concat('_f', CAST(c_custkey AS STRING)) ELSE '' END) AS raw FROM customer JOIN fx_class ON k = CAST(c_custkey % 12 AS INT))"


def _over(spark, sf, sql: str, *tables: str, views: str = "fx_class"):
    """SQL for both engines over given tables and the class list."""
    for t in tables:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
    return spark.sql(with_views(views) + sql, **{t: spark.read.parquet(f"{sf}/{t}.parquet") for t in tables})


@query(f"""SELECT id, raw, CASE WHEN raw LIKE 'Class\\_II\\_Subclass\\_1\\_TIR\\_%' ESCAPE '\\' THEN 'Class_II/Subclass_1/TIR/' || substr(raw, 25) ELSE raw END AS canonical FROM {_NAMED}""", "fx_class")
def canon_tir(spark, sf):
    return _over(spark, sf, f"SELECT id, raw FROM {_NAMED} n", "customer").withColumn("canonical", lb.canon_underscored(F.col("raw")))


_DIALECTS = """(SELECT c_custkey AS id, cls, CASE c_custkey % 6 WHEN 0 THEN replace(cls, '/', '|') WHEN 1 THEN replace(cls, '/', '_') WHEN 2 THEN concat('  ', cls, ' (', CAST(c_custkey % 90 AS STRING), '.5%25)') WHEN 3 THEN ' ' WHEN 4 THEN concat(cls, '/none') ELSE cls END AS raw,
    CASE c_custkey % 7 WHEN 0 THEN 'DANTE' WHEN 1 THEN 'DANTE_TIR' WHEN 2 THEN 'RepeatMasker' WHEN 3 THEN 'other' END AS source FROM customer JOIN fx_class ON k = CAST(c_custkey % 12 AS INT))"""
_CLEAN = "trim(regexp_replace(trim(raw), ' *\\([0-9.]+%25\\)$', ''))"
_PIPED = f"replace(replace({_CLEAN}, '|', '/'), 'none', 'none')"
_FLATTED = f"CASE WHEN starts_with({_CLEAN}, 'Class_II_Subclass_1_TIR_') THEN 'Class_II/Subclass_1/TIR/' || substr({_CLEAN}, 25) ELSE {_CLEAN} END"
_AUTO = f"CASE WHEN contains({_CLEAN}, '|') THEN {_PIPED} WHEN starts_with({_CLEAN}, 'Class_II_Subclass_1_') THEN {_FLATTED} ELSE {_CLEAN} END"
_CANON = f"CASE WHEN {_CLEAN} = '' THEN NULL WHEN source IS NULL THEN {_AUTO} WHEN source = 'DANTE' THEN {_PIPED} WHEN source = 'DANTE_TIR' THEN {_FLATTED} WHEN source = 'RepeatMasker' THEN {_CLEAN} END"


def _dialects(spark, sf):
    from spanloom.plans.fixtures import with_views as head

    return spark.sql(head("fx_class") + f"SELECT * FROM {_DIALECTS.replace('FROM customer', 'FROM {customer}')} d", customer=spark.read.parquet(f"{sf}/customer.parquet"))


@query(f"""WITH d AS (SELECT *, {_CANON} AS canonical FROM {_DIALECTS})
    SELECT id, raw, source, canonical, CASE WHEN trim(raw) = '' THEN 'empty' WHEN source = 'other' THEN 'unknown source' WHEN canonical IN {tuple(lb.STANDARD.paths + lb.SPECIAL + lb.BUCKETS)} OR canonical LIKE 'Satellite/_%' THEN NULL ELSE 'not canonical' END AS reason FROM d""", "fx_class")
def canon_any(spark, sf):
    raw, source = F.col("raw"), F.col("source")
    return _dialects(spark, sf).select("id", "raw", "source", lb.canonicalise(raw, source).alias("canonical"), lb.failure(raw, source).alias("reason"))


_LABELLED = """(SELECT o_orderkey AS id, CASE CAST(o_orderkey % 5 AS INT) WHEN 0 THEN cls WHEN 1 THEN concat(cls, '/none') WHEN 2 THEN concat('Satellite/', o_orderpriority) WHEN 3 THEN 'Satellite/' ELSE o_orderstatus END AS raw, cls
    FROM orders JOIN fx_class ON k = CAST(o_custkey % 12 AS INT))"""


@query(f"SELECT id, raw, CASE id % 5 WHEN 0 THEN true WHEN 1 THEN starts_with(cls, 'Satellite/') WHEN 2 THEN true ELSE false END AS canonical FROM {_LABELLED}", "fx_class")
def is_canonical(spark, sf):
    return _over(spark, sf, f"SELECT id, raw FROM {_LABELLED} l", "orders").withColumn("canonical", lb.is_canonical(F.col("raw")))


@query("SELECT raw, n, 'not canonical' AS reason FROM (SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'odd_' || o_orderpriority ELSE 'Unknown' END AS raw, count(*) AS n FROM orders GROUP BY ALL) WHERE raw <> 'Unknown'")
def validate_values(spark, sf):
    raw = F.when(F.col("o_orderkey") % 10 == 0, F.concat(F.lit("odd_"), "o_orderpriority")).otherwise("Unknown")
    rows = spark.read.parquet(f"{sf}/orders.parquet").groupBy(raw.alias("raw")).agg(F.count(F.lit(1)).alias("n"))
    return rows.withColumn("reason", lb.failure(F.col("raw"))).filter("reason IS NOT NULL")


_ITEM_CLASSES = """(SELECT l_orderkey, l_linenumber, a.cls AS a, b.cls AS b FROM lineitem JOIN fx_class a ON a.k = CAST((l_orderkey + l_linenumber % 3) % 12 AS INT)
    JOIN fx_class b ON b.k = CAST((l_orderkey + l_linenumber % 3 + l_partkey % 4) % 12 AS INT))"""


def _item_classes(spark, sf):
    return _over(spark, sf, f"SELECT * FROM {_ITEM_CLASSES} i", "lineitem")


@query(f"SELECT l_orderkey AS id, {st.common_class('a')} AS lca FROM {_ITEM_CLASSES} GROUP BY l_orderkey", "fx_class")
def lca_prefix(spark, sf):
    return _item_classes(spark, sf).groupBy(F.col("l_orderkey").alias("id")).agg(lb.lca_prefix(F.collect_list("a")).alias("lca"))


@query(f"""WITH p AS (SELECT l_orderkey, l_linenumber, a, b, string_split(a, '/') AS x, string_split(b, '/') AS y FROM {_ITEM_CLASSES}),
    q AS (SELECT *, coalesce(list_max(list_filter(range(1, len(x) + 1), lambda i: i <= len(y) AND x[i] = y[i])), 0) AS n FROM p)
    SELECT l_orderkey, l_linenumber, a, b, CASE WHEN n = 0 THEN 'Unknown' ELSE array_to_string(x[1:n], '/') END AS lca FROM q""", "fx_class")
def lca_positional(spark, sf):
    return _item_classes(spark, sf).withColumn("lca", lb.lca_positional(F.array("a", "b")))


@query(f"SELECT *, a = b OR starts_with(a, b || '/') OR starts_with(b, a || '/') AS compatible FROM {_ITEM_CLASSES}", "fx_class")
def is_compatible(spark, sf):
    return _item_classes(spark, sf).withColumn("compatible", lb.is_compatible(F.col("a"), F.col("b")))


@query("""SELECT CASE WHEN regexp_matches(classification, '^(Satellite|Simple_repeat|Low_complexity|rDNA|Unknown)') THEN 'repeat_region' ELSE 'transposable_element' END AS type,
    count(*) AS n FROM fx_features GROUP BY ALL""", "fx_features")
def feature_type(spark, sf):
    return view(spark, sf, "fx_features").groupBy(lb.feature_type(F.col("classification")).alias("type")).agg(F.count(F.lit(1)).alias("n"))


_CATEGORY = "CASE " + " ".join(f"WHEN regexp_matches(classification, '{p}') THEN '{c}'" for p, c in lb.CATEGORIES) + " ELSE 'Other repeats' END"


@query(f"SELECT classification, {_CATEGORY} AS category, count(*) AS n FROM fx_features GROUP BY ALL", "fx_features")
def repeat_category(spark, sf):
    return view(spark, sf, "fx_features").groupBy("classification").agg(F.count(F.lit(1)).alias("n")).withColumn("category", lb.repeat_category(F.col("classification")))


@query("SELECT fid, name FROM fx_domains WHERE identity >= 0.35 AND similarity >= 0.45 AND relat_interruptions <= 3 AND relat_length BETWEEN 0.8 AND 1.2", "fx_domains")
def domain_quality(spark, sf):
    good = lb.good_domain(*[F.col(c) for c in ("identity", "similarity", "relat_length", "relat_interruptions")])
    return view(spark, sf, "fx_domains").filter(good).select("fid", "name")


@query("SELECT fid, round(coalesce(similarity, 0) * coalesce(relat_length, 0), 9) AS score FROM fx_domains WHERE name = 'TPase'", "fx_domains")
def anchor_score(spark, sf):
    score = lb.anchor_score(F.col("similarity"), F.col("relat_length"))
    return view(spark, sf, "fx_domains").filter("name = 'TPase'").select("fid", F.round(score, 9).alias("score"))


@query("""SELECT subtype || '_' || idx || '_partial' AS group_id, fid FROM (SELECT fid, regexp_replace(regexp_replace(o, '[^A-Za-z0-9_.-]+', '_', 'g'), '^_+|_+$', '', 'g') AS subtype,
    row_number() OVER (PARTITION BY o ORDER BY s, o_orderkey) AS idx FROM (SELECT o_orderkey AS fid, o_orderkey, o_orderpriority AS o, o_orderkey % 1000 AS s FROM orders))""")
def sanitize_label(spark, sf):
    rows = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderpriority", "o_orderkey", (F.col("o_orderkey") % 1000).alias("at"))
    rows = od.placed_within(spark, rows, ["o_orderpriority"], ["at", "o_orderkey"])
    return rows.select(lb.group_id(F.col("o_orderpriority"), F.col("place")).alias("group_id"), F.col("o_orderkey").alias("fid"))

    rows = spark.read.parquet(f"{sf}/orders.parquet")
    idx = F.row_number().over(W.partitionBy("o_orderpriority").orderBy(F.col("o_orderkey") % 1000, "o_orderkey"))
    return rows.select(F.concat_ws("_", lb.sanitised(F.col("o_orderpriority")), idx.cast("string"), F.lit("partial")).alias("group_id"), F.col("o_orderkey").alias("fid"))


# Patterns


@query("""SELECT a.fid, (SELECT max(b.end_pos) FROM fx_domains b WHERE b.seqid = a.seqid AND b.end_pos < a.start_pos) AS left_end,
    (SELECT min(b.start_pos) FROM fx_domains b WHERE b.seqid = a.seqid AND b.start_pos > a.end_pos) AS right_start FROM fx_domains a""", "fx_domains")
def asof_neighbours(spark, sf):
    return pt.neighbours(view(spark, sf, "fx_domains")).select("fid", "left_end", "right_start")


@query("""WITH n AS (SELECT a.*, length, (SELECT max(b.end_pos) FROM fx_domains b WHERE b.seqid = a.seqid AND b.end_pos < a.start_pos) AS l,
    (SELECT min(b.start_pos) FROM fx_domains b WHERE b.seqid = a.seqid AND b.start_pos > a.end_pos) AS r FROM fx_domains a JOIN fx_seqs USING (seqid)),
    x AS (SELECT fid, seqid, CASE strand WHEN '-' THEN '3prime' ELSE '5prime' END AS prime, greatest(start_pos - 3000, coalesce(l + 1, 1), 1) AS start_pos, start_pos - 1 AS end_pos FROM n
    UNION ALL SELECT fid, seqid, CASE strand WHEN '-' THEN '5prime' ELSE '3prime' END, end_pos + 1, least(end_pos + 3000, coalesce(r - 1, length), length) FROM n)
    SELECT * FROM x WHERE end_pos > start_pos""", "fx_domains", "fx_seqs")
def flank_clip(spark, sf):
    return pt.flanks(view(spark, sf, "fx_domains"), view(spark, sf, "fx_seqs"), 3000)


@query("""WITH n AS (SELECT a.*, length, (SELECT max(b.end_pos) FROM fx_domains b WHERE b.seqid = a.seqid AND b.end_pos < a.start_pos) AS l,
    (SELECT min(b.start_pos) FROM fx_domains b WHERE b.seqid = a.seqid AND b.start_pos > a.end_pos) AS r, (SELECT max(b.end_pos) FROM fx_small b WHERE b.seqid = a.seqid AND b.end_pos < a.start_pos) AS ml,
    (SELECT min(b.start_pos) FROM fx_small b WHERE b.seqid = a.seqid AND b.start_pos > a.end_pos) AS mr FROM fx_domains a JOIN fx_seqs USING (seqid)),
    x AS (SELECT fid, seqid, CASE strand WHEN '-' THEN '3prime' ELSE '5prime' END AS prime, greatest(start_pos - 3000, coalesce(l + 1, 1), coalesce(ml + 1, 1), 1) AS start_pos, start_pos - 1 AS end_pos FROM n
    UNION ALL SELECT fid, seqid, CASE strand WHEN '-' THEN '5prime' ELSE '3prime' END, end_pos + 1, least(end_pos + 3000, coalesce(r - 1, length), coalesce(mr - 1, length), length) FROM n)
    SELECT * FROM x WHERE end_pos > start_pos""", "fx_domains", "fx_seqs", "fx_small")
def flank_clip_masked(spark, sf):
    return pt.flanks(view(spark, sf, "fx_domains"), view(spark, sf, "fx_seqs"), 3000, view(spark, sf, "fx_small"))


@query("""SELECT fid, seqid, greatest(1, start_pos - CASE strand WHEN '-' THEN 70 ELSE 40 END) AS start_pos,
    least(length, end_pos + CASE strand WHEN '-' THEN 40 ELSE 70 END) AS end_pos FROM fx_domains JOIN fx_seqs USING (seqid)""", "fx_domains", "fx_seqs")
def extend_elements(spark, sf):
    return pt.extended(view(spark, sf, "fx_domains"), F.lit(40), F.lit(70), view(spark, sf, "fx_seqs")).select("fid", "seqid", "start_pos", "end_pos")


@query("""WITH p AS (SELECT parent AS id, min({'s': start_pos, 'e': end_pos}) AS f, max({'s': start_pos, 'e': end_pos}) AS l FROM fx_ltr_parts GROUP BY parent),
    o AS (SELECT *, lag(l) OVER w AS pl, lag(strand) OVER w AS ps, lag(final_classification) OVER w AS pc FROM fx_ltr_elements LEFT JOIN p USING (id) WHERE NOT starts_with(id, 'TE_partial') WINDOW w AS (PARTITION BY seqid ORDER BY start_pos, end_pos, id)),
    f AS (SELECT *, CASE WHEN ps = strand AND pc = final_classification AND greatest(0, least(pl.e, f.e) - greatest(pl.s, f.s) + 1) / least(pl.e - pl.s + 1, f.e - f.s + 1) >= 0.5 THEN 0 ELSE 1 END AS n FROM o),
    g AS (SELECT *, sum(n) OVER (PARTITION BY seqid ORDER BY start_pos, end_pos, id ROWS UNBOUNDED PRECEDING) AS c FROM f)
    SELECT seqid, min(start_pos) AS start_pos, max(end_pos) AS end_pos, min(strand) AS strand, min(final_classification) AS final_classification, count(*) AS copy_number,
        string_agg(id, ',' ORDER BY start_pos, end_pos, id) AS members FROM g GROUP BY seqid, c HAVING count(*) >= 2""", "fx_ltr_elements", "fx_ltr_parts")
def ltr_tandems(spark, sf):
    return pt.ltr_tandems(view(spark, sf, "fx_ltr_elements"), view(spark, sf, "fx_ltr_parts"))


@query("""WITH o AS (SELECT *, lead(name) OVER w AS n1, lead(name, 2) OVER w AS n2, lead(start_pos) OVER w AS s1, lead(start_pos, 2) OVER w AS s2, lead(end_pos) OVER w AS e1, lead(end_pos, 2) OVER w AS e2
        FROM fx_domains WINDOW w AS (PARTITION BY seqid, strand ORDER BY start_pos, end_pos, fid)),
    t AS (SELECT *, coalesce(s1 - end_pos <= 2000 AND s2 - e1 <= 2000 AND CASE strand WHEN '+' THEN name = 'ENDO' AND n1 = 'RT' AND n2 = 'RH' ELSE name = 'RH' AND n1 = 'RT' AND n2 = 'ENDO' END, false) AS t3,
        coalesce(s1 - end_pos <= 2000 AND CASE strand WHEN '+' THEN name = 'ENDO' AND n1 = 'RT' ELSE name = 'RT' AND n1 = 'ENDO' END, false) AS t2 FROM o),
    u AS (SELECT *, coalesce(lag(t3) OVER (PARTITION BY seqid, strand ORDER BY start_pos, end_pos, fid), false) AS inside FROM t)
    SELECT fid, seqid, strand, start_pos, CASE WHEN t3 THEN e2 ELSE e1 END AS end_pos, CASE WHEN t3 THEN 'ENDO-RT-RH' ELSE 'ENDO-RT' END AS pattern_type FROM u WHERE t3 OR t2 AND NOT inside""", "fx_domains")
def line_patterns(spark, sf):
    return pt.line_patterns(view(spark, sf, "fx_domains"))


_SF_RUNS = islands("(SELECT seqid, strand, sf, s0 + 1 AS s, e0 AS e FROM h)", "seqid, strand, sf")
_SF_PADDED = islands("(SELECT r.seqid, r.strand, r.sf, greatest(0, s - 1 - pad) + 1 AS s, e + pad AS e FROM (SELECT *, CAST(floor(least(2 * coalesce(monomer, 30), (e - s + 1) * 0.1)) AS BIGINT) AS pad FROM r LEFT JOIN m USING (sf)) r)", "seqid, strand, sf")


@query(f"""WITH h AS (SELECT f.*, coalesce(x.sf, f.trc) AS sf FROM fx_sfhits f LEFT JOIN fx_superfamilies x USING (trc)),
    m AS (SELECT coalesce(x.sf, o.trc) AS sf, min(monomer) AS monomer FROM fx_monomers o LEFT JOIN fx_superfamilies x USING (trc) GROUP BY 1),
    r AS (SELECT * FROM {_SF_RUNS}), a AS (SELECT * FROM {_SF_PADDED} LEFT JOIN m USING (sf) WHERE e - s + 1 >= 2 * coalesce(monomer, 30)),
    g AS (SELECT r.* FROM r SEMI JOIN a ON a.seqid = r.seqid AND a.strand = r.strand AND a.sf = r.sf AND a.s <= r.e AND r.s <= a.e),
    b AS (SELECT g.seqid, g.strand, g.sf, g.s, g.e, h.trc, sum(h.e0 - h.s0) AS bp, min({{'s': h.s0, 'e': h.e0}}) AS f FROM g JOIN h ON h.seqid = g.seqid AND h.strand = g.strand AND h.sf = g.sf AND h.s0 + 1 >= g.s AND h.e0 <= g.e GROUP BY ALL)
    SELECT seqid, s - 1 AS s0, e AS e0, strand, arg_min(trc, {{'b': -bp, 'f': f, 't': trc}}) AS trc FROM b GROUP BY seqid, strand, sf, s, e""", "fx_sfhits", "fx_superfamilies", "fx_monomers")
def sf_array_filter(spark, sf):
    return pt.superfamily_arrays(*(view(spark, sf, v) for v in ("fx_sfhits", "fx_monomers", "fx_superfamilies")))


@query("""WITH d AS (SELECT seqid, count(*) AS n, bool_and(coalesce(final_classification = 'Class_I|LINE', false)) AS line, string_agg(name || strand, ' ' ORDER BY start_pos, name, strand) AS o
        FROM (SELECT concat('s', CAST(event_id // 3 AS VARCHAR)) AS seqid, (event_id * 37) % 1000 AS start_pos, CASE WHEN user_id % 5 < 4 THEN '+' ELSE '-' END AS strand,
            CASE event_type WHEN 'click' THEN 'ENDO' WHEN 'view' THEN 'RT' ELSE 'RH' END AS name, CASE WHEN user_id % 29 = 0 THEN 'Class_I|LTR' ELSE 'Class_I|LINE' END AS final_classification, event_id FROM events) WHERE NOT (event_id % 3 = 2 AND event_id % 2 = 0) GROUP BY seqid)
    SELECT seqid FROM d WHERE line AND o IN ('ENDO+ RT+', 'RT- ENDO-', 'ENDO+ RT+ RH+', 'RH- RT- ENDO-')""")
def line_valid(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").filter("NOT (event_id % 3 = 2 AND event_id % 2 = 0)")
    name = F.expr("CASE event_type WHEN 'click' THEN 'ENDO' WHEN 'view' THEN 'RT' ELSE 'RH' END")
    rows = e.select(
        F.concat(F.lit("s"), F.expr("event_id div 3").cast("string")).alias("seqid"), (F.col("event_id") * 37 % 1000).alias("start_pos"),
        F.expr("CASE WHEN user_id % 5 < 4 THEN '+' ELSE '-' END").alias("strand"), name.alias("name"),
        F.expr("CASE WHEN user_id % 29 = 0 THEN 'Class_I|LTR' ELSE 'Class_I|LINE' END").alias("final_classification"),
    )
    return pt.valid_lines(rows)


# Hits and clusters


@query(f"""WITH long AS (SELECT qid, qstart AS s, qend AS e FROM fx_hits WHERE aln_len >= 50),
    m AS (SELECT qid, sum(e - s + 1) AS c FROM {islands('long', 'qid')} GROUP BY qid), q AS (SELECT qid, max(qlen) AS qlen FROM fx_hits GROUP BY qid)
    SELECT q.qid, CAST(coalesce(c, 0) AS BIGINT) AS covered, qlen, round(coalesce(c, 0) / qlen, 9) AS coverage, coalesce(c, 0) / qlen > 0.98 AS dropped FROM q LEFT JOIN m USING (qid)""", "fx_hits")
def query_cov(spark, sf):
    rows = ht.query_coverage(view(spark, sf, "fx_hits").withColumn("qid", F.col("qid").cast("string")))
    return rows.withColumn("qid", F.col("qid").cast("long"))


def _classed(spark, sf):
    return view(spark, sf, "fx_hits").withColumn("qclass", F.col("qlen") % 300).withColumn("sclass", F.col("slen") % 300)


_CONTAINERS = f"""good AS (SELECT qid, sid, qstart AS s, qend AS e, qlen FROM fx_hits WHERE pident >= 80 AND slen > qlen AND qlen % 300 = slen % 300),
    m AS (SELECT qid, sid, sum(e - s + 1) AS bp FROM {islands('good', 'qid, sid')} GROUP BY ALL),
    edge AS (SELECT m.qid, m.sid FROM m JOIN (SELECT qid, max(qlen) AS qlen FROM good GROUP BY qid) USING (qid) WHERE bp / qlen >= 0.9)"""


@query(f"WITH {_CONTAINERS} SELECT qid, sid FROM edge", "fx_hits")
def containment(spark, sf):
    return ht.containers(_classed(spark, sf))


@query(f"WITH RECURSIVE {_CONTAINERS}, {st.greedy('k', 'SELECT qid AS id FROM fx_hits UNION SELECT sid FROM fx_hits', 'SELECT qid, sid FROM edge')} SELECT n.id, n.id IN (SELECT id FROM k) AS kept FROM k_node n", "fx_hits")
def containment_greedy(spark, sf):
    hits = view(spark, sf, "fx_hits")
    ids = hits.select(F.col("qid").alias("id")).union(hits.select("sid")).distinct()
    return ht.containment_reduced(spark, ids, ht.containers(_classed(spark, sf)))


@query("""WITH b AS (SELECT qid AS id, qlen AS len FROM fx_hits UNION ALL SELECT sid, slen FROM fx_hits),
    r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY len DESC) AS r FROM b), c AS (SELECT id, len FROM r WHERE r = 3)
    SELECT c.id, c.len AS selected_length, (SELECT count(*) FROM b WHERE b.id = c.id AND b.len <= c.len) - 1 AS num_shorter FROM c""", "fx_hits")
def nth_largest(spark, sf):
    hits = view(spark, sf, "fx_hits").withColumn("qspan", F.col("qlen")).withColumn("sspan", F.col("slen"))
    return ht.nth_largest(hits, 3)


@query("SELECT rep, count(*) AS members FROM fx_clusters GROUP BY rep HAVING count(*) >= 5", "fx_clusters")
def cluster_sizes(spark, sf):
    return ht.cluster_sizes(view(spark, sf, "fx_clusters"), 5)


@query("SELECT DISTINCT doc_id, header FROM fx_sequences WHERE doc_id NOT IN (SELECT qid FROM fx_hits WHERE pident > 95)", "fx_sequences", "fx_hits")
def anti_hit_filter(spark, sf):
    return mb.without_hits(view(spark, sf, "fx_sequences").select("doc_id", "header"), view(spark, sf, "fx_hits").filter("pident > 95"), "doc_id")


_DIMERS = """z AS (SELECT cluster, min(length // 2) < 12 AS short FROM fx_members GROUP BY cluster), m AS (SELECT * FROM fx_members JOIN z USING (cluster)),
    p AS (SELECT DISTINCT h.qid, h.sid, b.length AS lb FROM fx_hits h JOIN m a ON a.id = h.qid JOIN m b ON b.id = h.sid WHERE a.cluster = b.cluster AND NOT a.short AND h.qid <> h.sid AND pident >= 80 AND qcov >= 0.8
        AND least(a.length, b.length) >= 0.95 * greatest(a.length, b.length) AND (b.length > a.length OR b.length = a.length AND h.sid < h.qid))"""


@query(f"""WITH RECURSIVE {_DIMERS}, {st.greedy('k', 'SELECT id FROM fx_members', 'SELECT qid, sid FROM p')},
    l AS (SELECT qid, arg_min(sid, {{'l': -lb, 's': sid}}) AS rep FROM p WHERE sid IN (SELECT id FROM k) GROUP BY qid)
    SELECT cluster, id, id IN (SELECT id FROM k) AS kept, CASE WHEN id IN (SELECT id FROM k) THEN id ELSE rep END AS representative FROM fx_members LEFT JOIN l ON l.qid = id""", "fx_members", "fx_hits")
def dimer_setcover(spark, sf):
    return ht.star_cover(spark, view(spark, sf, "fx_members"), view(spark, sf, "fx_hits"))


_RIVALS = """SELECT a.fid AS qid, b.fid AS sid FROM fx_small a JOIN fx_small b ON a.seqid = b.seqid AND a.start_pos <= b.end_pos AND b.start_pos <= a.end_pos
    AND {'s': -(b.fid % 100), 'w': -(b.end_pos - b.start_pos), 'i': b.fid} < {'s': -(a.fid % 100), 'w': -(a.end_pos - a.start_pos), 'i': a.fid}"""


@query(f"WITH RECURSIVE {st.greedy('k', 'SELECT fid AS id FROM fx_small', _RIVALS)} SELECT seqid, start_pos, end_pos, fid AS id, CAST(fid % 100 AS DOUBLE) AS score FROM fx_small WHERE fid IN (SELECT id FROM k)", "fx_small")
def cross_subtype(spark, sf):
    small = view(spark, sf, "fx_small")
    return ht.best_scoring(spark, small.select("seqid", "start_pos", "end_pos", F.col("fid").alias("id"), (F.col("fid") % 100).cast("double").alias("score")))


# Tracks and reports

STEP = 10_000


def _density_sql(step: int) -> str:
    return f"""bins AS (SELECT seqid, length, b FROM (SELECT seqid, length, unnest(range(CAST(floor((length - 1) / {step}) AS BIGINT) + 1)) AS b FROM fx_seqs)),
    isl AS (SELECT * FROM {islands(FEATURES)}),
    cut AS (SELECT seqid, b, sum(least(e, (b + 1) * {step}) - greatest(s, b * {step} + 1) + 1) AS bp FROM (
        SELECT *, unnest(range(CAST(floor((s - 1) / {step}) AS BIGINT), CAST(floor((e - 1) / {step}) AS BIGINT) + 1)) AS b FROM isl) GROUP BY ALL),
    dens AS (SELECT seqid, b * {step} + 1 AS start_pos, least((b + 1) * {step}, length) AS end_pos,
        round(coalesce(bp, 0) / (least((b + 1) * {step}, length) - b * {step}), 9) AS score FROM bins LEFT JOIN cut USING (seqid, b))"""


def _track(spark, sf):
    return tr.density(view(spark, sf, "fx_features"), view(spark, sf, "fx_seqs"), STEP)


@query(f"WITH {_density_sql(STEP)} SELECT * FROM dens", "fx_features", "fx_seqs")
def density(spark, sf):
    return _track(spark, sf)


@query(f"""WITH {_density_sql(STEP)} SELECT seqid, start_pos, end_pos, round(sum(score) OVER (PARTITION BY seqid ORDER BY start_pos ROWS BETWEEN 4 PRECEDING AND 5 FOLLOWING) / 10, 6) AS score FROM dens""", "fx_features", "fx_seqs")
def smooth10(spark, sf):
    return tr.smoothed(_track(spark, sf)).withColumn("score", F.round("score", 6))


@query(f"""WITH {_density_sql(STEP)}, r AS (SELECT *, row_number() OVER w AS p, count(*) OVER (PARTITION BY seqid) AS c, sum(score) OVER (PARTITION BY seqid ORDER BY start_pos ROWS BETWEEN 4 PRECEDING AND 5 FOLLOWING) / 10 AS m FROM dens WINDOW w AS (PARTITION BY seqid ORDER BY start_pos))
    SELECT seqid, start_pos, end_pos, CASE WHEN c < 10 THEN score WHEN p BETWEEN 10 AND c - 9 THEN round(m, 6) END AS score FROM r""", "fx_features", "fx_seqs")
def smooth_na(spark, sf):
    return tr.smoothed_inside(_track(spark, sf)).withColumn("score", F.round("score", 6))


@query(f"""WITH {_density_sql(200)}, c AS (SELECT seqid, start_pos, end_pos, round(score, 1) AS score FROM dens),
    f AS (SELECT *, CASE WHEN lag(score) OVER (PARTITION BY seqid ORDER BY start_pos) = score THEN 0 ELSE 1 END AS n FROM c),
    g AS (SELECT *, sum(n) OVER (PARTITION BY seqid ORDER BY start_pos ROWS UNBOUNDED PRECEDING) AS r FROM f)
    SELECT seqid, min(start_pos) AS start_pos, max(end_pos) AS end_pos, min(score) AS score FROM g GROUP BY seqid, r""", "fx_features", "fx_seqs")
def rle_merge(spark, sf):
    fine = tr.density(view(spark, sf, "fx_features"), view(spark, sf, "fx_seqs"), 200)
    return tr.run_lengths(fine.withColumn("score", F.round("score", 1)))


@query(f"""WITH {_density_sql(STEP)} SELECT seqid, CAST(floor((start_pos - 1) / 100000) AS BIGINT) AS bin, round(greatest(0, sum(score * (end_pos - start_pos + 1)) / sum(end_pos - start_pos + 1)), 6) AS score FROM dens GROUP BY ALL""", "fx_features", "fx_seqs")
def rebin(spark, sf):
    return tr.rebinned(_track(spark, sf), view(spark, sf, "fx_seqs"), 100_000)


_SCAFFOLDS = "(SELECT CAST(o_orderkey AS STRING) AS seqid, 1000 + o_custkey % 500 AS length FROM orders)"
_BEFORE = "coalesce(sum(length) OVER (ORDER BY length DESC, seqid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"


def _scaffolds(spark, sf):
    return _over(spark, sf, f"SELECT * FROM {_SCAFFOLDS} s", "orders")


@query(f'SELECT seqid, length, CAST({_BEFORE} AS BIGINT) AS "offset", round(({_BEFORE} + length / 2) / 1e6, 3) AS mid_mb FROM {_SCAFFOLDS}')
def concat_axis(spark, sf):
    return tr.axis(spark, _scaffolds(spark, sf))


_GROUPED = """(SELECT *, CASE WHEN regexp_matches(nm, '^(TRC_|Satellite)') THEN 'Tandem_repeats' WHEN contains(nm, 'Simple_repeat') THEN 'Simple_repeat' ELSE nm END AS grp FROM (
    SELECT *, CASE WHEN classification LIKE 'rDNA%' THEN classification ELSE name END AS nm FROM fx_unified WHERE id IS NULL OR starts_with(id, 'UA_L1_')))"""


@query(f"SELECT grp AS name, CAST(sum(end_pos - start_pos + 1) AS BIGINT) AS total_bp, round(sum(end_pos - start_pos + 1) * 100.0 / (SELECT sum(length) FROM fx_seqs), 9) AS percent FROM {_GROUPED} GROUP BY ALL", "fx_unified", "fx_seqs")
def summary_stats(spark, sf):
    return rp.summary_stats(view(spark, sf, "fx_unified"), view(spark, sf, "fx_seqs"))


_CATS = [c for _, c in lb.CATEGORIES] + ["Other repeats"]


@query(f"""WITH f AS (SELECT seqid, start_pos AS s, end_pos AS e, {_CATEGORY} AS category FROM fx_features)
    SELECT seqid, {', '.join(f"CAST(coalesce(sum(e - s + 1) FILTER (category = '{c}'), 0) AS BIGINT) AS {rp.labels_key(c)}" for c in _CATS)} FROM {islands('f', 'seqid, category')} GROUP BY seqid""", "fx_features")
def seq_category_bp(spark, sf):
    return rp.category_bp(view(spark, sf, "fx_features"))


@query("""WITH c AS (SELECT classification, string_split(classification, '/') AS p, count(*) AS n, sum(end_pos - start_pos + 1) AS bp FROM fx_features GROUP BY ALL),
    x AS (SELECT classification, n, bp, array_to_string(p[1:i], '/') AS node FROM (SELECT *, unnest(range(1, len(p) + 1)) AS i FROM c))
    SELECT node, CAST(len(string_split(node, '/')) AS INT) AS level, CAST(sum(CASE WHEN node = classification THEN n ELSE 0 END) AS BIGINT) AS own_n,
    CAST(sum(CASE WHEN node = classification THEN bp ELSE 0 END) AS BIGINT) AS own_bp, CAST(sum(n) AS BIGINT) AS total_n, CAST(sum(bp) AS BIGINT) AS total_bp,
    bool_and(node = classification) AS leaf FROM x GROUP BY node""", "fx_features")
def class_rollup(spark, sf):
    return rp.class_rollup(view(spark, sf, "fx_features"))


@query(f"""WITH l AS (SELECT 'chr' || k AS seqid, 3000000 - k * 100000 AS length FROM (SELECT unnest(range(1, 9)) AS k)),
    n AS (SELECT seqid, length, CASE WHEN length >= 2750000 THEN seqid ELSE 'Other' END AS seq FROM l), z AS (SELECT seq, sum(length) AS len FROM n GROUP BY seq),
    f AS (SELECT seqid, start_pos AS s, end_pos AS e, {_CATEGORY} AS category FROM fx_features), b AS (SELECT seq, category, sum(e - s + 1) AS bp FROM {islands('f', 'seqid, category')} JOIN n USING (seqid) GROUP BY ALL),
    r AS (SELECT seq, category, bp / len AS fraction FROM b JOIN z USING (seq)), p AS (SELECT seq, row_number() OVER (ORDER BY seq = 'Other', coalesce(t, 0) DESC, seq) AS place FROM z LEFT JOIN (SELECT seq, sum(fraction) AS t FROM r GROUP BY seq) USING (seq))
    SELECT CAST(place AS INT) AS place, seq, category, round(fraction, 9) AS fraction FROM r JOIN p USING (seq)""", "fx_features")
def composition_bar(spark, sf):
    lengths = spark.range(1, 9).select(F.concat(F.lit("chr"), F.col("id").cast("string")).alias("seqid"), (3_000_000 - F.col("id") * 100_000).alias("length"))
    return rp.composition(view(spark, sf, "fx_features"), lengths, 2_750_000)


def _sizes(spark, sf):
    return rp.grouped_names(view(spark, sf, "fx_tiers")).groupBy(F.col("group").alias("type")).agg(F.sum(F.col("end_pos") - F.col("start_pos") + 1).alias("bp"))


_SIZES = "c AS (SELECT CASE WHEN regexp_matches(nm, '^(TRC_|Satellite)') THEN 'Tandem_repeats' WHEN contains(nm, 'Simple_repeat') THEN 'Simple_repeat' ELSE nm END AS type, sum(end_pos - start_pos + 1) AS bp FROM (SELECT *, CASE WHEN classification LIKE 'rDNA%' THEN classification ELSE name END AS nm FROM fx_tiers) GROUP BY ALL)"


@query(f"""WITH {_SIZES}, x AS (SELECT array_to_string(p[1:i], '/') AS path, type, bp FROM (SELECT *, unnest(range(1, len(p) + 1)) AS i FROM (SELECT *, string_split(type, '/') AS p FROM c))),
    n AS (SELECT path, sum(bp) AS total, sum(CASE WHEN path = type THEN bp ELSE 0 END) AS own, bool_or(path <> type) AS inner_ FROM x GROUP BY path),
    k AS (SELECT *, len(string_split(path, '/')) - 1 AS d, CASE WHEN contains(path, '/') THEN 0 ELSE coalesce(nullif(list_position({list(rp.TOP_ORDER)}, path), 0), 10) END AS o FROM n),
    t AS (SELECT b.path, list({{'o': a.o, 's': -a.total, 'p': a.path}} ORDER BY a.d) AS trail FROM k b JOIN k a ON b.path = a.path OR starts_with(b.path, a.path || '/') GROUP BY b.path),
    r AS (SELECT path, 'total' AS row_type, 0 AS w, d AS depth, total AS bp FROM k WHERE inner_ UNION ALL SELECT path, 'unspecified', 1, d + 1, own FROM k WHERE inner_ AND own > 0 UNION ALL SELECT path, 'leaf', 0, d, own FROM k WHERE NOT inner_)
    SELECT CAST(row_number() OVER (ORDER BY trail, w) AS INT) AS place, path, string_split(path, '/')[-1] AS label, row_type, CAST(depth AS INT) AS depth, CAST(bp AS BIGINT) AS bp, round(bp / 15003000 * 100, 9) AS percent,
        CASE WHEN row_type = 'leaf' THEN CASE path WHEN 'Class_I/LINE' THEN 777 ELSE e.n END END AS elements, CASE WHEN row_type = 'leaf' THEN m.n END AS tandem_members FROM r JOIN t USING (path)
        LEFT JOIN (SELECT classification AS path, count(*) AS n FROM fx_tiers WHERE source_tier = 1 GROUP BY classification) e USING (path)
        LEFT JOIN (SELECT classification AS path, CAST(sum(CAST(copy_number AS BIGINT)) AS BIGINT) AS n FROM fx_tiers WHERE structure = 'LTR_RT_TR' GROUP BY classification) m USING (path)""", "fx_tiers")
def class_rows(spark, sf):
    counts = view(spark, sf, "fx_tiers").filter("source_tier = 1").groupBy(F.col("classification").alias("path")).agg(F.count(F.lit(1)).alias("count"))
    tandem = view(spark, sf, "fx_tiers").filter("structure = 'LTR_RT_TR'").select(F.col("classification").alias("path"), F.col("copy_number").cast("long").alias("count"))
    return rp.class_table(_sizes(spark, sf), 15_003_000, counts, tandem, 777)


@query("""WITH b AS (SELECT seqid, trc, CAST(sum(e0 - s0) AS DOUBLE) AS bp FROM fx_trc GROUP BY ALL), l AS (SELECT seqid, max(e0) + 1000 AS length FROM fx_trc GROUP BY seqid),
    p AS (SELECT seqid, length, row_number() OVER (ORDER BY sum(bp) / length DESC, seqid) AS place FROM b JOIN l USING (seqid) GROUP BY seqid, length)
    SELECT CAST(place AS INT) AS place, seqid, printf('%s (%.1f Mb)', seqid, length / 1e6) AS label, trc, round(coalesce(bp, 0) / length, 9) AS fraction FROM p CROSS JOIN (SELECT DISTINCT trc FROM b) t LEFT JOIN b USING (seqid, trc)""", "fx_trc")
def satellite_bars(spark, sf):
    rows = view(spark, sf, "fx_trc")
    lengths = rows.groupBy("seqid").agg((F.max("e0") + 1000).alias("length"))
    return rp.satellite_bars(rows.select("seqid", "trc", (F.col("e0") - F.col("s0")).cast("double").alias("bp")), lengths)


@query("SELECT split_part(header, '#', 1) AS trc, max(length(regexp_replace(seq, '\\s', '', 'g'))) / 2.0 AS monomer FROM (SELECT 'TRC_' || (doc_id % 20) || '#' || doc_id AS header, seq FROM fx_sequences) GROUP BY ALL", "fx_sequences")
def dimer_monomers(spark, sf):
    name = F.concat(F.lit("TRC_"), (F.col("doc_id") % 20).cast("string"), F.lit("#"), F.col("doc_id").cast("string"))
    return mb.dimer_monomers(view(spark, sf, "fx_sequences").select(name.alias("name"), "seq"))


@query(f"""WITH {_SIZES}, n AS (SELECT DISTINCT array_to_string(p[1:i], '/') AS id FROM (SELECT *, unnest(range(1, len(p) + 1)) AS i FROM (SELECT *, string_split(type, '/') AS p FROM c))),
    r AS (SELECT id, string_split(id, '/')[-1] AS label, CASE WHEN contains(id, '/') THEN regexp_replace(id, '/[^/]+$', '') ELSE 'Repeats' END AS parent, coalesce(bp, 0) AS value FROM n LEFT JOIN c ON c.type = n.id
        UNION ALL SELECT 'Repeats', 'Repeats', '', 0 UNION ALL SELECT 'Non-repetitive', 'Non-repetitive', '', greatest(0, 15003000 - (SELECT sum(bp) FROM c)))
    SELECT id, label, parent, CAST(value AS BIGINT) AS value, round(value / 15003000 * 100, 9) AS percent FROM r""", "fx_tiers")
def sunburst(spark, sf):
    return rp.sunburst(_sizes(spark, sf), 15_003_000)


@query(f"""WITH {_density_sql(STEP)} SELECT seqid AS series, '{{"start_pos":[' || string_agg(CAST(start_pos AS VARCHAR), ',' ORDER BY start_pos) || '],"level":[' || string_agg(CAST(CAST(round(score * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY start_pos) || ']}}' AS spec FROM dens GROUP BY seqid""", "fx_features", "fx_seqs")
def density_chart(spark, sf):
    track = _track(spark, sf).withColumn("level", F.round(F.col("score") * 100).cast("long"))
    return rp.chart_series(track, "seqid", ["start_pos"], ["start_pos", "level"])


_FILES = "(SELECT 'd/' || CASE c_custkey % 3 WHEN 0 THEN 'Class_I.LTR.Ty1_copia.' || ['Ale','SIRE','Tork','odd'][c_custkey % 4 + 1] WHEN 1 THEN 'TRC_' || (c_custkey % 40) ELSE 'TRC_S_' || c_custkey END || CASE WHEN c_custkey % 5 = 0 THEN '_10k.bw' ELSE '_100k.bw' END AS file FROM customer)"


def _files(spark, sf):
    key = F.col("c_custkey")
    lineage = F.element_at(F.array(*map(F.lit, ("Ale", "SIRE", "Tork", "odd"))), (key % 4 + 1).cast("int"))
    name = F.when(key % 3 == 0, F.concat(F.lit("Class_I.LTR.Ty1_copia."), lineage)).when(key % 3 == 1, F.concat(F.lit("TRC_"), (key % 40).cast("string"))).otherwise(F.concat(F.lit("TRC_S_"), key.cast("string")))
    return spark.read.parquet(f"{sf}/customer.parquet").select(F.concat(F.lit("d/"), name, F.when(key % 5 == 0, "_10k.bw").otherwise("_100k.bw")).alias("file")).distinct()


@query(f"""SELECT CAST(row_number() OVER (ORDER BY list_position({list(rp.LINEAGE_TRACKS)}, label), file) AS INT) AS place, label, file FROM (SELECT DISTINCT file, regexp_extract(file, '([^.]*)_100k[.]bw$', 1) AS label FROM {_FILES} WHERE contains(file, 'LTR.Ty') AND ends_with(file, '_100k.bw')) WHERE label IN {rp.LINEAGE_TRACKS}""")
def track_discovery(spark, sf):
    return rp.lineage_tracks(_files(spark, sf), "100k")


@query(f"""WITH f AS (SELECT *, regexp_replace(split_part(file, '/', 2), '_100k[.]bw$', '') AS trc FROM (SELECT DISTINCT file FROM {_FILES}) WHERE ends_with(file, '_100k.bw')),
    n AS (SELECT *, TRY_CAST(replace(trc, 'TRC_', '') AS DOUBLE) AS k FROM f), t AS (SELECT * FROM n WHERE k IS NOT NULL ORDER BY k, file LIMIT 20)
    SELECT CAST(row_number() OVER (ORDER BY k, file) AS INT) AS place, CASE WHEN k < 10 THEN trc || ' (' || CAST(CAST(k * 7 AS BIGINT) AS VARCHAR) || 'bp)' ELSE trc END AS label, file FROM t""")
def cluster_track_discovery(spark, sf):
    monomers = spark.range(10).select(F.concat(F.lit("TRC_"), F.col("id").cast("string")).alias("trc"), (F.col("id") * 7).alias("monomer"))
    return rp.cluster_tracks(_files(spark, sf), "100k", monomers)


@query("SELECT source_tool, classification, count(*) AS n, CAST(sum(end_pos - start_pos + 1) AS BIGINT) AS bp FROM fx_features GROUP BY ALL", "fx_features")
def tool_stats(spark, sf):
    return rp.tool_stats(view(spark, sf, "fx_features"))


@query("""SELECT trc, size AS monomer FROM (SELECT trc, size, row_number() OVER (PARTITION BY trc ORDER BY count(*) DESC, size) AS r FROM (SELECT trc, e0 - s0 AS size FROM fx_trc) GROUP BY trc, size) WHERE r = 1""", "fx_trc")
def monomer_mode(spark, sf):
    return rp.modal_monomer(view(spark, sf, "fx_trc").select("trc", (F.col("e0") - F.col("s0")).alias("size")))


@query("""WITH r AS (SELECT trc, seqid, CAST(sum((fid % 4) / 4 * (e0 - s0)) AS DOUBLE) AS bp FROM fx_trc GROUP BY ALL),
    t AS (SELECT trc, sum(bp) AS t FROM r GROUP BY trc ORDER BY t DESC, trc LIMIT 4)
    SELECT trc, seqid, round(bp, 3) AS bp, round(bp / t, 9) AS share FROM r JOIN t USING (trc)""", "fx_trc")
def sat_coverage(spark, sf):
    track = view(spark, sf, "fx_trc").select("trc", "seqid", (F.col("s0") + 1).alias("start_pos"), F.col("e0").alias("end_pos"), (F.col("fid") % 4 / 4).alias("score"))
    return rp.satellite_coverage(track, 4)


@query(f"""WITH {_SIZES} SELECT 15.003 AS genome_mb, 5 AS sequences, round(sum(bp) / 15003000 * 100, 9) AS repeats_percent, {', '.join(f"round(coalesce(sum(bp) FILTER (type = '{p}' OR starts_with(type, '{p}/')), 0) / 15003000 * 100, 9) AS {n}_percent" for n, p in (("ltr", "Class_I/LTR"), ("class_ii", "Class_II"), ("line", "Class_I/LINE"), ("tandem", "Tandem_repeats")))} FROM c""", "fx_tiers")
def report_cards(spark, sf):
    return rp.report_cards(_sizes(spark, sf), view(spark, sf, "fx_seqs"))


# Sequences


@query("SELECT doc_id, header, split_part(header, '#', 1) AS name, split_part(header, '#', 2) AS class, length(seq) AS length FROM fx_sequences", "fx_sequences")
def lib_parsers(spark, sf):
    h = F.col("header")
    return view(spark, sf, "fx_sequences").select("doc_id", "header", sq.header_name(h).alias("name"), sq.header_class(h).alias("class"), F.length("seq").cast("long").alias("length"))


@query("SELECT doc_id, md5(reverse(translate(seq, 'ACGTacgt', 'TGCAtgca'))) AS digest FROM fx_sequences", "fx_sequences")
def revcomp(spark, sf):
    return view(spark, sf, "fx_sequences").select("doc_id", F.md5(sq.reverse_complement(F.col("seq")).cast("binary")).alias("digest"))


@query("SELECT doc_id, substring(seq, 1, 30) AS head, right(seq, 30) AS tail, length(substring(seq, 1, CAST(floor(length(seq) / 2) AS INT))) AS half FROM fx_sequences", "fx_sequences")
def end_region(spark, sf):
    s = F.col("seq")
    return view(spark, sf, "fx_sequences").select("doc_id", sq.end_region(s, "start").alias("head"), sq.end_region(s, "end").alias("tail"), F.length(sq.monomer(s)).cast("long").alias("half"))


_GAPPED = f"(SELECT CAST(doc_id AS STRING) AS name, concat(repeat('N', CAST(doc_id % 13 AS INT)), seq, repeat('N', CAST(doc_id % 25 AS INT)), seq, repeat('n', 4), repeat('N', CAST(doc_id % 200 AS INT)), 'AC', repeat('N', CAST(doc_id % 11 AS INT))) AS seq FROM (SELECT doc_id, regexp_replace(seq, '[^ACGTN]', ''GLOBAL) AS seq FROM fx_sequences) b)"  # one text for all runs, replaced everywhere


@query(f"""WITH g AS (SELECT name, string_split_regex(seq, '[Nn]+') AS gaps, regexp_extract_all(seq, '[Nn]+') AS runs FROM {_GAPPED.replace('GLOBAL', ", 'g'")}),
    r AS (SELECT name, i, len(gaps[i]) AS gap, len(runs[i]) AS run FROM (SELECT *, unnest(range(1, len(runs) + 1)) AS i FROM g)),
    p AS (SELECT name, run, sum(gap + run) OVER (PARTITION BY name ORDER BY i) - run AS s FROM r) SELECT name, CAST(s AS BIGINT) AS start0, CAST(s + run AS BIGINT) AS end0 FROM p WHERE run >= 10""", "fx_sequences")
def gaps_n10(spark, sf):
    rows = _bases(spark, sf).withColumn("doc_id", F.col("doc_id").cast("int"))
    n = lambda k: F.repeat(F.lit("N"), (F.col("doc_id") % k).cast("int"))
    rows = rows.select(F.col("doc_id").cast("string").alias("header"), F.concat(n(13), "seq", n(25), "seq", F.lit("nnnn"), n(200), F.lit("AC"), n(11)).alias("seq"))
    path = scratch.folder(spark, "gapped")
    sinks.write_fasta(rows, path, width=60)
    return sq.n_runs(tabular.read_sequence_parts(spark, f"{path}/part-*", 97))


_RECORDS = "(SELECT o_orderkey AS id, CASE WHEN o_orderkey % 97 = 0 THEN 3000 WHEN o_orderkey % 89 < 2 THEN 0 ELSE o_custkey % 700 END AS size FROM orders)"


@query(f"""WITH RECURSIVE r AS MATERIALIZED (SELECT *, row_number() OVER w AS at, sum(size) OVER w AS s, sum(size) OVER w - size AS bf FROM {_RECORDS} WINDOW w AS (ORDER BY id)),
    b AS (SELECT CAST(1 AS BIGINT) AS at, CAST(0 AS BIGINT) AS n UNION ALL SELECT min(CASE WHEN r.bf = x.bf THEN r.at + 1 ELSE r.at END), any_value(b.n) + 1 FROM b JOIN r x ON x.at = b.at JOIN r ON r.at >= x.at AND r.s > x.bf + 2500 GROUP BY b.at)
    SELECT id, size, max(n) AS bin FROM r JOIN b ON b.at <= r.at GROUP BY id, size""")
def bin_pack(spark, sf):
    rows = _over(spark, sf, f"SELECT * FROM {_RECORDS} r", "orders")
    return sq.packed_in_order(spark, rows, ["id"], "size", 2500)


@query("""WITH r AS (SELECT doc_id, seq, k, k * 97 % length(seq) + 1 AS s FROM fx_sequences, (SELECT unnest(range(4)) AS k))
    SELECT doc_id * 4 + k AS key, md5(substring(seq, s, 60 + k * 500)) AS digest, length(substring(seq, s, 60 + k * 500)) AS size FROM r""", "fx_sequences")
def subseq(spark, sf):
    seqs = view(spark, sf, "fx_sequences")
    start = F.col("k") * 97 % F.length("seq") + 1
    regions = seqs.select("doc_id", "seq", F.explode(F.array(*map(F.lit, range(4)))).alias("k")).select((F.col("doc_id") * 4 + F.col("k")).alias("key"), F.col("doc_id").alias("seqid"), start.cast("long").alias("start_pos"), (start + 59 + F.col("k") * 500).cast("long").alias("end_pos"))
    parts = sq.in_parts(seqs.select(F.col("doc_id").alias("name"), "seq"), 300)
    found = sq.subsequences(regions, parts, "key", 300)
    return found.select("key", F.md5(F.col("bases").cast("binary")).alias("digest"), F.length("bases").cast("long").alias("size"))


@query("""WITH r AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '-' ELSE '+' END AS strand, substring(seq, 6, 40) AS b FROM fx_sequences)
    SELECT doc_id, CASE strand WHEN '-' THEN doc_id || '_revcomp' ELSE CAST(doc_id AS VARCHAR) END AS name, CASE strand WHEN '-' THEN reverse(translate(b, 'ACGTacgt', 'TGCAtgca')) ELSE b END AS bases FROM r""", "fx_sequences")
def strand_orient(spark, sf):
    seqs = view(spark, sf, "fx_sequences")
    regions = seqs.select("doc_id", F.col("doc_id").alias("seqid"), F.lit(6).cast("long").alias("start_pos"), F.lit(45).cast("long").alias("end_pos"), F.when(F.col("doc_id") % 2 == 0, "-").otherwise("+").alias("strand"))
    return mb.strand_regions(regions, sq.in_parts(seqs.select(F.col("doc_id").alias("name"), "seq"), 300), "doc_id", 300)


@query("""WITH p AS (SELECT doc_id AS name, length(seq) AS len, CASE WHEN length(seq) > 1000 THEN CAST(floor(length(seq) / 500) AS BIGINT) ELSE 1 END AS n FROM fx_sequences),
    q AS (SELECT *, unnest(range(n)) AS part FROM p)
    SELECT name, part, CAST(floor(part * len / n) AS BIGINT) AS "offset", least(len, CAST(floor((part + 1) * len / n) AS BIGINT) + 20) - CAST(floor(part * len / n) AS BIGINT) AS size FROM q""", "fx_sequences")
def chunk_plan(spark, sf):
    rows = view(spark, sf, "fx_sequences").select("doc_id", F.length("seq").alias("len"))
    return sq.chunk_plan(rows, "doc_id", "len", 500, 20)


@query("SELECT doc_id, row_number() OVER (ORDER BY encode(seq), encode(header)) AS place FROM fx_sequences", "fx_sequences")
def canonical_sort(spark, sf):
    return od.placed(spark, view(spark, sf, "fx_sequences"), ["seq", "header"]).select("doc_id", "place")


# Members, children and lookups


@query("""WITH c AS (SELECT DISTINCT o_custkey AS m FROM orders WHERE o_orderkey % 3 = 0) SELECT o_orderkey AS id, o_orderkey IN (SELECT m FROM c) AS member FROM orders""")
def member_split(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    lists = orders.filter("o_orderkey % 3 = 0").groupBy((F.col("o_orderkey") % 50).alias("c")).agg(F.array_join(F.collect_set(F.col("o_custkey").cast("string")), ",").alias("members"))
    return mb.member_split(orders.select(F.col("o_orderkey").alias("id")), lists)


_MATCHED = """p AS (SELECT *, CASE WHEN classification <> '' THEN replace(classification, 'Class_II_Subclass_1_TIR_', 'Class_II/Subclass_1/TIR/') END AS own, fid % 7 = 0 AS has FROM fx_tir),
    c AS (SELECT *, replace(classification, '|', '/') AS its FROM fx_tpase),
    m AS (SELECT p.fid, count(*) AS n, min(c.fid) AS one, min(its) AS its FROM p JOIN c ON c.seqid = p.seqid AND c.start_pos >= p.start_pos AND c.end_pos <= p.end_pos AND (p.strand = '.' OR p.strand = c.strand) GROUP BY p.fid),
    r AS (SELECT p.fid, CASE WHEN has THEN 'has_child' WHEN n IS NULL THEN 'none' WHEN n > 1 THEN 'several' WHEN own IS NULL OR its IS NULL THEN 'unparseable' WHEN its <> own THEN 'class_differs' ELSE 'taken' END AS outcome, one FROM p LEFT JOIN m USING (fid))"""


def _matched(spark, sf):
    parents = view(spark, sf, "fx_tir")
    return mb.exactly_one_match(parents, parents.filter("fid % 7 = 0").select(F.col("fid").alias("parent")), view(spark, sf, "fx_tpase"))


@query(f"WITH {_MATCHED} SELECT fid, outcome, CASE WHEN outcome = 'taken' THEN one END AS candidate FROM r", "fx_tir", "fx_tpase")
def exactly_one_match(spark, sf):
    return _matched(spark, sf)


@query(f"""WITH {_MATCHED} SELECT count(*) AS total, count(*) FILTER (outcome = 'has_child') AS already, count(*) FILTER (outcome = 'taken') AS injected, count(*) FILTER (outcome = 'none') AS zero,
    count(*) FILTER (outcome IN ('several', 'unparseable', 'class_differs')) AS anomalies FROM r""", "fx_tir", "fx_tpase")
def enrichment_counts(spark, sf):
    counted, seen = mb.outcome_counts(_matched(spark, sf))
    scratch.settled(spark, counted)  # the counts come with the write
    return spark.createDataFrame([tuple(seen.get[k] for k in ("total", "already", "injected", "zero", "anomalies"))], "total long, already long, injected long, zero long, anomalies long")


@query(f"""WITH {_MATCHED} SELECT c.fid, c.seqid, c.start_pos, c.end_pos, c.strand, 'TIR_' || r.fid AS parent, 'DANTE_TIR_enriched' AS source, 'TPase' AS name, CAST(c.fid % 4 AS VARCHAR) AS kept FROM r JOIN c ON c.fid = r.one WHERE outcome = 'taken'""", "fx_tir", "fx_tpase")
def enrichment_children(spark, sf):
    entries = F.create_map(F.lit("Name"), F.lit("TPase"), F.lit("Parent"), F.lit("old"), F.lit("Identity"), (F.col("fid") % 4).cast("string"))
    parents = view(spark, sf, "fx_tir").select("fid", F.concat(F.lit("TIR_"), F.col("fid").cast("string")).alias("id"))
    rows = mb.injected_children(_matched(spark, sf), parents, view(spark, sf, "fx_tpase").withColumn("attrs", entries))
    at = lambda k: F.col("attrs")[k]
    return rows.select("fid", "seqid", "start_pos", "end_pos", "strand", at("Parent").alias("parent"), at("Source").alias("source"), at("Name").alias("name"), at("Identity").alias("kept"))


@query(f"""WITH spare AS (SELECT fid FROM fx_small WHERE source_tier <= 2 AND fid NOT IN (SELECT a.fid {PAIRS})),
    c AS (SELECT l_orderkey * 10 + l_linenumber AS k, l_orderkey, l_linenumber FROM lineitem)
    SELECT 'e' || fid AS id, CASE WHEN source_tier > 2 THEN 'primary' ELSE 'fallback' END AS source, CASE WHEN source_tier > 2 THEN 'complete' WHEN fid % 4 = 0 THEN 'partial' ELSE 'whole' END AS status FROM fx_small WHERE source_tier > 2 OR fid IN (SELECT fid FROM spare)
    UNION SELECT 'c' || k, 'fallback', 'partial' FROM c JOIN spare ON fid = l_orderkey""", "fx_small")
def merge_fallback(spark, sf):
    small = view(spark, sf, "fx_small")
    none = F.lit(None).cast("string")
    rows = small.select(
        F.concat(F.lit("e"), F.col("fid").cast("string")).alias("id"), "seqid", "start_pos", "end_pos", F.when(F.col("source_tier") > 2, "primary").otherwise("raw").alias("source"),
        none.alias("parent"), F.concat(F.lit("g"), F.col("fid").cast("string")).alias("group_id"), F.when(F.col("source_tier") > 2, "complete").when(F.col("fid") % 4 != 0, "whole").alias("status"),
    )
    key = F.col("l_orderkey").cast("string")
    by_parent = F.col("l_linenumber") % 2 == 0
    children = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.concat(F.lit("c"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string")).alias("id"), F.lit("chr1").alias("seqid"), F.lit(1).cast("long").alias("start_pos"), F.lit(2).cast("long").alias("end_pos"),
        F.lit("raw").alias("source"), F.when(by_parent, F.concat(F.lit("e"), key)).alias("parent"), F.when(~by_parent, F.concat(F.lit("g"), key)).alias("group_id"), none.alias("status"),
    )
    return mb.merge_fallback(rows.filter("source = 'primary'"), rows.filter("source = 'raw'"), children, "fallback").select("id", "source", "status").distinct()


_PAIR_CLASSES = "fx_hits JOIN fx_class a ON a.k = qid % 12 JOIN fx_class b ON b.k = sid % 12"


_CONFLICTS = f"(SELECT qid, sid, a.cls AS qclass, b.cls AS sclass, NOT (a.cls = b.cls OR starts_with(a.cls, b.cls || '/') OR starts_with(b.cls, a.cls || '/')) AS bad FROM {_PAIR_CLASSES})"


def _class_hits(spark, sf):
    classes = view(spark, sf, "fx_class")
    a = F.broadcast(classes.select(F.col("k").alias("_qk"), F.col("cls").alias("qclass")))
    b = F.broadcast(classes.select(F.col("k").alias("_sk"), F.col("cls").alias("sclass")))
    return view(spark, sf, "fx_hits").join(a, F.col("qid") % 12 == F.col("_qk")).join(b, F.col("sid") % 12 == F.col("_sk"))


@query(f"SELECT p_partkey AS qid, coalesce(bool_or(bad), false) AS dropped FROM part LEFT JOIN {_CONFLICTS} ON qid = p_partkey GROUP BY p_partkey", "fx_hits", "fx_class")
def class_conflict_filter(spark, sf):
    reps = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_partkey").alias("qid"))
    return mb.class_conflicts(reps, _class_hits(spark, sf))


@query(f"""SELECT p_partkey AS qid, CASE WHEN n > 0 THEN 'dropped' ELSE 'kept' END AS status, sid, sclass FROM part
    LEFT JOIN (SELECT qid, sum(CASE WHEN bad THEN 1 ELSE 0 END) AS n FROM {_CONFLICTS} GROUP BY qid) t ON t.qid = p_partkey
    LEFT JOIN (SELECT DISTINCT qid, sid, sclass FROM {_CONFLICTS} WHERE bad) c ON c.qid = p_partkey""", "fx_hits", "fx_class")
def class_conflict_audit(spark, sf):
    reps = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_partkey").alias("qid"))
    return mb.conflict_audit(reps, _class_hits(spark, sf))


@query("SELECT c_custkey AS id FROM customer WHERE CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE c_custkey % 9 END >= 3")
def filter_multiplicity(spark, sf):
    rows = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("id"))
    return mb.by_multiplicity(rows, rows.withColumn("multiplicity", F.when(F.col("id") % 4 == 0, "bad").otherwise((F.col("id") % 9).cast("string"))), 3)


_STRANDED = "(SELECT *, start_pos AS s, end_pos AS e, CASE WHEN fid % 3 = 0 THEN '-' ELSE '+' END AS strand FROM fx_small)"


@query(f"""WITH n AS (SELECT seqid, strand, classification, s AS start_pos, e AS end_pos FROM {islands(_STRANDED, 'seqid, strand, classification')}),
    seg AS (SELECT * FROM {_segments_sql('n')} WHERE e IS NOT NULL),
    l AS (SELECT g.seqid, g.s, g.e, list(n.classification ORDER BY n.classification, n.start_pos, n.end_pos, n.strand) AS a, list(n.strand ORDER BY n.classification, n.start_pos, n.end_pos, n.strand) AS b FROM seg g JOIN n ON n.seqid = g.seqid AND n.start_pos <= g.s AND n.end_pos >= g.e GROUP BY ALL),
    u AS (SELECT seqid, s, e, list_filter(a, lambda x, i: list_position(a, x) = i) AS names, list_filter(b, lambda x, i: list_position(b, x) = i) AS strands FROM l),
    x AS (SELECT *, string_split(names[1], '/') AS p FROM u),
    y AS (SELECT *, coalesce(list_max(list_filter(range(1, len(p) + 1), lambda i: len(list_filter(names, lambda m: coalesce(string_split(m, '/')[i] = p[i], false))) = len(names))), 0) AS d FROM x),
    z AS (SELECT *, CASE WHEN d = 0 THEN 'Unknown' ELSE array_to_string(p[1:d], '/') END AS classification FROM y)
    SELECT classification || '_' || seqid AS id, seqid, s AS start_pos, e AS end_pos, array_to_string(strands, '|') AS strand, classification, array_to_string(names, '|') AS names FROM z""", "fx_small")
def cleanup_lca(spark, sf):
    return mb.cleaned(view(spark, sf, "fx_small").withColumn("strand", F.when(F.col("fid") % 3 == 0, "-").otherwise("+")))


@query("SELECT fid, trc, CASE WHEN fid % 31 = 0 THEN 'rDNA/5S_rDNA' WHEN trc = 'TRC_0' THEN 'rDNA/45S_rDNA' WHEN trc = 'TRC_4' THEN 'rDNA/5S_rDNA' ELSE 'Satellite/TideCluster/' || trc END AS classification FROM fx_trc", "fx_trc")
def norm_satellite(spark, sf):
    known = spark.createDataFrame([("TRC_0", "rDNA/45S_rDNA"), ("TRC_4", "rDNA/5S_rDNA")], "trc string, class string")
    rows = view(spark, sf, "fx_trc").select("fid", "trc", F.when(F.col("fid") % 31 == 0, "5S").alias("rdna_type"))
    return mb.satellite_names(rows, known).drop("rdna_type")


@query("SELECT fid, trc, coalesce(sf, trc) AS sf FROM fx_trc x LEFT JOIN (SELECT trc AS t, sf FROM fx_superfamilies) y ON x.trc = y.t".replace("fx_trc x", "(SELECT fid, trc FROM fx_trc) x"), "fx_trc", "fx_superfamilies")
def lookup_superfamily(spark, sf):
    return mb.looked_up(view(spark, sf, "fx_trc").select("fid", "trc"), view(spark, sf, "fx_superfamilies"), "trc", "sf", F.col("trc"))


@query("""WITH e AS (SELECT 'e' || event_id AS id, CASE WHEN user_id % 2 = 0 THEN '-' ELSE '+' END AS strand, event_id FROM events), d AS (SELECT CASE WHEN event_id % 3 = 0 THEN 'e' || event_id || '_revcomp' ELSE 'e' || event_id END AS name, 'AC' || event_id AS seq FROM events)
    SELECT id, strand, seq FROM e LEFT JOIN d ON d.name = id || CASE strand WHEN '-' THEN '_revcomp' ELSE '' END""")
def lookup_dimer(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    name = F.concat(F.lit("e"), F.col("event_id").cast("string"))
    elements = e.select(name.alias("id"), F.when(F.col("user_id") % 2 == 0, "-").otherwise("+").alias("strand"))
    dimers = e.select(F.when(F.col("event_id") % 3 == 0, F.concat(name, F.lit("_revcomp"))).otherwise(name).alias("name"), F.concat(F.lit("AC"), F.col("event_id").cast("string")).alias("seq"))
    return mb.dimer_of(elements, dimers)


_REPEATS = """(SELECT p_partkey AS id, cls, CASE WHEN p_partkey % 3 = 0 THEN 'Simple_repeat' WHEN p_partkey % 3 = 1 THEN 'Unspecified' ELSE cls END AS kind,
    CASE WHEN p_partkey % 3 = 0 THEN concat('(', substring(p_name, 1, 4), ')n') ELSE concat('fam', CAST(p_partkey AS STRING), '__', p_name, '__x') END AS repeat FROM part JOIN fx_class ON k = CAST((p_partkey - p_partkey % 3) / 3 % 12 AS INT))"""


@query(f"SELECT id, CASE WHEN kind = 'Simple_repeat' THEN 'Simple_repeat/' || repeat WHEN id % 3 = 1 THEN 'fam' || id ELSE cls END AS name, replace(replace(replace(cls, '/', '|') || '_' || repeat, '/', '_'), '|', '/') AS slashed FROM {_REPEATS}", "fx_class")
def rm_name(spark, sf):
    rows = _over(spark, sf, f"SELECT * FROM {_REPEATS} r", "part")
    label = F.concat_ws("_", F.replace("cls", F.lit("/"), F.lit("|")), "repeat")
    return rows.select("id", mb.repeat_name(F.col("repeat"), F.col("kind")).alias("name"), mb.other_separator(label, "|", "/").alias("slashed"))


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN 'partial' ELSE 'complete' END AS status, 'g' || o_orderkey AS grp, o_orderkey % 6 IN (1, 2, 3, 4) AS ranked FROM orders")
def completeness(spark, sf):
    key = F.col("o_orderkey").cast("string")
    name = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("TE_partial_"), key)).otherwise(F.concat(F.lit("TE_"), key))
    header = F.concat(F.lit("chr1:1-9  g"), key, F.lit("_5prime"))
    rank = F.get(F.array(*map(F.lit, ("D", "DL", "DLT", "DLP", "DLTP"))), (F.col("o_orderkey") % 6).cast("int"))
    return spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("id"), lb.completeness(name).alias("status"), sq.header_group(header).alias("grp"), lb.complete_rank(rank).alias("ranked"))


@query("""WITH l AS (SELECT split_part(header, '#', 2) AS class, length(seq) AS n, doc_id FROM fx_sequences)
    SELECT class, CAST(sum(n) AS BIGINT) AS input_bp, CAST(coalesce(sum(n) FILTER (doc_id % 3 > 0), 0) AS BIGINT) AS output_bp, round(coalesce(sum(n) FILTER (doc_id % 3 > 0), 0) * 100 / sum(n), 6) AS percent FROM l GROUP BY class""", "fx_sequences")
def library_size_ratios(spark, sf):
    rows = view(spark, sf, "fx_sequences").select(sq.last_header_class(F.col("header")).alias("class"), F.length("seq").alias("n"), "doc_id")
    kept = F.sum(F.when(F.col("doc_id") % 3 > 0, F.col("n")).otherwise(0))
    return rows.groupBy("class").agg(F.sum("n").alias("input_bp"), kept.alias("output_bp"), F.round(kept * 100 / F.sum("n"), 6).alias("percent"))


@query("""WITH p AS (SELECT doc_id AS name, length(seq) AS len, CASE WHEN length(seq) > 1000 THEN CAST(floor(length(seq) / 500) AS BIGINT) ELSE 1 END AS n FROM fx_sequences),
    q AS (SELECT *, unnest(range(n)) AS part FROM p)
    SELECT name, 1 + CAST(floor(part * len / n) AS BIGINT) AS start_pos, 9 + CAST(floor(part * len / n) AS BIGINT) AS end_pos FROM q""", "fx_sequences")
def chunk_remap(spark, sf):
    plan = chunk_plan(spark, sf)
    return sq.chunk_remap(plan.select("name", "part", F.lit(1).alias("start_pos"), F.lit(9).alias("end_pos")), plan)


@query(f"""WITH {_density_sql(STEP)} SELECT seqid, start_pos, end_pos, round(least(1, score * 3), 5) AS score FROM dens""", "fx_features", "fx_seqs")
def sum_tracks(spark, sf):
    track = _track(spark, sf)
    return tr.summed(track.union(track).union(track)).withColumn("score", F.round("score", 5))


_CUSTOMER_LENGTHS = "(SELECT 'sq' || c_custkey AS seqid, c_custkey * 37 % 1000 AS length FROM customer)"


def _customer_lengths(spark, sf):
    return spark.read.parquet(f"{sf}/customer.parquet").select(F.concat(F.lit("sq"), F.col("c_custkey").cast("string")).alias("seqid"), (F.col("c_custkey") * 37 % 1000).alias("length"))


@query(f"WITH l AS (SELECT * FROM {_CUSTOMER_LENGTHS}), t AS (SELECT seqid FROM l WHERE length >= 300 ORDER BY length DESC, seqid LIMIT 40) SELECT seqid, length, length >= 500 AS chart, seqid IN (SELECT seqid FROM t) AS track FROM l")
def seq_thresholds(spark, sf):
    return rp.shown_sequences(_customer_lengths(spark, sf), 500, 300, 40)


@query(f"SELECT count(*) AS n_other, CAST(sum(length) AS BIGINT) AS other_bp FROM {_CUSTOMER_LENGTHS} WHERE length < 500")
def seq_other(spark, sf):
    return rp.other_sequences(_customer_lengths(spark, sf), 500)


@query("""SELECT CASE WHEN classification LIKE 'rDNA/45S%' THEN 'rDNA/45S_rDNA' ELSE classification END AS classification, count(*) AS n, CAST(sum(end_pos - start_pos + 1) AS BIGINT) AS bp
    FROM fx_features GROUP BY ALL""", "fx_features")
def collapse_rdna(spark, sf):
    return rp.collapsed_rdna(view(spark, sf, "fx_features"))


@query("""SELECT classification AS path, CAST(sum(CASE WHEN fid % 5 = 0 THEN 0 ELSE CAST(copy_number AS BIGINT) END) AS BIGINT) AS tr_members, count(*) AS tr_arrays FROM fx_tiers WHERE structure = 'LTR_RT_TR' GROUP BY classification""", "fx_tiers")
def tr_stats(spark, sf):
    rows = view(spark, sf, "fx_tiers").withColumn("copy_number", F.when(F.col("fid") % 5 == 0, "many").otherwise(F.col("copy_number")))
    return rp.tandem_stats(rows)


@query("""SELECT replace(replace(replace(final_classification, 'Ty1/copia', 'Ty1_copia'), 'Ty3/gypsy', 'Ty3_gypsy'), '|', '/') AS path, count(*) AS count, CAST(sum(end_pos - start_pos + 1) AS BIGINT) AS bp
    FROM fx_ltr WHERE id % 6 IN (1, 2, 3, 4) GROUP BY 1""", "fx_ltr")
def dante_ltr_stats(spark, sf):
    rank = F.element_at(F.array(*map(F.lit, ("D", "DL", "DLT", "DLP", "DLTP", ""))), (F.col("id") % 6 + 1).cast("int"))
    return rp.element_stats(view(spark, sf, "fx_ltr").withColumn("rank", rank))


@query("SELECT source_tool, count(*) AS regions, round(sum(end_pos - start_pos + 1) / 1e6, 6) AS mb FROM fx_features WHERE source_tier = 1 GROUP BY source_tool", "fx_features")
def domain_summary(spark, sf):
    return rp.structural_summary(view(spark, sf, "fx_features"))


@query(f"""WITH g AS (SELECT * FROM {_GROUPED}), b AS (SELECT DISTINCT fid, bucket FROM (SELECT *, row_number() OVER () AS fid FROM g) LEFT JOIN LATERAL (SELECT unnest([replace(grp, '/', '.'), CASE WHEN starts_with(grp, 'Class') THEN 'Mobile_elements' END, CASE WHEN starts_with(grp, 'Simple_repeat') THEN 'Simple_repeats' END,
        CASE WHEN starts_with(grp, 'Low_complexity') THEN 'Low_complexity' END, CASE WHEN starts_with(grp, 'rDNA') THEN 'rDNA' END, CASE WHEN contains(grp, 'copia') THEN 'All_Ty1_Copia' END, CASE WHEN contains(grp, 'gypsy') THEN 'All_Ty3_Gypsy' END,
        CASE WHEN contains(grp, 'Class_II/Subclass_1/TIR') THEN 'Class_II.Subclass_1.TIR' END, CASE WHEN structure = 'LTR_RT_TR' THEN 'LTR_RT_TR' END]) AS bucket) ON true)
    SELECT bucket, count(*) AS n FROM b WHERE bucket IS NOT NULL GROUP BY bucket""", "fx_unified")
def snk_split_by_class(spark, sf):
    return rp.buckets(view(spark, sf, "fx_unified")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH b AS (SELECT o_orderpriority AS rule, CAST(sum(o_totalprice) AS DOUBLE) AS s, CAST(count(*) AS DOUBLE) AS cpu_time FROM orders GROUP BY o_orderpriority)
    SELECT rule, round(s, 2) AS s, cpu_time, round(cpu_time / s, 6) AS load, s = (SELECT max(s) FROM b) AS slowest FROM b
    UNION ALL SELECT 'total', round(sum(s), 2), sum(cpu_time), round(sum(cpu_time) / sum(s), 6), false FROM b""")
def bench_stats(spark, sf):
    rows = spark.read.parquet(f"{sf}/orders.parquet").groupBy(F.col("o_orderpriority").alias("rule")).agg(F.sum("o_totalprice").cast("double").alias("s"), F.count(F.lit(1)).cast("double").alias("cpu_time"))
    return rp.benchmark_stats(rows).withColumn("s", F.round("s", 2))


@query("SELECT fid, CASE WHEN fid % 3 = 0 THEN 0 ELSE start_pos % 50 END AS five, CASE WHEN fid % 3 = 1 THEN 0 ELSE end_pos % 70 END AS three FROM fx_domains", "fx_domains")
def prime_lengths(spark, sf):
    rows = view(spark, sf, "fx_domains")
    sides = rows.filter("fid % 3 <> 0").select("fid", F.lit("5prime").alias("prime"), (F.col("start_pos") % 50).alias("length"))
    return pt.prime_lengths(sides.union(rows.filter("fid % 3 <> 1").select("fid", F.lit("3prime"), F.col("end_pos") % 70)))


@query("""SELECT fid AS id, seqid, start_pos, end_pos, CAST(NULL AS BIGINT) AS parent, fid AS group_id FROM fx_small WHERE source_tier > 2
    UNION ALL SELECT c.fid, c.seqid, c.start_pos, c.end_pos, p.fid, p.fid FROM fx_small c JOIN fx_small p ON c.source_tier <= 2 AND p.source_tier > 2 AND c.seqid = p.seqid AND c.start_pos >= p.start_pos AND c.end_pos <= p.end_pos""", "fx_small")
def pattern_gff(spark, sf):
    children, elements = _halves(spark, sf)
    return pt.with_children(elements, children)


@query("SELECT 'UA_L1_' || lpad(CAST(row_number() OVER (ORDER BY seqid, start_pos, end_pos, fid) AS VARCHAR), 8, '0') AS id, fid FROM fx_features", "fx_features")
def assign_ids(spark, sf):
    return rs.with_ids(view(spark, sf, "fx_features"), ("seqid", "start_pos", "end_pos", "fid")).select("id", "fid")


@query("""WITH l AS (SELECT 'a' AS lib, header, seq FROM fx_sequences WHERE doc_id % 2 = 0 UNION ALL SELECT 'b', replace(header, 'el_', 'TRC_S_'), seq FROM fx_sequences WHERE doc_id % 2 = 1)
    SELECT lib, header, row_number() OVER (PARTITION BY split_part(header, '#', 2) ORDER BY encode(seq), encode(header)) || '#' || split_part(header, '#', 2) AS short_name FROM l""", "fx_sequences")
def short_names(spark, sf):
    rows = view(spark, sf, "fx_sequences")
    first = rows.filter("doc_id % 2 = 0").select(F.lit("a").alias("lib"), "header", "seq")
    second = rows.filter("doc_id % 2 = 1").select(F.lit("b").alias("lib"), "header", "seq")
    both = mb.joined_libraries(first, second, "el_").withColumn("_class", sq.header_class(F.col("header")))
    rows = od.placed_within(spark, both, ["_class"], ["seq", "header"])
    return rows.select("lib", "header", F.concat(F.col("place").cast("string"), F.lit("#"), "_class").alias("short_name"))


# Tier resolution


@query(f"WITH RECURSIVE t AS (SELECT * FROM fx_tiers WHERE source_tier = 2), {st.within_tier('w', 't')} SELECT * FROM w", "fx_tiers")
def within_tier(spark, sf):
    return rs.within_tier(view(spark, sf, "fx_tiers").filter("source_tier = 2"))


@query(f"WITH RECURSIVE t AS (SELECT * FROM fx_tiers WHERE source_tier = 1), {st.longest_first('w', 't')} SELECT * FROM w", "fx_tiers")
def tier1_greedy(spark, sf):
    rows = view(spark, sf, "fx_tiers").filter("source_tier = 1")
    return rs.longest_first(spark, rows.unionByName(rows.filter("fid % 10 = 0")))  # repeated rows count once


def _derived(least: int, depth: int, share: float) -> str:
    return f"""WITH RECURSIVE arrays AS (SELECT *, source_tool AS tool FROM fx_tiers WHERE source_tier = 3), elements AS (SELECT * FROM fx_tiers WHERE source_tier = 1 AND classification LIKE 'Class_I/LTR/%'),
        {st.te_derived('w', 'arrays', 'elements', least, depth, share)} SELECT * FROM w"""


@query(_derived(2, 1, 0.01), "fx_tiers")
def te_derived(spark, sf):
    rows = view(spark, sf, "fx_tiers")
    return rs.te_derived(rows.filter("source_tier = 3"), rows.filter("source_tier = 1 AND classification LIKE 'Class_I/LTR/%'"), depth=1, share=0.01)


@query("""WITH a AS (SELECT o_orderkey AS k, 'TRC_' || (o_orderkey % 400) AS name, CASE WHEN o_orderkey % 2 = 0 THEN 'TideCluster_default' ELSE 'TideCluster_short' END AS source_tool, 'c' || (o_orderkey % 7) AS seqid, o_orderkey * 1000 AS s FROM orders),
    x AS (SELECT name, source_tool, count(*) FILTER (k % 3 = 0) AS n, count(DISTINCT CASE WHEN k % 3 = 0 THEN (k % 800) % 5 END) AS kinds, min(CASE WHEN k % 3 = 0 THEN (k % 800) % 5 END) AS kind, count(*) AS arrays FROM a GROUP BY ALL)
    SELECT source_tool, name, CASE kind WHEN 4 THEN 'Class_I/LTR/Ty1_copia' ELSE 'Class_I/LTR/Ty1_copia/L' || kind END AS te_origin FROM x WHERE n >= 2 AND kinds = 1 AND n * 300.0 / (arrays * 400) >= 0.25""")
def te_derived_defaults(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("fid"))
    at = o.select(
        "fid", F.concat(F.lit("TRC_"), (F.col("fid") % 400).cast("string")).alias("name"), F.when(F.col("fid") % 2 == 0, "TideCluster_default").otherwise("TideCluster_short").alias("source_tool"),
        F.concat(F.lit("c"), (F.col("fid") % 7).cast("string")).alias("seqid"), (F.col("fid") * 1000).alias("start_pos"), (F.col("fid") * 1000 + 399).alias("end_pos"),
    )
    kind = F.col("fid") % 800 % 5
    elements = at.filter("fid % 3 = 0").withColumn("end_pos", F.col("start_pos") + 299)
    elements = elements.withColumn("classification", F.when(kind == 4, "Class_I/LTR/Ty1_copia").otherwise(F.concat(F.lit("Class_I/LTR/Ty1_copia/L"), kind.cast("string"))))
    return rs.te_derived(at, elements)


_RESOLVED = f"WITH RECURSIVE th6 AS (SELECT * FROM fx_tiers WHERE source_tier = 6 AND seqid <> 'chr5'), {st.tier_resolve('fx_tiers', 'th6', 'fx_tandem_members')}, {st.finalised()}"


@query(f"{_RESOLVED} SELECT * FROM final", "fx_tiers", "fx_tandem_members")
def tier_resolve(spark, sf):
    rows = view(spark, sf, "fx_tiers")
    return rs.finalised(spark, rs.tier_resolve(spark, rows.unionByName(rows.filter("fid % 10 = 0")), rows.filter("source_tier = 6 AND seqid <> 'chr5'"), view(spark, sf, "fx_tandem_members")))


_RULES = {
    "seqid": "coalesce(seqid, '') = ''", "source": f"coalesce(source NOT IN {tuple(rs.TOOL_TIERS)}, true)", "type": f"coalesce(type NOT IN {rs.TYPES}, true)",
    "coordinates": "coalesce(start_pos < 1 OR end_pos < start_pos, true)", "strand": "coalesce(strand NOT IN ('+', '-', '.'), true)",
    **{f"missing_{k}": f"{k} IS NULL" for k in ("id", "name", "classification", "source_tier", "source_tool")},
}
_WHOLE = {
    "id_format": "lv = ''", "unique_id": "lv <> '' AND copies > 1", "tool_is_source": "source_tool IS DISTINCT FROM source", "tier_of_tool": "source_tier <> " + "CASE source_tool " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in rs.TOOL_TIERS.items()) + " END",
    "type_of_class": "type IS DISTINCT FROM CASE WHEN regexp_matches(classification, '^(Satellite|Simple_repeat|Low_complexity|rDNA|Unknown)') THEN 'repeat_region' ELSE 'transposable_element' END",
    "cluster_name": f"source_tool IN {rs.NAMED_BY_CLUSTER} AND NOT regexp_full_match(name, 'TRC_[0-9]+')", "element_type_tool": "element_type IS NOT NULL AND source_tool <> 'DANTE_LTR'",
    "element_type_value": "source_tool = 'DANTE_LTR' AND element_type NOT IN ('complete', 'partial')", "element_type_missing": "element_type IS NULL AND source_tool = 'DANTE_LTR' AND structure IS DISTINCT FROM 'LTR_RT_TR'",
    "structure_value": "structure <> 'LTR_RT_TR'", "structure_tool": "structure IS NOT NULL AND source_tool <> 'DANTE_LTR'", "copy_number_structure": "copy_number IS NOT NULL AND structure IS DISTINCT FROM 'LTR_RT_TR'",
    "copy_number_integer": "structure = 'LTR_RT_TR' AND NOT regexp_full_match(copy_number, '[0-9]+')", "in_structure_value": "in_structure <> 'LTR_RT_TR'", "in_structure_level": "in_structure IS NOT NULL AND (lv <> '2' OR source_tool <> 'DANTE_LTR')",
    "member_of_structure": "member_of IS NOT NULL AND in_structure IS NULL", "member_of_format": "NOT regexp_full_match(member_of, 'UA_L1_[0-9]{8}')", "member_of_parent": "regexp_full_match(member_of, 'UA_L1_[0-9]{8}') AND member_of <> parent",
    "te_origin_tool": f"te_origin IS NOT NULL AND source_tool NOT IN {rs.ORIGIN_TOOLS}", "te_origin_path": "NOT contains(te_origin, '/')", "te_origin_structure_origin": "te_origin_structure IS NOT NULL AND te_origin IS NULL",
    "te_origin_structure_value": "te_origin_structure <> 'tandem_LTR_RT'", "level_2_parent": "lv = '2' AND parent IS NULL", "level_1_parent": "lv = '1' AND parent IS NOT NULL", "parent_format": "NOT regexp_full_match(parent, 'UA_L1_[0-9]{8}')",
    "parent_exists": "regexp_full_match(parent, 'UA_L1_[0-9]{8}') AND parent NOT IN (SELECT id FROM fx_unified WHERE id IS NOT NULL)",
}
_REQUIRED = "id IS NOT NULL AND name IS NOT NULL AND classification IS NOT NULL AND source_tier IS NOT NULL AND source_tool IS NOT NULL"
_CASES = ", ".join([f"CASE WHEN {t} THEN '{k}' END" for k, t in _RULES.items()] + [f"CASE WHEN {_REQUIRED} AND ({t}) THEN '{k}' END" for k, t in _WHOLE.items()])


@query(f"""WITH c AS (SELECT id, count(*) AS copies FROM fx_unified GROUP BY id), r AS (SELECT u.*, copies, regexp_extract(u.id, '^UA_L([12])_[0-9]{{8}}$', 1) AS lv FROM fx_unified u LEFT JOIN c USING (id)),
    x AS (SELECT unnest([{_CASES}]) AS rule FROM r) SELECT rule, count(*) AS n FROM x WHERE rule IS NOT NULL GROUP BY rule""", "fx_unified")
def contract_validate(spark, sf):
    return rs.violations(view(spark, sf, "fx_unified")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


_ANNOTATED = "final AS (SELECT *, CASE WHEN fid % 21 = 0 THEN fid + CASE WHEN fid % 2 = 0 THEN 1 ELSE 0 END END AS parent FROM fx_tiers)"


@query(f"""WITH {_ANNOTATED}, top AS (SELECT * FROM final WHERE parent IS NULL), el AS (SELECT * FROM top WHERE NOT regexp_matches(classification, '^(Simple_repeat|Low_complexity|Satellite|Unknown)')),
    cov AS (SELECT coalesce(sum(e - s + 1), 0) AS bp FROM {islands('(SELECT seqid, start_pos AS s, end_pos AS e FROM top)')})
    SELECT 'overlapping_elements' AS "check", 'T' || a.source_tier || '-T' || b.source_tier AS item, CAST(count(*) AS DOUBLE) AS value FROM el a JOIN el b ON a.seqid = b.seqid AND a.start_pos <= b.end_pos AND b.start_pos <= a.end_pos
        AND {{'s': a.start_pos, 'e': a.end_pos, 'i': a.fid}} < {{'s': b.start_pos, 'e': b.end_pos, 'i': b.fid}} GROUP BY ALL
    UNION ALL SELECT 'coverage', 'bp', CAST(bp AS DOUBLE) FROM cov UNION ALL SELECT 'coverage', 'percent', round(bp / (SELECT sum(length) FROM fx_seqs) * 100, 2) FROM cov
    UNION ALL SELECT 'bad_parents', 'level_2', CAST(count(*) AS DOUBLE) FROM final WHERE parent IS NOT NULL AND parent NOT IN (SELECT fid FROM top)
    UNION ALL SELECT 'source_tool', source_tool, CAST(count(*) AS DOUBLE) FROM top GROUP BY source_tool UNION ALL SELECT 'source_tier', CAST(source_tier AS VARCHAR), CAST(count(*) AS DOUBLE) FROM top GROUP BY source_tier""", "fx_tiers", "fx_seqs")
def sanity_checks(spark, sf):
    rows = view(spark, sf, "fx_tiers").withColumn("id", F.col("fid"))
    rows = rows.withColumn("parent", F.when(F.col("fid") % 21 == 0, F.col("fid") + F.when(F.col("fid") % 2 == 0, 1).otherwise(0)))
    return rs.sanity_checks(rows, view(spark, sf, "fx_seqs"))


@query("""WITH u AS (SELECT * FROM fx_tiers) SELECT a.seqid, greatest(a.start_pos, b.start_pos) AS start_pos, least(a.end_pos, b.end_pos) AS end_pos, a.name AS name_a, a.classification AS class_a, a.source_tier AS tier_a,
    b.name AS name_b, b.classification AS class_b, b.source_tier AS tier_b, least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos) + 1 AS overlap_bp FROM u a JOIN u b ON a.seqid = b.seqid AND a.fid < b.fid AND a.start_pos <= b.end_pos AND b.start_pos <= a.end_pos
    WHERE NOT regexp_matches(a.classification, '^(Simple_repeat|Low_complexity)') AND NOT regexp_matches(b.classification, '^(Simple_repeat|Low_complexity)')""", "fx_tiers")
def residual_overlaps(spark, sf):
    rows = view(spark, sf, "fx_tiers").withColumn("id", F.col("fid")).withColumn("parent", F.lit(None).cast("string"))
    return rs.residual_overlaps(rows)


# Files: each query writes a file in its own format to the shared folder, reads it back and compares


def _lines_file(spark, df, name: str, header: str | None = None, **options: str) -> str:
    """Write text rows (value) as a folder of files; a header line comes first in each of its files."""
    path = scratch.folder(spark, name)
    if header is None:
        df.select("value").write.options(**options).text(path)
    else:
        spark.createDataFrame([(header,)], "value string").coalesce(1).unionByName(df.select("value")).coalesce(1).write.options(**options).text(path)
    return path


@query("""SELECT seqid, source_tool AS source, CASE WHEN regexp_matches(classification, '^(Satellite|Simple_repeat|Low_complexity|rDNA|Unknown)') THEN 'repeat_region' ELSE 'transposable_element' END AS type,
    start_pos, end_pos, CASE strand WHEN '*' THEN '.' ELSE strand END AS strand, CAST(fid AS VARCHAR) AS id, name, classification FROM fx_tiers""", "fx_tiers")
def src_gff3(spark, sf):
    rows = view(spark, sf, "fx_tiers").withColumn("type", lb.feature_type(F.col("classification"))).withColumnsRenamed({"fid": "ID", "name": "Name"})
    path = scratch.folder(spark, "gff3")
    sinks.write_gff3(rows, path, ["ID", "Name", "classification"])
    at = lambda k: F.try_element_at("attrs", F.lit(k))
    return tabular.read_gff3(spark, path).select("seqid", "source", "type", "start_pos", "end_pos", "strand", at("ID").alias("id"), at("Name").alias("name"), at("classification").alias("classification"))


#: Sequences without the characters that no sequence file keeps.
_BASES = "(SELECT doc_id, header, regexp_replace(seq, '[^ACGTN]', '', 'g') AS seq FROM fx_sequences)"


def _bases(spark, sf):
    return view(spark, sf, "fx_sequences").withColumn("seq", F.regexp_replace("seq", "[^ACGTN]", ""))


def _library(spark, sf, gzip: bool = False) -> str:
    path = scratch.folder(spark, "fasta")
    rows = _bases(spark, sf).select(F.concat("header", F.lit(" doc "), F.col("doc_id").cast("string")).alias("header"), "seq")
    if gzip:
        # A packed file without its usual ending.
        from spanloom.functions.sequences import wrapped

        text = rows.select(F.concat(F.lit(">"), "header", F.lit("\n"), wrapped(F.col("seq"), 60)).alias("value"))
        text.coalesce(1).write.option("compression", "gzip").text(path)
        jvm = spark.sparkContext._jvm
        base = jvm.org.apache.hadoop.fs.Path(path)
        files = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        packed = next(f.getPath() for f in files.listStatus(base) if f.getPath().getName().endswith(".gz"))
        files.rename(packed, jvm.org.apache.hadoop.fs.Path(path, "genome.fa"))
        return f"{path}/genome.fa"
    sinks.write_fasta(rows, path, width=60)
    return f"{path}/part-*"


@query(f"SELECT header || ' doc ' || doc_id AS header, header AS name, md5(upper(seq)) AS digest FROM {_BASES}", "fx_sequences")
def src_fasta(spark, sf):
    rows = tabular.read_fasta(spark, _library(spark, sf), upper=True)
    return rows.select("header", "name", F.md5(F.col("seq").cast("binary")).alias("digest"))


_PARTS_SQL = f"SELECT header AS name, header || ' doc ' || doc_id AS header, k AS part, k * 700 AS \"offset\", md5(substring(seq, k * 700 + 1, 700)) AS digest FROM (SELECT *, unnest(range(CAST(ceil(length(seq) / 700) AS BIGINT))) AS k FROM {_BASES})"


def _digests(rows):
    return rows.select("name", "header", "part", "offset", F.md5(F.col("seq").cast("binary")).alias("digest"))


@query(_PARTS_SQL, "fx_sequences")
def src_fasta_parts(spark, sf):
    return _digests(tabular.read_sequence_parts(spark, _library(spark, sf), 700))


@query(_PARTS_SQL, "fx_sequences")
def src_fasta_gz_clean(spark, sf):
    return _digests(tabular.read_sequence_parts(spark, _library(spark, sf, gzip=True), 700))


@query(f"SELECT header AS seqid, length(seq) AS length FROM {_BASES}", "fx_sequences")
def seq_lengths(spark, sf):
    return tabular.part_lengths(tabular.read_sequence_parts(spark, _library(spark, sf), 700))


@query(f"SELECT seqid, length FROM {_SCAFFOLDS}")
def src_fai(spark, sf):
    rows = _scaffolds(spark, sf).select(F.concat_ws("\t", "seqid", F.col("length").cast("string"), F.lit("6"), F.lit("60"), F.lit("61")).alias("value"))
    return tabular.read_lengths(spark, _lines_file(spark, rows.union(spark.sql("SELECT 'short line'")), "fai"))


@query("SELECT seqid, start_pos, end_pos, 'el' || (fid % 9) AS repeat, classification AS class FROM fx_small", "fx_small")
def src_rm_out(spark, sf):
    parts = [F.lit("  239 12.1 0.0 3.1"), "seqid", F.col("start_pos").cast("string"), F.col("end_pos").cast("string"), F.lit("(99) +"), F.concat(F.lit("el"), (F.col("fid") % 9).cast("string")), "classification", F.lit("1 9 (2) 7")]
    return tabular.read_repeat_hits(spark, _lines_file(spark, view(spark, sf, "fx_small").select(F.concat_ws("  ", *parts).alias("value")), "rm", "   SW   perc perc perc  query      position in query  matching repeat position\nscore  div. del. ins. sequence begin end (left) repeat class/family begin end (left) ID\n"))


_HIT_COLUMNS = "CAST(qid AS VARCHAR) AS qseqid, CAST(sid AS VARCHAR) AS sseqid, round(pident, 2) AS pident, aln_len AS length"


def _hits(spark, sf, *fields):
    hits = view(spark, sf, "fx_hits").withColumn("pident", F.round("pident", 2))
    return hits.select(F.concat_ws("\t", *[F.col(f).cast("string") if isinstance(f, str) else f for f in fields]).alias("value"))


@query(f"SELECT {_HIT_COLUMNS}, 1 AS mismatch, 0 AS gapopen, qstart, qend, sstart, send, 0.001 AS evalue, 50.0 AS bitscore FROM fx_hits", "fx_hits")
def src_blast6(spark, sf):
    back = F.col("qid") % 2 == 0
    fields = ["qid", "sid", "pident", "aln_len", F.lit("1"), F.lit("0"), F.when(back, F.col("qend")).otherwise(F.col("qstart")).cast("string"), F.when(back, F.col("qstart")).otherwise(F.col("qend")).cast("string"), "send", "sstart", F.lit("0.001"), F.lit("50")]
    return tabular.read_hits(spark, _lines_file(spark, _hits(spark, sf, *fields), "hits"))


@query(f"SELECT {_HIT_COLUMNS}, qstart, qend, 0.001 AS evalue, 50.0 AS bitscore, qlen, slen, 90.0 AS qcovs FROM fx_hits", "fx_hits")
def src_blast6_11(spark, sf):
    fields = ["qid", "sid", "pident", "aln_len", "qend", "qstart", F.lit("0.001"), F.lit("50"), "qlen", "slen", F.lit("90")]
    return tabular.read_hits(spark, _lines_file(spark, _hits(spark, sf, *fields), "hits"), tabular.HITS_11)


@query(f"SELECT {_HIT_COLUMNS}, qlen, slen, qstart, qend FROM fx_hits", "fx_hits")
def src_blast6_8(spark, sf):
    return tabular.read_hits(spark, _lines_file(spark, _hits(spark, sf, "qid", "sid", "pident", "aln_len", "qlen", "slen", "qend", "qstart"), "hits"), tabular.HITS_8)


@query("SELECT 'TRC_' || c_custkey AS trc, CASE WHEN c_custkey % 3 = 0 THEN 'rDNA/45S_rDNA' ELSE 'rDNA/5S_rDNA' END AS class FROM customer WHERE c_custkey % 3 < 2")
def src_rdna_tsv(spark, sf):
    key = F.col("c_custkey")
    kind = F.element_at(F.array(*map(F.lit, (" 45s ", "5S", "other"))), (key % 3 + 1).cast("int"))
    second = F.when(key % 2 == 0, F.lit("45S")).otherwise("5S")
    lines = F.array(F.concat(F.lit("TRC_"), key.cast("string"), F.lit("\t"), kind, F.lit("\t0.9")), F.when(key % 3 < 2, F.concat(F.lit("TRC_"), key.cast("string"), F.lit("\t"), second, F.lit("\t0.1"))))
    rows = spark.read.parquet(f"{sf}/customer.parquet").coalesce(1).select(F.explode(F.array_compact(lines)).alias("value"))
    return tabular.read_rdna(spark, _lines_file(spark, rows, "rdna", "TRC\trDNA_type\tcoverage"))


@query("SELECT 'TRC_' || c_custkey AS trc, 'SF' || (c_custkey % 7) AS sf FROM customer")
def src_sf_csv(spark, sf):
    key, number = F.col("c_custkey").cast("string"), (F.col("c_custkey") % 7).cast("string")
    line = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit('"TRC_'), key, F.lit('","'), number, F.lit('"'))).otherwise(F.concat(number, F.lit(";TRC_"), key, F.lit(";x")))
    rows = spark.read.parquet(f"{sf}/customer.parquet").select(line.alias("value"))
    return tabular.read_superfamilies(spark, _lines_file(spark, rows, "sf", "cluster,superfamily"))


@query("SELECT trc, monomer FROM (SELECT 'TRC_' || (c_custkey % 20) AS trc, c_nationkey AS monomer, row_number() OVER (PARTITION BY c_custkey % 20 ORDER BY count(*) DESC, c_nationkey) AS r FROM customer GROUP BY c_custkey % 20, c_nationkey) WHERE r = 1")
def src_kite_csv(spark, sf):
    rows = spark.read.parquet(f"{sf}/customer.parquet").select(F.concat_ws("\t", F.lit("x"), F.concat(F.lit("TRC_"), (F.col("c_custkey") % 20).cast("string")), F.col("c_nationkey").cast("string")).alias("value"))
    return rp.modal_monomer(tabular.read_monomer_sizes(spark, _lines_file(spark, rows, "kite", "array\tTRC_ID\tmonomer_size")))


@query("SELECT 'Class_II/Subclass_1/TIR/T' || n_nationkey AS path, n_nationkey * 3 AS count FROM nation")
def src_tir_summary(spark, sf):
    key = F.col("n_nationkey")
    rows = spark.read.parquet(f"{sf}/nation.parquet").select(F.concat_ws("\t", F.concat(F.lit("Class_II_Subclass_1_TIR_T"), key.cast("string")), (key * 3).cast("string")).alias("value"))
    return tabular.read_element_counts(spark, _lines_file(spark, rows, "tir", "raw_name\tcount"))


@query("SELECT n_name AS type, n_nationkey * 1000.0 AS bp, n_nationkey / 10.0 AS pct FROM nation")
def src_composition(spark, sf):
    key = F.col("n_nationkey")
    rows = spark.read.parquet(f"{sf}/nation.parquet").select(F.concat_ws("\t", F.concat(F.lit('"'), "n_name", F.lit('"')), (key * 1000).cast("string"), (key / 10).cast("string")).alias("value"))
    return tabular.read_composition(spark, _lines_file(spark, rows, "comp", "Repeat_type\tTotal_size [bp]\tProportion [%]"))


@query("SELECT 'r' || c_custkey AS rule, CAST(c_custkey * 10 AS DOUBLE) AS s, CASE WHEN c_custkey % 2 = 0 THEN c_custkey * 2.5 END AS max_rss, c_custkey * 8.0 AS cpu_time, '0:00:10' AS hms FROM customer")
def src_bench_tsv(spark, sf):
    path, key = scratch.folder(spark, "bench"), F.col("c_custkey")
    line = F.concat_ws("\t", (key * 10).cast("string"), F.lit("0:00:10"), F.when(key % 2 == 0, (key * 2.5).cast("string")).otherwise("-"), (key * 8).cast("string"))
    rows = spark.read.parquet(f"{sf}/customer.parquet").select(F.concat(F.lit("r"), key.cast("string")).alias("bucket"), line.alias("value"))
    write_buckets(rows, path, [], "s\th:m:s\tmax_rss\tcpu_time", ".tsv")
    return tabular.read_benchmarks(spark, path).select("rule", "s", "max_rss", "cpu_time", "hms")


_VOCABULARY = """version: 1
classifications:
  - Class_I
  - "Class_I/LTR"   # quoted
  - Class_II/Subclass_1/TIR/hAT
special_classes:
  Satellite: Satellite
  Unknown: Unknown
leaf_aliases:
  "Ty1/copia": Ty1_copia
aggregation_buckets:
  Mobile_elements:
    description: all
tool_dialects:
  DANTE_TIR:
    hierarchy_prefixes:
      - underscore: "Class_II_"
        canonical:  "Class_II/"
      - underscore: "Class_II_Subclass_1_TIR_"
        canonical:  "Class_II/Subclass_1/TIR/"
"""


@query("""SELECT * FROM (VALUES ('Class_I|LTR', 'Class_I/LTR', true), ('Class_II_Subclass_1_TIR_hAT', 'Class_II/Subclass_1/TIR/hAT', true), ('Class_II_x', 'Class_II/x', false), ('Ty1/copia|y', 'Ty1_copia/y', false),
    ('Satellite', 'Satellite', true), ('Mobile_elements', 'Mobile_elements', true), ('Simple_repeat', 'Simple_repeat', false)) t(raw, canonical, known)""")
def src_vocab_yaml(spark, sf):
    vocab = tabular.read_vocabulary(spark, _lines_file(spark, spark.createDataFrame([(_VOCABULARY,)], "value string").coalesce(1), "vocab") + "/part-*")
    raw = spark.createDataFrame([(x,) for x in ("Class_I|LTR", "Class_II_Subclass_1_TIR_hAT", "Class_II_x", "Ty1/copia|y", "Satellite", "Mobile_elements", "Simple_repeat")], "raw string")
    label = lb.canonicalise(F.col("raw"), vocab=vocab)
    return raw.select("raw", label.alias("canonical"), lb.is_canonical(label, vocab).alias("known"))


@query("SELECT CASE WHEN trc = 'TRC_5' THEN 'TRC_5_x' ELSE trc END || '.gff3' AS file, count(*) AS n, min(s0) + 1 AS first_start, true AS headed, true AS sorted FROM fx_trc WHERE trc <> 'TRC_0' GROUP BY ALL", "fx_trc")
def snk_split_by_name(spark, sf):
    name = F.when(F.col("trc") == "TRC_0", "").when(F.col("trc") == "TRC_5", "TRC_5/x").otherwise(F.col("trc"))
    rows = view(spark, sf, "fx_trc").select("seqid", (F.col("s0") + 1).alias("start_pos"), F.col("e0").alias("end_pos"), "strand", F.lit("x").alias("source_tool"), name.alias("Name"))
    path = scratch.folder(spark, "split")
    sinks.write_by_name(rows, path, "Name", ["Name"], prefix="TRC_")
    return _files_read_back(spark, path)


def _files_read_back(spark, path: str):
    """By file (its number left out): rows, first start, whether the header comes first and the rows are in order."""
    from pyspark.sql import Window as W

    lines = ranges.read_lines(spark, path)
    c = F.split("value", "\t")
    rows = lines.select("file", "split", "line", F.col("value").startswith("#").alias("head"), c[0].alias("q"), F.get(c, F.lit(3)).try_cast("long").alias("s"))
    before = F.lag(F.struct("head", "q", "s")).over(W.partitionBy("file").orderBy("split", "line"))
    rows = rows.withColumn("b", before)
    fine = F.when(F.col("b").isNull(), F.col("head")).otherwise(~F.col("head") & (F.col("b.head") | (F.struct("b.q", "b.s") <= F.struct("q", "s"))))
    name = F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"\.\d{5}(?=\.gff3$)", "")
    out = rows.groupBy(name.alias("file")).agg(F.count_if(~F.col("head")).alias("n"), F.min("s").alias("first_start"), F.bool_and(F.col("b").isNotNull() | F.col("head")).alias("headed"), F.bool_and(fine).alias("sorted"))
    return out


@query("""WITH g AS (SELECT CASE WHEN classification LIKE 'rDNA%' THEN classification ELSE name END AS nm, * FROM fx_unified WHERE id IS NULL OR starts_with(id, 'UA_L1_')),
    r AS (SELECT *, CASE WHEN regexp_matches(nm, '^(TRC_|Satellite)') THEN 'Tandem_repeats' WHEN contains(nm, 'Simple_repeat') THEN 'Simple_repeat' ELSE nm END AS grp FROM g),
    x AS (SELECT start_pos, unnest(list_distinct([replace(grp, '/', '.'), CASE WHEN starts_with(grp, 'Class') THEN 'Mobile_elements' END, CASE WHEN starts_with(grp, 'Simple_repeat') THEN 'Simple_repeats' END, CASE WHEN starts_with(grp, 'Low_complexity') THEN 'Low_complexity' END,
        CASE WHEN starts_with(grp, 'rDNA') THEN 'rDNA' END, CASE WHEN contains(grp, 'copia') THEN 'All_Ty1_Copia' END, CASE WHEN contains(grp, 'gypsy') THEN 'All_Ty3_Gypsy' END, CASE WHEN contains(grp, 'Class_II/Subclass_1/TIR') THEN 'Class_II.Subclass_1.TIR' END, CASE WHEN structure = 'LTR_RT_TR' THEN 'LTR_RT_TR' END])) AS bucket FROM r)
    SELECT bucket || '.gff3' AS file, count(*) AS n, min(start_pos) AS first_start, true AS headed, true AS sorted FROM x WHERE bucket IS NOT NULL GROUP BY bucket""", "fx_unified")
def snk_class_files(spark, sf):
    path = scratch.folder(spark, "classes")
    sinks.write_by_class(view(spark, sf, "fx_unified"), path, ["id", "name", "classification"])
    return _files_read_back(spark, path).filter("n > 0")


@query(f"SELECT CAST(doc_id AS VARCHAR) AS seqid, length(seq) AS length, least(60, length(seq)) AS bases FROM {_BASES}", "fx_sequences")
def src_fasta_index(spark, sf):
    return ranges.index_of(spark, _indexed(spark, sf)).select("seqid", "length", "bases")


def _indexed(spark, sf) -> str:
    path = f"{scratch.folder(spark, 'indexed')}/genome.fa"
    sinks.write_indexed(_bases(spark, sf).select(F.col("doc_id").cast("string").alias("name"), "seq"), path)
    return path


@query(f"""SELECT CAST(doc_id AS VARCHAR) AS name, k * 200 AS "offset", md5(substr(seq, k * 200 + 1, 200)) AS digest, true AS narrow FROM (SELECT *, unnest(range(2, greatest(2, (length(seq) + 199) // 200))) AS k FROM {_BASES} WHERE doc_id IN (3, 17, 42))""", "fx_sequences")
def src_fasta_pushed(spark, sf):
    path = _indexed(spark, sf)
    parts = ranges.read_indexed(spark, path, size=200).filter(F.col("name").isin("3", "17", "42") & (F.col("offset") >= 400))
    size = _bases(spark, sf).agg(F.sum(F.length("seq")).alias("_all"))
    read = parts.agg(F.sum("read_bytes").alias("_read")).crossJoin(F.broadcast(size))
    narrow = read.select((F.col("_read") < 0.2 * F.col("_all")).alias("narrow"))
    return parts.select("name", "offset", F.md5(F.col("seq").cast("binary")).alias("digest")).crossJoin(F.broadcast(narrow))


@query(f"""SELECT o_orderkey AS id, substr(seq, start_pos, end_pos - start_pos + 1) AS bases FROM (SELECT o_orderkey, o_custkey % (SELECT count(*) FROM documents) AS d, 1 + o_custkey % 400 AS start_pos, o_custkey % 400 + o_orderkey % 90 AS end_pos FROM orders) r JOIN {_BASES} ON doc_id = d""", "fx_sequences")
def src_fasta_regions(spark, sf):
    path = _indexed(spark, sf)
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    key, at = F.col("o_orderkey"), F.col("o_custkey") % 400
    regions = spark.read.parquet(f"{sf}/orders.parquet").select(key.alias("id"), (F.col("o_custkey") % n).cast("string").alias("seqid"), (at + 1).alias("start_pos"), (at + key % 90).alias("end_pos"))
    return ranges.read_regions(regions, ranges.index_of(spark, path), path).select("id", "bases")


@query(_PARTS_SQL, "fx_sequences")
def src_fasta_blocks(spark, sf):
    path = f"{scratch.folder(spark, 'blocks')}/genome.fa"
    rows = _bases(spark, sf).select(F.concat("header", F.lit(" doc "), F.col("doc_id").cast("string")).alias("name"), "seq")
    sinks.write_packed(rows, path)
    return _digests(tabular.read_sequence_parts(spark, path, 700, check=">"))


@query(f"SELECT doc_id, CAST(ceil(length(seq) / 80) AS BIGINT) AS lines, md5(seq) AS digest FROM {_BASES}", "fx_sequences")
def snk_fasta_wrap(spark, sf):
    path = scratch.folder(spark, "wrap")
    sinks.write_fasta(_bases(spark, sf).select(F.col("doc_id").cast("string").alias("header"), "seq"), path, width=80)
    rows = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>|\n$", "").alias("v"))
    lines = F.split("v", "\n")
    return rows.select(lines[0].cast("long").alias("doc_id"), (F.size(lines) - 1).cast("long").alias("lines"), F.md5(F.array_join(F.slice(lines, 2, F.size(lines)), "").cast("binary")).alias("digest"))


@query(f"""WITH {_density_sql(200)}, c AS (SELECT seqid, start_pos, end_pos, score FROM dens),
    f AS (SELECT *, CASE WHEN lag(score) OVER (PARTITION BY seqid ORDER BY start_pos) = score THEN 0 ELSE 1 END AS n FROM c),
    g AS (SELECT *, sum(n) OVER (PARTITION BY seqid ORDER BY start_pos ROWS UNBOUNDED PRECEDING) AS r FROM f)
    SELECT seqid, min(start_pos) - 1 AS start0, max(end_pos) AS end0, min(score) AS score FROM g GROUP BY seqid, r""", "fx_features", "fx_seqs")
def snk_track(spark, sf):
    path = scratch.folder(spark, "track")
    sinks.write_track(tr.run_lengths(tr.density(view(spark, sf, "fx_features"), view(spark, sf, "fx_seqs"), 200)), path)
    c = F.split("value", "\t")
    return spark.read.text(path).select(c[0].alias("seqid"), c[1].cast("long").alias("start0"), c[2].cast("long").alias("end0"), c[3].cast("double").alias("score"))


@query(f"""WITH {_density_sql(200)}, c AS (SELECT seqid, start_pos, end_pos, CAST(CAST(score AS FLOAT) AS DOUBLE) AS score FROM dens),
    f AS (SELECT *, CASE WHEN lag(score) OVER (PARTITION BY seqid ORDER BY start_pos) = score THEN 0 ELSE 1 END AS n FROM c),
    g AS (SELECT *, sum(n) OVER (PARTITION BY seqid ORDER BY start_pos ROWS UNBOUNDED PRECEDING) AS r FROM f)
    SELECT seqid, min(start_pos) AS start_pos, max(end_pos) AS end_pos, min(score) AS score FROM g GROUP BY seqid, r""", "fx_features", "fx_seqs")
def snk_bigwig(spark, sf):
    path = f"{scratch.folder(spark, 'track')}/density.bw"
    fine = tr.density(view(spark, sf, "fx_features"), view(spark, sf, "fx_seqs"), 200).withColumn("score", F.col("score").cast("float"))
    bigwig.write_bigwig(tr.run_lengths(fine), view(spark, sf, "fx_seqs"), path)
    return bigwig.read_bigwig(spark, path)


# Headers, attributes, subtypes and loaders


def _headers(spark, sf):
    key = F.col("c_custkey")
    cls = F.element_at(F.array(*map(F.lit, ("Class_I|LTR|Ty1/copia|Ale", "Class_I/LINE", "Class_I|LTR|Ty3/gypsy"))), (key % 3 + 1).cast("int"))
    return spark.read.parquet(f"{sf}/customer.parquet").select(key.alias("id"), F.when(key % 5 == 0, F.concat(F.lit("bare"), key.cast("string"))).otherwise(F.concat(F.lit("s"), key.cast("string"), F.lit("#"), cls, F.lit(" len=9"))).alias("header"), cls.alias("cls"))


_HEADER_SQL = "(SELECT c_custkey AS id, ['Class_I|LTR|Ty1/copia|Ale', 'Class_I/LINE', 'Class_I|LTR|Ty3/gypsy'][c_custkey % 3 + 1] AS cls, ['Class_I/LTR/Ty1_copia/Ale', 'Class_I/LINE', 'Class_I/LTR/Ty3_gypsy'][c_custkey % 3 + 1] AS canon FROM customer)"


@query(f"SELECT id, CASE WHEN id % 5 = 0 THEN 'bare' || id ELSE 's' || id || '#' || canon || ' len=9' END AS header, id % 5 <> 0 AND cls <> canon AS rewritten FROM {_HEADER_SQL}")
def canon_fasta_headers(spark, sf):
    return mb.canonical_headers(_headers(spark, sf)).select("id", "header", "rewritten")


def _attributed(spark, sf):
    rows = _headers(spark, sf)
    pairs = F.map_from_arrays(F.array(F.lit("ID"), F.lit("Final_Classification"), F.lit("Name")), F.array(F.col("id").cast("string"), "cls", F.lit("n")))
    return rows.select("id", F.when(F.col("id") % 5 == 0, F.create_map(F.lit("ID"), F.col("id").cast("string"))).otherwise(pairs).alias("attrs"))


@query(f"SELECT id, CASE WHEN id % 5 <> 0 THEN canon END AS value, id % 5 <> 0 AND cls <> canon AS rewritten FROM {_HEADER_SQL}")
def canon_gff_attr(spark, sf):
    rows = mb.canonical_attribute(_attributed(spark, sf), "Final_Classification", "DANTE")
    return rows.select("id", F.try_element_at("attrs", F.lit("Final_Classification")).alias("value"), "rewritten")


@query(f"SELECT 'attribute' AS kind, cls AS value, count(*) AS n FROM {_HEADER_SQL} WHERE id % 5 <> 0 GROUP BY cls UNION ALL SELECT 'header', cls, count(*) FROM {_HEADER_SQL} WHERE id % 5 <> 0 GROUP BY cls")
def collect_attr(spark, sf):
    a = mb.attribute_values(_attributed(spark, sf), "Final_Classification").groupBy("value").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("attribute"))
    b = mb.header_classes(_headers(spark, sf)).groupBy("value").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("header"))
    return a.unionByName(b)


@query(f"SELECT id, CASE WHEN id % 5 <> 0 THEN canon END AS name FROM {_HEADER_SQL}")
def clean_names(spark, sf):
    return mb.clean_names(_attributed(spark, sf)).select("id", F.try_element_at("attrs", F.lit("Name")).alias("name"))


@query("SELECT doc_id, header FROM fx_sequences WHERE regexp_matches(header, 'Class_I/LTR/.*/(Ale|CRM)$')", "fx_sequences")
def filter_fasta_regex(spark, sf):
    return mb.matching(view(spark, sf, "fx_sequences"), "Class_I/LTR/.*/(Ale|CRM)$").select("doc_id", "header")


_SUBTYPED = """(SELECT *, CASE fid % 4 WHEN 0 THEN 'Class_II|Subclass_1|TIR|hAT' WHEN 1 THEN 'Class_II|Subclass_1|TIR|Mu DR/x' WHEN 2 THEN 'Class_II|Subclass_1|TIR' ELSE 'Class_II|Subclass_2|TIR|P' END AS cls FROM fx_domains)"""
_GOOD = "name = 'TPase' AND contains(cls, 'Subclass_1') AND identity >= 0.35 AND similarity >= 0.45 AND relat_interruptions <= 3 AND relat_length BETWEEN 0.8 AND 1.2 AND len(string_split(cls, '|')) >= 4"


@query(f"""SELECT fid, string_split(cls, '|')[-1] AS subtype, 'Class_II_Subclass_1_TIR_' || regexp_replace(regexp_replace(string_split(cls, '|')[-1], '[^A-Za-z0-9_.-]+', '_', 'g'), '^_+|_+$', '', 'g') || '_' || row_number() OVER (PARTITION BY string_split(cls, '|')[-1] ORDER BY seqid, start_pos, end_pos, strand) || '_partial' AS group_id
    FROM {_SUBTYPED} WHERE {_GOOD}""", "fx_domains")
def tir_subtype(spark, sf):
    cls = F.element_at(F.array(*map(F.lit, ("Class_II|Subclass_1|TIR|hAT", "Class_II|Subclass_1|TIR|Mu DR/x", "Class_II|Subclass_1|TIR", "Class_II|Subclass_2|TIR|P"))), (F.col("fid") % 4 + 1).cast("int"))
    good = lb.good_domain(*[F.col(c) for c in ("identity", "similarity", "relat_length", "relat_interruptions")])
    rows = view(spark, sf, "fx_domains").withColumn("subtype", lb.tir_subtype(F.col("name"), cls, good)).filter("subtype IS NOT NULL")
    rows = od.placed_within(spark, rows, ["subtype"], ["seqid", "start_pos", "end_pos", "strand"])
    group = F.concat_ws("_", F.lit("Class_II_Subclass_1_TIR"), lb.sanitised(F.col("subtype")), F.col("place").cast("string"), F.lit("partial"))
    return rows.select("fid", "subtype", group.alias("group_id"))


@query("SELECT o_orderkey AS id, o_orderkey % 4 AS kind FROM orders WHERE o_orderkey % 4 = 3 OR o_custkey % 3 = 0")
def select_by_ids(spark, sf):
    key = F.col("o_orderkey").cast("string")
    wanted = F.concat(F.lit("w"), F.col("o_custkey").cast("string"))
    kinds = [F.create_map(F.lit("ID"), wanted, F.lit("Parent"), F.lit("no")), F.create_map(F.lit("Parent"), wanted, F.lit("Group_ID"), F.lit("no")), F.create_map(F.lit("Group_ID"), wanted), F.create_map(F.lit("Note"), key)]
    attrs = F.when(F.col("o_orderkey") % 4 == 0, kinds[0]).when(F.col("o_orderkey") % 4 == 1, kinds[1]).when(F.col("o_orderkey") % 4 == 2, kinds[2]).otherwise(kinds[3])
    rows = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("id"), "o_custkey", attrs.alias("attrs"))
    ids = rows.filter("o_custkey % 3 = 0").select(F.concat(F.lit("w"), F.col("o_custkey").cast("string")).alias("id"))
    return mb.selected(rows.drop("o_custkey"), ids).select("id", (F.col("id") % 4).alias("kind"))


@query("SELECT header, seq FROM fx_sequences WHERE doc_id % 2 = 0 AND contains(header, 'Class_II/Subclass_1') UNION ALL SELECT header, seq FROM fx_sequences WHERE doc_id % 2 = 1", "fx_sequences")
def make_subclass_2(spark, sf):
    rows = view(spark, sf, "fx_sequences")
    return mb.second_subclass_library(rows.filter("doc_id % 2 = 1").select("header", "seq"), rows.filter("doc_id % 2 = 0").select("header", "seq"))


@query("SELECT 'el_' || doc_id || '#' || split_part(header, '#', 2) AS header, seq FROM fx_sequences WHERE doc_id % 3 = 0", "fx_sequences")
def fallback_representatives(spark, sf):
    rows = view(spark, sf, "fx_sequences")
    library = rows.select(sq.header_name(F.col("header")).alias("name"), "seq")
    wanted = rows.filter("doc_id % 3 = 0").select(sq.header_name(F.col("header")).alias("id"), sq.header_class(F.col("header")).alias("class"))
    return mb.representatives(library, wanted)


@query("""WITH r AS (SELECT doc_id AS idx, split_part(header, '#', 2) AS class, split_part(header, '#', 1) AS h, doc_id % 3 AS part FROM fx_sequences), n AS (SELECT class, row_number() OVER (ORDER BY encode(class)) AS number FROM (SELECT DISTINCT class FROM r))
    SELECT CAST(part AS INT) AS part, class, row_number() OVER (ORDER BY part, encode(class), idx) AS place, CASE part WHEN 0 THEN h || '_' || number || '#' || class ELSE h END AS header FROM r JOIN n USING (class)""", "fx_sequences")
def reduced_library(spark, sf):
    rows = view(spark, sf, "fx_sequences").select(F.col("doc_id").alias("idx"), sq.header_class(F.col("header")).alias("class"), sq.header_name(F.col("header")).alias("header"), "seq", (F.col("doc_id") % 3).alias("_p"))
    parts = [rows.filter(f"_p = {i}").drop("_p") for i in range(3)]
    return mb.reduced_library(*parts).select("part", "class", "place", "header")


_ENDS = "(SELECT doc_id AS id, split_part(header, '#', 2) AS class, substring(seq, 1, 30) AS seq FROM fx_sequences)"


def _ends(spark, sf):
    return view(spark, sf, "fx_sequences").select(F.col("doc_id").alias("id"), sq.header_class(F.col("header")).alias("class"), sq.end_region(F.col("seq"), "start").alias("seq"))


@query(f"SELECT a.id AS qid, b.id AS sid, a.seq AS query, b.seq AS ref FROM {_ENDS} a JOIN {_ENDS} b USING (class) WHERE a.id < b.id AND class LIKE 'Class_I/LTR/%'", "fx_sequences")
def pairs_all(spark, sf):
    return mb.all_pairs(_ends(spark, sf).filter("class LIKE 'Class_I/LTR/%'"), ["class"]).select("qid", "sid", "query", "ref")


@query(f"""WITH e AS (SELECT *, count(*) OVER (PARTITION BY class) AS n FROM {_ENDS}), c AS (SELECT DISTINCT least(l_orderkey % 300, l_partkey % 300) AS x, greatest(l_orderkey % 300, l_partkey % 300) AS y FROM lineitem)
    SELECT a.id AS qid, b.id AS sid, class FROM e a JOIN e b USING (class) WHERE a.id < b.id AND (a.n < 20 OR EXISTS (SELECT 1 FROM c WHERE c.x = a.id AND c.y = b.id))""", "fx_sequences")
def pairs_filtered(spark, sf):
    candidates = spark.read.parquet(f"{sf}/lineitem.parquet").select((F.col("l_orderkey") % 300).alias("qid"), (F.col("l_partkey") % 300).alias("sid"))
    return mb.candidate_pairs(_ends(spark, sf), ["class"], candidates, 20).select("qid", "sid", "class")


@query(None)
def align_nw(spark, sf):
    return al.align_pairs(mb.all_pairs(_ends(spark, sf), ["class"]).drop("class"))


def _primes(spark, sf):
    """What lies beside elements: regions of sequences before and behind them, by the element's class and side."""
    rows = view(spark, sf, "fx_sequences")
    sides = [rows.select(F.col("doc_id").alias("id"), sq.header_class(F.col("header")).alias("class"), F.lit(f"{p}prime").alias("prime"), sq.end_region(F.col("seq"), e, 60).alias("seq")) for p, e in (("5", "start"), ("3", "end"))]
    return sides[0].unionByName(sides[1])


@query(None)
def prime_anchoring(spark, sf):
    return al.anchored_flanks(mb.all_pairs(_primes(spark, sf), ["class", "prime"]))


@query(None)
def prime_lengths_by_alignment(spark, sf):
    """From flanks to the length that each element is extended by: seeds, alignment, n-th largest span."""
    ends = _primes(spark, sf)
    found = al.anchored_flanks(sd.seeded_pairs(spark, ends, ["class", "prime"]))
    spans = [ht.nth_largest(found.filter(f"prime = '{p}'"), 2).withColumn("prime", F.lit(p)) for p in ("5prime", "3prime")]
    return spans[0].unionByName(spans[1])


@query(f"""WITH RECURSIVE {_density_sql(STEP)}, pt AS (SELECT seqid AS track, CAST(start_pos AS DOUBLE) AS x, CASE WHEN start_pos % 7 <> 0 THEN score END AS y FROM dens),
    ln AS MATERIALIZED (SELECT *, sum(CASE WHEN y IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY track ORDER BY x) AS l FROM pt),
    ok AS MATERIALIZED (SELECT track, l, x, y FROM ln WHERE y IS NOT NULL), en AS (SELECT track, l, min({{'x': x, 'y': y}}) AS a, max({{'x': x, 'y': y}}) AS b FROM ok GROUP BY track, l),
    sg AS (SELECT track, l, a, b FROM en UNION ALL
        SELECT track, l, CASE WHEN side = 0 THEN a ELSE {{'x': -m.o, 'y': m.y}} END, CASE WHEN side = 0 THEN {{'x': -m.o, 'y': m.y}} ELSE b END FROM (
            SELECT sg.track, sg.l, sg.a, sg.b, max({{'d': abs(ok.y - (sg.a.y + (ok.x - sg.a.x) / (sg.b.x - sg.a.x) * (sg.b.y - sg.a.y))), 'o': -ok.x, 'y': ok.y}}) AS m
            FROM sg JOIN ok ON ok.track = sg.track AND ok.l = sg.l AND ok.x > sg.a.x AND ok.x < sg.b.x GROUP BY sg.track, sg.l, sg.a, sg.b) z, (VALUES (0), (1)) AS v(side) WHERE m.d > 0.02)
    SELECT track, x, y FROM pt WHERE y IS NULL UNION SELECT track, a.x, a.y FROM sg UNION SELECT track, b.x, b.y FROM sg""", "fx_features", "fx_seqs")
def rdp(spark, sf):
    track = _track(spark, sf).select(F.col("seqid").alias("track"), F.col("start_pos").cast("double").alias("x"), F.when(F.col("start_pos") % 7 != 0, F.col("score")).alias("y"))
    return si.simplified(spark, track, 0.02)


@query("""SELECT source_tool, source_tier, classification, name, element_type, structure, copy_number, member, count(*) AS n FROM (
    SELECT 'DANTE_LTR' AS source_tool, 1 AS source_tier, replace(replace(replace(final_classification, 'Ty1/copia', 'Ty1_copia'), 'Ty3/gypsy', 'Ty3_gypsy'), '|', '/') AS classification,
        replace(replace(replace(final_classification, 'Ty1/copia', 'Ty1_copia'), 'Ty3/gypsy', 'Ty3_gypsy'), '|', '/') AS name, CASE WHEN starts_with(id, 'TE_partial_') THEN 'partial' ELSE 'complete' END AS element_type, CAST(NULL AS VARCHAR) AS structure, CAST(NULL AS VARCHAR) AS copy_number,
        id IN (SELECT unnest(string_split(members, ',')) FROM chain) AS member FROM fx_ltr_elements
    UNION ALL SELECT 'DANTE_LTR', 1, cls, cls, NULL, 'LTR_RT_TR', CAST(copy_number AS VARCHAR), false FROM (SELECT *, replace(replace(replace(final_classification, 'Ty1/copia', 'Ty1_copia'), 'Ty3/gypsy', 'Ty3_gypsy'), '|', '/') AS cls FROM chain)
    UNION ALL SELECT CASE WHEN fid % 2 = 0 THEN 'TideCluster_default' ELSE 'TideCluster_short' END, 3, CASE WHEN fid % 31 = 0 THEN 'rDNA/45S_rDNA' WHEN trc = 'TRC_4' AND fid % 2 = 0 THEN 'rDNA/5S_rDNA' ELSE 'Satellite/TideCluster/' || trc END, trc, NULL, NULL, NULL, false FROM fx_trc
    UNION ALL SELECT 'RepeatMasker', 5, classification, classification, NULL, NULL, NULL, false FROM fx_small
    UNION ALL SELECT 'DANTE_TIR', 1, 'Class_II/Subclass_1/TIR/hAT', 'Class_II/Subclass_1/TIR/hAT', NULL, NULL, NULL, false FROM fx_small WHERE source_tier = 1
    UNION ALL SELECT 'DANTE_LINE', 1, 'Class_I/LINE', 'Class_I/LINE', NULL, NULL, NULL, false FROM fx_small WHERE source_tier = 2
    UNION ALL SELECT 'DANTE', 2, 'Class_I/LINE', 'Class_I/LINE', NULL, NULL, NULL, false FROM fx_domains
    UNION ALL SELECT 'TideCluster_RM', 4, CASE WHEN trc = 'TRC_4' THEN 'rDNA/5S_rDNA' ELSE 'Satellite/TideCluster/' || trc END, trc, NULL, NULL, NULL, false FROM fx_trc WHERE fid % 3 = 0
    UNION ALL SELECT 'TideHunter', 6, 'Satellite/Unknown', 'Satellite/Unknown', NULL, NULL, NULL, false FROM runs) GROUP BY ALL""".replace("FROM runs", "FROM " + islands("(SELECT seqid, strand, s0 + 1 AS s, e0 AS e FROM fx_sfhits)", "seqid, strand")).replace("chain", """(WITH p AS (SELECT parent AS id, min({'s': start_pos, 'e': end_pos}) AS f, max({'s': start_pos, 'e': end_pos}) AS l FROM fx_ltr_parts GROUP BY parent),
    o AS (SELECT *, lag(l) OVER w AS pl, lag(strand) OVER w AS ps, lag(final_classification) OVER w AS pc FROM fx_ltr_elements LEFT JOIN p USING (id) WHERE NOT starts_with(id, 'TE_partial') WINDOW w AS (PARTITION BY seqid ORDER BY start_pos, end_pos, id)),
    f AS (SELECT *, CASE WHEN ps = strand AND pc = final_classification AND greatest(0, least(pl.e, f.e) - greatest(pl.s, f.s) + 1) / least(pl.e - pl.s + 1, f.e - f.s + 1) >= 0.5 THEN 0 ELSE 1 END AS n FROM o),
    g AS (SELECT *, sum(n) OVER (PARTITION BY seqid ORDER BY start_pos, end_pos, id ROWS UNBOUNDED PRECEDING) AS c FROM f)
    SELECT min(final_classification) AS final_classification, count(*) AS copy_number, string_agg(id, ',' ORDER BY start_pos, end_pos, id) AS members FROM g GROUP BY seqid, c HAVING count(*) >= 2)"""), "fx_ltr_elements", "fx_ltr_parts", "fx_trc", "fx_small", "fx_domains", "fx_sfhits")
def tier_loaders(spark, sf):
    rows, members = _from_files(spark, sf)
    both = rows.withColumn("member", F.lit(False)).unionByName(members.withColumn("member", F.lit(True)))
    return both.groupBy("source_tool", "source_tier", "classification", "name", "element_type", "structure", "copy_number", "member").agg(F.count(F.lit(1)).alias("n"))


def source_tables(spark, sf):
    """Feature tables of all sources, in the columns of the feature reader."""

    def features(df, kind, **attrs):
        pairs = F.map_filter(F.map_from_arrays(F.array(*map(F.lit, attrs)), F.array(*[a.cast("string") for a in attrs.values()])), lambda k, v: v.isNotNull())
        kind = kind if not isinstance(kind, str) else F.lit(kind)
        return df.select("seqid", F.col("start_pos").cast("long").alias("start_pos"), F.col("end_pos").cast("long").alias("end_pos"), "strand", kind.alias("type"), pairs.alias("attrs"))

    elements = view(spark, sf, "fx_ltr_elements")
    chains = pt.ltr_tandems(elements, view(spark, sf, "fx_ltr_parts"))
    trc = view(spark, sf, "fx_trc").select("seqid", (F.col("s0") + 1).alias("start_pos"), F.col("e0").alias("end_pos"), "strand", "trc", "fid")
    small = view(spark, sf, "fx_small").withColumn("strand", F.lit("+"))
    runs = view(spark, sf, "fx_sfhits").select("seqid", "strand", (F.col("s0") + 1).alias("start_pos"), F.col("e0").alias("end_pos"), "trc")
    arrays = [features(trc.filter(f"fid % 2 = {i}"), "repeat_region", Name=F.col("trc"), rDNA_type=F.when(F.col("fid") % 31 == 0, "45S")) for i in (0, 1)]
    return {
        "ltr": features(elements, "transposable_element", ID=F.col("id"), Final_Classification=F.col("final_classification")),
        "tandems": features(chains, "transposable_element", members=F.col("members"), Final_Classification=F.col("final_classification"), copy_number=F.col("copy_number")),
        "tir": features(small.filter("source_tier <= 2"), F.when(F.col("source_tier") == 1, "sequence_feature").otherwise("protein_domain"), Classification=F.lit("Class_II_Subclass_1_TIR_hAT")),
        "line": features(small.filter("source_tier IN (2, 3)"), F.when(F.col("source_tier") == 2, "LINE_element").otherwise("protein_domain"), ID=F.col("fid")),
        "domains": features(view(spark, sf, "fx_domains"), "protein_domain", Name=F.col("name"), Final_Classification=F.lit("Class_I|LINE")),
        "clusters": arrays[0], "short_clusters": arrays[1],
        "cluster_hits": features(trc.filter("fid % 3 = 0"), "repeat_region", Name=F.col("trc")),
        "hits": features(small, "repeat_region", Name=F.col("classification")),
        "runs_a": features(runs.filter("trc < 'TRC_5'"), "repeat_region"), "runs_b": features(runs.filter("trc >= 'TRC_5'"), "repeat_region"),
    }


def loaded(tables):
    rdna = next(iter(tables.values())).sparkSession.createDataFrame([("TRC_4", "rDNA/5S_rDNA")], "trc string, class string")
    given = {k: v for k, v in tables.items() if not k.startswith("runs_")}
    return tl.all_tiers(**given, rdna=rdna, tandem_runs=[tables["runs_a"], tables["runs_b"]])


def _from_files(spark, sf):
    """Tier rows and tandem members of all sources, each written to its own files and read from them."""
    read = {}
    for name, df in source_tables(spark, sf).items():
        path = scratch.folder(spark, name)
        sinks.write_features(df, path)
        read[name] = tabular.read_gff3(spark, path)
    return loaded(read)


#: Attributes of the annotation's file.
ATTRIBUTES = ["id", "name", "classification", "source_tier", "source_tool", "element_type", "structure", "copy_number", "te_origin", "te_origin_structure", "in_structure", "member_of", "parent"]


def annotated(spark, rows, members):
    """The annotation of tier rows, gated by their residual tandems."""
    rows = scratch.settled(spark, rows)
    return rs.finalised(spark, rs.tier_resolve(spark, rows, rows.filter("source_tier = 6"), members))


def read_annotation(spark, path: str):
    """An annotation's files in the columns of the contract."""
    rows = tabular.read_gff3(spark, path)
    at = {c: F.try_element_at("attrs", F.lit(c)) for c in ATTRIBUTES}
    at["source_tier"] = at["source_tier"].cast("int")
    level = F.when(at["id"].startswith("UA_L2_"), 2).otherwise(1)
    return rows.select(at["id"].alias("id"), "seqid", "source", "type", "start_pos", "end_pos", "strand", *[at[c].alias(c) for c in ATTRIBUTES[1:]], level.alias("level")).select(*rs.FINAL)


@query(None)
def annotation_from_files(spark, sf):
    """Source files of all nine kinds to one annotation file, read back; its broken rules count in ``violations``."""
    path = scratch.folder(spark, "annotation")
    sinks.write_gff3(annotated(spark, *_from_files(spark, sf)), path, ATTRIBUTES)
    back = read_annotation(spark, path)
    broken = rs.violations(back).agg(F.count(F.lit(1)).alias("violations"))
    return back.crossJoin(F.broadcast(broken))


def entry(spark: SparkSession, sf: str) -> DataFrame:
    """Share of the genome by class and union bases, on the smallest tables."""
    stats = summary_stats(spark, sf)
    return stats.crossJoin(F.broadcast(union_bp(spark, sf).withColumnRenamed("bp", "union_bp")))
