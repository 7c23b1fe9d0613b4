"""Mappings of the star-schema tables to features, sequences and hits, as SQL for both engines."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")

#: Name: (views it needs, SQL valid in Spark and DuckDB).
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "fx_seqs": ((), "SELECT seqid, CAST(length AS BIGINT) AS length FROM (VALUES ('chr1',3000600),('chr2',3000600),('chr3',3000600),('chr4',3000600),('chr5',3000600)) AS t(seqid,length)"),
    "fx_class": ((), "SELECT k, cls FROM (VALUES (0,'Class_I/LTR/Ty1_copia/Ale'),(1,'Class_I/LTR/Ty1_copia/Angela'),(2,'Class_I/LTR/Ty3_gypsy/chromovirus/Tekay'),(3,'Class_I/LTR/Ty3_gypsy/chromovirus/CRM'),(4,'Class_I/LTR'),(5,'Class_I/LINE'),(6,'Class_II/Subclass_1/TIR/hAT'),(7,'Class_II/Subclass_1/TIR/EnSpm_CACTA'),(8,'Satellite/FabTR-1'),(9,'Simple_repeat'),(10,'Low_complexity'),(11,'rDNA/45S_rDNA/18S')) AS t(k,cls)"),
    "fx_layer": ((), "SELECT k, tool, tier FROM (VALUES (0,'DANTE_LTR',1),(1,'DANTE_TIR',1),(2,'DANTE_LINE',1),(3,'DANTE',2),(4,'TideCluster_default',3),(5,'TideCluster_short',3),(6,'TideCluster_RM',4),(7,'RepeatMasker',5),(8,'RepeatMasker',5),(9,'TideHunter',6)) AS t(k,tool,tier)"),
    "fx_features": (("fx_class", "fx_layer"), """
        SELECT f.fid, f.seqid, f.start_pos, f.start_pos + f.width - 1 AS end_pos, f.strand, c.cls AS classification, y.tool AS source_tool, y.tier AS source_tier
        FROM (SELECT l_orderkey * 1000000000000 + l_linenumber * 100000000000 + l_partkey * 100000 + l_suppkey AS fid,
                concat('chr', CAST(l_suppkey % 5 + 1 AS STRING)) AS seqid,
                (l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 3000000 + 1 AS start_pos,
                CAST(l_quantity AS BIGINT) * 10 AS width,
                CASE l_returnflag WHEN 'A' THEN '+' WHEN 'R' THEN '-' ELSE '*' END AS strand,
                CAST(l_partkey % 12 AS INT) AS ck, CAST((l_partkey + l_linenumber) % 10 AS INT) AS lk FROM lineitem) f
        JOIN fx_class c ON c.k = f.ck JOIN fx_layer y ON y.k = f.lk"""),
    "fx_small": (("fx_class",), """
        SELECT o_orderkey AS fid, concat('chr', CAST(o_custkey % 5 + 1 AS STRING)) AS seqid,
               (o_orderkey * 7919 + o_custkey * 31) % 2000000 + 1 AS start_pos,
               (o_orderkey * 7919 + o_custkey * 31) % 2000000 + 40 + CAST(floor(o_totalprice) AS BIGINT) % 900 AS end_pos,
               CAST(o_orderkey % 6 AS INT) + 1 AS source_tier, c.cls AS classification
        FROM orders JOIN fx_class c ON c.k = CAST(o_custkey % 12 AS INT)"""),
    "fx_domains": ((), """
        SELECT event_id AS fid, concat('chr', CAST(user_id % 5 + 1 AS STRING)) AS seqid, event_id * 271 + 1 AS start_pos, event_id * 271 + 180 AS end_pos,
               CASE WHEN user_id % 2 = 0 THEN '+' ELSE '-' END AS strand,
               CASE event_type WHEN 'click' THEN 'ENDO' WHEN 'view' THEN 'RT' WHEN 'signup' THEN 'RH' WHEN 'purchase' THEN 'TPase' ELSE 'INT' END AS name,
               0.2 + value / 700.0 AS identity, 0.3 + value / 700.0 AS similarity, 0.7 + value / 800.0 AS relat_length, value / 120.0 AS relat_interruptions
        FROM events"""),
    "fx_ltr": ((), """
        SELECT o_orderkey AS id, concat('chr', CAST(o_orderkey % 5 + 1 AS STRING)) AS seqid, CASE WHEN o_custkey % 11 = 0 THEN '-' ELSE '+' END AS strand,
               CASE WHEN o_custkey % 7 = 0 THEN 'Class_I|LTR|Ty1/copia|Ale' ELSE 'Class_I|LTR|Ty3/gypsy|chromovirus|CRM' END AS final_classification,
               (o_orderkey - o_orderkey % 5) * 180 + 1 + CASE WHEN o_custkey % 3 = 0 THEN 60 ELSE 0 END AS start_pos,
               (o_orderkey - o_orderkey % 5) * 180 + 1000 + CASE WHEN o_custkey % 3 = 0 THEN 60 ELSE 0 END AS end_pos
        FROM orders"""),
    "fx_hits": ((), """
        SELECT qid, sid, pident, qstart, least(qstart + len - 1, qlen) AS qend, qlen, slen, least(len, qlen - qstart + 1) AS aln_len,
               sstart, sstart + len - 1 AS send, qcov
        FROM (SELECT l_partkey AS qid, (l_partkey + l_suppkey) % 2000 AS sid, 60 + l_quantity * 0.8 AS pident,
                l_orderkey * 13 % (200 + (l_partkey + l_suppkey) % 2000 % 10 * 100) + 1 AS sstart, 0.5 + l_quantity / 100 AS qcov,
                l_orderkey % (100 + l_partkey % 10 * 50) + 1 AS qstart, CAST(l_quantity AS BIGINT) * 12 AS len,
                200 + l_partkey % 10 * 100 AS qlen, 200 + (l_partkey + l_suppkey) % 2000 % 10 * 100 AS slen FROM lineitem) h"""),
    "fx_members": ((), """
        SELECT p_partkey % 10 AS cluster, p_partkey AS id, CASE WHEN p_partkey % 10 = 9 THEN 20 ELSE 200 + p_partkey % 10 * 100 END + p_partkey % 7 AS length
        FROM part"""),
    "fx_ltr_elements": (("fx_ltr",), """
        SELECT concat(CASE WHEN id % 17 = 0 THEN 'TE_partial_' ELSE 'TE_' END, CAST(id AS STRING)) AS id, seqid, start_pos, end_pos, strand, final_classification
        FROM fx_ltr"""),
    "fx_ltr_parts": (("fx_ltr",), """
        SELECT concat(CASE WHEN id % 17 = 0 THEN 'TE_partial_' ELSE 'TE_' END, CAST(id AS STRING)) AS parent,
               CASE WHEN k = 1 THEN start_pos ELSE end_pos - 79 - id % 40 END AS start_pos, CASE WHEN k = 1 THEN start_pos + 79 + id % 40 ELSE end_pos END AS end_pos
        FROM fx_ltr CROSS JOIN (VALUES (1), (2)) AS t(k) WHERE id % 13 <> 0"""),
    "fx_sfhits": ((), """
        SELECT concat('chr', CAST(event_id % 3 + 1 AS STRING)) AS seqid, CASE WHEN user_id % 2 = 0 THEN '+' ELSE '-' END AS strand,
               concat('TRC_', CAST(user_id % 9 AS STRING)) AS trc, event_id * 8 AS s0, event_id * 8 + 20 + CAST(floor(value) AS BIGINT) % 60 AS e0
        FROM events"""),
    "fx_monomers": ((), "SELECT trc, monomer FROM (VALUES ('TRC_0',21.5),('TRC_1',17.0),('TRC_3',40.0),('TRC_4',25.0),('TRC_6',18.5)) AS t(trc,monomer)"),
    "fx_superfamilies": ((), "SELECT trc, sf FROM (VALUES ('TRC_0','SF1'),('TRC_1','SF1'),('TRC_2','SF1'),('TRC_3','SF2'),('TRC_4','SF2')) AS t(trc,sf)"),
    "fx_tiers": (("fx_features",), """
        SELECT fid, seqid, start_pos, end_pos, strand, CASE WHEN source_tool LIKE 'Tide%' THEN concat('TRC_', CAST(fid % 50 AS STRING)) ELSE classification END AS name,
               classification, source_tool, source_tier, CASE WHEN source_tool = 'DANTE_LTR' AND fid % 11 <> 0 THEN 'complete' END AS element_type,
               CASE WHEN source_tool = 'DANTE_LTR' AND fid % 11 = 0 THEN 'LTR_RT_TR' END AS structure, CASE WHEN source_tool = 'DANTE_LTR' AND fid % 11 = 0 THEN '3' END AS copy_number
        FROM (SELECT *, row_number() OVER (PARTITION BY fid ORDER BY end_pos, strand) AS place FROM fx_features) f WHERE place = 1"""),
    "fx_tandem_members": (("fx_tiers",), """
        SELECT -fid AS fid, seqid, start_pos + 3 AS start_pos, end_pos - 3 AS end_pos, strand, name, classification, source_tool, source_tier,
               'complete' AS element_type, CAST(NULL AS STRING) AS structure, CAST(NULL AS STRING) AS copy_number
        FROM fx_tiers WHERE structure = 'LTR_RT_TR'"""),
    # An annotation in which the residue m of a row says what is wrong with it.
    "fx_unified": (("fx_tiers",), """
        SELECT CASE m WHEN 1 THEN concat('X', CAST(fid AS STRING)) WHEN 2 THEN 'UA_L1_00000002' WHEN 3 THEN NULL ELSE concat(CASE WHEN two THEN 'UA_L2_' ELSE 'UA_L1_' END, lpad(CAST(fid % 100000000 AS STRING), 8, '0')) END AS id,
               CASE m WHEN 4 THEN '' ELSE seqid END AS seqid, CASE m WHEN 5 THEN 'other' ELSE source_tool END AS source,
               CASE m WHEN 6 THEN 'gene' WHEN 7 THEN CASE WHEN region THEN 'transposable_element' ELSE 'repeat_region' END ELSE CASE WHEN region THEN 'repeat_region' ELSE 'transposable_element' END END AS type,
               start_pos, CASE m WHEN 8 THEN start_pos - 1 ELSE end_pos END AS end_pos, CASE m WHEN 9 THEN '?' ELSE CASE strand WHEN '*' THEN '.' ELSE strand END END AS strand,
               CASE m WHEN 10 THEN NULL WHEN 11 THEN 'TRC_x' ELSE name END AS name, CASE m WHEN 12 THEN NULL ELSE classification END AS classification,
               CASE m WHEN 13 THEN NULL WHEN 14 THEN 7 ELSE source_tier END AS source_tier, CASE m WHEN 15 THEN NULL ELSE source_tool END AS source_tool,
               CASE m WHEN 16 THEN 'half' WHEN 17 THEN NULL ELSE element_type END AS element_type,
               CASE m WHEN 18 THEN 'LTR_RT_TR' WHEN 19 THEN 'odd' ELSE structure END AS structure, CASE m WHEN 20 THEN '2' WHEN 21 THEN 'two' ELSE copy_number END AS copy_number,
               CASE m WHEN 22 THEN 'a/b' WHEN 23 THEN 'ab' END AS te_origin, CASE m WHEN 24 THEN 'tandem_LTR_RT' WHEN 22 THEN 'odd' END AS te_origin_structure,
               CASE m WHEN 25 THEN 'LTR_RT_TR' WHEN 26 THEN 'odd' END AS in_structure, CASE m WHEN 27 THEN 'UA_L1_1' WHEN 25 THEN 'UA_L1_00000001' END AS member_of,
               CASE WHEN m = 28 THEN NULL WHEN two OR m = 29 THEN CASE m WHEN 30 THEN 'UA_L1_5' ELSE concat('UA_L1_0000000', CAST(fid % 3 AS STRING)) END END AS parent,
               CAST(CASE WHEN two THEN 2 ELSE 1 END AS INT) AS level
        FROM (SELECT *, CAST((fid - fid % 100000) / 100000 AS BIGINT) % 67 AS m, fid % 7 = 0 AS two, classification LIKE 'Satellite%' OR classification LIKE 'Simple_repeat%' OR classification LIKE 'Low_complexity%' OR classification LIKE 'rDNA%' OR classification LIKE 'Unknown%' AS region FROM fx_tiers) u"""),
    "fx_trc": ((), """
        SELECT event_id AS fid, concat('chr', CAST(event_id % 3 + 1 AS STRING)) AS seqid, '+' AS strand,
               concat('TRC_', CAST(user_id % 9 AS STRING)) AS trc, concat('SF', CAST(CAST(floor(user_id % 9 / 3.0) AS BIGINT) AS STRING)) AS sf,
               event_id * 40 AS s0, event_id * 40 + 20 + CAST(floor(value) AS BIGINT) % 60 AS e0
        FROM events"""),
    "fx_sequences": (("fx_class",), """
        SELECT doc_id, concat('el_', CAST(doc_id AS STRING), '#', c.cls) AS header,
               concat(s, repeat('N', CAST(5 + doc_id % 20 AS INT)), substring(s, 1, 50)) AS seq
        FROM (SELECT doc_id, translate(text, 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ', 'ACGTACGTACGTACGTACGTACGTACACGTACGTACGTACGTACGTACGTAC') AS s FROM documents) d
        JOIN fx_class c ON c.k = CAST(doc_id % 12 AS INT)"""),
    # Elements and candidates of orders: classes in the dialect of their tool, some missing; strands of both kinds and none.
    "fx_tir": (("fx_small",), """
        SELECT fid, seqid, start_pos, end_pos, CASE fid % 5 WHEN 0 THEN '.' WHEN 1 THEN '-' ELSE '+' END AS strand,
               CASE fid % 16 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'Class_II_Subclass_1_TIR_MITE' ELSE 'Class_II_Subclass_1_TIR_hAT' END AS classification
        FROM fx_small WHERE source_tier > 2"""),
    "fx_tpase": (("fx_small",), """
        SELECT fid, seqid, start_pos + 5 AS start_pos, start_pos + 14 AS end_pos, CASE WHEN fid % 3 = 0 THEN '-' ELSE '+' END AS strand,
               CASE fid % 14 WHEN 0 THEN NULL WHEN 1 THEN 'Class_II|Subclass_1|TIR|MITE' ELSE 'Class_II|Subclass_1|TIR|hAT' END AS classification
        FROM fx_small WHERE fid % 2 = 0"""),
    "fx_clusters": ((), "SELECT c_nationkey * 10 + c_custkey % 10 AS rep, o_orderkey AS member FROM customer JOIN orders ON c_custkey = o_custkey"),
}


#: What Spark takes in place of a view's expression: casts from fractions cut there and round in the oracles' engine. Products of
#: keys beyond 2^53 lose digits when they are divided as doubles, so the whole quotient is taken from integers.
WHOLE = {"CAST((fid - fid % 100000) / 100000 AS BIGINT)": "((fid - fid % 100000) div 100000)"}


def needed(*names: str) -> list[str]:
    """The views and what they need, in order of definition."""
    out: list[str] = []
    for name in names:
        for need in (*needed(*VIEWS[name][0]), name):
            if need not in out:
                out.append(need)
    return out


def with_views(*names: str) -> str:
    """``WITH`` clause that defines the views for an oracle statement."""
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in needed(*names)) + "\n"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One view over the Parquet tables of a directory, without registering anything in the session."""
    sql = with_views(name) + f"SELECT * FROM {name}"
    for cut, whole in WHOLE.items():
        sql = sql.replace(cut, whole)
    used = [t for t in TABLES if re.search(rf"\b(?:FROM|JOIN) {t}\b", sql)]
    for t in used:
        sql = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", sql)
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used}
    return spark.sql(sql, **frames)
