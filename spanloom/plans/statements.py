"""SQL of the sequential rules, for the oracles: each function gives common table expressions.

A relation of tier rows has the columns ROW; ``prefix`` keeps the names of one use apart from those of another.
"""

from __future__ import annotations

ROW = "fid, seqid, start_pos, end_pos, strand, name, classification, source_tool, source_tier, element_type, structure, copy_number"
_NULLS = "CAST(NULL AS VARCHAR) AS element_type, CAST(NULL AS VARCHAR) AS structure, CAST(NULL AS VARCHAR) AS copy_number"


def islands(relation: str, keys: str = "seqid") -> str:
    """Islands of intervals that a relation r(keys, s, e) has."""
    return f"""(SELECT {keys}, min(s) AS s, max(e) AS e FROM (
        SELECT *, sum(n) OVER (PARTITION BY {keys} ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM (
            SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY {keys} ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS n
            FROM {relation})) GROUP BY {keys}, g)"""


def segments(relation: str) -> str:
    """Atomic segments g(seqid, s, e) of a relation with start_pos and end_pos."""
    return f"""(SELECT seqid, p AS s, lead(p) OVER (PARTITION BY seqid ORDER BY p) - 1 AS e FROM (
        SELECT seqid, start_pos AS p FROM {relation} UNION SELECT seqid, end_pos + 1 FROM {relation}))"""


def common_class(classes: str) -> str:
    """Common ancestor of an aggregate of split class paths."""
    low, high = f"min(string_split({classes}, '/'))", f"max(string_split({classes}, '/'))"
    depth = f"len(list_filter(range(1, len({low}) + 1), lambda i: {low}[1:i] = {high}[1:i]))"
    return f"CASE WHEN {depth} = 0 THEN 'Unknown' ELSE array_to_string({low}[1:{depth}], '/') END"


def trim(out: str, low: str, high: str, least: int = 50) -> str:
    """``out``: rows of ``low`` without what ``high`` covers."""
    p = f"{out}_"
    return f"""
    {p}hit AS MATERIALIZED (SELECT DISTINCT l.fid, l.start_pos AS ls, l.seqid FROM {low} l JOIN {high} h ON h.seqid = l.seqid AND h.start_pos <= l.end_pos AND l.start_pos <= h.end_pos),
    {p}low AS MATERIALIZED (SELECT * FROM {low} WHERE seqid IN (SELECT seqid FROM {p}hit)),
    {p}cover AS MATERIALIZED (SELECT seqid, s AS start_pos, e AS end_pos FROM {islands(f"(SELECT seqid, start_pos AS s, end_pos AS e FROM {high})")}),
    {p}every AS (SELECT seqid, start_pos, end_pos FROM {p}low UNION ALL SELECT * FROM {p}cover WHERE seqid IN (SELECT seqid FROM {p}hit)),
    {p}seg AS MATERIALIZED (SELECT * FROM {segments(f'{p}every')} WHERE e IS NOT NULL),
    {p}bare AS MATERIALIZED (SELECT g.* FROM {p}seg g ANTI JOIN {p}cover c ON c.seqid = g.seqid AND c.start_pos <= g.s AND c.end_pos >= g.e),
    {p}piece AS MATERIALIZED (SELECT g.seqid, g.s, g.e, min({{'fid': l.fid, 's': l.start_pos}}) AS k FROM {p}bare g JOIN {p}low l ON l.seqid = g.seqid AND l.start_pos <= g.s AND l.end_pos >= g.e GROUP BY ALL),
    {out} AS MATERIALIZED (SELECT l.fid, p.seqid, p.s AS start_pos, p.e AS end_pos, CASE WHEN h.fid IS NULL THEN l.strand ELSE '*' END AS strand, l.name, l.classification, l.source_tool, l.source_tier, l.element_type, l.structure, l.copy_number
        FROM {p}piece p JOIN {p}low l ON l.fid = p.k.fid AND l.start_pos = p.k.s LEFT JOIN {p}hit h ON h.fid = l.fid AND h.ls = l.start_pos
        WHERE h.fid IS NULL OR p.e - p.s + 1 >= {least}
        UNION ALL SELECT {ROW} FROM {low} WHERE seqid NOT IN (SELECT seqid FROM {p}hit))"""


def within_tier(out: str, rows: str) -> str:
    """``out``: disjoint segments of the rows on seqids with overlaps."""
    p = f"{out}_"
    return f"""
    {p}crowd AS MATERIALIZED (SELECT DISTINCT a.seqid FROM (SELECT seqid, start_pos, max(end_pos) OVER (PARTITION BY seqid ORDER BY start_pos, end_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {rows}) a WHERE reach >= start_pos),
    {p}in AS MATERIALIZED (SELECT * FROM {rows} WHERE seqid IN (SELECT seqid FROM {p}crowd)),
    {p}seg AS MATERIALIZED (SELECT * FROM {segments(f'{p}in')} WHERE e IS NOT NULL),
    {out} AS MATERIALIZED (SELECT min({{'fid': l.fid, 's': l.start_pos}}).fid AS fid, g.seqid, g.s AS start_pos, g.e AS end_pos, '*' AS strand, {common_class('l.classification')} AS name, {common_class('l.classification')} AS classification,
            arg_min(l.source_tool, {{'fid': l.fid, 's': l.start_pos}}) AS source_tool, min(l.source_tier) AS source_tier, {_NULLS}
        FROM {p}seg g JOIN {p}in l ON l.seqid = g.seqid AND l.start_pos <= g.s AND l.end_pos >= g.e GROUP BY g.seqid, g.s, g.e
        UNION ALL SELECT {ROW} FROM {rows} WHERE seqid NOT IN (SELECT seqid FROM {p}crowd))"""


def _levels(p: str, nodes: str) -> str:
    """Level of each node k of edges (lo, hi): the longest chain of earlier partners."""
    return f"""
    {p}lv AS (SELECT k, 0 AS l FROM ({nodes}) WHERE k NOT IN (SELECT lo FROM {p}edge) UNION SELECT e.lo, v.l + 1 FROM {p}lv v JOIN {p}edge e ON e.hi = v.k),
    {p}level AS MATERIALIZED (SELECT k, max(l) AS l FROM {p}lv GROUP BY k)"""


def longest_first(out: str, rows: str, least: int = 50) -> str:
    """``out``: longer rows whole, shorter ones without what kept ones cover, level after level until none is left.

    Each row of a level gives its pieces and one row that isn't kept, so no level is empty.
    """
    p = f"{out}_"
    rank = "{{'w': -({x}.end_pos - {x}.start_pos), 'fid': {x}.fid, 's': {x}.start_pos}}"
    key = "{{'fid': {x}.fid, 's': {x}.start_pos}}"
    kept = "name, classification, source_tool, source_tier, element_type, structure, copy_number"
    piece = "{{'s': {s}, 'e': {e}, 'k': {e} >= {s} AND (cs IS NULL OR {e} - {s} + 1 >= {least})}}"
    first = piece.format(s="start_pos", e="coalesce(cs - 1, end_pos)", least=least)
    after = piece.format(s="ce + 1", e="coalesce(nx - 1, end_pos)", least=least)
    return f"""
    {p}edge AS MATERIALIZED (SELECT {key.format(x='a')} AS lo, {key.format(x='b')} AS hi FROM {rows} a JOIN {rows} b ON a.seqid = b.seqid AND a.start_pos <= b.end_pos AND b.start_pos <= a.end_pos AND {rank.format(x='b')} < {rank.format(x='a')}),
    {_levels(p, f"SELECT {key.format(x='r')} AS k FROM {rows} r")},
    {p}k({ROW}, l, kept) USING KEY (fid, start_pos, l, kept) AS (
        SELECT {ROW}, 0, true FROM (SELECT r.* FROM {rows} r JOIN {p}level v ON v.k = {key.format(x='r')} WHERE l = 0)
        UNION SELECT fid, seqid, x.s, x.e, CASE WHEN cs IS NULL THEN strand ELSE '*' END, {kept}, l, x.k FROM (
            SELECT *, unnest([CASE WHEN rn = 1 THEN {first} END, CASE WHEN cs IS NOT NULL THEN {after} END, {{'s': -start_pos, 'e': end_pos, 'k': false}}]) AS x FROM (
                SELECT *, row_number() OVER (PARTITION BY fid, start_pos ORDER BY cs) AS rn, lead(cs) OVER (PARTITION BY fid, start_pos ORDER BY cs) AS nx FROM (
                    SELECT r.*, n.l, h.start_pos AS cs, h.end_pos AS ce FROM (SELECT max(l) + 1 AS l FROM {p}k) n JOIN {p}level v ON v.l = n.l JOIN {rows} r ON v.k = {key.format(x='r')}
                    LEFT JOIN recurring.{p}k h ON h.kept AND h.seqid = r.seqid AND h.start_pos <= r.end_pos AND r.start_pos <= h.end_pos))) WHERE x IS NOT NULL),
    {out} AS MATERIALIZED (SELECT {ROW} FROM {p}k WHERE kept)"""


def greedy(out: str, nodes: str, edges: str) -> str:
    """``out`` (id): nodes that stay when a node goes with a kept earlier partner, level after level until none is left."""
    p = f"{out}_"
    return f"""
    {p}node AS MATERIALIZED ({nodes}),
    {p}edge AS MATERIALIZED (SELECT DISTINCT qid AS lo, sid AS hi FROM ({edges}) WHERE sid IN (SELECT id FROM {p}node)),
    {_levels(p, f'SELECT id AS k FROM {p}node')},
    {p}k(id, l, kept) USING KEY (id) AS (
        SELECT k, l, true FROM {p}level WHERE l = 0
        UNION SELECT v.k, v.l, NOT bool_or(coalesce(r.kept, false)) FROM (SELECT max(l) + 1 AS l FROM {p}k) n JOIN {p}level v ON v.l = n.l JOIN {p}edge e ON e.lo = v.k LEFT JOIN recurring.{p}k r ON r.id = e.hi GROUP BY v.k, v.l),
    {out} AS (SELECT id FROM {p}k WHERE kept)"""


def te_derived(out: str, arrays: str, elements: str, least: int, depth: int, share: float) -> str:
    """``out`` (source_tool, name, te_origin): clusters of arrays that elements explain."""
    p = f"{out}_"
    return f"""
    {p}m AS MATERIALIZED (SELECT * FROM {islands(f'(SELECT seqid, source_tool, name, start_pos AS s, end_pos AS e FROM {arrays})', 'seqid, source_tool, name')}),
    {p}p AS MATERIALIZED (SELECT m.source_tool, m.name, m.seqid, greatest(m.s, x.start_pos) AS s, least(m.e, x.end_pos) AS e, x.fid, x.classification FROM {p}m m JOIN {elements} x ON x.seqid = m.seqid AND x.start_pos <= m.e AND m.s <= x.end_pos),
    {p}c AS (SELECT source_tool, name, sum(e - s + 1) AS cov FROM {islands(f'(SELECT source_tool, name, seqid, s, e FROM {p}p)', 'seqid, source_tool, name')} GROUP BY ALL),
    {p}z AS (SELECT source_tool, name, count(DISTINCT fid) AS n, {common_class('classification')} AS te_origin FROM {p}p GROUP BY source_tool, name),
    {out} AS MATERIALIZED (SELECT source_tool, name, te_origin FROM {p}z JOIN {p}c USING (source_tool, name) JOIN (SELECT source_tool, name, sum(e - s + 1) AS bp FROM {p}m GROUP BY ALL) USING (source_tool, name)
        WHERE n >= {least} AND len(string_split(te_origin, '/')) >= {depth} AND cov / bp >= {share})"""


def overlapping(a: str, b: str, within: bool = False) -> str:
    """Condition that row l of ``a`` overlaps (or lies in) a row of ``b``."""
    meets = "x.start_pos <= l.start_pos AND l.end_pos <= x.end_pos" if within else "x.start_pos <= l.end_pos AND l.start_pos <= x.end_pos"
    return f"(SELECT l.fid FROM {a} l SEMI JOIN {b} x ON x.seqid = l.seqid AND {meets})"


def tier_resolve(rows: str, evidence: str, members: str) -> str:
    """``resolved``: level-1 and level-2 rows of all tiers, with te_origin, te_origin_structure, level and pool."""
    plain = "CAST(NULL AS VARCHAR) AS te_origin, CAST(NULL AS VARCHAR) AS te_origin_structure"
    parts = [
        f"r AS MATERIALIZED (SELECT {ROW} FROM {rows})",
        "r1 AS MATERIALIZED (SELECT * FROM r WHERE source_tier = 1)",
        "r3 AS MATERIALIZED (SELECT * FROM r WHERE source_tool IN ('TideCluster_default', 'TideCluster_short'))",
        te_derived("ted", "r3", "r1", 2, 3, 0.25),
        "won AS MATERIALIZED (SELECT r3.*, te_origin FROM r3 JOIN ted USING (source_tool, name))",
        "cont AS (SELECT * FROM r1 WHERE structure = 'LTR_RT_TR')",
        "open3 AS MATERIALIZED (SELECT r3.* FROM r3 ANTI JOIN ted USING (source_tool, name))",
        trim("t1a", "r1", "won"), longest_first("t1", "t1a"),
        "r2 AS (SELECT * FROM r WHERE source_tier = 2)", trim("t2a", "r2", "won"), trim("t2b", "t2a", "t1"), within_tier("t2", "t2b"),
        "ltr AS MATERIALIZED (SELECT * FROM t1 WHERE source_tool = 'DANTE_LTR')",
        "def AS MATERIALIZED (SELECT * FROM open3 WHERE source_tool = 'TideCluster_default')",
        f"defin AS MATERIALIZED (SELECT * FROM def WHERE fid IN {overlapping('def', 'ltr', True)})",
        "defout AS MATERIALIZED (SELECT * FROM def WHERE fid NOT IN (SELECT fid FROM defin))",
        f"p2 AS MATERIALIZED (SELECT {ROW} FROM won UNION ALL SELECT {ROW} FROM t1 UNION ALL SELECT {ROW} FROM t2)", trim("t3", "defout", "p2"),
        "p3 AS MATERIALIZED (SELECT * FROM p2 UNION ALL SELECT * FROM t3)",
        "short AS (SELECT * FROM open3 WHERE source_tool = 'TideCluster_short')", trim("t3s", "short", "p3"),
        "p4 AS MATERIALIZED (SELECT * FROM p3 UNION ALL SELECT * FROM t3s)",
        "r4 AS MATERIALIZED (SELECT * FROM r WHERE source_tool = 'TideCluster_RM')",
        f"r4y AS MATERIALIZED (SELECT * FROM r4 WHERE fid IN {overlapping('r4', evidence)} OR seqid NOT IN (SELECT seqid FROM {evidence}))",
        "r4n AS MATERIALIZED (SELECT * FROM r4 WHERE fid NOT IN (SELECT fid FROM r4y))",
        trim("t4a", "r4y", "p4"), within_tier("t4", "t4a"), "p5 AS MATERIALIZED (SELECT * FROM p4 UNION ALL SELECT * FROM t4)",
        "simple AS MATERIALIZED (SELECT * FROM r WHERE source_tool = 'RepeatMasker' AND regexp_matches(classification, '^(Simple_repeat|Low_complexity)'))",
        "te AS MATERIALIZED (SELECT * FROM r WHERE source_tool = 'RepeatMasker' AND NOT regexp_matches(classification, '^(Simple_repeat|Low_complexity)'))",
        trim("t5a", "te", "p5"), within_tier("t5", "t5a"), "p6 AS MATERIALIZED (SELECT * FROM p5 UNION ALL SELECT * FROM t5)",
        trim("t6a", "r4n", "p6"), within_tier("t6", "t6a"), "p7 AS MATERIALIZED (SELECT * FROM p6 UNION ALL SELECT * FROM t6)",
        f"simpin AS MATERIALIZED (SELECT * FROM simple WHERE fid IN {overlapping('simple', 'p7')})",
        "simpout AS MATERIALIZED (SELECT * FROM simple WHERE fid NOT IN (SELECT fid FROM simpin))",
        "p8 AS MATERIALIZED (SELECT * FROM p7 UNION ALL SELECT * FROM simpout)",
        "th AS MATERIALIZED (SELECT * FROM r WHERE source_tool = 'TideHunter')",
        f"thin AS MATERIALIZED (SELECT * FROM th WHERE fid IN {overlapping('th', 'ltr', True)})",
        "thout AS MATERIALIZED (SELECT * FROM th WHERE fid NOT IN (SELECT fid FROM thin))",
        f"thfree AS MATERIALIZED (SELECT * FROM thout WHERE fid NOT IN {overlapping('thout', 'p8')})",
        f"mem AS MATERIALIZED (SELECT {ROW} FROM {members})",
        f"memfree AS MATERIALIZED (SELECT * FROM mem WHERE fid NOT IN {overlapping('mem', 'won')})",
        f"""resolved AS MATERIALIZED (
            SELECT {ROW}, te_origin, CASE WHEN fid IN {overlapping('won', 'cont')} THEN 'tandem_LTR_RT' END AS te_origin_structure, 1 AS level, CAST(NULL AS VARCHAR) AS pool FROM won
            UNION ALL SELECT {ROW}, {plain}, 1, NULL FROM (SELECT * FROM p8 UNION ALL SELECT * FROM thfree) WHERE (fid, start_pos) NOT IN (SELECT (fid, start_pos) FROM won)
            UNION ALL SELECT {ROW}, {plain}, 2, 'any' FROM simpin
            UNION ALL SELECT {ROW}, {plain}, 2, 'DANTE_LTR' FROM (SELECT * FROM defin UNION ALL SELECT * FROM thin UNION ALL SELECT * FROM memfree))""",
    ]
    return ",\n".join(x.strip() for x in parts)


def finalised() -> str:
    """The annotation of ``resolved``."""
    order = "seqid, start_pos, end_pos, strand, fid"
    number = "lpad(CAST({n} AS VARCHAR), 8, '0')"
    return f"""
    f1 AS MATERIALIZED (SELECT *, 'UA_L1_' || {number.format(n=f'row_number() OVER (ORDER BY {order})')} AS id FROM resolved WHERE level = 1),
    f2 AS MATERIALIZED (SELECT *, 'UA_L2_' || {number.format(n=f'row_number() OVER (ORDER BY {order})')} AS id FROM resolved WHERE level = 2),
    fp AS MATERIALIZED (SELECT a.id, min({{'w': -(least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos) + 1), 'p': b.id}}).p AS parent FROM f2 a JOIN f1 b ON a.seqid = b.seqid AND a.start_pos <= b.end_pos AND b.start_pos <= a.end_pos AND (a.pool = 'any' OR b.source_tool = 'DANTE_LTR') GROUP BY a.id),
    f2p AS MATERIALIZED (SELECT * FROM f2 LEFT JOIN fp USING (id)),
    fo AS (SELECT * REPLACE ('UA_L1_' || {number.format(n=f'(SELECT count(*) FROM f1) + row_number() OVER (ORDER BY {order})')} AS id, 1 AS level) FROM f2p WHERE parent IS NULL),
    fa AS (SELECT *, CAST(NULL AS VARCHAR) AS parent FROM f1 UNION ALL BY NAME SELECT * FROM fo UNION ALL BY NAME SELECT * FROM f2p WHERE parent IS NOT NULL),
    final AS (SELECT id, seqid, source_tool AS source, CASE WHEN regexp_matches(classification, '^(Satellite|Simple_repeat|Low_complexity|rDNA|Unknown)') THEN 'repeat_region' ELSE 'transposable_element' END AS type,
        start_pos, end_pos, CASE WHEN strand IN ('+', '-') THEN strand ELSE '.' END AS strand, name, classification, source_tier, source_tool, element_type, structure, copy_number, te_origin, te_origin_structure,
        CASE WHEN level = 2 AND source_tool = 'DANTE_LTR' THEN 'LTR_RT_TR' END AS in_structure, CASE WHEN level = 2 AND source_tool = 'DANTE_LTR' THEN parent END AS member_of, parent, CAST(level AS INT) AS level FROM fa)"""
