"""Sequential and iterative rules against plain Python on random rows."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from spanloom.operators import hits as ht
from spanloom.operators import intervals as iv
from spanloom.operators import patterns as pt
from spanloom.operators import resolve as rs


def features(spark, n, seed, top=4000, seqs=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        s = rnd.randint(1, top)
        rows.append((i, f"chr{rnd.randint(1, seqs)}", s, s + rnd.randint(10, 900), rnd.choice("+-"), "x", rnd.choice(("Class_I/LTR/Ty1_copia/Ale", "Class_I/LTR/Ty1_copia/Tork", "Class_II")), "DANTE_LTR", 1))
    return rows, spark.createDataFrame(rows, "fid long, seqid string, start_pos long, end_pos long, strand string, name string, classification string, source_tool string, source_tier int")


def bases(rows):
    return {(r[1], p) for r in rows for p in range(r[2], r[3] + 1)}


def test_small_bins_change_nothing(spark):
    _, df = features(spark, 80, 1)
    for f in (lambda b: iv.reduce_intervals(df, size=b), lambda b: iv.overlap_join(df, df, b).select("fid_a", "fid_b"), lambda b: iv.disjoin(df, "fid", b).withColumn("members", F.col("members").cast("string")), lambda b: iv.subtract(df.filter("fid % 2 = 0"), df.filter("fid % 2 = 1"), "fid", b)):
        assert sorted(map(tuple, f(64).collect())) == sorted(map(tuple, f(1 << 20).collect()))


def test_reduce_joins_neighbours_and_takes_empty_tables(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 11, 20), ("a", 22, 30), ("a", 1, 10)], "seqid string, start_pos long, end_pos long")
    assert sorted(map(tuple, iv.reduce_intervals(df, size=8).collect())) == [("a", 1, 20), ("a", 22, 30)]
    assert iv.reduce_intervals(df.limit(0)).count() == 0


def test_longest_first(spark):
    rows, df = features(spark, 60, 2)
    got = [tuple(r) for r in rs.longest_first(spark, df, 50).select("fid", "seqid", "start_pos", "end_pos").collect()]
    kept: dict = {}
    want = []
    for r in sorted(rows, key=lambda r: (r[2] - r[3], r[0])):
        own = kept.setdefault(r[1], set())
        free = [p for p in range(r[2], r[3] + 1) if p not in own]
        runs, start = [], None
        for i, p in enumerate(free):
            start = p if start is None else start
            if i + 1 == len(free) or free[i + 1] != p + 1:
                runs.append((start, p))
                start = None
        whole = len(free) == r[3] - r[2] + 1
        for a, b in runs:
            if whole or b - a + 1 >= 50:
                want.append((r[0], r[1], a, b))
                own.update(range(a, b + 1))
    assert sorted(got) == sorted(want)
    twice = df.unionByName(df.filter("fid % 3 = 0"))
    for island in (0, 5):
        again = rs.longest_first(spark, twice, 50, island).select("fid", "seqid", "start_pos", "end_pos").collect()
        assert sorted(map(tuple, again)) == sorted(want)


def test_within_tier_covers_the_same_bases_once(spark):
    rows, df = features(spark, 50, 3)
    got = [(r.fid, r.seqid, r.start_pos, r.end_pos) for r in rs.within_tier(df).collect()]
    assert bases(got) == bases(rows)
    assert sum(r[3] - r[2] + 1 for r in got) == len(bases(rows))


def test_best_scoring(spark):
    rnd = random.Random(4)
    rows = [("a", s := rnd.randint(1, 2000), s + rnd.randint(5, 80), i, float(rnd.randint(0, 9))) for i in range(150)]
    got = {r.id for r in ht.best_scoring(spark, spark.createDataFrame(rows, "seqid string, start_pos long, end_pos long, id long, score double")).collect()}
    kept = []
    for r in sorted(rows, key=lambda r: (-r[4], r[1] - r[2], r[3])):
        if all(r[2] < k[1] or r[1] > k[2] for k in kept):
            kept.append(r)
    assert got == {k[3] for k in kept}


def test_containment_settles(spark):
    ids = spark.createDataFrame([(i,) for i in range(6)], "id long")
    edges = spark.createDataFrame([(0, 1), (1, 2), (3, 4)], "qid long, sid long")
    got = {r.id: r.kept for r in ht.containment_reduced(spark, ids, edges).collect()}
    assert got == {0: True, 1: False, 2: True, 3: False, 4: True, 5: True}


def test_star_cover(spark):
    rnd = random.Random(9)
    members = [(i % 3, i, rnd.choice([20, 22] if i % 3 == 2 else [200, 204, 208, 300])) for i in range(60)]
    hits = [(rnd.randrange(60), rnd.randrange(60), rnd.choice([70.0, 85.0]), rnd.choice([0.5, 0.9])) for _ in range(900)]
    got = {r.id: r.representative for r in ht.star_cover(spark, spark.createDataFrame(members, "cluster int, id int, length int"), spark.createDataFrame(hits, "qid int, sid int, pident double, qcov double")).collect()}
    want = {}
    for cluster in range(3):
        sizes = {i: n for c, i, n in members if c == cluster}
        if min(n // 2 for n in sizes.values()) < 12:
            want.update({i: i for i in sizes})
            continue
        for i in sorted(sizes, key=lambda i: (-sizes[i], i)):
            if i not in want:
                cover = {q for q, t, pid, cov in hits if t == i and q in sizes and pid >= 80 and cov >= 0.8 and min(sizes[q], sizes[i]) >= 0.95 * max(sizes[q], sizes[i])}
                want.update({q: i for q in cover | {i} if q not in want})
    assert got == want


def test_superfamily_arrays(spark):
    hits = [("a", "+", "TRC_1", 100 * i, 100 * i + 98) for i in range(6)] + [("a", "+", "TRC_2", 60, 70), ("a", "+", "TRC_2", 5000, 5030), ("a", "-", "TRC_9", 0, 50), ("b", "+", "TRC_9", 0, 60)]
    df = spark.createDataFrame(hits, "seqid string, strand string, trc string, s0 long, e0 long")
    got = pt.superfamily_arrays(df, spark.createDataFrame([("TRC_1", 40.0), ("TRC_2", 45.0)], "trc string, monomer double"), spark.createDataFrame([("TRC_1", "SF1"), ("TRC_2", "SF1")], "trc string, sf string"))
    # A gap of two bases is bridged for judging only; an unknown cluster needs two units of 30.
    assert sorted(map(tuple, got.collect())) == [("a", 100 * i, 100 * i + 98, "+", "TRC_1") for i in range(6)] + [("b", 0, 60, "+", "TRC_9")]


def test_clusters_of_two_runs_are_told_apart(spark):
    schema = "fid long, seqid string, start_pos long, end_pos long, name string, classification string, source_tool string"
    arrays = spark.createDataFrame([(1, "c1", 1, 1000, "TRC_1", "s", "TideCluster_default"), (2, "c2", 1, 1000, "TRC_1", "s", "TideCluster_short")], schema)
    elements = spark.createDataFrame([(10 + i, "c1", 1 + 300 * i, 300 + 300 * i, "e", f"Class_I/LTR/Ty1_copia/{x}", "DANTE_LTR") for i, x in enumerate(("Ale", "Ale", "Tork"))] + [(20, "c2", 5, 400, "e", "Class_II/x/y", "DANTE_LTR")], schema)
    assert [tuple(r) for r in rs.te_derived(arrays, elements).collect()] == [("TideCluster_default", "TRC_1", "Class_I/LTR/Ty1_copia")]


def test_resolution_has_one_owner_for_each_base(spark):
    tools = [("DANTE_LTR", 1), ("DANTE", 2), ("TideCluster_default", 3), ("TideCluster_short", 3), ("TideCluster_RM", 4), ("RepeatMasker", 5), ("TideHunter", 6)]
    rows, df = features(spark, 140, 5, top=20_000, seqs=2)
    tool = F.element_at(F.array(*[F.struct(F.lit(t).alias("t"), F.lit(k).alias("k")) for t, k in tools]), (F.col("fid") % len(tools) + 1).cast("int"))
    df = df.withColumn("source_tool", tool["t"]).withColumn("source_tier", tool["k"]).withColumn("name", F.concat(F.lit("TRC_"), F.col("fid").cast("string")))
    df = df.withColumn("element_type", F.when(F.col("source_tier") == 1, "complete"))
    out = rs.finalised(spark, rs.tier_resolve(spark, df)).cache()
    first = [(r.id, r.seqid, r.start_pos, r.end_pos) for r in out.filter("level = 1 AND source_tool <> 'TideHunter'").collect()]
    assert sum(r[3] - r[2] + 1 for r in first) == len(bases(first))
    assert bases([(0, r.seqid, r.start_pos, r.end_pos) for r in out.collect()]) <= bases(rows)
    assert rs.violations(out).count() == 0 and [r.rule for r in rs.violations(out.limit(0)).collect()] == ["no_features"]


def test_orphans_go_on_with_the_ids_of_level_1(spark):
    none = F.lit(None).cast("string")
    rows = [(1, "c", 1, 9, 1, "DANTE_LTR"), (2, "c", 100, 200, 1, "DANTE_TIR"), (3, "c", 3, 5, 2, "DANTE_LTR"), (4, "c", 150, 160, 2, "DANTE_LTR"), (5, "d", 1, 2, 2, "RepeatMasker")]
    df = spark.createDataFrame(rows, "fid long, seqid string, start_pos long, end_pos long, level int, source_tool string").withColumn("strand", F.lit("*")).withColumn("name", F.lit("n")).withColumn("classification", F.lit("Class_I"))
    df = rs.with_columns(df.withColumn("source_tier", F.lit(1)).withColumn("element_type", F.lit("complete"))).join(df.select("fid", "level"), "fid").withColumn("pool", F.when(F.col("source_tool") == "DANTE_LTR", "DANTE_LTR").otherwise("any"))
    got = {(r.seqid, r.start_pos): (r.id, r.level, r.parent, r.member_of) for r in rs.finalised(spark, df.withColumn("te_origin", none).withColumn("te_origin_structure", none)).collect()}
    assert got[("c", 3)] == ("UA_L2_00000001", 2, "UA_L1_00000001", "UA_L1_00000001")
    assert got[("c", 150)] == ("UA_L1_00000003", 1, None, None) and got[("d", 1)] == ("UA_L1_00000004", 1, None, None)


def test_ordered_helpers_in_small_bins(spark):
    from pyspark.sql import Window as W

    from spanloom.operators import ordered as od

    rnd = random.Random(12)
    rows = [(i, rnd.choice(["a", "b", None]), rnd.randint(-300, 900), rnd.randint(0, 50)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, k string, p long, v int")
    w = W.partitionBy("k").orderBy("p", "id")
    want = df.select("id", F.lag(F.struct("v")).over(w).alias("x"), F.lead(F.struct("v")).over(w).alias("y"), F.sum("v").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("s"), F.max("v").over(w.rowsBetween(W.unboundedPreceding, -1)).alias("m"))
    for size in (7, 10_000):
        got = od.neighbour(df, ["k"], "p", ["p", "id"], ["v"], "x", size=size)
        got = od.neighbour(got, ["k"], "p", ["p", "id"], ["v"], "y", ahead=True, size=size)
        got = od.running(got, ["k"], "p", ["p", "id"], F.col("v"), "s", size=size)
        got = od.running(got, ["k"], "p", ["p", "id"], F.col("v"), "m", "max", before=True, size=size)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    places = {r.id: (r.place, r.inner) for r in od.placed_within(spark, od.placed(spark, df, ["v", "id"]), ["v"], ["id"], "inner").collect()}
    order = sorted(rows, key=lambda r: (r[3], r[0]))
    assert places == {r[0]: (i + 1, 1 + sum(x[3] == r[3] for x in order[:i])) for i, r in enumerate(order)}


def test_smoothing_across_blocks(spark):
    from spanloom.operators import ordered as od

    df = spark.range(50).select(F.lit("a").alias("k"), F.col("id").alias("place"))
    from pyspark.sql import Window as W

    rows = od.halo(df, ["k"], "place", 4, 5, block=6).withColumn("s", F.sum("place").over(W.partitionBy("k", "_block").orderBy("place").rowsBetween(-4, 5))).filter("_own")
    assert sorted((r.place, r.s) for r in rows.collect()) == [(i, sum(range(max(0, i - 4), min(50, i + 6)))) for i in range(50)]
