"""Queries over keys and tables larger than those of the test tables."""

from __future__ import annotations

import gzip
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_queries import plain

from spanloom.operators import hits as ht
from spanloom.operators import resolve as rs
from spanloom.operators import intervals as iv
from spanloom.operators import scratch, sweep
from spanloom.plans import queries as plans
from spanloom.sources import ranges, tabular


@pytest.fixture(scope="module")
def large_keys(tmp_path_factory):
    """Order keys whose products don't fit the digits of a double."""
    path = tmp_path_factory.mktemp("large_keys")
    rows = """SELECT 700000 + i AS l_orderkey, i * 37 % 20000 AS l_partkey, i * 13 % 1000 AS l_suppkey, CAST(i % 7 + 1 AS INTEGER) AS l_linenumber, CAST(i % 50 + 1 AS DOUBLE) AS l_quantity,
        ['A', 'R', 'N'][i % 3 + 1] AS l_returnflag FROM range(3000) t(i)"""
    duckdb.connect().execute(f"COPY ({rows}) TO '{path}/lineitem.parquet' (FORMAT parquet)")
    return str(path)


@pytest.mark.parametrize("name", ["contract_validate", "summary_stats", "snk_class_files", "snk_split_by_class"])
def test_annotations_of_large_keys(spark, large_keys, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{large_keys}/lineitem.parquet'")
    assert plain(plans.QUERIES[name](spark, large_keys).toPandas()) == plain(con.execute(plans.ORACLES[name]).df())


def test_long_chains_take_few_rounds(spark):
    """Each row of a chain is cut by the one before it, so all of them decide one after another."""
    n, step = 2500, 3000
    rows = [(i, "a", 1 + i * step, i * step + step + 1000 - i // 4, "+", "x", "Class_I", "DANTE_LTR", 1) for i in range(n)]
    df = spark.createDataFrame(rows, "fid long, seqid string, start_pos long, end_pos long, strand string, name string, classification string, source_tool string, source_tier int")
    before = len(scratch.made(spark))
    got = sorted((r.fid, r.start_pos, r.end_pos, r.strand) for r in rs.longest_first(spark, df).collect())
    assert len(scratch.made(spark)) - before < 12
    want, reach = [], 0
    for i, _, s, e, *_ in rows:  # widths fall along the chain
        if e - max(s, reach + 1) + 1 >= 50:
            want.append((i, max(s, reach + 1), e, "+" if s > reach else "*"))
            reach = e
    assert got == want


def test_chains_of_scores_take_few_rounds(spark):
    """Of a chain of falling scores every other row stays; margins of any width give the same rows."""
    rows = [("a", 1 + i * 90, 100 + i * 90, i, float(-i)) for i in range(1500)]
    df = spark.createDataFrame(rows, "seqid string, start_pos long, end_pos long, id long, score double")
    before = len(scratch.made(spark))
    got = sorted(r.id for r in ht.best_scoring(spark, df, 64).collect())
    assert got == list(range(0, 1500, 2))
    assert len(scratch.made(spark)) - before < 16


def test_deep_segments(spark):
    """Segments under many rows come in several batches, and their depths without their members."""
    n = 800
    df = spark.createDataFrame([(i, "a", 1 + i, 2 * n - i % 7 + i) for i in range(n)], "fid long, seqid string, start_pos long, end_pos long")
    found = iv.disjoin(df, "fid").select("seqid", "start_pos", "end_pos", "depth", F.size("members").alias("n"), F.array_min("members").alias("low"), F.array_max("members").alias("high"))
    got = sorted(map(tuple, found.collect()))
    assert sum(r[4] for r in got) > sweep.MEMBERS
    assert [r[:4] for r in got] == sorted(map(tuple, sweep.depths(df).collect()))
    for _, s, e, depth, size, low, high in got:
        own = [i for i in range(n) if 1 + i <= s and e <= 2 * n - i % 7 + i]
        assert (depth, size, low, high) == (len(own), len(own), own[0], own[-1])


def test_pairs_are_counted_without_listing_them(spark):
    """40,000 rows over each other are 8 * 10^8 pairs."""
    n = 40_000
    rows = spark.range(n).select(F.col("id"), F.lit("a").alias("seqid"), (F.col("id") % 900 + 1).alias("start_pos"), (F.col("id") % 900 + 70_000).alias("end_pos"), (F.col("id") % 2).cast("string").alias("kind"))
    found = sweep.pair_counts(rows, "kind", ["start_pos", "end_pos", "id"]).collect()
    assert sum(r.n for r in found) == n * (n - 1) // 2
    rnd = random.Random(7)
    few = [(i, s := rnd.randint(1, 3000), s + rnd.randint(0, 300), str(rnd.randint(0, 3))) for i in range(200)]
    want = Counter((a[3], b[3]) for a in few for b in few if (a[1], a[2], a[0]) < (b[1], b[2], b[0]) and b[1] <= a[2])
    df = spark.createDataFrame([("a", *r) for r in few], "seqid string, id long, start_pos long, end_pos long, kind string")
    assert {(r.first, r.second): r.n for r in sweep.pair_counts(df, "kind", ["start_pos", "end_pos", "id"], 128).collect() if r.n} == want


def test_small_files_share_tasks(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"r{i}.tsv").write_text(f"s\th:m:s\n{i}\t0:00:01\n")
    (tmp_path / "empty.tsv").write_text("")
    (tmp_path / "packed.tsv").write_bytes(gzip.compress(b"s\th:m:s\n7\t0:00:02\n"))
    assert len(ranges.LinesReader({"path": str(tmp_path)}).partitions()) == 1
    got = {r.rule: r.s for r in tabular.read_benchmarks(spark, str(tmp_path)).collect()}
    assert got == {**{f"r{i}": float(i) for i in range(300)}, "packed": 7.0}


def test_best_parents_of_deep_rows(spark):
    """Rows over and over each other: parents tie, reach over bins and come in several blocks."""
    rnd = random.Random(8)
    make = lambda n, wide: [(i, "ab"[i % 2], s := rnd.randint(1, 900), s + rnd.randint(0, wide)) for i in rnd.sample(range(10 * n), n)]
    kids, above = make(700, 120), make(400, 300)
    want = {}
    for c, q, s, e in kids:
        found = [(-(min(e, y) - max(s, x) + 1), p) for p, r, x, y in above if r == q and x <= e and s <= y]
        if found:
            want[c] = min(found)
    frames = [spark.createDataFrame(x, "fid long, seqid string, start_pos long, end_pos long") for x in (kids, above)]
    for size in (64, 1 << 16):
        assert {r.child: (-r.overlap_bp, r.parent) for r in iv.best_parent(*frames, "fid", "fid", size).collect()} == want


def test_blocks_hold_bounded_pairs_and_miss_none():
    n = 6000
    start, end = np.arange(n) // 7 + 1, np.arange(n) // 7 + 900
    seen, largest = 0, 0
    for mine, theirs in sweep.blocks(start, end, start, end):
        largest = max(largest, len(mine) * len(theirs))
        seen += int(((start[mine][:, None] <= end[theirs]) & (start[theirs] <= end[mine][:, None])).sum())
    assert largest <= sweep.CELLS
    assert seen == n * n  # every pair overlaps


def test_candidates_inside_deep_parents(spark):
    rnd = random.Random(9)
    make = lambda n, wide, kinds: [(i, "ab"[i % 2], s := rnd.randint(1, 900), s + rnd.randint(0, wide), rnd.choice(kinds), f"c{i}") for i in range(n)]
    above, inner = make(500, 40, "+-."), make(300, 30, ["+", "-", None])
    want = {}
    for f, q, s, e, strand, _ in above:
        found = sorted((i, c) for i, r, x, y, own, c in inner if r == q and s <= x and y <= e and strand in (".", own))
        if found:
            want[f] = (len(found), *found[0])
    frames = [spark.createDataFrame(x, "fid long, seqid string, start_pos long, end_pos long, strand string, classification string") for x in (above, inner)]
    for size in (64, 1 << 16):
        got: dict = {}
        for r in sweep.contained(*frames, size).collect():
            n, one, cls = got.get(r.fid, (0, r.one, r["class"]))
            got[r.fid] = (n + r.n, *min((one, cls), (r.one, r["class"])))
        assert got == want
