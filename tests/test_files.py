"""Readers on awkward files and round trips of the writers."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.operators import report as rp
from spanloom.sources import sinks, tabular


def test_gff3_edges(spark, tmp_path):
    path = tmp_path / "a.gff3"
    path.write_text("##gff-version 3\n\nchr1\tx\tt\t1\t9\t0.5\t+\t.\tID=a;Name=b=c;flag;ID=d\r\nchr1\tx\tt\tone\t9\t.\t+\t.\tID=e\nchr1\tx\tt\t1\n#c\nchr2\t.\tt\t5\t6\t.\t-\t.\t.\n")
    rows = {r.seqid: r for r in tabular.read_gff3(spark, str(path)).collect()}
    assert rows["chr1"].attrs == {"ID": "d", "Name": "b=c"} and rows["chr1"].score == 0.5
    assert rows["chr2"].source is None and rows["chr2"].attrs == {} and len(rows) == 2
    for name in ("missing", "empty"):
        (tmp_path / "empty").write_text("")
        assert tabular.read_gff3(spark, str(tmp_path / name)).count() == 0


def test_fasta(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">s1#Class_I one\nACgt\nAC\n>s2\n\n>s3\nNNN")
    rows = sorted(tuple(r) for r in tabular.read_fasta(spark, str(tmp_path / "a.fa"), upper=True).collect())
    assert rows == [("s1#Class_I one", "s1#Class_I", "ACGTAC"), ("s2", "s2", ""), ("s3", "s3", "NNN")]
    df = spark.createDataFrame([("h1", "ACGT" * 50), ("h2", "A" * 80)], "header string, seq string")
    sinks.write_fasta(df, str(tmp_path / "out"))
    back = tabular.read_fasta(spark, str(tmp_path / "out" / "part-*"))
    assert sorted(map(tuple, back.select("header", "seq").collect())) == sorted(map(tuple, df.collect()))


def test_sequence_parts_over_many_file_parts(spark, tmp_path):
    import gzip
    import random

    rnd = random.Random(3)
    want, text = set(), ";head\nACGT\n"
    for i in range(12):
        seq = "".join(rnd.choice("ACGTN") for _ in range(rnd.choice([0, 1, 59, 60, 61, 700])))
        text += f">s{i} some words\r\n" + "".join(seq[k : k + 60] + "\n" for k in range(0, len(seq), 60)) + "\n" * (i % 2)
        want.update({(f"s{i}", f"s{i} some words", k // 50, k, seq[k : k + 50]) for k in range(0, len(seq), 50)})
    (tmp_path / "a.fa").write_text(text)
    (tmp_path / "packed.fa").write_bytes(gzip.compress(text.encode()))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("97", "400", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert set(map(tuple, tabular.read_sequence_parts(spark, str(tmp_path / "a.fa"), 50).collect())) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert set(map(tuple, tabular.read_sequence_parts(spark, str(tmp_path / "packed.fa"), 50).collect())) == want
    assert tabular.read_sequence_parts(spark, str(tmp_path / "none.fa"), 50).count() == 0
    lengths = {r.seqid: r.length for r in tabular.part_lengths(tabular.read_sequence_parts(spark, str(tmp_path / "a.fa"), 50)).collect()}
    assert lengths == {n: max(o + len(s) for m, _, _, o, s in want if m == n) for n, *_ in want}


def test_tables(spark, tmp_path):
    (tmp_path / "h").write_text("q\ts\t99.5\t10\t0\t0\t20\t11\t5\t1\t1e-5\t50\nshort\trow\n")
    hit = tabular.read_hits(spark, str(tmp_path / "h")).collect()
    assert [(r.qstart, r.qend, r.sstart, r.send, r.pident) for r in hit] == [(11, 20, 1, 5, 99.5)]
    (tmp_path / "rm").write_text("   SW  perc perc perc  query position in query x x x\nscore div. del. ins. sequence begin end (left) repeat class\n\n 12 1.0 0 0 chr1 5 90 (0) + el1 Class_I/LINE 1 2\n")
    assert [tuple(r) for r in tabular.read_repeat_hits(spark, str(tmp_path / "rm")).collect()] == [("chr1", 5, 90, "el1", "Class_I/LINE")]
    (tmp_path / "sf").write_text('"TRC_1","3"\n7;TRC_2;x\nnone\n')
    assert sorted(map(tuple, tabular.read_superfamilies(spark, str(tmp_path / "sf")).collect())) == [("TRC_1", "SF3"), ("TRC_2", "SF7")]
    (tmp_path / "rd").write_text("TRC_1\t45s \t1\nTRC_1\t5S\t1\nTRC_2\tother\t1\n")
    assert [tuple(r) for r in tabular.read_rdna(spark, str(tmp_path / "rd")).collect()] == [("TRC_1", "rDNA/45S_rDNA")]
    (tmp_path / "fai").write_text("chr1\t3000000000\t6\t60\t61\nbad\n")
    assert [tuple(r) for r in tabular.read_lengths(spark, str(tmp_path / "fai")).collect()] == [("chr1", 3_000_000_000)]


def test_benchmarks(spark, tmp_path):
    for name, s in (("a", "10.5"), ("b", "99")):
        (tmp_path / f"{name}.tsv").write_text(f"s\th:m:s\tmax_rss\n{s}\t0:00:10\t-\n")
    got = tabular.read_benchmarks(spark, str(tmp_path / "*.tsv")).collect()
    assert [(r.rule, r.s, r.max_rss) for r in got] == [("b", 99.0, None), ("a", 10.5, None)]


def test_gff3_round_trip_and_split(spark, tmp_path):
    df = spark.createDataFrame([("chr1", 5, 9, "+", "tool", "TRC 1/a", None), ("chr1", 1, 3, "*", "tool", None, "x")], "seqid string, start_pos long, end_pos long, strand string, source_tool string, Name string, note string")
    sinks.write_gff3(df, str(tmp_path / "g"), ["Name", "note"])
    back = sorted((r.seqid, r.start_pos, r.end_pos, r.strand, tuple(sorted(r.attrs.items()))) for r in tabular.read_gff3(spark, str(tmp_path / "g")).collect())
    assert back == [("chr1", 1, 3, ".", (("note", "x"),)), ("chr1", 5, 9, "+", (("Name", "TRC 1/a"),))]
    sinks.write_gff3(df.limit(0), str(tmp_path / "e"), ["Name"])
    assert "##gff-version 3" in "".join(p.read_text() for p in (tmp_path / "e").glob("*.gff3"))
    sinks.write_by_name(df, str(tmp_path / "s"), "Name", ["Name"], prefix="TRC")
    assert [p.name for p in (tmp_path / "s").iterdir()] == ["TRC_1_a.gff3"]
    assert rp.labels_key("Ty1/copia x") == "ty1_copia_x"


def test_lines_of_all_kinds_of_files(spark, tmp_path):
    import gzip
    import random

    import pytest

    from spanloom.sources import ranges

    rnd = random.Random(1)
    text = ">first\n" + "".join("".join(rnd.choice("ACGT") for _ in range(rnd.choice([0, 1, 30, 60]))) + "\n" for _ in range(400)) + ">last\nAC"
    want = text.split("\n")
    data = text.encode()
    kinds = {
        "plain": data,
        "gzip": gzip.compress(data[:5000]) + gzip.compress(data[5000:]),
        "blocks": ranges.packed_blocks(data, 700) + ranges.packed_blocks(b""),
    }
    for kind, content in kinds.items():
        path = tmp_path / f"{kind}.any"
        path.write_bytes(content)
        assert ranges.kind_of(content[:18]) == kind
        for size in (300, 777, 1 << 20):
            rows = ranges.read_lines(spark, str(path), ">", size).collect()
            rows.sort(key=lambda r: (r.split, r.line))
            assert [r.value for r in rows] == want
            if kind == "plain":
                assert all(data[r.pos : r.pos + r.width].rstrip(b"\n").decode() == r.value for r in rows)
    parts = [sorted(map(tuple, tabular.read_sequence_parts(spark, str(tmp_path / f"{k}.any"), 100).collect())) for k in kinds]
    assert parts[0] == parts[1] == parts[2] and len(parts[0]) > 80
    (tmp_path / "odd.fa").write_text("no header\n")
    with pytest.raises(Exception, match="begins with"):
        ranges.read_lines(spark, str(tmp_path / "*.*"), ">").count()
    (tmp_path / "short.gz").write_bytes(kinds["gzip"][:-30])
    with pytest.raises(Exception, match="ends early|incomplete|Error"):
        ranges.read_lines(spark, str(tmp_path / "short.gz")).count()
    assert ranges.read_lines(spark, str(tmp_path / "missing")).count() == 0


def test_one_percent_of_a_file_is_one_percent_of_its_bytes(spark, tmp_path):
    from spanloom.sources import ranges

    df = spark.range(100).select(F.format_string("s%03d", "id").alias("name"), F.repeat(F.concat(F.lit("ACGTTGCAAC"), F.col("id").cast("string"), F.lit("T")), 1000).alias("seq"))
    path = str(tmp_path / "genome.fa")
    sinks.write_indexed(df, path, 70)
    size = (tmp_path / "genome.fa").stat().st_size
    whole = {r.name: r.seq for r in df.collect()}
    one = ranges.read_indexed(spark, path, size=500).filter("name = 's042'").collect()
    assert "".join(r.seq for r in sorted(one, key=lambda r: r.offset)) == whole["s042"]
    assert 0 < sum(r.read_bytes for r in one) < 0.012 * size
    some = ranges.read_indexed(spark, path, size=500).filter("name IN ('s001', 's002') AND offset > 1000 AND offset <= 2000").collect()
    assert {(r.name, r.offset, r.seq) for r in some} == {(n, o, whole[n][o : o + 500]) for n in ("s001", "s002") for o in (1500, 2000)}
    assert ranges.read_indexed(spark, path).filter("length(seq) > 5").count() == 100
    index = {(r.seqid, r.length, r.offset, r.bases, r.width) for r in ranges.index_of(spark, path).collect()}
    lines = (tmp_path / "genome.fa.fai").read_text().splitlines()
    assert index == {(n, *map(int, rest)) for n, *rest in (x.split("\t") for x in lines)} and len(lines) == 100
    regions = spark.createDataFrame([("s003", 69, 72), ("s003", 11990, 99999), ("s004", 0, 3), ("s005", 20000, 20010)], "seqid string, start_pos long, end_pos long")
    got = {(r.seqid, r.start_pos): (r.bases, r.read_bytes) for r in ranges.read_regions(regions, ranges.index_of(spark, path), path).collect()}
    assert got == {("s003", 69): (whole["s003"][68:72], 5), ("s003", 11990): (whole["s003"][11989:], len(whole["s003"][11989:])), ("s004", 0): (whole["s004"][:3], 3), ("s005", 20000): ("", 0)}


def test_files_appear_whole_or_not_at_all(spark, tmp_path):
    import pytest

    from spanloom.sources.writer import write_buckets

    df = spark.range(2000).select(F.when(F.col("id") % 3 == 0, "big").otherwise("a b").alias("bucket"), F.col("id").alias("k"), F.format_string("line %04d", "id").alias("value"))
    path = tmp_path / "out"
    write_buckets(df.repartition(5), str(path), ["k"], "# head", ".txt", always=("none", "big"))
    found = {}
    for file in sorted(path.iterdir()):
        head, *lines = file.read_text().splitlines()
        assert head == "# head" and lines == sorted(lines)
        found.setdefault(file.name.split(".")[0], []).extend(lines)
    assert {k: len(v) for k, v in found.items()} == {"big": 667, "a b": 1333, "none": 0} and all(v == sorted(v) for v in found.values())
    bad = df.withColumn("value", F.when(F.col("k") < 1900, F.col("value")).otherwise(F.raise_error(F.lit("stop"))))
    with pytest.raises(Exception, match="stop"):
        write_buckets(bad, str(tmp_path / "bad"), ["k"])
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
    with pytest.raises(Exception, match="exists"):
        write_buckets(df, str(path), ["k"])
    write_buckets(df.limit(3), str(path), ["k"], overwrite=True)
    assert sum(len(p.read_text().splitlines()) for p in path.iterdir()) == 3


def test_packing_in_order(spark):
    import random

    from spanloom.functions import sequences as sq

    rnd = random.Random(4)
    sizes = [rnd.choice([0, 0, 1, 5, 30, 99, 100, 101, 250]) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(sizes)), "k long, size long").repartition(4)
    want, bin_, total, begun = {}, 0, 0, False
    for k, n in enumerate(sizes):
        if begun and total > 0 and total + n > 100:
            bin_, total = bin_ + 1, 0
        begun = True
        want[k] = bin_
        total += n
    assert {r.k: r.bin for r in sq.packed_in_order(spark, df, ["k"], "size", 100).collect()} == want
    assert sq.packed_in_order(spark, df.limit(0), ["k"], "size", 100).count() == 0


def test_n_runs_over_part_borders(spark):
    import re

    from spanloom.functions import sequences as sq

    seqs = {"a": "NNNNNNNNNNNNACnnnnnnnnnnnnnnnnnnnnnnnnnnnnnnnnnGT", "b": "N" * 40, "c": "ACGT", "d": "ANNNNNNNNNCNNNNNNNNNNNT", "e": ""}
    df = spark.createDataFrame(list(seqs.items()), "name string, seq string")
    want = {(n, m.start(), m.end()) for n, s in seqs.items() for m in re.finditer("[Nn]{10,}", s)}
    for size in (1, 3, 7, 1000):
        assert {tuple(r) for r in sq.n_runs(sq.in_parts(df, size)).collect()} == want


def test_annotation_from_files_equals_that_from_tables(spark):
    import os

    from spanloom.operators import resolve as rs
    from spanloom.plans import queries as plans

    sf = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    rows = plans.annotation_from_files(spark, sf).collect()
    assert {r.violations for r in rows} == {0} and len({r.id for r in rows}) == len(rows)
    assert {r.source_tool for r in rows} >= {"DANTE_LTR", "DANTE_TIR", "DANTE_LINE", "DANTE", "TideCluster_default", "RepeatMasker"}
    tables = plans.annotated(spark, *plans.loaded(plans.source_tables(spark, sf))).collect()
    columns = rs.FINAL
    assert sorted((tuple(r[c] for c in columns) for r in rows), key=repr) == sorted((tuple(r[c] for c in columns) for r in tables), key=repr)


def plain_bigwig(data):
    """An independent reader: walks the file by its offsets; (intervals, zoom levels, summary)."""
    import struct
    import zlib

    u = lambda form, at: struct.unpack_from("<" + form, data, at)
    magic, version, zooms, chroms, full, index, _, _, _, summary, buffer, _ = u("IHHQQQHHQQIQ", 0)
    assert magic == u("I", len(data) - 4)[0] == 0x888FFC26 and version == 4

    def names(at, key):
        leaf, _, n = u("BBH", at)
        for k in range(n):
            item = at + 4 + k * (key + 8)
            if leaf:
                yield u("I", item + key)[0], (data[item : item + key].rstrip(b"\0").decode(), u("I", item + key + 4)[0])
            else:
                yield from names(u("Q", item + key)[0], key)

    assert u("I", chroms)[0] == 0x78CA8C91
    known = dict(names(chroms + 32, u("I", chroms + 8)[0]))
    assert len(known) == u("Q", chroms + 16)[0]

    def blocks(at, bounds=None):
        leaf, _, n = u("BBH", at)
        for k in range(n):
            item = at + 4 + k * (32 if leaf else 24)
            a, b, c, d = u("IIII", item)
            assert bounds is None or (bounds[:2] <= (a, b) and (c, d) <= bounds[2:])
            if leaf:
                offset, size = u("QQ", item + 16)
                raw = zlib.decompress(data[offset : offset + size])
                assert len(raw) <= buffer
                yield (a, b, c, d), raw
            else:
                yield from blocks(u("Q", item + 16)[0], (a, b, c, d))

    def tree(at):
        assert u("I", at)[0] == 0x2468ACE0
        found = list(blocks(at + 48))
        assert len(found) == u("Q", at + 8)[0] and [x[0] for x in found] == sorted(x[0] for x in found)
        return found

    rows = []
    for (a, b, c, d), raw in tree(index):
        chrom, start, end, _, _, kind, _, n = struct.unpack_from("<IIIIIBBH", raw)
        own = [struct.unpack_from("<IIf", raw, 24 + 12 * k) for k in range(n)]
        assert (a, b, c, d) == (chrom, own[0][0], chrom, own[-1][1]) and kind == 1 and len(raw) == 24 + 12 * n
        rows += [(known[chrom][0], *x) for x in own]
    levels = []
    for k in range(zooms):
        step, _, at, where = u("IIQQ", 64 + 24 * k)
        own = [(known[r[0]][0], *r[1:]) for _, raw in tree(where) for r in struct.iter_unpack("<IIIIffff", raw)]
        levels.append((step, own))
    return rows, levels, u("Qdddd", summary), u("Q", full)[0]


def test_binary_tracks(spark, tmp_path, monkeypatch):
    import random

    import numpy as np

    from spanloom.sources import bigwig

    rnd = random.Random(2)
    rows, lengths = [], []
    for k in range(40):
        at = 1
        for _ in range(rnd.choice([0, 1, 90])):
            at += rnd.choice([0, 0, 3])
            end = at + rnd.randint(0, 30)
            rows.append((f"chr{k}" + "x" * (k % 3), at, end, round(rnd.random(), 3)))
            at = end + 1
        lengths.append((f"chr{k}" + "x" * (k % 3), at + 5))
    kind = "seqid string, start_pos long, end_pos long, score double"
    df, sizes = spark.createDataFrame(rows, kind).repartition(4), spark.createDataFrame(lengths, "seqid string, length long")
    for fan, items in ((256, 1024), (3, 7)):
        for name, value in (("FAN", fan), ("ITEMS", items), ("RECORDS", items)):
            monkeypatch.setattr(bigwig, name, value)
        path = tmp_path / f"t{fan}.bw"
        bigwig.write_bigwig(df, sizes, str(path))
        found, levels, summary, count = plain_bigwig(path.read_bytes())
        single = lambda v: float(np.float32(v))
        want = sorted((s, a - 1, b, single(v)) for s, a, b, v in rows)
        assert found == want and count >= 1 and len(levels) == 4
        bases = sum(b - a for _, a, b, _ in want)
        assert summary[0] == bases and abs(summary[3] - sum((b - a) * v for _, a, b, v in want)) < 1e-6
        for step, own in levels:
            cells = {}
            for s, a, b, v in want:
                for p in range(a, b):
                    cells.setdefault((s, p // step), []).append((p, v))
            got = {(r[0], r[1] // step): r for r in own}
            assert set(got) == set(cells) and len(got) == len(own)
            for key, r in got.items():
                values = [v for _, v in cells[key]]
                assert r[1:4] == (cells[key][0][0], cells[key][-1][0] + 1, len(values)) and r[4] == min(values) and r[5] == max(values)
                assert abs(r[6] - sum(values)) < 1e-3 * len(values) and abs(r[7] - sum(v * v for v in values)) < 1e-3 * len(values)
        back = sorted(map(tuple, bigwig.read_bigwig(spark, str(path)).collect()))
        assert back == sorted((s, a + 1, b, v) for s, a, b, v in want)
    bigwig.write_bigwig(df.limit(0), sizes, str(tmp_path / "e.bw"))
    assert plain_bigwig((tmp_path / "e.bw").read_bytes())[0] == [] and bigwig.read_bigwig(spark, str(tmp_path / "e.bw")).count() == 0
