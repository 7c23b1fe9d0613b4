"""Binary tracks (bigWig): blocks packed in tasks, offsets by prefix sums, a tree of blocks and zoom levels over them.

All parts of a file are rows (at, value): data blocks, tree nodes, zoom blocks and the heads. Where each begins follows
from sums and counts, so tasks write them at their places and no task or driver holds the file. Numbers are
little-endian; intervals are 0-based half-open inside the file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from spanloom.operators.intervals import clipped
from spanloom.operators.ordered import placed, running, totalled
from spanloom.operators.scratch import settled
from spanloom.operators.sweep import local
from spanloom.sources.files import located, write_placed

# Fixed values of the format.
MAGIC, CHROM_MAGIC, TREE_MAGIC = 0x888FFC26, 0x78CA8C91, 0x2468ACE0
VERSION, BED_GRAPH = 4, 1
HEAD, ZOOM_HEAD, SUMMARY, TREE_HEAD, CHROM_HEAD = 64, 24, 40, 48, 32
# End of fixed values.

#: Intervals in a block, records in a zoom block, entries in a tree node.
ITEMS, RECORDS, FAN = 1024, 512, 256
ITEM = np.dtype([("start", "<u4"), ("end", "<u4"), ("value", "<f4")])
RECORD = np.dtype([("chrom", "<u4"), ("start", "<u4"), ("end", "<u4"), ("valid", "<u4"), ("min", "<f4"), ("max", "<f4"), ("sum", "<f4"), ("squares", "<f4")])
LEAF = np.dtype([("chrom", "<u4"), ("start", "<u4"), ("chrom_end", "<u4"), ("end", "<u4"), ("offset", "<u8"), ("size", "<u8")])
INNER = np.dtype([("chrom", "<u4"), ("start", "<u4"), ("chrom_end", "<u4"), ("end", "<u4"), ("offset", "<u8")])
BLOCK = "chrom long, block long, start long, chrom_end long, end long, value binary"


def _filled(table: pa.Table, kind: np.dtype) -> np.ndarray:
    out = np.zeros(table.num_rows, kind)
    for name in kind.names:
        if name in table.column_names:
            out[name] = table.column(name).to_numpy()
    return out


def _blocks(rows: DataFrame, items: int, records: bool) -> DataFrame:
    """BLOCK rows of ``items`` rows each, in order of (chrom, start); blocks of zoom records or of intervals."""
    rows = running(rows, ["chrom"], "start", ["start"], F.lit(1), "_n").withColumn("block", F.floor((F.col("_n") - 1) / items))

    def fold(table: pa.Table) -> pa.Table:
        chrom, start, end = (table.column(c)[k].as_py() for c, k in (("chrom", 0), ("start", 0), ("end", table.num_rows - 1)))
        if records:
            data = _filled(table, RECORD).tobytes()
        else:
            head = struct.pack("<IIIIIBBH", chrom, start, end, 0, 0, BED_GRAPH, 0, table.num_rows)
            data = head + _filled(table, ITEM).tobytes()
        return pa.table({"chrom": [chrom], "block": [table.column("block")[0].as_py()], "start": [start], "chrom_end": [chrom], "end": [end], "value": [zlib.compress(data)]})

    return local(rows, ["chrom", "block"], ["start"], fold, BLOCK)


def _tree(spark: SparkSession, blocks: DataFrame, begin: int, count: int, data_end: int) -> tuple[DataFrame, int]:
    """Rows (at, value) of the tree over stored blocks (chrom, start, chrom_end, end, offset, size, n from 0), and where it ends."""
    levels = [-(-max(count, 1) // FAN)]
    while levels[-1] > 1:
        levels.append(-(-levels[-1] // FAN))
    sizes = [4 + FAN * (LEAF if k == 0 else INNER).itemsize for k in range(len(levels))]
    # The root comes first, the leaves last.
    starts, at = {}, begin + TREE_HEAD
    for k in reversed(range(len(levels))):
        starts[k] = at
        at += levels[k] * sizes[k]
    entries = blocks.select("chrom", "start", "chrom_end", "end", "offset", "size", "n")
    bounds = entries.agg(F.min(F.struct("chrom", "start")).alias("a"), F.max(F.struct("chrom_end", "end")).alias("b")).first()
    a, b = (bounds["a"] or (0, 0)), (bounds["b"] or (0, 0))
    head = struct.pack("<IIQIIIIQII", TREE_MAGIC, FAN, count, a[0], a[1], b[0], b[1], data_end, ITEMS, 0)
    out = spark.createDataFrame([(begin, bytearray(head))], "at long, value binary")
    for k in range(len(levels)):
        kind = LEAF if k == 0 else INNER
        own = entries.withColumn("node", F.floor(F.col("n") / FAN))

        def fold(table: pa.Table, kind=kind, k=k) -> pa.Table:
            data = struct.pack("<BBH", k == 0, 0, table.num_rows) + _filled(table, kind).tobytes()
            node = table.column("node")[0].as_py()
            far = max(zip(table.column("chrom_end").to_pylist(), table.column("end").to_pylist()))
            return pa.table({"n": [node], "chrom": [table.column("chrom")[0].as_py()], "start": [table.column("start")[0].as_py()], "chrom_end": [far[0]], "end": [far[1]], "value": [data]})

        nodes = settled(spark, local(own, ["node"], ["n"], fold, "n long, chrom long, start long, chrom_end long, end long, value binary"))
        place = F.lit(starts[k]) + F.col("n") * sizes[k]
        out = out.unionByName(nodes.select(place.alias("at"), "value"))
        entries = nodes.select("chrom", "start", "chrom_end", "end", place.alias("offset"), F.lit(0).cast("long").alias("size"), "n")
    return out, at


def _section(spark: SparkSession, rows: DataFrame, begin: int, head: int, items: int, records: bool) -> tuple[DataFrame, int, int, int]:
    """A data section from ``begin`` on, behind ``head`` bytes, and its tree: rows, tree's place, end, blocks."""
    blocks = _blocks(rows, items, records).withColumn("size", F.octet_length("value").cast("long"))
    blocks = placed(spark, totalled(spark, settled(spark, blocks), ["chrom", "start"], "size", "skip"), ["chrom", "start"], "n")
    blocks = settled(spark, blocks.withColumn("n", F.col("n") - 1).withColumn("offset", F.lit(begin + head) + F.col("skip")))
    count, size = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    tree_at = begin + head + size
    tree, end = _tree(spark, blocks, tree_at, count, tree_at)
    count_bytes = struct.pack("<Q", count) if head == 8 else struct.pack("<I", count)
    out = blocks.select(F.col("offset").alias("at"), "value").unionByName(tree)
    return out.unionByName(spark.createDataFrame([(begin, bytearray(count_bytes))], "at long, value binary")), tree_at, end, count


def write_bigwig(track: DataFrame, lengths: DataFrame, path: str, zooms: int = 4) -> None:
    """Runs (seqid, start_pos, end_pos, score) as one binary track with ``zooms`` levels.

    Runs don't overlap; those of sequences without a length are left out. Values are stored with single precision. The first level
    sums over ten mean runs, each further one over four times as much. Sequences are numbered by name; an empty
    track is a file without blocks.
    """
    spark = track.sparkSession
    chroms = settled(spark, placed(spark, lengths.select("seqid", "length").distinct(), ["seqid"], "chrom").withColumn("chrom", F.col("chrom") - 1))
    rows = track.join(chroms, "seqid").select("chrom", F.col("seqid"), (F.col("start_pos") - 1).alias("start"), F.col("end_pos").alias("end"), F.col("score").cast("float").alias("value"))
    rows = settled(spark, rows)
    width = F.col("end") - F.col("start")
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bases"), F.min("value").alias("low"), F.max("value").alias("high"), F.coalesce(F.sum(F.col("value").cast("double") * width), F.lit(0.0)).alias("sum"), F.coalesce(F.sum(F.col("value").cast("double") ** 2 * width), F.lit(0.0)).alias("squares")).first()
    names = chroms.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.octet_length("seqid")), F.lit(1)).alias("key"), F.coalesce(F.max("length"), F.lit(1)).alias("longest")).first()
    reduction = max(10, 10 * total["bases"] // max(1, total["n"]))
    steps = [reduction * 4**k for k in range(zooms)] if total["n"] else []

    summary_at = HEAD + ZOOM_HEAD * len(steps)
    chrom_at = summary_at + SUMMARY
    chrom_rows, data_at = _chrom_tree(spark, chroms, chrom_at, names["n"], names["key"])
    parts, index_at, end, _ = _section(spark, rows, data_at, 8, ITEMS, False)
    parts = parts.unionByName(chrom_rows)
    heads = b""
    for step in steps:
        spans = rows.select(F.col("chrom"), F.col("chrom").alias("seqid"), (F.col("start") + 1).alias("start_pos"), F.col("end").alias("end_pos"), F.col("value").cast("double").alias("v"))
        cut = clipped(spans, step).withColumn("_w", F.col("end_pos") - F.col("start_pos") + 1)
        zoom = cut.groupBy("chrom", "bin").agg(
            (F.min("start_pos") - 1).alias("start"), F.max("end_pos").alias("end"), F.sum("_w").alias("valid"), F.min("v").alias("min"), F.max("v").alias("max"),
            F.sum(F.col("v") * F.col("_w")).alias("sum"), F.sum(F.col("v") ** 2 * F.col("_w")).alias("squares"),
        )
        more, tree_at, after, _ = _section(spark, settled(spark, zoom.drop("bin")), end, 4, RECORDS, True)
        heads += struct.pack("<IIQQ", step, 0, end, tree_at)
        parts, end = parts.unionByName(more), after
    head = struct.pack("<IHHQQQHHQQIQ", MAGIC, VERSION, len(steps), chrom_at, data_at, index_at, 0, 0, 0, summary_at, max(24 + ITEMS * ITEM.itemsize, RECORDS * RECORD.itemsize), 0)
    summary = struct.pack("<Qdddd", total["bases"], total["low"] or 0.0, total["high"] or 0.0, total["sum"], total["squares"])
    rest = [(0, bytearray(head + heads)), (summary_at, bytearray(summary)), (end, bytearray(struct.pack("<I", MAGIC)))]
    write_placed(parts.unionByName(spark.createDataFrame(rest, "at long, value binary")), path)


def _chrom_tree(spark: SparkSession, chroms: DataFrame, begin: int, count: int, key: int) -> tuple[DataFrame, int]:
    """Rows (at, value) of the tree of names (seqid, length, chrom from 0), and where it ends."""
    levels = [-(-max(count, 1) // FAN)]
    while levels[-1] > 1:
        levels.append(-(-levels[-1] // FAN))
    size = 4 + FAN * (key + 8)
    starts, at = {}, begin + CHROM_HEAD
    for k in reversed(range(len(levels))):
        starts[k] = at
        at += levels[k] * size
    head = struct.pack("<IIIIQQ", CHROM_MAGIC, FAN, key, 8, count, 0)
    out = spark.createDataFrame([(begin, bytearray(head))], "at long, value binary")
    entries = chroms.select("seqid", F.col("chrom").alias("n"), F.col("chrom").alias("a"), F.col("length").cast("long").alias("b"))
    for k in range(len(levels)):
        own = entries.withColumn("node", F.floor(F.col("n") / FAN))

        def fold(table: pa.Table, k=k) -> pa.Table:
            rows = list(zip(*(table.column(c).to_pylist() for c in ("seqid", "a", "b"))))
            pack = (lambda a, b: struct.pack("<II", a, b)) if k == 0 else (lambda a, b: struct.pack("<Q", a))
            data = struct.pack("<BBH", k == 0, 0, len(rows)) + b"".join(s.encode().ljust(key, b"\0") + pack(a, b) for s, a, b in rows)
            return pa.table({"n": [table.column("node")[0].as_py()], "seqid": [rows[0][0]], "value": [data.ljust(size, b"\0")]})

        nodes = settled(spark, local(own, ["node"], ["n"], fold, "n long, seqid string, value binary"))
        place = F.lit(starts[k]) + F.col("n") * size
        out = out.unionByName(nodes.select(place.alias("at"), "value"))
        entries = nodes.select("seqid", "n", place.alias("a"), F.lit(0).cast("long").alias("b"))
    return out, at


@dataclass
class TreeNode(InputPartition):
    """A node of the block tree, below which one task reads."""

    at: int
    names: dict[int, str]


class BigWigReader(DataSourceReader):
    """Reads intervals block by block; the tree's inner nodes are split into tasks."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]

    def partitions(self) -> list[TreeNode]:
        system, place = located(self.path)
        with system.open_input_file(place) as file:
            magic, _, _, chrom_at, _, index_at = struct.unpack("<IHHQQQ", self._at(file, 0, 32))
            if magic != MAGIC:
                raise ValueError(f"{self.path} is no binary track")
            names = dict(self._names(file, chrom_at))
            nodes, inner = [index_at + TREE_HEAD], []
            while nodes and len(nodes) < 256:
                leaf, _, count = struct.unpack("<BBH", self._at(file, nodes[0], 4))
                if leaf:
                    break
                inner = [n for at in nodes for n in self._children(file, at)]
                nodes = inner
        return [TreeNode(at, names) for at in nodes] or [TreeNode(0, {})]

    @staticmethod
    def _at(file, at: int, n: int) -> bytes:
        file.seek(at)
        return file.read(n)

    def _names(self, file, begin: int) -> Iterator[tuple[int, str]]:
        key = struct.unpack("<I", self._at(file, begin + 8, 4))[0]
        todo = [begin + CHROM_HEAD]
        while todo:
            at = todo.pop()
            leaf, _, count = struct.unpack("<BBH", self._at(file, at, 4))
            data = self._at(file, at + 4, count * (key + 8))
            for k in range(count):
                item = data[k * (key + 8) : (k + 1) * (key + 8)]
                if leaf:
                    yield struct.unpack("<I", item[key : key + 4])[0], item[:key].rstrip(b"\0").decode()
                else:
                    todo.append(struct.unpack("<Q", item[key:])[0])

    def _children(self, file, at: int) -> list[int]:
        count = struct.unpack("<H", self._at(file, at + 2, 2))[0]
        return np.frombuffer(self._at(file, at + 4, count * INNER.itemsize), INNER)["offset"].tolist()

    def read(self, part: TreeNode) -> Iterator[pa.RecordBatch]:
        system, place = located(self.path)
        with system.open_input_file(place) as file:
            todo = [part.at] if part.at else []  # an empty tree has no nodes
            while todo:
                at = todo.pop()
                leaf, _, count = struct.unpack("<BBH", self._at(file, at, 4))
                if not leaf:
                    todo += self._children(file, at)
                    continue
                for entry in np.frombuffer(self._at(file, at + 4, count * LEAF.itemsize), LEAF):
                    data = zlib.decompress(self._at(file, int(entry["offset"]), int(entry["size"])))
                    chrom, _, _, _, _, kind, _, n = struct.unpack("<IIIIIBBH", data[:24])
                    if kind != BED_GRAPH:
                        raise ValueError(f"{self.path}: blocks of kind {kind} aren't read")
                    items = np.frombuffer(data[24:], ITEM)
                    yield pa.RecordBatch.from_pydict(
                        {"seqid": [part.names[chrom]] * n, "start_pos": items["start"].astype(np.int64) + 1, "end_pos": items["end"].astype(np.int64), "score": items["value"].astype(np.float64)}
                    )


class BigWig(DataSource):
    @classmethod
    def name(cls) -> str:
        return "binary_track"

    def schema(self) -> str:
        return "seqid string, start_pos long, end_pos long, score double"

    def reader(self, schema) -> DataSourceReader:
        return BigWigReader(self.options)


def read_bigwig(spark: SparkSession, path: str) -> DataFrame:
    """Runs (seqid, start_pos, end_pos, score) of a binary track of interval blocks."""
    spark.dataSource.register(BigWig)
    return spark.read.format("binary_track").option("path", path).load()
