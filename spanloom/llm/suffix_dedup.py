"""Removal of repeated byte strings with suffix arrays built by two-stage sorting.

A byte goes when a string of ``length`` bytes that covers it also starts earlier. Every
window of that length holds an anchor: the smallest of its ``gram``-byte hashes, which equal
windows share. Runs of windows with one anchor form a context. Contexts whose anchor occurs
nowhere else are done. Equal contexts (by 128-bit digests of their bytes and the anchor's place)
repeat each other whole, so only the first of them stays in play; the firsts that share an anchor but differ somewhere are dealt to tasks, which
sort their suffixes and find the shared windows by adjacent common prefixes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanloom.llm.common import dropped, prefix_hash, slices, span_hash, stored, text_bytes, whole_text

#: Bytes of text that a task takes at once; longer texts are taken in overlapping parts.
PART = 1 << 19
#: Contexts with one anchor that a task sorts together (about 4 MB);
#: the windows of larger groups are dealt singly.
GROUP = 20_000


def eight_bytes(text: np.ndarray, beyond: int) -> np.ndarray:
    """A view of the next eight bytes of each place as one big-endian number; zeros follow the text."""
    padded = np.concatenate((text, np.zeros(beyond + 8, np.uint8)))
    return np.ndarray(len(text) + beyond, ">u8", padded, strides=(1,))


def _sorted_directly(words: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` in the order of their suffixes; only ties of the first words read further ones."""
    value = words[starts].astype(np.uint64)
    order = np.argsort(value, kind="stable").astype(np.int32)
    group = np.zeros(len(order), np.int32)
    group[1:] = np.cumsum(value[order][1:] != value[order][:-1])
    for k in range(8, depth, 8):
        tied = np.flatnonzero(np.bincount(group)[group] > 1) if len(group) else group
        if not len(tied):
            break
        value, own = words[starts[order[tied]] + k].astype(np.uint64), group[tied]
        sub = np.lexsort((value, own))
        order[tied] = order[tied][sub]
        value = value[sub]
        fresh = np.zeros(len(order), bool)
        fresh[1:] = group[1:] != group[:-1]
        fresh[tied[1:]] |= (value[1:] != value[:-1]) & (own[1:] == own[:-1])
        group = np.cumsum(fresh, dtype=np.int32)
    return starts[order]


def two_stage_suffix_array(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes at ``wanted`` (rising places) in order of their first ``depth`` bytes.

    Stage one sorts directly the suffixes that are smaller than their successors. Stage two
    scans the buckets of first bytes: a suffix that is larger than its successor takes its
    place from the successor's rank, in order of the length of its first run of equal bytes,
    and before the smaller ones of its bucket. Places that the second stage needs beyond
    the wanted ones are added and left out of the result.
    """
    n = len(text)
    if not len(wanted):
        return wanted
    change = np.flatnonzero(text[1:] != text[:-1]).astype(np.int32)  # last places of runs of equal bytes
    run_end = np.repeat(np.append(change, np.int32(n - 1)), np.diff(np.concatenate(([-1], change, [n - 1]))))
    after = np.append(text, 0)[run_end + 1].astype(np.int16)
    after[run_end == n - 1] = -1  # the end of the text is smaller than any byte
    larger = after < text
    del after
    # A larger suffix needs its successors up to the first smaller one.
    stop = np.append(np.flatnonzero(~larger).astype(np.int32), np.int32(n - 1))
    nearest = stop[np.searchsorted(stop[:-1], wanted.astype(np.int32))]
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, wanted, 1)
    np.add.at(edge, nearest + 1, -1)
    places = np.flatnonzero(np.cumsum(edge, dtype=np.int32)[:n] > 0).astype(np.int32)
    del edge, nearest, stop
    direct = _sorted_directly(eight_bytes(text, depth + 8), places[~larger[places]], depth)
    rank = np.full(n + 1, -1, np.int32)
    rank[n] = 0
    done, out = 1, []
    induced = places[larger[places]]
    by_byte = np.lexsort((run_end[induced] - induced, text[induced]))
    induced = induced[by_byte]
    run = run_end[induced] - induced
    level = np.flatnonzero((np.diff(text[induced].astype(np.int16)) != 0) | (np.diff(run) != 0)) + 1
    del by_byte, run, run_end, places
    levels = {}
    for part in np.split(induced, level):
        if len(part):
            levels.setdefault(int(text[part[0]]), []).append(part)
    bucket_ends = np.searchsorted(text[direct], np.arange(257))
    for byte in range(256):
        for part in levels.get(byte, []):
            part = part[np.argsort(rank[part + 1], kind="stable")]
            rank[part] = done + np.arange(len(part))
            done += len(part)
            out.append(part)
        part = direct[bucket_ends[byte] : bucket_ends[byte + 1]]
        rank[part] = done + np.arange(len(part))
        done += len(part)
        out.append(part)
    order = np.concatenate(out)
    asked = np.zeros(n, bool)
    asked[wanted] = True
    return order[asked[order]]


def shared_with_next(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Whether adjacent suffixes of a suffix array have a common prefix of ``depth`` bytes."""
    words = eight_bytes(text, depth + 8)
    same = np.ones(max(0, len(order) - 1), bool)
    for k in [*range(0, depth - 7, 8), max(0, depth - 8)]:
        at = np.flatnonzero(same)
        same[at] = words[order[at + 1] + k] == words[order[at] + k]
    return same


def repeats_in(contexts: list[bytes], offsets: np.ndarray, first: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """For each window of the contexts whether an equal window starts at a smaller place.

    Context i has ``counts[i]`` windows whose global places begin at ``first[i]``; the
    result lists the windows of all contexts one after another.
    """
    text = np.frombuffer(b"".join(contexts), np.uint8)
    ends = np.cumsum(counts)
    local = np.arange(ends[-1]) - np.repeat(ends - counts, counts)
    starts = np.repeat(offsets, counts) + local
    place = np.repeat(first, counts) + local
    order = two_stage_suffix_array(text, starts, length)
    window = np.searchsorted(starts, order)
    same = shared_with_next(text, order, length)
    group = np.concatenate(([0], np.cumsum(~same)))
    least = np.full(group[-1] + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, group, place[window])
    out = np.zeros(len(starts), bool)
    out[window] = place[window] > least[group]
    return out


def _contexts(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Contexts of the texts: text index, first window, windows, anchor hash, anchor's place, first window's place in ``data``."""
    width = length - gram + 1
    size = np.diff(offsets)
    if len(data) < length or size.max() < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.int64, np.int64))
    prefix = prefix_hash(data)
    at = np.arange(len(data) - gram + 1)
    grams = span_hash(prefix, at, at + gram)
    low = np.uint64((1 << 24) - 1)
    key = (grams & ~low) | at.astype(np.uint64)
    m = -(-len(key) // width) * width
    padded = np.full(m, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(key)] = key
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = len(data) - length + 1
    anchor = (np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows]) & low).astype(np.int64)
    inside = np.zeros(len(data) + 1, np.int64)
    long_ = size >= length
    np.add.at(inside, offsets[:-1][long_], 1)
    np.add.at(inside, offsets[1:][long_] - length + 1, -1)
    valid = np.flatnonzero(np.cumsum(inside)[:windows] > 0)
    anchor = anchor[valid]
    begin = np.ones(len(valid), bool)
    begin[1:] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1] + 1)
    begin = np.flatnonzero(begin)
    first = valid[begin]
    count = np.diff(np.append(begin, len(valid)))
    place = anchor[begin]
    owner = np.searchsorted(offsets, first, "right") - 1
    return owner, first - offsets[owner], count, grams[place], place - first, first


CONTEXTS = "doc_id long, first long, windows int, anchor long, h1 long, h2 long"


def contexts(docs: DataFrame, length: int, gram: int, digests: bool = True) -> DataFrame:
    """The contexts of all texts, with 128-bit digests of their bytes (else 0)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", PART):
                ids = part.column("doc_id").to_numpy(zero_copy_only=False)
                data, offsets = text_bytes(part.column("text"))
                # A slice of more than one part is a single long text.
                for begin in range(0, max(1, len(data) - length + 1), PART):
                    end = min(len(data), begin + PART + length - 1)
                    bounds = offsets if end - begin == len(data) else np.array([0, end - begin])
                    own, first, count, anchor, inside, at = _contexts(data[begin:end], bounds, length, gram)
                    halves = np.zeros((len(at), 2), np.int64)
                    if digests:
                        flat, ends = data[begin:end].tobytes(), at + count + length - 1
                        found = (
                            hashlib.blake2b(flat[b:e], digest_size=16, salt=k.to_bytes(8, "little")).digest()
                            for b, e, k in zip(at.tolist(), ends.tolist(), inside.tolist())
                        )
                        halves = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids[own], pa.int64()), pa.array(first + begin), pa.array(count.astype(np.int32)),
                            pa.array(anchor.view(np.int64)), pa.array(halves[:, 0]), pa.array(halves[:, 1]),
                        ],
                        [x.split()[0] for x in CONTEXTS.split(", ")],
                    )

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return given.mapInArrow(rows, CONTEXTS)


def _bytes_of(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Add to context rows their bytes; texts meet only the list of their own contexts."""
    lists = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("first", "windows", "anchor", "place", "large")).alias("own"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().cast("binary").alias("_bytes"))
    rows = texts.join(lists, "doc_id").select("doc_id", "_bytes", F.explode("own").alias("c")).select("doc_id", "c.*", "_bytes")
    size = F.col("windows") + F.lit(length - 1)
    return rows.withColumn("bytes", F.substring(F.col("_bytes"), (F.col("first") + 1).cast("int"), size)).drop("_bytes")


RANGES = "doc_id long, start long, windows long"


def _sort_groups(rows: DataFrame, length: int, budget: int = PART) -> DataFrame:
    """Repeated windows among contexts of one anchor, by suffix arrays over whole groups."""

    def flush(block: list) -> pa.RecordBatch:
        ids, first, windows, place, data = zip(*block)
        counts = np.array(windows, np.int64)
        size = np.array([len(d) for d in data])
        flags = repeats_in(list(data), np.cumsum(size) - size, np.array(place, np.int64), counts, length)
        edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
        begin, end = edge[::2], edge[1::2]
        ends = np.cumsum(counts)
        # A run of flags may pass from one context to the next: cut it there.
        out = []
        for b, e in zip(begin.tolist(), end.tolist()):
            while b < e:
                i = int(np.searchsorted(ends, b, "right"))
                stop = min(e, int(ends[i]))
                out.append((ids[i], first[i] + b - int(ends[i] - counts[i]), stop - b))
                b = stop
        columns = list(zip(*out)) if out else [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [x.split()[0] for x in RANGES.split(", ")])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, last = [], 0, None
        for batch in batches:
            for doc, first, windows, anchor, rank, data in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "first", "windows", "anchor", "rank", "bytes"))):
                if anchor != last and held >= budget:
                    yield flush(block)
                    block, held = [], 0
                block.append((doc, first, windows, rank, data))
                held, last = held + len(data), anchor
        if block:
            yield flush(block)

    # Places are compared within a task only, so their order can be a rank below 2**63.
    return rows.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(sort, RANGES)


def _single_windows(spark: SparkSession, rows: DataFrame, length: int) -> DataFrame:
    """Repeated windows among contexts of very common anchors: each window is dealt by its own hash."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, first, count, data in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "first", "windows", "bytes"))):
                digests = [hashlib.blake2b(data[k : k + length], digest_size=16).digest() for k in range(count)]
                halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * count, pa.int64()), pa.array(first + np.arange(count)), pa.array(halves[:, 0]), pa.array(halves[:, 1])],
                    ["doc_id", "start", "h1", "h2"],
                )

    each = stored(spark, rows.mapInArrow(windows, "doc_id long, start long, h1 long, h2 long"), "windows")
    place = _place(each, "start")
    least = stored(spark, each.groupBy("h1", "h2").agg(F.min(place).alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "least")
    return each.withColumn("place", place).join(least, ["h1", "h2"]).filter("place > least").select("doc_id", "start", F.lit(1).cast("long").alias("windows"))


def _place(df: DataFrame, start: str) -> Column:
    """One ordered number for (doc_id, start)."""
    wide = F.col("doc_id").cast("decimal(38,0)") * F.lit(1 << 31).cast("decimal(11,0)")
    return (wide + F.col(start).cast("decimal(11,0)")).cast("decimal(38,0)")


def repeated_ranges(spark: SparkSession, docs: DataFrame, length: int = 100, gram: int = 20) -> DataFrame:
    """(doc_id, start, windows): windows of ``length`` bytes that also start earlier."""
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    narrow = low is not None and low >= 0 and high < 1 << 31

    def place(df: DataFrame, start: str) -> Column:
        return F.shiftleft(F.col("doc_id"), 31) + F.col(start) if narrow else _place(df, start)

    common = contexts(docs, length, gram, digests=False).groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    common = stored(spark, common.filter("n > 1").select("anchor"), "anchors")
    every = contexts(docs, length, gram)
    key = ["anchor", "h1", "h2"]
    shared = stored(spark, every.join(common, "anchor", "left_semi").withColumn("place", place(every, "first")), "shared")
    dropped(spark, common)
    firsts = stored(spark, shared.groupBy(*key).agg(F.min("place").alias("least"), F.count(F.lit(1)).alias("n")), "firsts")
    again = shared.join(firsts.filter("n > 1").select(*key, "least"), key).filter("place > least")
    again = stored(spark, again.select("doc_id", F.col("first").alias("start"), F.col("windows").cast("long").alias("windows")), "again")

    groups = firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    leading = firsts.join(groups, "anchor").select("anchor", F.col("least").alias("place"), (F.col("members") > GROUP).alias("large"))
    leading = stored(spark, leading, "leading")
    wanted = shared.select("doc_id", "first", "windows", "anchor", "place").distinct().join(leading, ["anchor", "place"])
    wanted = stored(spark, _bytes_of(docs, wanted, length), "bytes")
    for done in (shared, firsts, leading):
        dropped(spark, done)
    small = wanted.filter("NOT large")
    if narrow:
        small = small.withColumn("rank", F.col("place"))
    else:
        small = small.withColumn("rank", F.dense_rank().over(W.partitionBy("anchor").orderBy("place")).cast("long") * F.lit(1 << 31))
    ranges = _sort_groups(small.select("doc_id", "first", "windows", "anchor", "rank", "bytes"), length)
    return again.unionByName(ranges).unionByName(_single_windows(spark, wanted.filter("large"), length))


def remove_repeats(spark: SparkSession, docs: DataFrame, length: int = 100) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, kept.

    A byte of the UTF-8 text goes when a ``length``-byte string covering it also starts earlier
    (smaller doc_id, or earlier in the same document); strings are judged on the input and
    never cross documents. ``spans`` lists the removed runs (start, end), ``kept`` holds the
    bytes that stay. Null is the empty text. Rows that repeat an id and its text count as one
    document; rows without an id, and rows that repeat an id with another text, stay whole and
    count for no other document. Columns other than doc_id and text are ignored.
    """
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    kinds = given.groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("_l"), F.max(F.xxhash64("text")).alias("_h"))
    unclear = stored(spark, kinds.filter("_l <> _h").select("doc_id"), "unclear")
    judged = given.filter("doc_id IS NOT NULL")
    if unclear.limit(1).count():
        judged = judged.join(unclear, "doc_id", "left_anti")
    ranges = stored(spark, repeated_ranges(spark, judged, length).distinct(), "ranges")
    own = ranges.groupBy("doc_id").agg(F.collect_list(F.struct("start", "windows")).alias("own"))
    rows = given.join(own, "doc_id", "left")
    rows = rows.select("doc_id", "text", F.transform("own", lambda r: r["start"]).alias("starts"), F.transform("own", lambda r: r["windows"]).alias("windows"))

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>, kept binary"
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", PART):
                out = []
                for doc, text, starts, windows in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "starts", "windows"))):
                    data, spans, kept = text.encode(), [], []
                    at = 0
                    for b, n in sorted(zip(starts or [], windows or [])):
                        e = min(b + n + length - 1, len(data))
                        if spans and b <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], e)
                        else:
                            spans.append([b, e])
                    for b, e in spans:
                        kept.append(data[at:b])
                        at = e
                    kept = b"".join([*kept, data[at:]])
                    out.append((doc, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), [{"start": b, "end": e} for b, e in spans], kept))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), span, pa.binary())
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return rows.mapInArrow(cut, schema)
