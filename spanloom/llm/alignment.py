"""Alignment of two tokenizers over the same texts by elementary intervals.

The ends of both tokenizers' tokens, taken together, cut a text's bytes into elementary intervals; each
interval lies in one token of either side, which are its owners. An end that both sides have closes a group,
and the tokens of a group are linked each with each. How many documents hold a pair of ids linked is
counted over the corpus and looked up again for every link.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import dropped, slices, stored, text_bytes
from spanloom.llm.tokens import load_encoder

#: Links that are expanded at once in a task.
LINKS = 1 << 22
#: Most pairs of ids whose counts are sent to all tasks (13 bytes each); the rest is joined.
COMMON_PAIRS = 1 << 20


@dataclass
class Aligned:
    """Tokens of many texts in one row of bytes, their groups and elementary intervals.

    ``a`` and ``b`` are ids; ``a_group`` and ``b_group`` rise from 0; ``ends``, ``a_owner`` and ``b_owner``
    describe the intervals; ``text`` is each group's text and ``closes`` its last byte's end.
    """

    a: np.ndarray
    b: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    ends: np.ndarray
    a_owner: np.ndarray
    b_owner: np.ndarray
    closes: np.ndarray


def aligned(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray) -> Aligned:
    """Elementary intervals and groups of two tokenizations of the same bytes, given their tokens' ends.

    Every text's last byte ends a token on both sides, so texts laid end to end never share a group.
    """
    # The union of both end arrays, taken by marking bytes: both are sorted, and np.union1d would hash them.
    ends = np.zeros(int(a_ends[-1]) + 1 if len(a_ends) else 0, bool)
    ends[a_ends], ends[b_ends] = True, True
    ends = np.flatnonzero(ends)
    a_owner, b_owner = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
    shared = (a_ends[a_owner] == ends) & (b_ends[b_owner] == ends) if len(ends) else np.zeros(0, bool)
    # An interval's group is the number of shared ends before its own.
    group = np.cumsum(shared) - shared
    a_group, b_group = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    a_group[a_owner], b_group[b_owner] = group, group
    return Aligned(a, b, a_group, b_group, ends, a_owner, b_owner, ends[shared])


def group_links(found: Aligned, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of linked tokens (of a, of b): the products of the groups ``first`` to ``last`` (exclusive)."""
    lo, hi = np.searchsorted(found.a_group, (first, last))
    n_b = np.bincount(found.b_group, minlength=last)
    start_b = np.cumsum(n_b) - n_b
    own = found.a_group[lo:hi]
    times = n_b[own]
    ends = np.cumsum(times)
    step = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - times, times)
    return np.repeat(np.arange(lo, hi), times), np.repeat(start_b[own], times) + step


def pair_counts(found: Aligned, text_of: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Each text's distinct linked pairs (text, a * width + b, links), texts in order and whole.

    Groups are expanded in runs of about LINKS links; one group of more is expanded from its distinct ids.
    """
    n_a, n_b = np.bincount(found.a_group), np.bincount(found.b_group)
    texts = np.append(np.flatnonzero(np.append(True, text_of[1:] != text_of[:-1])), len(text_of)) if len(text_of) else np.zeros(1, np.int64)
    total = np.concatenate(([0], np.cumsum(n_a * n_b)))
    begin = 0
    while begin < len(texts) - 1:
        end = max(begin + 1, int(np.searchsorted(total[texts], total[texts[begin]] + LINKS, "right")) - 1)
        lo, hi = int(texts[begin]), int(texts[end])
        parts = []
        at = lo
        while at < hi:
            to = min(hi, max(at + 1, int(np.searchsorted(total, total[at] + LINKS, "right")) - 1))
            if total[to] - total[at] <= LINKS:
                i, j = group_links(found, at, to)
                key = (text_of[found.a_group[i]] - text_of[lo]).astype(np.int64)
                code = found.a[i].astype(np.int64) * width + found.b[j]
                parts.append(summed(key, code, np.ones(len(code), np.int64)))
            else:
                x, nx = np.unique(found.a[np.searchsorted(found.a_group, at) : np.searchsorted(found.a_group, to)], return_counts=True)
                y, ny = np.unique(found.b[np.searchsorted(found.b_group, at) : np.searchsorted(found.b_group, to)], return_counts=True)
                code = (x.astype(np.int64)[:, None] * width + y[None, :]).ravel()
                parts.append((np.full(len(code), text_of[at] - text_of[lo]), code, (nx[:, None] * ny[None, :]).ravel()))
            at = to
        key, code, n = summed(*(np.concatenate(c) for c in zip(*parts))) if len(parts) > 1 else parts[0]
        yield key + text_of[lo], code, n
        begin = end


def summed(key: np.ndarray, code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows (key, code) without repeats, in order, and their sums of ``n``."""
    if not len(key):
        return key, code, n
    span = int(code.max()) + 1
    both = key * span + code
    order = np.argsort(both)
    both = both[order]
    first = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
    return both[first] // span, both[first] % span, np.add.reduceat(n[order], first)


class Vocabulary:
    """The bytes of all ids of one side, laid end to end."""

    def __init__(self, tokens: list[bytes | None]):
        self.size = np.array([len(t or b"") for t in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(t or b"" for t in tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the ids one after another, and where each ends."""
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.data[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.start[ids] - (ends - size), size)], ends


def decimal_table(n: int) -> np.ndarray:
    """The decimal digits of 0 to n - 1 in rows, zero bytes before them."""
    width = len(str(max(0, n - 1)))
    return np.array([list(str(i).encode().rjust(width, b"\0")) for i in range(n)], np.uint8).reshape(n, width)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[Vocabulary, np.ndarray]:
    """Bytes and decimal digits of all ids of a vocabulary file, once for each worker process."""
    words = Vocabulary(load_encoder(path).token_bytes())
    return words, decimal_table(len(words.size))


def group_texts(found: Aligned, digits: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3`` with a mark after each id, and the end of each group in it."""
    n_a, n_b = np.bincount(found.a_group), np.bincount(found.b_group)
    before = np.cumsum(n_a + n_b) - (n_a + n_b)
    width = max(d.shape[1] for d in digits)
    out = np.zeros((len(found.a) + len(found.b), width + 1), np.uint8)
    for ids, group, n, base, table, mark in (
        (found.a, found.a_group, n_a, before, digits[0], b"|"),
        (found.b, found.b_group, n_b, before + n_a, digits[1], b";"),
    ):
        rank = np.arange(len(ids)) - (np.cumsum(n) - n)[group]
        row = base[group] + rank
        out[row, width - table.shape[1] : width] = table[ids]
        out[row, width] = np.where(rank + 1 == n[group], ord(mark), ord(","))
    flat = out.ravel()
    used = np.concatenate(([0], np.cumsum((out != 0).sum(axis=1))))
    return flat[flat != 0], used[np.cumsum(n_a + n_b)]


ROWS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"


def align_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Counts, digest and distinct linked pairs (a * ids of b + b) of every document; see :func:`align_tokenizers`."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        a_side, b_side = load_encoder(a_path), load_encoder(b_path)
        (a_words, a_digits), (b_words, b_digits) = vocabulary(a_path), vocabulary(b_path)
        digits = a_digits, b_digits
        width, row = len(b_words.size), TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                n = part.num_rows
                data, offsets = text_bytes(part.column("text"))
                want = np.insert(data, offsets[:-1], 32)  # a space before each text
                size = np.diff(offsets) + 1
                sides, good = [], size > 1
                for ids, ends, words in (
                    (*a_side.encode(part.column("text"), " "), a_words),
                    (*b_side.encode(part.column("text")), b_words),
                ):
                    joined, token_ends = words.joined(ids)
                    stop = np.concatenate(([0], token_ends))[ends]
                    for i in np.flatnonzero(good):
                        begin = offsets[i] + i
                        good[i] = np.array_equal(joined[stop[i] : stop[i + 1]], want[begin : begin + size[i]])
                    sides.append((ids, ends))
                taken = []
                for (ids, ends), words in zip(sides, (a_words, b_words)):
                    keep = np.repeat(good, np.diff(ends))
                    taken += [ids[keep], np.cumsum(words.size[ids[keep]])]
                found = aligned(*taken)
                # The texts that have tokens lie end to end.
                text_of = np.flatnonzero(good)[np.searchsorted(np.cumsum(size[good]), found.closes)]
                n_a, n_b = (np.where(good, np.diff(ends), 0) for _, ends in sides)
                n_groups = np.bincount(text_of, minlength=n)
                products = np.bincount(found.a_group, minlength=len(text_of)) * np.bincount(found.b_group, minlength=len(text_of))
                n_links = np.zeros(n, np.int64)
                np.add.at(n_links, text_of, products)
                text, closes = group_texts(found, digits)
                last = np.concatenate(([0], closes))[np.cumsum(n_groups)]
                first = np.concatenate(([0], last[:-1]))
                shas = [hashlib.sha256(text[b : e - 1]).hexdigest() if ok else "" for b, e, ok in zip(first, last, good)]
                pairs = [np.zeros((3, 0), np.int64), *(np.stack(x) for x in pair_counts(found, text_of, width))]
                key, code, times = np.concatenate(pairs, axis=1)
                bounds = pa.array(np.searchsorted(key, np.arange(n + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + n)), part.column("doc_id"), *map(pa.array, (n_a, n_b, n_groups, n_links)), pa.array(shas, pa.string()),
                        pa.ListArray.from_arrays(bounds, pa.array(code)), pa.ListArray.from_arrays(bounds, pa.array(times.astype(np.int32))),
                    ],
                    [x.split()[0] for x in ROWS.split(", ")],
                )
                row += n

    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows_in.mapInArrow(align, ROWS)


def linked_pairs(spark: SparkSession, rows: DataFrame, width: int) -> DataFrame:
    """Stored (pair, n, best): how many documents hold a pair, and whether no pair of its A id is in more.

    Sums are taken inside tasks first; A ids are at most as many as the vocabulary has.
    """
    counts = stored(spark, rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "counts")
    own = F.expr(f"pair div {width}")
    most = counts.groupBy(own.alias("a")).agg(F.max("n").alias("most"))
    out = counts.withColumn("a", own).join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    out = stored(spark, out, "linked")
    dropped(spark, counts)
    return out


def common_from(pairs: DataFrame, most: int) -> int:
    """The smallest count from which on at most ``most`` pairs have it, from a histogram of counts by eighths of octaves."""
    step = F.floor(F.log2("n") * 8)
    steps = pairs.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("n")).orderBy(F.col("s").desc()).collect()
    least, total = 1 << 62, 0
    for r in steps:
        total += r["k"]
        if total > most:
            break
        least = r["n"]
    return least


SCORED = f"{ROWS}, n_best long, count_sum long"


def scored(rows: DataFrame, common: pa.Table) -> DataFrame:
    """The rows with their sums over links of common pairs (pair, n, best); ``pairs`` then holds the others."""
    order = np.argsort(common.column("pair").to_numpy())
    pair, n = (common.column(c).to_numpy()[order] for c in ("pair", "n"))
    best = common.column("best").to_numpy(zero_copy_only=False)[order]
    given = rows.sparkSession.sparkContext.broadcast((pair, n, best))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = given.value
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("times")
            bounds = lists.offsets.to_numpy()
            code, times = (x.values.to_numpy()[bounds[0] : bounds[-1]] for x in (lists, times))
            bounds = bounds - bounds[0]
            at = np.minimum(np.searchsorted(pair, code), max(0, len(pair) - 1))
            known = pair[at] == code if len(pair) else np.zeros(len(code), bool)
            links = np.where(known, times, 0)
            found = []
            for value in (best, n):
                total = np.concatenate(([0], np.cumsum(links * value[at] if len(pair) else links)))
                found.append(pa.array(total[bounds[1:]] - total[bounds[:-1]]))
            left = pa.array(np.concatenate(([0], np.cumsum(~known)))[bounds], pa.int32())
            others = [pa.ListArray.from_arrays(left, pa.array(x[~known])) for x in (code, times)]
            names = [x.split()[0] for x in SCORED.split(", ")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:-4]), *others, *found], names)

    return rows.mapInArrow(score, SCORED)


def align_tokenizers(spark: SparkSession, docs: DataFrame, a_path: str, b_path: str, common: int = COMMON_PAIRS) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Both sides encode a space and the text. Ends that both have cut the tokens into groups, whose
    tokens are linked each with each. A pair of ids counts the documents (rows) that hold it linked; ``n_best``
    are the links whose pair no other pair of the same A id exceeds, ``count_sum`` sums the counts over links.

    Null and empty texts, and those that a side doesn't give back byte by byte, have no tokens: zeros and ''.
    Repeated rows count each; null ids get rows like any other; very long texts are encoded in parts; an empty
    table gives no rows; other columns are ignored.

    The most frequent pairs, ``common`` at most, are looked up inside tasks; what links other pairs have
    is joined with their counts, so hot pairs are never shuffled and no pair is left out.
    """
    width = len(load_encoder(b_path).token_bytes())
    rows = stored(spark, align_documents(docs, a_path, b_path), "aligned")
    pairs = linked_pairs(spark, rows, width)
    least = common_from(pairs, common)
    found = stored(spark, scored(rows, pairs.filter(F.col("n") >= least).toArrow()), "scored")
    dropped(spark, rows)
    rest = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), "x.times")
    rest = rest.join(pairs.filter(F.col("n") < least), "pair")
    rest = rest.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times").cast("long")).otherwise(0)).alias("_best"), F.sum(F.col("times") * F.col("n")).alias("_sum"))
    zero = F.lit(0)
    return found.join(rest, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("_best", zero)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", zero)).alias("count_sum"),
        "groups_sha256",
    )
