"""Helpers shared by the corpus operators: inputs, scratch tables, text kernels."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as the contracts list it.
BLANK = r"[\x20\x09-\x0D]+"
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text column with null read as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's ``spark.checkpoint.dir``.

    Only where a local session names none (tests on one machine) a temporary folder is set.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = getattr(spark, "_spanloom_dir", None)
        if path is None:
            path = spark._spanloom_dir = tempfile.mkdtemp(prefix="spanloom-")
            spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    This cuts the lineage, so a lost executor costs only the tasks it ran, and it
    gives later joins plain scans whose skewed partitions adaptive execution can split.
    """
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    # What the written table was shuffled through isn't read again.
    clean = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(clean, "false")
    spark.conf.set(clean, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(clean, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a table made by :func:`stored` that no later plan reads."""
    root = shared_dir(spark)
    scheme = root.split(":", 1)[-1].lstrip("/")
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if scheme in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit words (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Bits of an id filter, whatever the number of ids (8 MB).
FILTER_BITS = 26


class IdFilter:
    """A bitmap of fixed size that has a bit for each id of a table, to pass by most other rows before a shuffle.

    What passes may still be no id of the table, so an exact join follows; ids of the table always pass.
    """

    def __init__(self, ids: DataFrame):
        (column,) = ids.columns

        def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = self.places(batch.column(0).to_numpy())
                mask = (np.uint64(1) << (at & np.uint64(63))).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array(mask)], ["word", "mask"])

        rows = ids.filter(F.col(column).isNotNull()).select(F.col(column).cast("long")).mapInArrow(words, "word long, mask long")
        found = rows.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
        bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
        bits[found.column("word").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
        self.bits = ids.sparkSession.sparkContext.broadcast(bits)

    @staticmethod
    def places(ids: np.ndarray) -> np.ndarray:
        return mixed(np.ascontiguousarray(ids).view(np.uint64)) >> np.uint64(64 - FILTER_BITS)

    def test(self) -> Callable[[np.ndarray], np.ndarray]:
        """A function for tasks: which of some non-null ids may be in the table."""
        bits, places = self.bits, self.places

        def maybe(ids: np.ndarray) -> np.ndarray:
            at = places(ids)
            return (bits.value[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1

        return maybe

    def column(self, ids: Column) -> Column:
        """Whether an id may be in the table; a null one may."""
        maybe = self.test()
        tested = F.pandas_udf(lambda x: pd.Series(maybe(x.to_numpy())), "boolean")
        return ids.isNull() | tested(F.coalesce(ids.cast("long"), F.lit(0).cast("long")))


class _Powers:
    """Powers of the odd hash base and of its inverse modulo 2**64, grown on demand."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << max(16, int(n - 1).bit_length())
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            for name, base in (("up", _BASE), ("down", inverse)):
                step = np.full(size, base, np.uint64)
                step[0] = 1
                setattr(cls, name, np.multiply.accumulate(step))
        return cls.up[:n], cls.down[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums P of the bytes; see :func:`span_hash`.

    Different texts can be made to collide, so these hashes only choose places; they never
    decide that bytes are equal.
    """
    up, _ = _Powers.upto(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end), the same wherever the bytes stand."""
    _, down = _Powers.upto(len(prefix))
    return mixed((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


#: Longer words are hashed one by one.
_LONG_WORD = 4096


def _tail(size: np.ndarray) -> np.ndarray:
    """Masks of the lowest ``size`` (1 to 8) bytes of a 64-bit word."""
    return np.uint64(_MASK) >> (np.uint64(64) - np.uint64(8) * size.astype(np.uint64))


def octets(data: np.ndarray) -> np.ndarray:
    """A view of the eight bytes from each place on as one number; zeros follow the data."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end), chained over eight bytes at a time."""
    lanes, size = octets(data), ends - starts
    out = mixed(size.astype(np.uint64) + _BASE)
    on = np.flatnonzero((size > 0) & (size <= _LONG_WORD))
    at = 0
    while len(on):
        lane = lanes[starts[on] + at] & _tail(np.minimum(size[on] - at, 8))
        out[on] = mixed((out[on] ^ lane) * _BASE + np.uint64(at + 1))
        at += 8
        on = on[size[on] > at]
    for i in np.flatnonzero(size > _LONG_WORD):
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated UTF-8 bytes of a string column and the n+1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[32, 9, 10, 11, 12, 13]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray, solid: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs of non-blank bytes, or of those marked ``solid``) of each text: starts, ends, index of the text."""
    solid = ~_IS_BLANK[data] if solid is None else solid
    n = len(data)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | first[1:n]
    stop = solid.copy()
    stop[:-1] &= ~solid[1:] | first[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(stop) + 1
    per_text = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, np.repeat(np.arange(len(offsets) - 1), per_text)


def shingle_hashes(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word-shingle hashes of each text (A-Z lower-cased), sorted within the text.

    Returns (hashes, offsets). A text with fewer words gives its whole word sequence as
    one shingle; a text without words gives none.
    """
    data, offsets = text_bytes(column)
    n_texts = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(n_texts + 1, np.int64)
    data = LOWER[data]
    starts, ends, owner = word_spans(data, offsets)
    hashes = word_hashes(data, starts, ends)
    per_text = np.bincount(owner, minlength=n_texts)
    first_word = np.concatenate(([0], np.cumsum(per_text)))
    left = first_word[1:][owner] - np.arange(len(owner))  # words from here to the end of the text
    span = np.minimum(words, per_text[owner])  # a short text is one shorter shingle
    at = np.flatnonzero(left >= span)
    value = np.zeros(len(at), np.uint64)
    for k in range(words):
        inside = span[at] > k
        step = np.zeros(len(at), np.uint64)
        step[inside] = hashes[at[inside] + k]
        value = np.where(inside, mixed(value * np.uint64(0x100000001B3) + step + np.uint64(k + 1)), value)
    own = owner[at]
    order = np.lexsort((value, own))
    value, own = value[order], own[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (own[1:] != own[:-1])
    value, own = value[fresh], own[fresh]
    return value, np.concatenate(([0], np.cumsum(np.bincount(own, minlength=n_texts))))


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20, also: str | None = None) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts (of one or two columns) hold about ``limit`` bytes, one row at least."""
    size = np.diff(text_bytes(batch.column(column))[1])
    if also:
        size = size + np.diff(text_bytes(batch.column(also))[1])
    total, begin = 0, 0
    for i, n in enumerate(size):
        if total and total + n > limit:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += int(n)
    if begin < batch.num_rows:
        yield batch.slice(begin)
