"""Exact dedup through a minimal perfect hash over historical distinct digests.

History is indexed once: its distinct digests are dealt to buckets, and each bucket gets
a minimal perfect hash whose slots hold the full 32-byte digest, the locator (doc_id) of
the winner and the number of rows. New rows are first reduced to distinct digests; a
digest whose slot holds the same bytes is a repeat of history, every other one is
a nonmember and forms a group of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import BLANK, dropped, mixed, stored, whole_text

#: Bits per remaining key in each level of the perfect hash.
GAMMA = 2.0


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, BLANK, " ")


def _digest() -> Column:
    return F.unhex(F.sha2(normalised(whole_text()).cast("binary"), 256))


class PerfectHash:
    """A minimal perfect hash: levels of bits where the keys alone at their place stay.

    A key's slot is the rank of its bit. Keys outside the set get -1 or any slot, so the
    slot's full digest decides membership.
    """

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.rank = np.concatenate(([0], np.cumsum(bits)))

    @classmethod
    def build(cls, digests: np.ndarray) -> PerfectHash:
        keys, sizes, levels = digests, [], []
        while len(keys):
            size = max(8, int(len(keys) * GAMMA))
            at = cls._place(keys, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            keys = keys[~alone[at]]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    @staticmethod
    def _place(digests: np.ndarray, level: int, size: int) -> np.ndarray:
        word = np.ascontiguousarray(digests[:, 8 * (level % 4) : 8 * (level % 4) + 8]).view(np.uint64).ravel()
        return (mixed(word + np.uint64(0x9E37_79B9 * (level + 1))) % np.uint64(size)).astype(np.int64)

    def slot(self, digests: np.ndarray) -> np.ndarray:
        out, base = np.full(len(digests), -1, np.int64), 0
        left = np.arange(len(digests))
        for level, size in enumerate(self.sizes):
            at = base + self._place(digests[left], level, size)
            hit = self.bits[at]
            out[left[hit]] = self.rank[at[hit]]
            left, base = left[~hit], base + size
        return out


def _matrix(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(d) for d in digests), np.uint8).reshape(-1, 32)


INDEX = "bucket int, sizes array<int>, bits binary, digests binary, locators binary, counts binary, named binary"
FOUND = "digest binary, keep_id long, group_size long, named boolean"


def _build(frame: pd.DataFrame) -> pd.DataFrame:
    digests = _matrix(frame["digest"])
    mph = PerfectHash.build(digests)
    order = np.argsort(mph.slot(digests))
    return pd.DataFrame(
        {
            "bucket": [int(frame["bucket"].iloc[0])],
            "sizes": [mph.sizes],
            "bits": [np.packbits(mph.bits).tobytes()],
            "digests": [digests[order].tobytes()],
            "locators": [frame["keep_id"].to_numpy(np.int64)[order].tobytes()],
            "counts": [frame["group_size"].to_numpy(np.int64)[order].tobytes()],
            "named": [frame["named"].to_numpy(bool)[order].tobytes()],
        }
    )


def _lookup(index: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
    """Merge one bucket's new digests into its historical slots."""
    if len(index):
        row = index.iloc[0]
        slots = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
        keep = np.frombuffer(row["locators"], np.int64).copy()
        count = np.frombuffer(row["counts"], np.int64).copy()
        named = np.frombuffer(row["named"], bool).copy()
        sizes = [int(s) for s in row["sizes"]]
        mph = PerfectHash(sizes, np.unpackbits(np.frombuffer(row["bits"], np.uint8))[: sum(sizes)].astype(bool))
    else:
        slots, keep, count, named = np.zeros((0, 32), np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        mph = PerfectHash([], np.zeros(0, bool))
    outside = new.iloc[:0]
    if len(new):
        digests = _matrix(new["digest"])
        slot = mph.slot(digests)
        member = slot >= 0
        member[member] = (slots[slot[member]] == digests[member]).all(axis=1)
        known = slot[member]
        np.minimum.at(keep, known, new["keep_id"].to_numpy(np.int64)[member])
        np.add.at(count, known, new["group_size"].to_numpy(np.int64)[member])
        named[known] |= new["named"].to_numpy(bool)[member]
        outside = new[~member]
    return pd.DataFrame(
        {
            "digest": [s.tobytes() for s in slots] + [bytes(d) for d in outside["digest"]],
            "keep_id": np.concatenate((keep, outside["keep_id"].to_numpy(np.int64))),
            "group_size": np.concatenate((count, outside["group_size"].to_numpy(np.int64))),
            "named": np.concatenate((named, outside["named"].to_numpy(bool))),
        }
    )


def _distinct(digests: DataFrame, buckets: int) -> DataFrame:
    """One row per digest with its smallest doc_id and its rows, summed before the shuffle.

    Where no row of a digest has an id, ``named`` is false and the id the largest number, so
    that no column passed to pandas holds a null.
    """
    groups = digests.groupBy("digest").agg(
        F.coalesce(F.min(F.col("doc_id").cast("long")), F.lit(np.iinfo(np.int64).max)).alias("keep_id"),
        F.count(F.lit(1)).alias("group_size"),
        (F.count("doc_id") > 0).alias("named"),
    )
    bucket = F.pmod(F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")
    return groups.withColumn("bucket", bucket)


def build_index(history: DataFrame, buckets: int) -> DataFrame:
    """Index rows (digest, doc_id): one row per bucket of about equally many digests."""
    return _distinct(history, buckets).groupBy("bucket").applyInPandas(_build, INDEX)


def match(index: DataFrame, new: DataFrame, buckets: int) -> DataFrame:
    """Groups (digest, keep_id, group_size) of history and ``new`` rows together."""
    new = _distinct(new, buckets)
    found = index.groupBy("bucket").cogroup(new.groupBy("bucket")).applyInPandas(_lookup, FOUND)
    return found.select("digest", F.when(F.col("named"), F.col("keep_id")).alias("keep_id"), "group_size")


def exact_groups(
    spark: SparkSession, docs: DataFrame, digests_per_bucket: int = 20_000
) -> tuple[DataFrame, DataFrame]:
    """Digests of all rows and the groups of equal digests, both as stored tables.

    The lower half of the doc_id range is the history and the rest is new to it, so one
    table passes through both halves of the method. Null ids count as history.
    """
    digests = stored(spark, docs.select("doc_id", _digest().alias("digest")), "digests")
    low, high, rows = digests.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
    buckets = max(8, -(-rows // digests_per_bucket))
    middle = (low + high) // 2 if low is not None else 0
    old = F.coalesce(F.col("doc_id") <= F.lit(middle), F.lit(True))
    index = stored(spark, build_index(digests.filter(old), buckets), "history")
    groups = stored(spark, match(index, digests.filter(~old), buckets), "groups")
    dropped(spark, index)
    return digests, groups


def exact_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after every run of ASCII blanks became one space;
    null text is empty. The smallest doc_id of a group stays. Rows that repeat a doc_id
    and its text all carry kept = true, as they are the row that stays. A null id is never
    chosen while the group has another id; a group of null ids alone has keep_id null and keeps
    all its rows, as none can be told from another. Other columns are ignored.
    """
    digests, groups = exact_groups(spark, docs)
    # Both sides are plain scans: a digest that a third of the rows share is split by AQE.
    return digests.join(groups, "digest", "left").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Documents without exact copies; the columns stay as they are.

    A repeated identical row stays as often as it occurs; of rows without an id those go whose text
    a row with an id has too.
    """
    digests, groups = exact_groups(spark, docs)
    gone = (
        digests.join(groups.filter("group_size > 1"), "digest")
        .filter(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .select("doc_id", "digest")
    )
    same = docs["doc_id"].eqNullSafe(gone["doc_id"]) & (_digest() == gone["digest"])
    return docs.join(gone, same, "left_anti")
