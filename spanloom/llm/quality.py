"""Quality classifier: regularised quadratic discriminant over document statistics.

Each document becomes a short vector of transformed statistics. Each class gets a Gaussian
whose covariance is shrunk towards the pooled one; its Cholesky factor is inverted once, and a
score is the logistic of the log-density difference, divided by the root of the number of
statistics, from two products with the cached inverse factors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import slices, stored, text_bytes, word_hashes, word_spans

_SYMBOLS = b"*$%&#~^<>{}=\\@_+`"
#: Byte classes that are counted: 0 other, 1 upper, 2 lower, 3 digit, 4 blank, 5 bang, 6 bar, 7 symbol, 8 point, 9 non-ASCII.
_KIND = np.zeros(256, np.int64)
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[128:] = 1, 2, 3, 9
_KIND[[32, 9, 10, 11, 12, 13]] = 4
_KIND[ord("!")], _KIND[ord("|")] = 5, 6
_KIND[list(_SYMBOLS)] = 7
_KIND[list(b".,;:?")] = 8
FEATURES = (
    "log_words", "log_word_length", "spread_word_length", "upper", "digit", "bang", "bar", "symbol", "point",
    "non_ascii", "distinct_words", "repeated_next", "top_word", "lines", "short_words", "distinct_pairs",
)


def _distinct(values: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and the largest count of one value, by owner."""
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    first = np.ones(len(v), bool)
    first[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    at = np.flatnonzero(first)
    most = np.zeros(n)
    np.maximum.at(most, o[at], np.diff(np.append(at, len(v))))
    return np.bincount(o[at], minlength=n), most


def statistics(column: pa.Array) -> np.ndarray:
    """The transformed statistics (rows x FEATURES) of whole texts; null and empty give one fixed row."""
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    out = np.zeros((n, len(FEATURES)))
    if not n:
        return out
    size = np.diff(offsets)
    chars = np.bincount(np.repeat(np.arange(n) * 10, size) + _KIND[data], minlength=10 * n).reshape(n, 10)
    starts, ends, owner = word_spans(data, offsets)
    words = np.bincount(owner, minlength=n)
    length = (ends - starts).astype(float)
    many, some = np.maximum(words, 1), np.maximum(size, 1)
    mean = np.bincount(owner, length, minlength=n) / many
    spread = np.sqrt(np.maximum(np.bincount(owner, length**2, minlength=n) / many - mean**2, 0))
    hashes = word_hashes(data, starts, ends)
    distinct, top = _distinct(hashes, owner, n)
    next_ = owner[1:] == owner[:-1]
    pairs = (hashes[1:] * np.uint64(0x100000001B3) + hashes[:-1])[next_]
    distinct_pairs, _ = _distinct(pairs, owner[1:][next_], n)
    again = np.bincount(owner[1:][next_ & (hashes[1:] == hashes[:-1])], minlength=n)
    letters = np.maximum(chars[:, 1] + chars[:, 2], 1)
    breaks = np.bincount(np.searchsorted(offsets, np.flatnonzero(data == 10), "right") - 1, minlength=n)
    log_many = np.log1p(many)
    out[:] = np.column_stack(
        (
            np.log1p(words),
            np.log1p(mean),
            np.log1p(spread),
            np.sqrt(chars[:, 1] / letters),
            np.sqrt(chars[:, 3] / some),
            np.sqrt(chars[:, 5] / some),
            np.sqrt(chars[:, 6] / some),
            np.sqrt(chars[:, 7] / some),
            np.sqrt(chars[:, 8] / some),
            np.sqrt(chars[:, 9] / some),
            np.log1p(distinct) / log_many,
            np.sqrt(again / many),
            np.sqrt(top / many),
            np.sqrt(breaks / some),
            np.sqrt(np.bincount(owner[length <= 3], minlength=n) / many),
            np.log1p(distinct_pairs) / log_many,
        )
    )
    return out


@dataclass(frozen=True)
class Discriminant:
    """Fitted classes: log priors, means, inverse Cholesky factors and their log determinants."""

    log_prior: np.ndarray
    mean: np.ndarray
    whiten: np.ndarray
    log_det: np.ndarray
    temper: float

    @classmethod
    def fit(cls, moments: np.ndarray, shrink: float, ridge: float) -> Discriminant:
        """From the sums of outer products of (1, x) in each class (2 x d+1 x d+1).

        A class covariance becomes (1 - shrink) * own + shrink * pooled, plus ``ridge`` times
        the pooled variances on the diagonal; a class without rows takes the pooled moments.
        """
        d = moments.shape[1] - 1
        total = moments.sum(axis=0)
        if total[0, 0] < 1:
            return cls(np.log([0.5, 0.5]), np.zeros((2, d)), np.stack([np.eye(d)] * 2), np.zeros(2), np.sqrt(d))

        def spread(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            mu = m[0, 1:] / m[0, 0]
            return mu, m[1:, 1:] / m[0, 0] - np.outer(mu, mu)

        own = [spread(m) if m[0, 0] >= 1 else spread(total) for m in moments]
        n = np.maximum(moments[:, 0, 0], 0.5)
        pooled = sum(w * c for w, (_, c) in zip(n, own)) / n.sum()
        floor = np.maximum(np.diag(spread(total)[1]), 1e-9)
        factors = [
            np.linalg.cholesky((1 - shrink) * c + shrink * pooled + np.diag(ridge * floor)) for _, c in own
        ]
        return cls(
            np.log(n / n.sum()),
            np.stack([mu for mu, _ in own]),
            np.stack([np.linalg.inv(f) for f in factors]),
            np.array([2 * np.log(np.diag(f)).sum() for f in factors]),
            float(np.sqrt(d)),
        )

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability-like score of class 1; the log-density difference is tempered by sqrt(d)."""
        logs = []
        for k in (0, 1):
            z = (x - self.mean[k]) @ self.whiten[k].T
            logs.append(self.log_prior[k] - 0.5 * (self.log_det[k] + (z * z).sum(axis=1)))
        return 1 / (1 + np.exp(-np.clip((logs[1] - logs[0]) / self.temper, -500, 500)))


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x array<double>) of every document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                x = statistics(part.column("text"))
                ends = pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], ["doc_id", "x"]
                )

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(rows, "doc_id long, x array<double>")


def fold() -> "F.Column":
    """crc32 of the doc_id's digits, modulo 3; remainder 1 is held out."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))


def learning_rows(labels: DataFrame, most: int = 200_000) -> DataFrame:
    """(doc_id, quality) outside the held-out fold; null labels don't count.

    Of more than ``most`` such rows about that many stay, chosen by a hash of doc_id, so that the
    learning set is bounded at any size of the corpus.
    """
    good = labels.filter("quality IN (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).filter(fold() != 1)
    n = good.count()
    if n > most:
        good = good.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit((1 << 30) * most // n))
    return good


def fit(x: DataFrame, shrink: float = 0.1, ridge: float = 1e-2) -> Discriminant:
    """Fit on rows (x, quality).

    Tasks send sums of outer products, summed again in Spark; the driver gets two matrices.
    """
    d = len(FEATURES) + 1

    def moments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((2, d, d))
        for frame in frames:
            if len(frame):
                rows = np.column_stack((np.ones(len(frame)), np.stack(frame["x"].to_numpy())))
                for k in (0, 1):
                    own = rows[(frame["quality"] == k).to_numpy()]
                    sums[k] += own.T @ own
        at = np.arange(2 * d * d)
        yield pd.DataFrame({"at": at, "v": sums.ravel()})

    sums = x.select("x", "quality").mapInPandas(moments, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(2 * d * d)
    for r in sums:
        flat[r["at"]] = r["v"]
    return Discriminant.fit(flat.reshape(2, d, d), shrink, ridge)


def score_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Scores use the whole text alone; the model learns from :func:`learning_rows`. Null and empty texts get the score of an empty
    document; null ids are scored and belong to no fold but the learning one; without
    labels every score is 0.5. Repeated rows are scored each; other columns are ignored.
    """
    x = stored(spark, document_statistics(docs), "statistics")
    model = fit(x.join(F.broadcast(learning_rows(labels)), "doc_id"))

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                s = model.score(np.stack(frame["x"].to_numpy()))
                yield pd.DataFrame({"doc_id": frame["doc_id"], "held_out": frame["held_out"], "score": s, "predicted": (s >= 0.5).astype("int32")})

    held = x.select("doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), "x")
    return held.mapInPandas(score, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier predicts as good, with all their columns.

    Statistics are taken of the labelled rows for learning and then once of every row.
    """
    learning = F.broadcast(learning_rows(labels))
    known = docs.join(learning.select("doc_id"), "doc_id", "left_semi")
    model = fit(stored(spark, document_statistics(known), "statistics").join(learning, "doc_id"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                yield part.filter(pa.array(model.score(statistics(part.column("text"))) >= 0.5))

    return docs.mapInArrow(keep, docs.schema)
