"""Exact token totals for every context limit from a histogram of encoded lengths."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanloom.llm.common import slices, stored
from spanloom.llm.tokens import load_encoder


def encoded_lengths(docs: DataFrame, tokenizer: str) -> DataFrame:
    """n_tokens of every document (null or empty text: 0); texts never leave their task."""

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_encoder(tokenizer)
        for batch in batches:
            for part in slices(batch, "text"):
                ends = encoder.encode(part.column("text"))[1]
                yield pa.RecordBatch.from_arrays([pa.array(np.diff(ends), pa.int64())], ["n_tokens"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(lengths, "n_tokens long")


def length_histogram(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(n_tokens, n_docs); rows are summed inside each task before the shuffle."""
    return encoded_lengths(docs, tokenizer).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(histogram: DataFrame, block: int = 1024) -> DataFrame:
    """Totals at every occurring length L taken as context limit.

    Columns: n_tokens (the limit L), n_docs, docs_over and tokens_over (documents longer
    than L and their tokens), tokens_within (tokens of documents of at most L),
    truncated_total (sum of min(length, L)), share (fraction of documents of at most L).
    Lengths are summed in blocks first, so no task sorts the whole histogram.
    """
    h = histogram.withColumn("_block", F.floor(F.col("n_tokens") / block)).withColumn(
        "_tokens", F.col("n_tokens") * F.col("n_docs")
    )
    blocks = h.groupBy("_block").agg(F.sum("n_docs").alias("_bd"), F.sum("_tokens").alias("_bt"))
    later = W.orderBy(F.col("_block").desc()).rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0)
    blocks = blocks.select(
        "_block",
        F.coalesce(F.sum("_bd").over(later), zero).alias("_ad"),
        F.coalesce(F.sum("_bt").over(later), zero).alias("_at"),
        F.sum("_bd").over(W.orderBy("_block").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("_docs"),
        F.sum("_bt").over(W.orderBy("_block").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("_all"),
    )
    inside = W.partitionBy("_block").orderBy(F.col("n_tokens").desc()).rowsBetween(W.unboundedPreceding, -1)
    out = h.join(blocks, "_block").select(
        "n_tokens",
        "n_docs",
        (F.coalesce(F.sum("n_docs").over(inside), zero) + F.col("_ad")).alias("docs_over"),
        (F.coalesce(F.sum("_tokens").over(inside), zero) + F.col("_at")).alias("tokens_over"),
        "_docs",
        "_all",
    )
    return out.select(
        "n_tokens",
        "n_docs",
        "docs_over",
        "tokens_over",
        (F.col("_all") - F.col("tokens_over")).alias("tokens_within"),
        (F.col("_all") - F.col("tokens_over") + F.col("docs_over") * F.col("n_tokens")).alias("truncated_total"),
        ((F.col("_docs") - F.col("docs_over")) / F.col("_docs")).alias("share"),
    )


def truncated_total(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(limit, truncated_total, docs_over) for any limits, from :func:`suffix_sums`.

    Each histogram row adds min(length, limit) for its documents. Limits may come in any order;
    a repeated limit counts once, one of 0 or less gives 0, no limits give no rows.
    """
    limits = sorted({max(0, int(x)) for x in limits})
    if not limits:
        return sums.sparkSession.createDataFrame([], "limit long, truncated_total long, docs_over long")
    pairs = sums.select(
        F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])).alias("limit"), "n_tokens", "n_docs"
    )
    return pairs.groupBy("limit").agg(
        F.sum(F.least("limit", "n_tokens") * F.col("n_docs")).alias("truncated_total"),
        F.sum(F.when(F.col("n_tokens") > F.col("limit"), F.col("n_docs")).otherwise(0)).alias("docs_over"),
    )


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(q, n_tokens): the smallest length that at least the fraction q of documents keep within.

    Shares may come in any order; a repeated one counts once; one above 1 gives null, one of 0 or
    less the smallest length, no shares give no rows.
    """
    shares = sorted({float(q) for q in shares})
    if not shares:
        return sums.sparkSession.createDataFrame([], "q double, n_tokens long")
    return sums.select(
        F.explode(
            F.array(*[F.struct(F.lit(q).alias("q"), F.when(F.col("share") >= q, F.col("n_tokens")).alias("n")) for q in shares])
        ).alias("x")
    ).groupBy(F.col("x.q").alias("q")).agg(F.min("x.n").alias("n_tokens"))


def token_counts(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """:func:`suffix_sums` of the documents' encoded lengths.

    Null and empty texts count as length 0; repeated rows count each; an empty table
    gives no rows; columns other than text are ignored.
    """
    return suffix_sums(stored(spark, length_histogram(docs, tokenizer), "lengths"))
