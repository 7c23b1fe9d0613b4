"""Corpus pipeline: five stages over ``documents``, each written and read again by the caller.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last keep the
columns of ``documents`` and only remove rows; the last one returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanloom.llm.common import stored, table
from spanloom.llm.decontaminate import drop_leaks
from spanloom.llm.exact_dedup import drop_copies
from spanloom.llm.near_dedup import drop_near_copies
from spanloom.llm.packing import pack_documents
from spanloom.llm.quality import keep_good
from spanloom.llm.tokens import tokenizer_path

#: SQL can't express the classifier, the sketches or the tokenizer.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return keep_good(spark, docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first of each group of equal texts."""
    return drop_copies(spark, docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 of its five-word shingles."""
    return drop_near_copies(spark, docs, words=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return drop_leaks(spark, docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 4096 tokens."""
    return pack_documents(spark, docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("benchmark decontamination", decontaminate),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each stored before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
