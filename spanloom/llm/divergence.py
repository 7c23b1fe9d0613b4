"""How the sources of each language differ in their words: wide term vectors, summed by pairs.

Terms are counted by (lang, source, term) in batches and tasks first. Each kept term is then pivoted into an array of
counts indexed by source; higher-order functions turn it into shares and emit what it adds to each
pair of sources, and these sums are taken map-side before they are shuffled. Shares are whole
billionths, so everything is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanloom.llm.common import LOWER, dropped, slices, stored, text_bytes, word_spans

#: Runs of letters: no ASCII character but A-Z and a-z, and all others.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 1_000_000_000
SMOOTHING = 5


_IN_TERM = np.arange(256) >= 128
_IN_TERM[[*range(65, 91), *range(97, 123)]] = True
COUNTS = "lang string, source string, term string, n long, n_docs long"


def counted(langs: pa.Array, sources: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """COUNTS of some documents: their terms are coded, then summed by document and by group."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    solid = _IN_TERM[data]
    starts, ends, owner = word_spans(data, offsets, solid)
    bounds = np.concatenate(([0], np.cumsum(ends - starts)))
    whole = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data[solid])])
    coded = whole.dictionary_encode()
    kinds = max(1, len(coded.dictionary))
    keys, n = np.unique(np.sort(owner * kinds + coded.indices.to_numpy()), return_counts=True)
    lang, source = langs.dictionary_encode(), sources.dictionary_encode()
    width = max(1, len(source.dictionary))
    group = lang.indices.to_numpy().astype(np.int64) * width + source.indices.to_numpy()
    keys = group[keys // kinds] * kinds + keys % kinds
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    sums = np.add.reduceat(n, first) if len(first) else n
    own = keys[first] // kinds
    return pa.RecordBatch.from_arrays(
        [
            lang.dictionary.take(pa.array(own // width)), source.dictionary.take(pa.array(own % width)),
            coded.dictionary.take(pa.array(keys[first] % kinds)).cast(pa.large_string()).cast(pa.string()), pa.array(sums), pa.array(np.diff(np.append(first, len(keys)))),
        ],
        [x.split()[0] for x in COUNTS.split(", ")],
    )


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, n_docs): occurrences and documents, summed by batch and by task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 8 << 20):
                yield counted(*(part.column(c) for c in ("lang", "source", "text")))

    words = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    return words.mapInArrow(count, COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + SMOOTHING) / (total + SMOOTHING * terms)) in exact arithmetic."""
    part = (count + SMOOTHING).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    whole = (total + SMOOTHING * terms).cast("decimal(19,0)")
    return F.call_function("div", part, whole) + 1


def term_vectors(spark: SparkSession, docs: DataFrame, least_docs: int = 30) -> tuple[DataFrame, DataFrame]:
    """Stored tables of the languages and of their kept terms.

    Languages: lang, sources (all of its sources, sorted), kept (its kept terms), totals (by source
    the occurrences of kept terms). Terms: lang, term, counts (by source).
    """
    groups = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    langs = groups.groupBy("lang").agg(F.array_sort(F.collect_list("source")).alias("sources"))
    langs = stored(spark, langs, "langs")
    counts = term_counts(docs)
    cells = counts.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "n")).alias("cells"), F.sum("n_docs").alias("_docs"))
    cells = stored(spark, cells.filter(F.col("_docs") >= least_docs).drop("_docs"), "cells")
    held = F.map_from_entries("cells")
    wide = cells.join(langs, "lang").select("lang", "term", "sources", held.alias("held"))
    wide = wide.select("lang", "term", F.transform("sources", lambda s: F.coalesce(F.col("held")[s], F.lit(0))).alias("counts"))
    wide = stored(spark, wide, "vectors")
    dropped(spark, cells)
    sums = wide.select("lang", F.posexplode("counts").alias("i", "n")).groupBy("lang", "i").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kept"))
    sums = sums.groupBy("lang").agg(F.max("kept").alias("kept"), F.map_from_entries(F.collect_list(F.struct("i", "n"))).alias("_n"))
    totals = F.transform("sources", lambda s, i: F.coalesce(F.col("_n")[i], F.lit(0)))
    known = langs.join(sums, "lang", "left").withColumn("_n", F.coalesce("_n", F.expr("map()").cast("map<int,bigint>")))
    known = known.select("lang", "sources", F.coalesce("kept", F.lit(0)).alias("kept"), totals.alias("totals"))
    known = stored(spark, known, "langs")
    dropped(spark, langs)
    return known, wide


def source_divergence(spark: SparkSession, docs: DataFrame, least_docs: int = 30, best_terms: int = 50) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) for every occurring (lang, source).

    Part ``pair``: item is each other source of the language, value the sum over all kept terms of
    the differences of their shares in the two sources. Part ``term``: item is each kept term that occurs in
    the source and has a larger share there than in the whole language, value the difference,
    ranks to ``best_terms``. Ranks run from 1 by falling value, ties by the item's UTF-8 bytes.

    Null text, lang and source count as ''. Kept terms are those in ``least_docs`` documents of the language
    or more; a row is a document, whatever its id, so repeated rows count each. Groups without terms take
    part in pairs; a language with one source has none; an empty table gives no rows. Other columns
    are ignored. Texts are counted in batches of 8 MB, a longer one alone.
    """
    langs, wide = term_vectors(spark, docs, least_docs)
    held = wide.join(langs, "lang").select("lang", "term", "counts", "sources", "totals", "kept")
    sum_of = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda x, y: x + y)
    shares = F.transform(F.arrays_zip("counts", "totals"), lambda x: share(x["counts"], x["totals"], F.col("kept")))
    held = held.select("*", shares.alias("p"), share(sum_of(F.col("counts")), sum_of(F.col("totals")), F.col("kept")).alias("q"))

    # What a term adds to the pairs of source i with each later one; i comes first, so that no array is square.
    rows = held.select("lang", "p", F.posexplode("p").alias("i", "own")).filter(F.col("i") < F.size("p") - 1)
    rest = F.transform(F.slice("p", F.col("i") + 2, F.size("p")), lambda x, k: F.struct((F.col("i") + k + 1).alias("j"), F.abs(x - F.col("own")).alias("f")))
    added = rows.select("lang", "i", F.explode(rest).alias("x")).groupBy("lang", "i", "x.j").agg(F.sum("x.f").alias("value"))
    both = stored(spark, added.unionByName(added.select("lang", F.col("j").alias("i"), F.col("i").alias("j"), "value")), "pairs")
    one = langs.select("lang", "sources", F.posexplode("sources").alias("i", "source"))
    every = one.select("lang", "i", "source", F.posexplode("sources").alias("j", "item")).filter("i <> j")
    pairs = every.join(both, ["lang", "i", "j"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))

    found = F.transform(F.arrays_zip("sources", "counts", "p"), lambda x: F.when((x["counts"] > 0) & (x["p"] > F.col("q")), F.struct(x["sources"].alias("source"), (x["p"] - F.col("q")).alias("value"))))
    found = held.select("lang", F.col("term").alias("item"), F.explode(F.filter(found, lambda x: x.isNotNull())).alias("x"))
    found = found.select("lang", "x.source", F.lit("term").alias("part"), "item", "x.value")

    by_value = W.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    best = found.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= best_terms)
    return pairs.withColumn("rank", F.row_number().over(by_value)).unionByName(best)
