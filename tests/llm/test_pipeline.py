"""Each pipeline stage against brute force over its own input."""

from __future__ import annotations

import re

import corpus_pipeline as cp
from spanloom.llm.common import stored

SF = "/root/testdata/sf0.001"


def shingles(text, words=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = []
    for name, stage in cp.STAGES:
        docs = stored(spark, stage(spark, docs, SF), "stage")
        tables.append(docs)
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(t.columns == columns for t in tables[:-1])
    texts = [{r.doc_id: r.text for r in t.collect()} for t in tables[:-1]]

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    judged = [(i in texts[0]) == bool(q) for i, q in labels.items()]
    assert sum(judged) / len(judged) > 0.95

    first: dict = {}
    for i in sorted(texts[0]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[0][i] or ""), i)
    assert set(texts[1]) == set(first.values())

    sets = {i: shingles(t) for i, t in texts[1].items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert set(texts[2]) == {i for i in ids if find(i) == i}

    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    whole = {i: " ".join((t or "").lower().split()) for i, t in texts[2].items()}
    assert set(texts[3]) == {i for i, t in whole.items() if not any(x in t for x in items)}

    places = tables[4].collect()
    assert {r.doc_id for r in places} == set(texts[3])
    ends: dict = {}
    for r in sorted(places, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 4096


def test_stages_take_empty_tables_and_nulls(spark, documents, odd):
    docs = documents(odd + [(None, "no id"), (None, None)])
    for name, stage in cp.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SF).count() == 0
        assert stage(spark, docs, SF).columns == docs.columns
    assert cp.pack(spark, docs, SF).count() >= len(odd) + 2


def test_stages_take_clashing_columns_and_repeated_ids(spark):
    """Columns named as the code names its own; rows that repeat an id, with the same text and with another."""
    names = "row place bucket digest rank _part bands component key n a b tokens label quality keep_id item_id".split()
    text = "a plain and calm text of quite some words that says nothing at all about anything"
    rows = [(1, text), (1, text), (2, text), (3, text + " indeed"), (4, "other words entirely stand here"), (4, "and here other ones still"), (None, text), (None, "no id at all but some words")]
    docs = spark.createDataFrame([(*r, *(["x"] * len(names))) for r in rows], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    kept = {}
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        kept[name] = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert kept["exact dedup"] == sorted([rows[0], rows[1], *rows[3:6], rows[7]], key=repr)
    # Of the group of document 1 its repeated rows stay; documents 2 and 3 and the row without an id are near copies.
    assert kept["near dedup"] == sorted([rows[0], rows[1], rows[4], rows[5], rows[7]], key=repr)
    assert kept["benchmark decontamination"] == sorted(rows, key=repr)
    assert cp.pack(spark, docs, SF).count() == len(rows)


def test_stages_drop_rows_and_not_ids(spark):
    """Leaks and near copies without an id go; clean texts stay whatever else their ids stand for."""
    item = spark.read.parquet(f"{SF}/benchmark.parquet").filter("length(text) > 60").orderBy("item_id").first().text
    leak = f"before it stands this and {item} and that follows"
    clean, other = "a clean text of its own that nobody else has written down", "another clean text about the weather of late autumn days"
    rows = [(None, leak), (5, leak), (5, clean), (6, other), (None, clean + " twice"), (None, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, cp.decontaminate(spark, docs, SF).collect()), key=repr)
    assert got == sorted(rows[2:], key=repr)

    words = [f"w{k}" for k in range(30)]
    text, near = " ".join(words), " ".join([*words, "more"])
    rows = [(1, text), (None, text), (4, "w1 of another text altogether, word after word"), (4, near), (None, "alone and without any id at all"), (9, None), (None, ""), (4, "yet another text under the id of four")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, cp.near(spark, docs, SF).collect()), key=repr)
    assert got == sorted([rows[0], rows[2], *rows[4:]], key=repr)
    # Groups without ids keep one text of those that are near each other.
    docs = spark.createDataFrame([(None, text), (None, near), (None, text)], "doc_id long, text string")
    kept = [r.text for r in cp.near(spark, docs, SF).collect()]
    assert len(set(kept)) == 1
