"""Shared rows: nulls, blanks, ties, repeats, long texts and extra columns."""

from __future__ import annotations

import pytest

ODD = [(900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, "x " * 3000), (905, "9" * 5000), (906, "a" * 5000)]


@pytest.fixture(scope="session")
def documents(spark):
    """Build a documents table with clashing extra columns from (doc_id, text) rows."""

    def build(rows, parts=3):
        wide = [(i, t, "en", "s", len(t or ""), "x", 7) for i, t in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, key string, n long"
        return spark.createDataFrame(wide, schema).repartition(parts)

    return build


@pytest.fixture(scope="session")
def odd():
    return list(ODD)
