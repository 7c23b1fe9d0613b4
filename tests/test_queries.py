"""Every registered query against its SQL oracle on the smallest tables."""

from __future__ import annotations

import os
from numbers import Real

import duckdb
import pandas as pd
import pytest

from spanloom.plans import queries as plans

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: Alignment, compared cell by cell in test_alignment.py, and the flow from files, compared with tables in test_files.py.
EXEMPT = {"align_nw", "prime_anchoring", "prime_lengths_by_alignment", "annotation_from_files"}


pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    rows = [tuple(None if pd.isna(v) else round(float(v), 6) if isinstance(v, Real) and not isinstance(v, bool) else str(v) for v in r) for r in df.itertuples(index=False)]
    return sorted(rows, key=repr)


def test_each_query_has_an_oracle_or_an_exemption():
    assert set(plans.QUERIES) - set(plans.ORACLES) == EXEMPT


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_oracle(spark, duck, name):
    got = plans.QUERIES[name](spark, SF).toPandas()
    want = duck.execute(plans.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(want)
    assert plain(got) == plain(want)
