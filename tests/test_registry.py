"""Registered queries against their DuckDB oracle on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from stratum.registry import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def _rows(pdf):
    import pandas as pd
    pdf = pdf[sorted(pdf.columns)]
    out = []
    for r in pdf.itertuples(index=False):
        out.append(tuple(None if (v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)))
                         else (round(v, 6) if isinstance(v, float) else v) for v in r))
    return sorted(out, key=repr)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["year", "genre_name", "members", "share_pct"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())
    assert set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = con.execute(E.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)
