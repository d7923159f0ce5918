"""Every query with a SQL oracle returns the same rows as DuckDB (sf0.001)."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from sentiscope.sources.tables import TABLES

ORACLES = E.oracle_sql()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, key):
    got = E.queries()[key](spark, SF_SMALL).toPandas()
    want = duck.execute(ORACLES[key]).fetchdf()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr


def test_every_query_has_a_callable():
    q = E.queries()
    assert set(ORACLES) <= set(q)
    assert len(q) >= 85


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["sentiment", "count", "percentage"]
    assert df.count() >= 1


def test_coverage_map_names_real_queries():
    import os
    import re

    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "COVERAGE.md")
    text = open(path).read()
    queries = E.queries()
    for kind, key in re.findall(r"\b([SR]) `([a-z_0-9]+)`", text):
        if kind == "S":
            assert key in ORACLES, key
        else:
            assert key in queries, key
