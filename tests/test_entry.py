"""Driver contract and the DuckDB oracle gate on the smallest data set."""

from __future__ import annotations

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from recsort.sources.tables import TABLES
from tests.conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["vc_id", "ai_violation_categories", "ai_reason", "ai_raw_response", "process_status"]
    assert df.count() >= 0


def test_oracle_keys_subset_of_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 50


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_duckdb(spark, duck, key):
    sp = E.queries()[key](spark, SF_SMALL).toPandas()
    dk = duck.execute(E.oracle_sql()[key]).df()
    sc, sr = _rows(sp)
    dc, dr = _rows(dk)
    assert sc == dc
    assert sr == dr
