"""Every registered query against its SQL twin in DuckDB."""

import math

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return v if isinstance(v, str) else float(v)


def _rows(df):
    columns = [[_cell(v) for v in df[c].tolist()] for c in sorted(df.columns)]
    return sorted(zip(*columns), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, name):
    mine, theirs = QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert _rows(mine) == _rows(theirs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
