"""Every catalogue query against its DuckDB oracle on the sf0.001 fixture."""

import math

import duckdb
import pandas as pd
import pytest

from cohortalloc.plans.catalog import QUERIES
from cohortalloc.plans.oracle import ORACLE_SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False)]
    return cols, sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    got_cols, got = _rows(QUERIES[name](spark, SF).toPandas())
    exp_cols, exp = _rows(duck.execute(ORACLE_SQL[name]).df())
    assert got_cols == exp_cols
    assert len(got) == len(exp)
    assert got == exp
