"""The driver contract: entry smoke run, and every query against its DuckDB
oracle on the sf0.001 tables (the driver repeats this at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import _norm

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 15
    assert df.columns[:3] == ["service", "date", "total_requests"]


def test_every_query_has_an_oracle():
    assert set(E.core_queries()) == set(E.core_oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute(f"create view events as select * from read_parquet('{SF}/events.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.core_queries()))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF).toPandas()
    exp = duck.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert _norm(got) == _norm(exp)
