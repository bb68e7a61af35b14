"""Registered queries against their DuckDB oracles."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as E
from logsieve.llm import queries as Q
from tools.oracle_check import _norm

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return con


def test_one_query_for_each_operator():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(Q.oracle_sql()) <= set(Q.queries())


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    got, exp = E.queries()[name](spark, SF).toPandas(), duck.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp) and _norm(got) == _norm(exp)
