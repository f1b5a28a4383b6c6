"""Corpus queries that have SQL give what DuckDB gives on the smallest tables; all others give rows."""

import os

import duckdb
import pytest
from conftest import SF
from test_queries import TABLES, plain

from ledgerloom.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{os.path.join(SF, t)}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    ours, theirs = QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert plain(ours) == plain(theirs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows(spark, name):
    rows = "pages" if name.startswith("op10") else "documents"
    assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{rows}.parquet").count()


@pytest.mark.parametrize("name", ["op5_mixing", "op8_sharding", "op13_point_in_time"])
def test_native_plans(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
