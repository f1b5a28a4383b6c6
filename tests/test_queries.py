"""Every query with SQL gives what DuckDB gives on the smallest tables."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest
from conftest import SF

from ledgerloom.plans.catalogue import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(df: pd.DataFrame) -> list[tuple]:
    def one(v):
        if v is None or (not isinstance(v, (list, dict, str)) and pd.isna(v)):
            return ""
        if isinstance(v, (bool, np.bool_)):
            return str(int(v)) + ".000000"
        return f"{float(v):.6f}" if isinstance(v, (int, float)) or type(v).__name__.startswith(("int", "float")) else str(v)

    return sorted(tuple(one(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


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
def test_rows_only(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


@pytest.mark.parametrize("name", ["facts_cleaned", "facts_flat", "company_theta_match", "concept_fallback", "disclosures_classified", "amendment_parent"])
def test_plans_join_on_keys(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "Arrow" not in plan


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
