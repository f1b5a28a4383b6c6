"""Queries give what their SQL gives on tables that hold what the given ones lack."""

import os

import duckdb
import pandas as pd
import pytest
from conftest import SF
from test_queries import plain

from ledgerloom.plans.catalogue import ORACLES, QUERIES


def equal(spark, folder, name, **tables):
    """Whether a query equals its SQL, where some tables are the given data frames."""
    folder, duck = str(folder), duckdb.connect()
    for file in os.listdir(SF):
        table, path = file.removesuffix(".parquet"), os.path.join(folder, file)
        if table in tables:
            duck.register("rows", tables[table])
            duck.execute(f"copy rows to '{path}' (format parquet)")
        elif not os.path.exists(path):
            os.symlink(os.path.join(SF, file), path)
        duck.execute(f"create view {table} as select * from read_parquet('{path}')")
    return plain(QUERIES[name](spark, folder).toPandas()) == plain(duck.execute(ORACLES[name]).df())


def documents(*texts):
    return pd.DataFrame({"doc_id": range(len(texts)), "text": pd.Series(texts, dtype="string"), "lang": "en", "source": "s", "n_chars": [len(x or "") for x in texts]})


ODD = documents("", None, "   ", "12", "\t" * 60, "", "12 | 34 " * 60, "a b " * 60, "\n" * 60, " " * 60, "a" * 3001, "1" * 199, "")


@pytest.mark.parametrize("name", ["vectorize_flag", "chunk_size"])
def test_texts_without_signs(spark, tmp_path, name):
    assert equal(spark, tmp_path, name, documents=ODD)


def test_ratios_that_lie_between_two_numbers_shown(spark, tmp_path):
    lines = pd.read_parquet(os.path.join(SF, "lineitem.parquet"))
    lines["l_extendedprice"] = (lines["l_partkey"] % 16 + 1.0) / 4
    assert equal(spark, tmp_path, "metrics_interpretation", lineitem=lines)


def test_disclosures_of_one_id_match_by_their_own_codes(spark, tmp_path):
    orders = pd.read_parquet(os.path.join(SF, "orders.parquet"))
    orders.loc[orders.index % 7 == 0, "o_orderkey"] = 8
    orders.loc[orders.index % 5 == 0, "o_custkey"] += 10_000
    assert equal(spark, tmp_path, "company_theta_match", orders=orders)


def test_names_and_dimensions_come_to_the_winners(spark):
    plan = QUERIES["facts_cleaned"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.split("Window [row_number")[0].count("Join LeftOuter") == 3
