"""Small column functions on golden cases."""

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.functions import columns
from ledgerloom.operators import text


def column(spark, value, build):
    return spark.createDataFrame([(value,)], "x string").select(build(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(("heading", "section"), [(None, "unknown"), ("　", "unknown"), ("配当方針", "capital_policy"), ("（３） 今後の見通し", "outlook"), ("添付資料の目次", "table_of_contents"), ("ヘッジ", "risk_management"), ("EPSの推移", "per_share_info"), ("xyz", "general")])
def test_headings(spark, heading, section):
    assert column(spark, heading, columns.heading_section) == section


@pytest.mark.parametrize(("name", "code", "day"), [("15-30_86300_2025年3月期決算短信.zip", "86300", "2025-03-31"), ("x_7203_2024年2月.zip", "7203", "2024-02-29"), ("a12345b.zip", "12345", None), ("none.zip", "000000", None), ("x_2024年13月.zip", "000000", None)])
def test_package_names(spark, name, code, day):
    assert column(spark, name, columns.package_code) == code
    found = column(spark, name, columns.package_date)
    assert (str(found) if found else None) == day


@pytest.mark.parametrize(("path", "expected"), [("/a/b", "/a/b"), ("old/x", "new/x"), ("older/x", "new/older/x"), ("x", "new/x"), (None, None)])
def test_rebased(spark, path, expected):
    assert column(spark, path, lambda c: columns.rebased(c, "old", "new")) == expected


def test_overlaps_keep_the_longer(spark):
    rows = [(1, 0, "abcdefghij" * 5), (1, 1, "abcdefghij" * 6), (1, 2, "something else entirely"), (2, 0, "abcdefghij" * 5)]
    out = text.overlapping(spark.createDataFrame(rows, "p int, i int, t string"), ["p"], "t", "i")
    assert {(r["p"], r["i"]) for r in out.collect()} == {(1, 1), (1, 2), (2, 0)}


def test_checks_of_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, "b")], "k int, v string")
    assert [tuple(r) for r in schemas.repeated_keys(df, "k").collect()] == [(1, 2)]
    assert schemas.orphans(df, "k", spark.createDataFrame([(2,)], "id int"), "id").count() == 2
    assert schemas.outside(df, "v", ["a"]).count() == 2
    for name, ddl in schemas.TABLES.items():
        assert spark.createDataFrame([], ddl).columns, name
