"""Running numbers against row_number, with ties, nulls and no rows."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.operators.numbering import ranked


def test_numbers_equal_row_number(spark):
    rows = spark.range(5000).select("id", (F.col("id") * 7919 % 101).alias("k"), F.when(F.col("id") % 9 > 0, F.col("id") % 13).alias("n")).repartition(7)
    order = [F.col("k").desc(), F.col("n").asc_nulls_last(), F.col("id")]
    ours = {r["id"]: r["no"] for r in ranked(rows, "no", order, partitions=11).collect()}
    theirs = {r["id"]: r["no"] for r in rows.withColumn("no", F.row_number().over(W.orderBy(*order))).collect()}
    assert ours == theirs


def test_equal_rows_are_dealt_to_many_ranges(spark):
    rows = spark.range(4000).select(F.lit(1).alias("k")).repartition(5)
    out = ranked(rows, "no", [F.col("k")], partitions=8)
    assert sorted(r["no"] for r in out.collect()) == list(range(1, 4001))
    assert out.inputFiles().__len__() >= 6


def test_no_rows(spark):
    assert ranked(spark.createDataFrame([], "k int"), "no", [F.col("k")]).count() == 0
