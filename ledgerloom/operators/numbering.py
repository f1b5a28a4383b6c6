"""Running numbers over a whole table without bringing it to one task."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.shared import written

#: monotonically_increasing_id() has the number of the partition above so many bits, and that of the row below.
BITS = 33


def ranked(rows: DataFrame, name: str, order: list[Column], *, partitions: int | None = None) -> DataFrame:
    """rows with `name`: 1, 2, 3 and so on in the given order, a long.

    Rows are dealt out by ranges of the order and sorted within each; a row's number is
    its place in its own range and the sizes of the ranges before it. Only those sizes,
    one for each range, reach the driver. Rows that tie in all of the order are told apart
    by where they were read, so that any number of equal rows is dealt to many ranges.

    Null keys stand where the order puts them. No rows: no rows. Columns named `_at` or
    `_place` are not allowed; others stay as they are.
    """
    parts = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    read = rows.withColumn("_at", F.monotonically_increasing_id())
    dealt = read.repartitionByRange(parts, *order, F.col("_at")).sortWithinPartitions(*order, F.col("_at"))
    placed = written(dealt.withColumn("_place", F.monotonically_increasing_id()).drop("_at"), "ranked")
    part = F.shiftrightunsigned("_place", BITS).cast("int")
    sizes = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before = [0, *accumulate(sizes.get(i, 0) for i in range(max(sizes, default=0)))]
    offset = F.element_at(F.lit(before).cast("array<long>"), part + 1)
    return placed.withColumn(name, offset + F.col("_place").bitwiseAND(F.lit((1 << BITS) - 1)) + 1).drop("_place")
