"""Disjoint predicates that cut rows to answers of bounded size: spans of days with a moving upper bound, and a tree of values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Where over-full days are cut by value, level by level; the two parts of a node are cut by the next level's bounds, from left to right.
LEVELS = [[1.0], [0.5, 2.0], [0.25, 0.75, 1.5, 5.0]]


def value_leaves(rows: DataFrame, keys: list[str], value: str, most: int, levels: list[list[float]] = LEVELS) -> DataFrame:
    """(keys, level, low, high, nulls, n): leaves of a tree of predicates low <= value < high for each key.

    All rows of a key are one node of level 0. A node of more than `most` rows is cut in two at its bound of the next
    level, and so on to the last level; others stay whole. Rows whose value is null or no number satisfy no comparison and are a leaf
    of their own (nulls) at level 1, if their node is cut. Leaves without rows are left out. So leaves are disjoint,
    hold all rows, and hold at most `most` rows except on the last level or as nulls.

    Rows are counted by key and finest part first, task by task; nothing else is shuffled, and a hot key is as many rows as
    there are parts.
    """
    v = F.col(value).cast("double")
    v = F.when(~F.isnan(v), v)
    place, parts = F.lit(0), []
    for level in levels:  # the number of a part, from left to right, among those of its level
        bound = F.element_at(F.array(*map(F.lit, level)), place + 1)
        place = 2 * place + (v >= bound).cast("int")
        parts.append(place.alias(f"_p{len(parts) + 1}"))
    counts = rows.groupBy(*keys, *parts).agg(F.count(F.lit(1)).alias("_n"))
    chosen, depth = F.lit(len(levels)), len(levels)
    sums = [F.sum("_n").over(W.partitionBy(*keys, *[f"_p{i}" for i in range(1, d + 1)])) for d in range(depth)]
    counts = counts.withColumns({f"_s{d}": s for d, s in enumerate(sums)})
    for d in reversed(range(depth)):
        chosen = F.when(F.col(f"_s{d}") <= most, d).otherwise(chosen)
    chosen = F.when(F.col("_p1").isNull() & (chosen > 0), 1).otherwise(chosen)
    bounds = [None, *sorted(x for level in levels for x in level), None]
    edges = F.array(*[F.lit(x).cast("double") for x in bounds])
    last = F.col(f"_p{depth}")
    at = counts.withColumn("level", chosen.cast("int"))
    width = F.element_at(F.array(*[F.lit(1 << (depth - d)) for d in range(depth + 1)]), F.col("level") + 1)
    first = F.when(F.col("level") > 0, last - last % width)
    nulls = (F.col("level") > 0) & last.isNull()
    at = at.withColumns({"nulls": nulls, "low": F.when(first.isNotNull(), F.element_at(edges, first + 1)), "high": F.when(first.isNotNull(), F.element_at(edges, first + width + 1))})
    return at.groupBy(*keys, "level", "low", "high", "nulls").agg(F.sum("_n").alias("n"))


def day_spans(rows: DataFrame, keys: list[str], day: str, most: int) -> DataFrame:
    """(keys, no, upper, lower, n, full): queries for the days of each key, the newest first, of which each gives its newest `most` rows.

    A query for days up to `upper` reaches the day `lower` with its last row. As that day may not be whole, it is the upper bound of the
    next query; but a day that fills a query by itself is `full`, has to be cut by value, and the next query goes on below it. n counts the rows
    of the days from lower to upper. Rows without a day are in none.

    Only counts by day are shuffled; what is gathered for a key is one number for each day.
    """
    counts = rows.where(F.col(day).isNotNull()).groupBy(*keys, F.to_date(day).alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    listed = counts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_day", "_n")), asc=False).alias("_days"))
    span = "struct<upper:date,lower:date,n:bigint,full:boolean>"
    none = F.lit(None).cast("date")
    start = F.struct(F.array().cast(f"array<{span}>").alias("spans"), none.alias("upper"), F.lit(0).cast("long").alias("n"))

    def step(state, x):
        d, n = x["_day"], x["_n"]
        upper, total = F.coalesce(state["upper"], d), state["n"] + n
        one = lambda u, k, full: F.struct(u.alias("upper"), d.alias("lower"), k.alias("n"), F.lit(full).alias("full"))
        filled, alone = total >= most, n >= most
        new = F.when(~filled, F.array().cast(f"array<{span}>")).when(upper == d, F.array(one(d, n, True))).when(alone, F.array(one(upper, total, False), one(d, n, True))).otherwise(F.array(one(upper, total, False)))
        return F.struct(F.concat(state["spans"], new).alias("spans"), F.when(~filled, upper).when(~alone, d).alias("upper"), F.when(~filled, total).when(~alone, n).otherwise(F.lit(0).cast("long")).alias("n"))

    done = listed.withColumn("_end", F.aggregate("_days", start, step))
    rest = F.struct(F.col("_end.upper").alias("upper"), F.element_at("_days", -1)["_day"].alias("lower"), F.col("_end.n").alias("n"), F.lit(False).alias("full"))
    spans = F.when(F.col("_end.upper").isNotNull(), F.concat("_end.spans", F.array(rest))).otherwise(F.col("_end.spans"))
    return done.select(*keys, F.posexplode(spans).alias("no", "_s")).select(*keys, "no", "_s.upper", "_s.lower", "_s.n", "_s.full")
