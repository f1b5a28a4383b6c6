"""Period tables of companies: pivots, corrections, year-to-date to quarter, choice of values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def margin_pivot(values: DataFrame, keys: list[str], name: str, value: str, names: list[str]) -> DataFrame:
    """The greatest value by name, as columns of the names given."""
    return values.groupBy(*keys).pivot(name, names).agg(F.max(value))


def percent_of(part: Column, whole: Column) -> Column:
    return F.round(part.cast("decimal(18,4)") * 100 / F.when(whole != 0, whole).cast("decimal(18,4)"), 1).cast("decimal(18,1)")


def statement_pivot(values: DataFrame, keys: list[str], concept: str, value: str, order: list[str], concepts: list) -> DataFrame:
    """Long to wide: the last value of each concept by order, in columns of the concepts given."""
    last = F.max_by(value, F.struct(*order))
    return values.groupBy(*keys).pivot(concept, concepts).agg(last)


def period_records(records: DataFrame, keys: list[str], newest: Column, *ties: Column) -> DataFrame:
    """One record per period: a correction before others, then the newest."""
    order = [F.col("is_correction").desc(), newest.desc(), *ties]
    return records.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def quarters(cumulative: DataFrame, keys: list[str], year: str, quarter: str, values: list[str]) -> DataFrame:
    """Quarter values from year-to-date ones: less those of the quarter before, if it is there.

    A join on quarter - 1 and no lag: a missing quarter must not be skipped. The
    values subtracted are the cumulative ones as they came.
    """
    before = cumulative.select(*keys, year, (F.col(quarter) + 1).alias(quarter), *[F.col(v).alias(f"_before_{v}") for v in values])
    out = cumulative.join(before, [*keys, year, quarter], "left")
    alone = F.coalesce
    return out.select(*keys, year, quarter, *[(F.col(v) - alone(F.col(f"_before_{v}"), F.lit(0))).alias(v) for v in values])


def best_value(candidates: DataFrame, keys: list[str], wanted: Column, name: str, value: str, consolidated: str, position: list[str]) -> DataFrame:
    """The value of the best match: exact name over ending over part, consolidated over unknown, then the first."""
    n = F.col(name)
    match = F.when(n == wanted, 3).when(n.endswith(wanted), 2).when(n.contains(wanted), 1)
    context = F.when(F.col(consolidated), 2).when(F.col(consolidated).isNull(), 1)
    scored = candidates.withColumn("_match", match).withColumn("_context", context).where("_match is not null and _context is not null")
    order = [F.desc("_match"), F.desc("_context"), *[F.asc(p) for p in position]]
    return scored.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_n = 1").select(*keys, F.col(value).alias("value"), F.col("_match").alias("match_quality"), F.col("_context").alias("context_quality"))


def preferred(values: DataFrame, keys: list[str], consolidated: str, value: str, position: list[str]) -> DataFrame:
    """The first consolidated value, else the first of the others."""
    at = F.struct(*position)
    whole = F.min_by(value, F.when(F.col(consolidated), at))
    has = F.count_if(F.col(consolidated)) > 0
    rest = F.min_by(value, F.when(~F.coalesce(F.col(consolidated), F.lit(False)), at))
    return values.groupBy(*keys).agg(F.when(has, whole).otherwise(rest).alias("value"), has.alias("is_consolidated"))


def statement_kind(period_type: Column, concept: Column) -> Column:
    cash = concept.contains("CashFlow") | concept.contains("CashAndEquivalents") | concept.contains("CashAndCash")
    return F.when(period_type == "Instant", "balance").when(cash, "cashflow").otherwise("income")
