"""CSV and JSON sources of companies and concepts, and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CONCEPT = "map<string,struct<taxonomy_prefix:string,std_label_en:string,std_label_ja:string,item_type:string>>"


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def split_list(c: Column) -> Column:
    """Parts of a text at semicolons, trimmed, without empty ones; null if none is left."""
    parts = F.filter(F.transform(F.split(c, ";"), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.size(parts) > 0, parts)


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    """Companies of a CSV file with a header: blanks are null, days are M/d/yyyy, lists are split at semicolons."""
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
    raw = raw.toDF(*[c.lstrip("﻿").strip() for c in raw.columns])
    out = raw.select(*[blank_to_null(F.col(f"`{c}`")).alias(c) for c in raw.columns])
    for c in out.columns:
        if c.endswith("_date"):
            out = out.withColumn(c, F.try_to_timestamp(c, F.lit("M/d/yyyy")).cast("date"))
        elif c.endswith("_at"):
            out = out.withColumn(c, F.try_to_timestamp(c, F.lit("M/d/yyyy H:mm")))
        elif c in ("aliases", "keywords"):
            out = out.withColumn(c, split_list(F.col(c)))
    return out


def required(df: DataFrame, *columns: str) -> DataFrame:
    """Rows that have all of the columns; a missing column is an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.dropna(subset=list(columns))


def read_concepts(spark: SparkSession, path: str) -> DataFrame:
    """Concepts of a JSON object keyed by local name."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", CONCEPT)).alias("local_name", "c")).select("local_name", "c.*")


def write(df: DataFrame, path: str, kind: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Write a table as Parquet, ORC, JSON or CSV, replacing what is there."""
    if kind not in ("parquet", "orc", "json", "csv"):
        raise ValueError(f"unknown kind of file: {kind}")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    getattr(writer.option("header", True) if kind == "csv" else writer, kind)(path)


def markdown(rows: DataFrame, group: str, columns: list[str], order: str) -> DataFrame:
    """(group, markdown): the rows of each group as a table, a line each, in order; bars in cells are escaped."""
    cell = lambda c: F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|"))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *map(cell, columns)), F.lit(" |"))
    head = f"| {' | '.join(columns)} |\n|{'---|' * len(columns)}\n"
    lines = rows.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("line")))).alias("lines"))
    return lines.select(group, F.concat(F.lit(head), F.array_join(F.transform("lines", lambda x: x["line"]), "\n")).alias("markdown"))
