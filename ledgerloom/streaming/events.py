"""Streams of listing rows and events: idempotent ingest, windows, and states of work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerloom.operators.ingest import first_of


def deduplicated(rows: DataFrame, time: str, keys: list[str], late: str = "1 day") -> DataFrame:
    """The first arrival of each natural key; state is kept for `late` after the watermark."""
    return rows.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def window_counts(events: DataFrame, time: str, size: str, keys: list[str], slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts by event time; on a stream, rows later than `late` are dropped and windows close behind it."""
    rows = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    window = F.window(time, size, slide) if slide else F.window(time, size)
    out = rows.groupBy(window, *keys).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("window.start").alias("start"), *keys, "n")


def session_counts(events: DataFrame, time: str, gap: str, key: str, late: str = "10 minutes") -> DataFrame:
    rows = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    out = rows.groupBy(F.session_window(time, gap), key).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("session_window.start").alias("start"), key, "n")


def ingest_absent(stream: DataFrame, path: str, keys: list[str], order: list[str], checkpoint: str):
    """Append rows whose key the table at path lacks; a batch that is replayed adds nothing.

    Null keys are equal to each other, as in insert_absent(). Returns the query,
    which takes what is there and ends.
    """

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        new = first_of(batch, keys, [F.asc(c) for c in order])
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
            old = spark.read.schema(batch.schema).parquet(path).select(*[F.col(k).alias(f"_old_{k}") for k in keys]).distinct()
            same = F.lit(True)
            for k in keys:
                same = same & F.col(k).eqNullSafe(F.col(f"_old_{k}"))
            new = new.join(old, same, "left_anti")
        new.write.mode("append").parquet(path)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_chain(stream: DataFrame, root: str, keys: list[str], order: list[str], checkpoint: str, derive: dict):
    """New rows and all that follows from them, batch by batch: rows, then each derived table.

    derive: name -> function of the batch's new rows and of the tables derived so far,
    such as labels of titles, filings, and facts. A batch is written to folders of its
    own number, which a replay overwrites, so that all tables hold each row once. The
    rows go last: only then does the next batch take them for known. Returns the query, which takes what
    is there and ends.
    """

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = first_of(batch, keys, [F.asc(c) for c in order])
        old = written_before(spark, f"{root}/rows", batch.schema, number)
        if old is not None:
            there = old.select(*[F.col(k).alias(f"_old_{k}") for k in keys]).distinct()
            same = F.lit(True)
            for k in keys:
                same = same & F.col(k).eqNullSafe(F.col(f"_old_{k}"))
            new = new.join(there, same, "left_anti")
        held = f"{root}/arrived/batch={number}"
        new.write.mode("overwrite").parquet(held)
        new, made = spark.read.schema(batch.schema).parquet(held), {}
        for name, f in derive.items():
            f(new, made).write.mode("overwrite").parquet(f"{root}/{name}/batch={number}")
            made[name] = spark.read.parquet(f"{root}/{name}/batch={number}")
        new.write.mode("overwrite").parquet(f"{root}/rows/batch={number}")

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def written_before(spark, folder: str, schema, number: int) -> DataFrame | None:
    """What batches before this one have written, None if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(folder).where(F.col("batch") < number).drop("batch")
