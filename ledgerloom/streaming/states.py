"""States of work items kept on a stream, with a timer that tries stuck ones again."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerloom.operators.tracking import FOLLOWS
from ledgerloom.shared import new_folder

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LOG = "id long, event_id long, micros long, before string, status string, allowed boolean"


class WorkStates(StatefulProcessor):
    """Goes through the events of an item in their order and tells each move, and whether it may follow.

    An item that has been processing for `micros` without another event is to be tried again: that move has no event,
    and is told by a timer, or, if a later event has come in the same batch, before that. So what is told does not depend on how
    events are dealt to batches, as long as batches follow one another in time. If strict, moves that may not follow
    change nothing. State is one row for each item.
    """

    def __init__(self, micros: int, strict: bool):
        self.micros, self.strict = micros, strict

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "status string, micros long")

    def move(self, key: Any, event: int | None, micros: int, before: str, status: str | None) -> Row:
        return Row(id=key[0], event_id=event, micros=micros, before=before, status=status, allowed=status in FOLLOWS.get(before, ()))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        status, at = self.state.get() if self.state.exists() else ("pending", None)
        if status == "processing":
            self.handle.deleteTimer((at + self.micros) // 1000)
        for r in sorted(rows, key=lambda r: (r["micros"], r["event_id"])):
            if status == "processing" and r["micros"] > at + self.micros:
                yield self.move(key, None, at + self.micros, status, "retry")
                status, at = "retry", at + self.micros
            told = self.move(key, r["event_id"], r["micros"], status, r["status"])
            yield told
            if told["allowed"] or not self.strict:
                status, at = r["status"], r["micros"]
        if at is not None:
            self.state.update((status, at))
        if status == "processing":
            self.handle.registerTimer((at + self.micros) // 1000)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        status, at = self.state.get()
        if status == "processing" and (at + self.micros) // 1000 <= expiredTimerInfo.getExpiryTimeInMs():
            self.state.update(("retry", at + self.micros))
            yield self.move(key, None, at + self.micros, status, "retry")

    def close(self) -> None:
        pass


def work_log(events: DataFrame, *, hours: float = 1, strict: bool = False, late: str = "0 seconds") -> DataFrame:
    """Moves (id, event_id, ts, before, status, allowed) of a stream of events (id, event_id, ts, status).

    Rows that are later than `late` behind the newest event are dropped. Null ids are one item. The session has to keep state in RocksDB (see ROCKS).
    """
    rows = events.select("id", "event_id", F.col("ts").cast("timestamp").alias("ts"), F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"), "status").withWatermark("ts", late)
    log = rows.groupBy("id").transformWithState(statefulProcessor=WorkStates(int(hours * 3_600_000_000), strict), outputStructType=LOG, outputMode="Append", timeMode="EventTime")
    return log.select("id", "event_id", F.timestamp_micros("micros").cast("timestamp_ntz").alias("ts"), "before", "status", "allowed")


def replayed(spark: SparkSession, events: DataFrame, pieces: int, run) -> DataFrame:
    """What run makes of events (with ts) that arrive as a stream in pieces of time, each taken in by a start of the query on one checkpoint.

    run maps a stream to a stream; its rows are appended to a folder of the shared root, and read from there.
    """
    root = new_folder(spark, "stream")
    cuts = events.agg(F.percentile_approx("ts", [i / pieces for i in range(1, pieces)], 10_000).alias("c")).first()["c"] or []
    cuts = [None, *sorted(set(cuts)), None]
    kept = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        for low, high in zip(cuts, cuts[1:]):
            after = F.lit(True) if low is None else F.col("ts") > F.lit(low)
            events.where(after & (F.lit(True) if high is None else F.col("ts") <= F.lit(high))).write.mode("append").parquet(f"{root}/arrived")
            stream = spark.readStream.schema(events.schema).parquet(f"{root}/arrived")
            query = run(stream).writeStream.format("parquet").option("path", f"{root}/log").option("checkpointLocation", f"{root}/checkpoint").outputMode("append").trigger(availableNow=True).start()
            query.awaitTermination()
    finally:
        if kept is None:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", kept)
    return spark.read.schema("id long, event_id long, ts timestamp_ntz, before string, status string, allowed boolean").parquet(f"{root}/log")
