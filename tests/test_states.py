"""The state machine on a stream: moves that may not follow, timers, items without an id."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.streaming.states import replayed, work_log

DAY = dt.datetime(2024, 1, 1)


def at(hours):
    return DAY + dt.timedelta(hours=hours)


ROWS = [(1, 10, at(0), "processing"), (1, 11, at(0.5), "completed"), (1, 12, at(1), "failed"), (2, 20, at(0.1), "processing"), (2, 21, at(3), "completed"), (3, 30, at(0.2), "completed"), (3, 31, at(0.3), "processing"), (None, 40, at(0.4), "processing"), (4, 50, at(9), None)]


def log(spark, strict, pieces):
    events = spark.createDataFrame(ROWS, "id long, event_id long, ts timestamp_ntz, status string")
    out = replayed(spark, events, pieces, lambda s: work_log(s, strict=strict))
    return sorted(((r["id"], r["event_id"], (r["ts"] - DAY).total_seconds() / 3600, r["before"], r["status"], r["allowed"]) for r in out.collect()), key=lambda x: (str(x[0]), x[2]))


def test_moves_and_timers(spark):
    told = log(spark, False, 1)
    assert [x[1:] for x in told if x[0] == 1] == [(10, 0.0, "pending", "processing", True), (11, 0.5, "processing", "completed", True), (12, 1.0, "completed", "failed", False)]
    assert [x[1:] for x in told if x[0] == 2] == [(20, 0.1, "pending", "processing", True), (None, 1.1, "processing", "retry", True), (21, 3.0, "retry", "completed", False)]
    assert [x[1:] for x in told if x[0] is None] == [(40, 0.4, "pending", "processing", True), (None, 1.4, "processing", "retry", True)]
    assert [x[1:] for x in told if x[0] == 4] == [(50, 9.0, "pending", None, False)]
    assert log(spark, False, 3) == told  # however events are dealt to batches


def test_strict_moves_change_nothing(spark):
    told = log(spark, True, 2)
    assert [x[3:] for x in told if x[0] == 3] == [("pending", "completed", False), ("pending", "processing", True), ("processing", "retry", True)]


def test_no_events(spark):
    events = spark.createDataFrame([], "id long, event_id long, ts timestamp_ntz, status string")
    assert replayed(spark, events, 2, work_log).agg(F.count(F.lit(1))).first()[0] == 0
