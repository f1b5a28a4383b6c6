"""Queries over work states and event windows, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import ranges, tracking
from ledgerloom.plans.bind import Tables
from ledgerloom.shared import new_folder
from ledgerloom.streaming.events import ingest_absent, window_counts
from ledgerloom.streaming.states import replayed, work_log

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


EVENTS = "ev AS (SELECT event_id, user_id AS id, ts, CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' WHEN 'click' THEN 'retry' ELSE 'processing' END AS status, CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 'xbrl' ELSE 'pdf' END AS method, value AS duration, event_id % 20 AS chunks, CASE WHEN event_type = 'error' THEN 'code ' || CAST(event_id % 7 AS VARCHAR) END AS error FROM events)"
FOLD = f"""WITH {EVENTS}, fold AS (SELECT id, arg_max(status, (ts, event_id)) AS status, arg_max(CASE WHEN error IS NULL THEN '' ELSE error END, (ts, event_id)) AS error, arg_max(method, (ts, event_id)) FILTER (WHERE method IS NOT NULL) AS method,
  arg_max(duration, (ts, event_id)) FILTER (WHERE status = 'completed') AS duration, arg_max(chunks, (ts, event_id)) FILTER (WHERE status = 'completed') AS chunks, max(ts) FILTER (WHERE status = 'completed') AS completed_at, max(ts) AS updated_at FROM ev GROUP BY 1)
"""


def work_events(t: Tables):
    kind, key = F.col("event_type"), F.col("event_id")
    status = F.when(kind == "purchase", "completed").when(kind == "error", "failed").when(kind == "click", "retry").otherwise("processing")
    method = F.when(key % 3 == 0, None).when(key % 2 == 0, "xbrl").otherwise("pdf")
    return t.raw("events").select("event_id", F.col("user_id").alias("id"), "ts", status.alias("status"), method.alias("method"), F.col("value").alias("duration"), (key % 20).alias("chunks"), F.when(kind == "error", F.concat(F.lit("code "), (key % 7).cast("string"))).alias("error"))


def states(t: Tables):
    return tracking.fold(work_events(t), "id", ["ts", "event_id"])


#: Every event's item was in the state of the event before, or to be tried again if that was 'processing' more than an hour ago; so was it at the end.
MOVES = f"""WITH {EVENTS}, n AS (SELECT *, lead(ts) OVER w AS next, lag(ts) OVER w AS last, lag(status) OVER w AS was FROM ev WINDOW w AS (PARTITION BY id ORDER BY ts, event_id)),
m AS (SELECT id, event_id, ts, CASE WHEN was IS NULL THEN 'pending' WHEN was = 'processing' AND ts > last + INTERVAL 1 HOUR THEN 'retry' ELSE was END AS before, status FROM n
  UNION ALL SELECT id, NULL, ts + INTERVAL 1 HOUR, 'processing', 'retry' FROM n WHERE status = 'processing' AND coalesce(next, (SELECT max(ts) FROM ev)) > ts + INTERVAL 1 HOUR)
"""
ALLOWED = " OR ".join(f"before = '{a}' AND status IN ({', '.join(repr(x) for x in b)})" for a, b in tracking.FOLLOWS.items())


@query("status_stream_log", MOVES + f"SELECT id, event_id, CAST(ts AS VARCHAR) AS ts, before, status, {ALLOWED} AS allowed FROM m")
def status_stream_log(t):
    """All moves of all items, told by a stream that keeps their states and tries stuck ones again."""
    events = work_events(t).select("id", "event_id", "ts", "status")
    return replayed(events.sparkSession, events, 3, work_log).withColumn("ts", F.col("ts").cast("string"))


@query("status_stream", FOLD + ", now AS (SELECT max(ts) AS t FROM ev) SELECT id, CASE WHEN status = 'processing' AND updated_at < now.t - INTERVAL 1 HOUR THEN 'retry' ELSE status END AS status FROM fold, now")
def status_stream(t):
    """The last state of every item on the stream: that of the fold, with stuck items reset at the time of the last event."""
    log = replayed(t.raw("events").sparkSession, work_events(t).select("id", "event_id", "ts", "status"), 4, work_log)
    return log.groupBy("id").agg(F.max_by("status", F.struct("ts", F.col("event_id").isNotNull(), "event_id")).alias("status"))


@query("status_fold", FOLD + "SELECT id, status, nullif(error, '') AS error, method, duration, chunks, CAST(completed_at AS VARCHAR) AS completed_at, CAST(updated_at AS VARCHAR) AS updated_at FROM fold")
def status_fold(t):
    return states(t).withColumns({c: F.col(c).cast("string") for c in ("completed_at", "updated_at")})


@query("status_select", FOLD + "SELECT o_orderkey AS id, f.status FROM orders LEFT JOIN fold f ON f.id = o_orderkey WHERE (o_orderkey % 4 <> 0 OR o_orderkey % 3 = 0) AND coalesce(f.status, 'pending') <> 'completed' AND o_orderdate >= TIMESTAMP '2001-01-01'")
def status_select(t):
    key = F.col("o_orderkey")
    items = t.raw("orders").select(key.alias("id"), F.to_date("o_orderdate").alias("disclosure_date"), F.when(key % 4 != 0, "a.pdf").alias("pdf_path"), F.when(key % 3 == 0, "a.zip").otherwise("").alias("xbrl_path"))
    return tracking.selected(items.join(states(t), "id", "left"), since=F.lit("2001-01-01").cast("date")).select("id", "status")


@query("status_select_first", FOLD + "SELECT o_orderkey AS id, f.status FROM orders LEFT JOIN fold f ON f.id = o_orderkey WHERE (o_orderkey % 4 <> 0 OR o_orderkey % 3 = 0) AND coalesce(f.status, 'pending') IN ('pending', 'failed', 'retry') ORDER BY o_orderdate DESC, o_orderkey LIMIT 100")
def status_select_first(t):
    """The hundred newest items that are open, failed ones too."""
    key = F.col("o_orderkey")
    items = t.raw("orders").select(key.alias("id"), F.col("o_orderdate").alias("disclosure_date"), F.when(key % 4 != 0, "a.pdf").alias("pdf_path"), F.when(key % 3 == 0, "a.zip").otherwise("").alias("xbrl_path"))
    return tracking.selected(items.join(states(t), "id", "left"), resume=True, retry_failed=True, most=100, order=[F.desc("disclosure_date"), F.asc("id")]).select("id", "status")


@query("event_windows", "SELECT CAST(s AS VARCHAR) AS start, event_type, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL 6 HOUR, ts), time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL 6 HOUR]) AS s FROM events) GROUP BY ALL")
def event_windows(t):
    """Events of windows of twelve hours, one every six."""
    out = window_counts(t.raw("events"), "ts", "12 hours", ["event_type"], "6 hours")
    return out.withColumn("start", F.col("start").cast("timestamp_ntz").cast("string"))


@query("ingest_stream", "SELECT user_id, event_type, CAST(arg_min(event_id, (ts, event_id)) AS BIGINT) AS event_id FROM events GROUP BY ALL")
def ingest_stream(t):
    """The first event of each user and kind, taken in from a stream of three arrivals; the last arrival repeats the first."""
    rows = t.raw("events").select("user_id", "event_type", "ts", "event_id")
    spark, root = rows.sparkSession, new_folder(rows.sparkSession, "ingest")
    middle = rows.agg(F.percentile_approx("ts", 0.5)).first()[0]
    for part in (rows.where(F.col("ts") <= F.lit(middle)), rows.where(F.col("ts") > F.lit(middle)), rows.where(F.col("ts") <= F.lit(middle))):
        part.write.mode("append").parquet(f"{root}/arrived")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/arrived")
        ingest_absent(stream, f"{root}/table", ["user_id", "event_type"], ["ts", "event_id"], f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{root}/table").select("user_id", "event_type", "event_id")


@query("status_stats", FOLD + "SELECT count(*) AS total, " + ", ".join(f"count(*) FILTER (WHERE status = '{s}') AS {s}" for s in tracking.STATES) + ", CAST(coalesce(sum(chunks), 0) AS BIGINT) AS total_chunks, round(avg(coalesce(duration, 0)), 4) AS avg_duration FROM fold")
def status_stats(t):
    return tracking.report(states(t)).withColumn("avg_duration", F.round("avg_duration", 4))


@query("status_reset", FOLD + "SELECT id, CASE WHEN status = 'processing' AND updated_at < TIMESTAMP '2024-01-29 00:00:00' - INTERVAL 1 HOUR THEN 'retry' ELSE status END AS status, status = 'processing' AND updated_at < TIMESTAMP '2024-01-29 00:00:00' - INTERVAL 1 HOUR AS was_stuck FROM fold")
def status_reset(t):
    return tracking.reset_stuck(states(t), F.lit("2024-01-29 00:00:00").cast("timestamp_ntz")).select("id", "status", "was_stuck")


@query("method_stats", FOLD + "SELECT method, count(*) AS n, CAST(sum(chunks) AS BIGINT) AS chunks, round(avg(duration), 4) AS avg_duration FROM fold WHERE method IS NOT NULL GROUP BY 1")
def method_stats(t):
    return tracking.by_method(states(t)).withColumn("avg_duration", F.round("avg_duration", 4))


@query("daily_activity", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n, count(DISTINCT user_id) AS users FROM events WHERE ts >= TIMESTAMP '2024-01-20' GROUP BY 1")
def daily_activity(t):
    rows = t.raw("events").where(F.col("ts") >= "2024-01-20")
    return rows.groupBy(F.to_date("ts").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"))


@query("event_tumbling", "SELECT CAST(time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '2000-01-01') AS VARCHAR) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def event_tumbling(t):
    rows = t.raw("events").withColumn("ts", F.col("ts").cast("timestamp"))
    return rows.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").cast("string").alias("start"), "event_type", "n")


@query("event_sliding", "SELECT CAST(time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2000-01-01') - k * INTERVAL 6 HOUR AS VARCHAR) AS start, count(*) AS n FROM events, (VALUES (0), (1), (2), (3)) o(k) GROUP BY 1")
def event_sliding(t):
    rows = t.raw("events").withColumn("ts", F.col("ts").cast("timestamp"))
    return rows.groupBy(F.window("ts", "24 hours", "6 hours")).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").cast("string").alias("start"), "n")


@query("event_session", """WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 2 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, new DESC) AS rn FROM g))
SELECT user_id, CAST(min(ts) AS VARCHAR) AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def event_session(t):
    rows = t.raw("events").withColumn("ts", F.col("ts").cast("timestamp"))
    return rows.groupBy("user_id", F.session_window("ts", "2 hours")).agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("session_window.start").cast("string").alias("start"), "n")


REPLY = T.StructType([T.StructField("n", T.LongType()), T.StructField("confidence", T.DoubleType())])


@query("llm_json_parse", """SELECT event_id, TRY_CAST(json_extract_string(j, '$.n') AS BIGINT) AS n, CASE WHEN j IS NULL THEN 0.0 ELSE coalesce(TRY_CAST(json_extract_string(j, '$.confidence') AS DOUBLE), 0.5) END AS confidence FROM (
  SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN props END AS j FROM events)""")
def llm_json_parse(t):
    """The object in a reply: from its first brace to its last, with a default confidence."""
    reply = F.when(F.col("event_id") % 10 == 0, F.lit("no object")).otherwise(F.concat(F.lit("Here:\n"), F.col("props"), F.lit("\nend")))
    body = F.nullif(F.regexp_extract(reply, r"(?s)\{.*\}", 0), F.lit(""))
    parsed = F.from_json(body, REPLY)
    return t.raw("events").select("event_id", parsed["n"].alias("n"), F.when(parsed.isNull(), 0.0).otherwise(F.coalesce(parsed["confidence"], F.lit(0.5))).alias("confidence"))


#: Bounds of the tree's nodes, level by level, and the rows of events with a day and a value.
NODES = "node(level, low, high) AS (VALUES (0, NULL, NULL), (1, NULL, 1.0), (1, 1.0, NULL), (2, NULL, 0.5), (2, 0.5, 1.0), (2, 1.0, 2.0), (2, 2.0, NULL), (3, NULL, 0.25), (3, 0.25, 0.5), (3, 0.5, 0.75), (3, 0.75, 1.0), (3, 1.0, 1.5), (3, 1.5, 2.0), (3, 2.0, 5.0), (3, 5.0, NULL))"


@query("value_tree", f"""WITH RECURSIVE {NODES}, r AS (SELECT CAST(ts AS DATE) AS day, CASE WHEN event_id % 10 > 0 THEN value / 20 END AS v FROM events),
c AS (SELECT day, level, CAST(low AS DOUBLE) AS low, CAST(high AS DOUBLE) AS high, count(*) AS n FROM r JOIN node ON level = 0 OR ((low IS NULL OR v >= low) AND (high IS NULL OR v < high) AND v IS NOT NULL) GROUP BY ALL),
t AS (SELECT * FROM c WHERE level = 0 UNION ALL SELECT c.* FROM t JOIN c ON c.day = t.day AND c.level = t.level + 1 AND t.n > 60 AND coalesce(c.low, -1e9) >= coalesce(t.low, -1e9) AND coalesce(c.high, 1e9) <= coalesce(t.high, 1e9))
SELECT CAST(day AS VARCHAR) AS day, CAST(level AS INTEGER) AS level, low, high, FALSE AS nulls, n FROM t WHERE n <= 60 OR level = 3
UNION ALL SELECT CAST(day AS VARCHAR), 1, NULL, NULL, TRUE, count(*) FILTER (WHERE v IS NULL) FROM r GROUP BY day HAVING count(*) > 60 AND count(*) FILTER (WHERE v IS NULL) > 0""")
def value_tree(t):
    rows = t.raw("events").select(F.to_date("ts").alias("day"), F.when(F.col("event_id") % 10 > 0, F.col("value") / 20).alias("v"))
    return ranges.value_leaves(rows, ["day"], "v", 60).withColumn("day", F.col("day").cast("string"))


@query("day_spans", """WITH RECURSIVE d AS (SELECT o_orderpriority AS k, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY ALL),
c AS (SELECT *, sum(n) OVER (PARTITION BY k ORDER BY day DESC) AS c FROM d),
e AS (SELECT u.k, u.day AS upper, u.c - u.n AS before, (SELECT max(x.day) FROM c x WHERE x.k = u.k AND x.c >= 25 + u.c - u.n) AS reached, (SELECT min(x.day) FROM c x WHERE x.k = u.k) AS oldest, (SELECT max(x.day) FROM c x WHERE x.k = u.k AND x.day < u.day) AS below FROM c u),
s AS (SELECT *, 0 AS no FROM e WHERE (k, upper) IN (SELECT (k, max(day)) FROM d GROUP BY k)
  UNION ALL SELECT e.*, s.no + 1 FROM s JOIN e ON e.k = s.k AND e.upper = CASE WHEN s.reached = s.upper THEN s.below ELSE s.reached END)
SELECT s.k, CAST(no AS INTEGER) AS no, CAST(upper AS VARCHAR) AS upper, CAST(coalesce(reached, oldest) AS VARCHAR) AS lower, CAST(c.c - before AS BIGINT) AS n, coalesce(reached = upper, FALSE) AS "full" FROM s JOIN c ON c.k = s.k AND c.day = coalesce(reached, oldest)""")
def day_spans(t):
    rows = t.raw("orders").select(F.col("o_orderpriority").alias("k"), "o_orderdate")
    return ranges.day_spans(rows, ["k"], "o_orderdate", 25).withColumns({c: F.col(c).cast("string") for c in ("upper", "lower")})
