"""Work tracking: states folded from an event log, selections, resets and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

STATES = ("pending", "processing", "completed", "failed", "retry")


def fold(events: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The state of each item after all its events, taken in order.

    The last event gives state and error; the method is the last one told; duration,
    chunks and time of completion come from the last completion. Plain aggregates
    with partial sums: no item's events have to be sorted.
    """
    at = F.struct(*order)
    done = F.when(F.col("status") == "completed", at)
    return events.groupBy(key).agg(
        F.max_by("status", at).alias("status"),
        F.max_by("error", at).alias("error"),
        F.max_by("method", F.when(F.col("method").isNotNull(), at)).alias("method"),
        F.max_by("duration", done).alias("duration"),
        F.max_by("chunks", done).alias("chunks"),
        F.max(F.when(F.col("status") == "completed", F.col("ts"))).alias("completed_at"),
        F.max("ts").alias("updated_at"),
    )


def selected(items: DataFrame, *, resume: bool = False, retry_failed: bool = False, force: bool = False, since: Column | None = None, most: int | None = None, order: list[Column] = ()) -> DataFrame:
    """Items to work on: those with a file that are open (resume), or not completed unless forced, and recent; the first `most` of them in order, if given."""
    status = F.coalesce(F.col("status"), F.lit("pending"))
    if resume:
        open_ = status.isin("pending", "failed", "retry") if retry_failed else status == "pending"
    else:
        open_ = F.lit(True) if force else status != "completed"
    there = (F.col("pdf_path").isNotNull() & (F.col("pdf_path") != "")) | (F.col("xbrl_path").isNotNull() & (F.col("xbrl_path") != ""))
    wanted = items.where(there & open_ & (F.lit(True) if since is None else F.col("disclosure_date") >= since))
    return wanted if most is None else wanted.orderBy(*order).limit(most)


def reset_stuck(states: DataFrame, now: Column, hours: int = 1) -> DataFrame:
    """Items that have been processing for longer are to be tried again."""
    stuck = (F.col("status") == "processing") & (F.col("updated_at") < now - F.expr(f"INTERVAL {hours} HOUR"))
    return states.withColumn("was_stuck", stuck).withColumn("status", F.when(stuck, "retry").otherwise(F.col("status")))


def report(states: DataFrame) -> DataFrame:
    count = lambda s: F.count_if(F.coalesce(F.col("status"), F.lit("pending")) == s).alias(s)
    return states.agg(F.count(F.lit(1)).alias("total"), *map(count, STATES), F.coalesce(F.sum("chunks"), F.lit(0)).alias("total_chunks"), F.avg(F.coalesce(F.col("duration"), F.lit(0.0))).alias("avg_duration"))


def by_method(states: DataFrame) -> DataFrame:
    return states.where(F.col("method").isNotNull()).groupBy("method").agg(F.count(F.lit(1)).alias("n"), F.sum("chunks").alias("chunks"), F.avg("duration").alias("avg_duration"))


#: Which state may follow which; an item without a state is pending.
FOLLOWS = {"pending": ("processing",), "processing": ("completed", "failed", "retry"), "completed": ("processing",), "failed": ("processing", "retry"), "retry": ("processing",)}


def violations(events: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Events whose state is unknown or may not follow the one before it, with that one."""
    before = F.coalesce(F.lag("status").over(W.partitionBy(key).orderBy(*order)), F.lit("pending"))
    rows = events.withColumn("status_before", before)
    allowed = F.lit(False)
    for a, after in FOLLOWS.items():
        allowed = allowed | ((F.col("status_before") == a) & F.col("status").isin(*after))
    return rows.where(F.col("status").isNull() | ~F.col("status").isin(*STATES) | ~allowed)


def reset(states: DataFrame, key: str, ids: DataFrame | None = None) -> DataFrame:
    """Items named by id, or all failed ones, are pending again without their error."""
    if ids is None:
        named = F.col("status") == "failed"
        rows = states
    else:
        rows = states.join(ids.select(F.col(key), F.lit(True).alias("_named")).distinct(), key, "left")
        named = F.coalesce("_named", F.lit(False))
    out = rows.withColumns({"status": F.when(named, "pending").otherwise(F.col("status")), "error": F.when(~F.coalesce(named, F.lit(False)), F.col("error"))})
    return out if ids is None else out.drop("_named")


def rates(states: DataFrame, total: int | None = None) -> DataFrame:
    """Files and chunks a second over the time worked, and the seconds left at that rate; null without time."""
    n, seconds = F.count_if(F.col("status").isin("completed", "failed")), F.sum("duration")
    rate = lambda x: F.when(seconds > 0, x / seconds)
    all_ = F.count(F.lit(1)) if total is None else F.lit(total)
    return states.agg(n.alias("n"), rate(n).alias("files_per_second"), rate(F.sum("chunks")).alias("chunks_per_second"), F.when((seconds > 0) & (n > 0), (all_ - n) * seconds / n).alias("seconds_left"))


def to_download(disclosures: DataFrame, first=None, last=None) -> DataFrame:
    """Disclosures with an address whose file is not there yet, of a span of days if given."""
    rows = disclosures.where(F.col("xbrl_url").isNotNull() & F.col("xbrl_path").isNull())
    if first is not None:
        rows = rows.where(F.col("disclosure_date") >= first)
    return rows if last is None else rows.where(F.col("disclosure_date") <= last)
