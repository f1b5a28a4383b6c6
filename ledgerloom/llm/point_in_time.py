"""Point-in-time feature join by range frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def winners(versions: DataFrame) -> DataFrame:
    """Of versions (entity, event, arrival, expiry, version, carry), those that can win at some time.

    Among versions of one event the earliest arrival goes first, then the largest version.
    All that go before a version are there when it arrives, so it can win only if it expires
    after every one of them. Versions of the same times are reduced to the largest first, task
    by task, so that no count of rows of one event meets in one task: what is left of an event is
    bounded by its distinct times.
    """
    usable = versions.where((F.col("event") < F.col("expiry")) & (F.col("arrival") < F.col("expiry")) & F.col("entity").isNotNull())
    best = usable.groupBy("entity", "event", "arrival", "expiry").agg(F.max(F.struct("version", "carry")).alias("best"))
    first = W.partitionBy("entity", "event").orderBy("arrival", F.col("best.version").desc_nulls_last(), F.col("expiry").desc())
    covered = F.max("expiry").over(first.rowsBetween(W.unboundedPreceding, -1))
    return best.withColumn("covered", covered).where("covered is null or expiry > covered").drop("covered")


def point_in_time(versions: DataFrame, questions: DataFrame, *, entity: str, event: str, arrival: str, expiry: str, version: str, time: str, lifetime: int, carry: tuple[str, ...] = (), ask_entity: str | None = None) -> DataFrame:
    """For every row of questions the version of its entity that was known and in force at its time.

    Versions count if event <= time and arrival <= time < expiry. The latest event wins,
    then the earliest arrival, then the largest version, then the largest carried values.
    Times are whole numbers of one unit; no version is in force for more than `lifetime`
    units after its event (a later expiry is cut to that).

    Versions and questions are one table, ordered by time within an entity; a range frame of
    the preceding lifetime collects the versions of each question, which are filtered on arrival
    and expiry, and the greatest is taken. Three things bound a frame, however many rows an
    entity has. Versions that can never win are left out (see winners); the versions of
    one event are one row; equal questions are asked once. An entity is cut into spans of half
    a lifetime, and a version is filed in each span that it reaches, so that a hot entity is
    spread over tasks. Joins are by sorting on keys of which one side has each once.

    Null entity or time: no version. Null event, arrival or expiry: never in force. Null
    version: ranks last. Repeated versions: as one. Repeated questions: answered each. Ties: as
    above. Empty tables: no version, or no rows. Texts are only carried, however long. Other columns of
    questions stay and cannot clash with those of versions.

    Returns (question struct of all its columns, found struct<event, arrival, expiry, version, carry>, null
    without a winner).
    """
    width = max(lifetime // 2, 1)
    as_long = lambda c: F.col(c).cast("long")
    carried = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(None).cast("int")
    known = versions.select(F.col(entity).alias("entity"), as_long(event).alias("event"), as_long(arrival).alias("arrival"), F.when(F.col(expiry).isNotNull(), F.least(as_long(expiry), as_long(event) + lifetime)).alias("expiry"), F.col(version).alias("version"), carried.alias("carry"))
    known = known.where("event is not null and arrival is not null and expiry is not null")
    one = F.struct("event", (-F.col("arrival")).alias("early"), F.col("best.version").alias("version"), F.col("best.carry").alias("carry"), "arrival", "expiry")
    packed = winners(known).groupBy("entity", "event").agg(F.collect_list(one).alias("pack"), F.max("expiry").alias("last"))
    spans = F.sequence(F.floor(F.col("event") / width), F.floor((F.col("last") - 1) / width))
    filed = packed.select("entity", F.explode(spans).alias("span"), F.col("event").alias("time"), "pack", F.lit(False).alias("asked"))

    asked = questions.select(F.struct("*").alias("question"), F.col(ask_entity or entity).alias("entity"), as_long(time).alias("time"))
    distinct = asked.where("entity is not null and time is not null").select("entity", "time").distinct()
    distinct = distinct.select("entity", F.floor(F.col("time") / width).alias("span"), "time", F.lit(None).cast(filed.schema["pack"].dataType).alias("pack"), F.lit(True).alias("asked"))

    before = W.partitionBy("entity", "span").orderBy("time").rangeBetween(-(lifetime - 1), 0)
    framed = filed.unionByName(distinct).withColumn("packs", F.collect_list("pack").over(before)).where("asked")
    in_force = lambda v: (v["arrival"] <= F.col("time")) & (F.col("time") < v["expiry"])
    found = F.array_max(F.transform("packs", lambda p: F.array_max(F.filter(p, in_force))))
    answers = framed.select("entity", "time", found.alias("found")).where("found is not null")
    out = asked.hint("merge").join(answers.hint("merge"), ["entity", "time"], "left")
    return out.select("question", F.when(F.col("found").isNotNull(), F.struct("found.event", "found.arrival", "found.expiry", "found.version", "found.carry")).alias("found"))


def number(doc_id: Column, group: int) -> Column:
    """The unsigned integer of a group of eight hex digits of the id's digest."""
    return F.conv(F.substring(F.sha2(doc_id.cast("string").cast("binary"), 256), 1 + 8 * group, 8), 16, 10).cast("long")


def op13(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The version of its document's source that each label sees; an id with several sources has the least of them."""
    i = F.col("doc_id")
    a, b, c = (number(i, k) for k in range(3))
    versions = docs.select("doc_id", "source", "n_chars", "lang", (a % 20000).alias("event"), (b % 300).alias("late"), (c % 900).alias("life"))
    versions = versions.select("doc_id", "source", "n_chars", "lang", "event", (F.col("event") - 60 + F.col("late")).alias("arrival"), (F.col("event") + F.col("life")).alias("expiry"))
    sources = docs.groupBy("doc_id").agg(F.min("source").alias("source"))
    asked = labels.select("doc_id", (number(i, 3) % 20000).alias("t")).hint("merge").join(sources.hint("merge"), "doc_id", "left")
    seen = point_in_time(versions, asked, entity="source", event="event", arrival="arrival", expiry="expiry", version="doc_id", time="t", lifetime=900, carry=("n_chars", "lang"))
    t, age = F.col("question.t"), F.col("question.t") - F.col("found.event")
    status = F.when(F.col("found").isNull(), "none").when(age > 60, "stale").otherwise("fresh")
    fresh = lambda c: F.when(status == "fresh", F.col(f"found.carry.{c}")).alias(c)
    return seen.select(F.col("question.doc_id").alias("doc_id"), t.alias("t"), F.col("found.version").alias("version_id"), age.alias("age"), status.alias("status"), fresh("n_chars"), fresh("lang"))


OP13_SQL = r"""
WITH h AS (
  SELECT doc_id, source, n_chars, lang, sha256(CAST(doc_id AS VARCHAR)) AS x FROM documents
), v AS (
  SELECT doc_id, source, n_chars, lang, CAST('0x' || x[1:8] AS BIGINT) % 20000 AS event,
    CAST('0x' || x[9:16] AS BIGINT) % 300 AS late, CAST('0x' || x[17:24] AS BIGINT) % 900 AS life
  FROM h
), s AS (
  SELECT doc_id, min(source) AS source FROM documents GROUP BY 1
), q AS (
  SELECT row_number() OVER () AS label, l.doc_id, CAST('0x' || sha256(CAST(l.doc_id AS VARCHAR))[25:32] AS BIGINT) % 20000 AS t, s.source
  FROM labels l LEFT JOIN s ON s.doc_id = l.doc_id
), f AS (
  SELECT q.label, q.doc_id, q.t, v.doc_id AS version_id, q.t - v.event AS age, v.n_chars, v.lang
  FROM q LEFT JOIN v ON v.source = q.source AND v.event <= q.t AND v.event - 60 + v.late <= q.t AND q.t < v.event + v.life
  QUALIFY row_number() OVER (PARTITION BY q.label ORDER BY v.event DESC NULLS LAST, v.late, v.doc_id DESC) = 1
)
SELECT doc_id, t, version_id, age, CASE WHEN version_id IS NULL THEN 'none' WHEN age > 60 THEN 'stale' ELSE 'fresh' END AS status,
  CASE WHEN age <= 60 THEN n_chars END AS n_chars, CASE WHEN age <= 60 THEN lang END AS lang
FROM f
"""
