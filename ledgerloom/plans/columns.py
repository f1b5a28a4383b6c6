"""Queries over names, days, paths and files, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import columns
from ledgerloom.operators import text
from ledgerloom.plans.bind import Tables
from ledgerloom.plans.texts import LINES, lines

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


@query("day_list", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + CAST(k AS INTEGER) AS VARCHAR) AS day FROM orders, LATERAL (SELECT unnest(range(o_orderkey % 5 + 1)) AS k)")
def day_list(t):
    rows = t.raw("orders").select("o_orderkey", F.to_date("o_orderdate").alias("first"))
    rows = rows.withColumn("last", F.date_add("first", (F.col("o_orderkey") % 5).cast("int")))
    return columns.day_list(rows, "first", "last").select("o_orderkey", F.col("day").cast("string").alias("day"))


@query("path_rebase", "SELECT p_partkey, CASE WHEN p LIKE '/%' THEN p WHEN p LIKE 'old/dir/%' THEN 'new/' || substring(p, 9) ELSE 'new/' || p END AS path FROM (SELECT p_partkey, list_extract(['/abs/', 'old/dir/', 'old/directory/', ''], p_partkey % 4 + 1) || replace(p_name, ' ', '-') AS p FROM part)")
def path_rebase(t):
    p = F.concat(F.element_at(F.array(*map(F.lit, ["/abs/", "old/dir/", "old/directory/", ""])), (F.col("p_partkey") % 4 + 1).cast("int")), F.replace("p_name", F.lit(" "), F.lit("-")))
    return t.raw("part").select("p_partkey", columns.rebased(p, "old/dir", "new/").alias("path"))


@query("name_split", "SELECT p_partkey, p_name AS english, CASE WHEN p_partkey % 2 = 0 THEN p_type END AS japanese FROM part")
def name_split(t):
    name = F.when(F.col("p_partkey") % 2 == 0, F.concat("p_name", F.lit(" ["), "p_type", F.lit("]"))).otherwise(F.col("p_name"))
    return t.raw("part").select("p_partkey", columns.english_part(name).alias("english"), columns.japanese_part(name).alias("japanese"))


@query("value_format", "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '-' ELSE format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) END AS shown FROM orders")
def value_format(t):
    value = F.when(F.col("o_orderkey") % 7 != 0, F.floor("o_totalprice"))
    return t.raw("orders").select("o_orderkey", columns.shown_value(value).alias("shown"))


@query("package_names", "SELECT o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 5, '0') AS code, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(last_day(make_date(year(o_orderdate), month(o_orderdate), 1)) AS VARCHAR) END AS period_end FROM orders")
def package_names(t):
    month = F.concat(F.year("o_orderdate").cast("string"), F.lit("年"), F.month("o_orderdate").cast("string"), F.lit("月期"))
    name = F.concat(F.lit("15-30_"), F.lpad(F.col("o_custkey").cast("string"), 5, "0"), F.lit("_"), F.when(F.col("o_orderkey") % 3 != 0, month).otherwise("x"), F.lit(".zip"))
    return t.raw("orders").select("o_orderkey", columns.package_code(name).alias("code"), columns.package_date(name).cast("string").alias("period_end"))


@query("file_choice", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 5 <> 0 THEN 'xbrl' WHEN o_orderkey % 3 <> 0 THEN 'pdf' ELSE 'none' END AS method FROM orders")
def file_choice(t):
    key = F.col("o_orderkey")
    chosen = columns.file_choice(F.when(key % 2 == 0, "a.zip"), F.when(key % 3 != 0, "a.pdf").otherwise(""), key % 5 != 0)
    return t.raw("orders").select("o_orderkey", chosen["method"].alias("method"))


@query("document_kind", f"WITH {LINES} SELECT doc_id, CASE WHEN m > 200 AND s > 0.5 THEN 'text' WHEN m < 50 AND s < 0.3 THEN 'image' ELSE 'mixed' END AS kind FROM (SELECT doc_id, avg(length(trim(content))) AS m, count(*) FILTER (WHERE length(trim(content)) > 50) / count(*) AS s FROM lines WHERE line < 3 GROUP BY 1)")
def document_kind(t):
    return columns.document_kind(lines(t), "doc_id", "line", "content")


@query("longest_context", "SELECT l_orderkey, max(l_linenumber) FILTER (WHERE rn = 1) AS l_linenumber FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber) AS rn FROM lineitem) GROUP BY 1")
def longest_context(t):
    rows = t.raw("lineitem").select("l_orderkey", "l_linenumber", F.lit("1990-01-01").cast("date").alias("start"), F.to_date("l_shipdate").alias("end"))
    return columns.longest_context(rows, "l_orderkey", "l_linenumber", "start", "end", "l_linenumber")


@query("document_vectors", "SELECT label, i, round(avg(x), 6) AS x FROM (SELECT label, CAST(unnest(range(len(embedding))) AS INTEGER) AS i, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings) GROUP BY 1, 2")
def document_vectors(t):
    out = columns.mean_vector(t.raw("embeddings"), "label", "embedding")
    return out.select("label", F.posexplode("embedding").alias("i", "x")).withColumn("x", F.round("x", 6))


NAMES = [("of the", "outlook"), ("une", "notes")]
WORDS = [("segment_analysis", ["tion"]), ("per_share_info", ["der"])]


@query("heading_sections", f"WITH {LINES} SELECT doc_id, line, CASE WHEN h = '' THEN 'unknown' WHEN contains('of the', h) OR contains(h, 'of the') THEN 'outlook' WHEN contains('une', h) OR contains(h, 'une') THEN 'notes' WHEN contains(lower(h), 'tion') THEN 'segment_analysis' WHEN contains(lower(h), 'der') THEN 'per_share_info' ELSE 'general' END AS section FROM (SELECT doc_id, line, regexp_replace(content, '[ \\t\\n\\r\\f\\v]+', '', 'g') AS h FROM lines)")
def heading_sections(t):
    return lines(t).select("doc_id", "line", columns.heading_section(F.col("content"), NAMES, WORDS).alias("section"))


@query("page_overlap")
def page_overlap(t):
    rows = text.fixed_chunks(t.raw("documents"), "doc_id", "text", 300).withColumn("page", F.floor(F.col("chunk_index") / 4))
    return text.overlapping(rows, ["doc_id", "page"], "content", "chunk_index").select("doc_id", "chunk_index")
