"""Queries over addresses, periods, filings, labels, cleaned pages and migrations, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import classify, cleaning, finance, retrieval, text, tracking, views, xbrl
from ledgerloom.operators.rules import PARENT_NAMES, SUBCATEGORY_NAMES
from ledgerloom.plans import financial, work
from ledgerloom.plans.bind import BIND, Tables
from ledgerloom.plans.classification import CLASSED, LABELLED, classed, labelled
from ledgerloom.plans.texts import CHUNKS, LINES, SECTION_OF, chunks, count_sql, documents, lines
from ledgerloom.sources import html, packages, tables

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = f"WITH {BIND}{sql}" if sql.lstrip().startswith(",") else sql
        return f

    return add


def one_of(key, values):
    """The value that a key's remainder picks."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values) + 1).cast("int"))


def list_sql(key: str, values) -> str:
    return f"list_extract([{', '.join('NULL' if v is None else repr(v) for v in values)}], {key} % {len(values)} + 1)"


URLS = ["https://host/a/{}.pdf", "{}.pdf", "https://host/{}.html", "", None]


@query("url_ids", f"SELECT o_orderkey, id, 'https://mirror/disc/' || code || '/' || id || '.pdf' AS mirror FROM (SELECT o_orderkey, CASE WHEN length(CAST(o_custkey AS VARCHAR)) = 4 THEN o_custkey || '0' ELSE CAST(o_custkey AS VARCHAR) END AS code, CASE WHEN u LIKE '%.pdf' THEN nullif(regexp_replace(string_split(u, '/')[-1], '\\.pdf$', ''), '') END AS id FROM (SELECT *, replace({list_sql('o_orderkey', URLS)}, '{{}}', CAST(o_orderkey AS VARCHAR)) AS u FROM orders))")
def url_ids(t):
    key = F.col("o_orderkey")
    found = xbrl.url_id(F.replace(one_of(key, URLS), F.lit("{}"), key.cast("string")))
    rows = t.raw("orders").select(key, found.alias("id"), xbrl.company_code(F.col("o_custkey").cast("string")).alias("code"))
    return rows.select("o_orderkey", "id", xbrl.mirror_url("https://mirror/disc", F.col("code"), F.col("id")).alias("mirror"))


PERIODS = [("{} Q2", 2), ("FY{} 3q", 3), ("{}-1", 1), ("{}年第２四半期", 2), ("{}年第3四半期", 3), ("{} interim", 2), ("{}年中間期", 2), ("{}", 4), ("half year", None), ("", None)]


@query("user_period", "SELECT o_orderkey, CASE WHEN q IS NOT NULL THEN year(o_orderdate) END AS year, q AS quarter FROM (SELECT *, " + list_sql("o_orderkey", [q for _, q in PERIODS]) + " AS q FROM orders)")
def user_period(t):
    key = F.col("o_orderkey")
    typed = F.replace(one_of(key, [p for p, _ in PERIODS]), F.lit("{}"), F.year("o_orderdate").cast("string"))
    rows = t.raw("orders").select(key, xbrl.user_period(typed).alias("p"))
    return rows.select("o_orderkey", F.col("p.year").cast("long").alias("year"), F.col("p.quarter").alias("quarter"))


FLAGS = ["true", "1", "Yes", "y", "false", "0", "", None]


@query("filing_fields", f""", dei AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 <> 0 THEN year(o_orderdate) END AS fiscal_year, CASE o_orderkey % 8 WHEN 6 THEN NULL WHEN 7 THEN NULL ELSE o_orderkey % 8 < 4 END AS amendment_flag FROM orders WHERE o_orderstatus <> 'P'),
summary AS (SELECT o_orderkey AS id, year(o_orderdate) + 1 AS fiscal_year, o_orderpriority < '3' AS amendment_flag FROM orders WHERE o_orderstatus <> 'F')
SELECT coalesce(d.id, s.id) AS id, coalesce(d.fiscal_year, s.fiscal_year) AS fiscal_year, coalesce(d.amendment_flag, s.amendment_flag) AS amendment_flag FROM dei d FULL JOIN summary s ON d.id = s.id""")
def filing_fields(t):
    o, key, year = t.raw("orders"), F.col("o_orderkey"), F.year("o_orderdate").cast("long")
    dei = o.where("o_orderstatus <> 'P'").select(key.alias("id"), F.when(key % 3 != 0, year).alias("fiscal_year"), xbrl.flag(one_of(key, FLAGS)).alias("amendment_flag"))
    summary = o.where("o_orderstatus <> 'F'").select(key.alias("id"), (year + 1).alias("fiscal_year"), (F.col("o_orderpriority") < "3").alias("amendment_flag"))
    return xbrl.filled(dei, summary, "id", ["fiscal_year", "amendment_flag"])


HEADERS = [" 2 ", "3", "7", "x", None]
IDS = ["CurrentAccumulatedQ1Duration", "CurrentAccumulatedQ3Duration_ConsolidatedMember", "CurrentYearDuration"]


@query("summary_quarter", f"SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 2 WHEN 1 THEN 3 ELSE CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 99 END END AS quarter FROM orders")
def summary_quarter(t):
    key = F.col("o_orderkey")
    return t.raw("orders").select(key, xbrl.summary_quarter(one_of(key, HEADERS), one_of(key, IDS)).alias("quarter"))


VALID = [("CurrentYearDuration", "duration", True), ("CurrentYearDuration_ConsolidatedMember", "duration", True), ("CurrentYearDuration_NonConsolidatedMember", "duration", False), ("ResultDuration", "duration", True), ("CurrentYearInstant", "instant", True), ("Prior1YearInstant", "instant", False), ("CurrentYearInstant_SegmentMember", "instant", False), ("CurrentYearInstant", "duration", False)]


@query("valid_contexts", "SELECT context_id, kind, valid, n FROM (SELECT l_partkey % 8 AS k, count(*) AS n FROM lineitem GROUP BY 1) JOIN (VALUES " + ", ".join(f"({i}, '{c}', '{p}', {v})" for i, (c, p, v) in enumerate(VALID)) + ") v(k, context_id, kind, valid) USING (k)")
def valid_contexts(t):
    rows = t.raw("lineitem").groupBy((F.col("l_partkey") % 8).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    rows = rows.select(one_of(F.col("k"), [c for c, _, _ in VALID]).alias("context_id"), one_of(F.col("k"), [p for _, p, _ in VALID]).alias("kind"), "n")
    return rows.withColumn("valid", xbrl.is_valid_context(F.col("context_id"), F.col("kind")))


@query("figure_sections", ", s AS (SELECT id, filing_id, CASE statement_role_en WHEN 'Summary' THEN 'ナラティブ' WHEN 'Balance sheet' THEN '貸借対照表' END AS ja FROM sections) SELECT id, filing_id FROM s WHERE ja IS NULL OR ja <> 'ナラティブ'")
def figure_sections(t):
    ja = F.when(F.col("statement_role_en") == "Summary", "ナラティブ").when(F.col("statement_role_en") == "Balance sheet", "貸借対照表")
    return xbrl.with_figures(t.sections().withColumn("ja", ja), "ja").select("id", "filing_id")


@query("first_facts", f", f AS (SELECT *, row_number() OVER (PARTITION BY section_id, concept_id, context_id ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linenumber) AS rn FROM facts) SELECT section_id, concept_id, context_id, CAST(value AS DOUBLE) AS value FROM f WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM facts o JOIN sections s ON o.section_id = s.id WHERE s.statement_role_en = 'Summary' AND s.filing_id % 5 = 0 AND o.section_id = f.section_id AND o.concept_id = f.concept_id AND o.context_id = f.context_id)")
def first_facts(t):
    keys = ["section_id", "concept_id", "context_id"]
    facts, sections = t.facts(), t.sections().where("statement_role_en = 'Summary' and filing_id % 5 = 0")
    old = facts.join(sections.select(F.col("id").alias("section_id")), "section_id", "left_semi").select(*keys).distinct()
    order = [F.col(f"fact_order.{c}") for c in "l_shipdate l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_linenumber".split()]
    return xbrl.first_facts(facts, order).join(old, keys, "left_anti").select(*keys, F.col("value").cast("double").alias("value"))


@query("to_download", "SELECT o_orderkey AS id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority NOT LIKE '1%' AND o_orderdate >= TIMESTAMP '1995-01-01'")
def to_download(t):
    url, path = F.when(F.col("o_orderstatus") != "P", F.lit("u")), F.when(F.col("o_orderpriority").startswith("1"), F.lit("p"))
    rows = t.raw("orders").select(F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("disclosure_date"), url.alias("xbrl_url"), path.alias("xbrl_path"))
    return tracking.to_download(rows, F.lit("1995-01-01").cast("date")).select("id", F.col("disclosure_date").cast("string").alias("day"))


@query("unlabelled_titles", ", labels AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R') SELECT id, title FROM disclosures WHERE id NOT IN (SELECT l_orderkey FROM labels) AND disclosure_date BETWEEN DATE '1994-01-01' AND DATE '1997-12-31'")
def unlabelled_titles(t):
    labels = t.raw("lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("disclosure_id"))
    first, last = (F.lit(d).cast("date") for d in ("1994-01-01", "1997-12-31"))
    return classify.chosen_titles(t.disclosures(), labels, first=first, last=last).select("id", "title")


@query("training_samples", CLASSED + """SELECT p_partkey, '{"text":"' || ttl || '","labels":{"parent_categories":["' || array_to_string(parents, '","') || '"],"subcategories":[' || array_to_string(list_transform(hits, lambda x: '"' || x.sub || '"'), ',') || ']}}' AS sample FROM classed""")
def training_samples(t):
    return classify.training_samples(classed(t), "title", "p_partkey")


NAMES = "(VALUES " + ", ".join(f"('{e}', '{j}')" for e, j, _ in PARENT_NAMES) + ") n(en, ja)"
SUB_NAMES = "(VALUES " + ", ".join(f"('{e}', '{j}')" for e, j in SUBCATEGORY_NAMES) + ") n(en, ja)"


@query("label_names", f"WITH r AS (SELECT p_partkey, {list_sql('p_partkey', [e for e, _ in SUBCATEGORY_NAMES] + ['none'])} AS sub, {list_sql('p_partkey', [e for e, _, _ in PARENT_NAMES] + ['OTHER'])} AS category FROM part) SELECT p_partkey, category, sub, c.ja AS category_ja, s.ja AS sub_ja FROM r LEFT JOIN {NAMES.replace(' n(', ' c(')} ON c.en = r.category LEFT JOIN {SUB_NAMES.replace(' n(', ' s(')} ON s.en = r.sub")
def label_names(t):
    key = F.col("p_partkey")
    rows = t.raw("part").select(key, one_of(key, [e for e, _ in SUBCATEGORY_NAMES] + ["none"]).alias("sub"), one_of(key, [e for e, _, _ in PARENT_NAMES] + ["OTHER"]).alias("category"))
    rows = classify.in_both_languages(rows, "category", [(e, j) for e, j, _ in PARENT_NAMES], "category_ja")
    return classify.in_both_languages(rows, "sub", SUBCATEGORY_NAMES, "sub_ja")


TITLES = [
    ("決算短信", "EARNINGS & PERFORMANCE", "Earnings Reports"),
    ("配当のお知らせ", "CORPORATE FINANCE", "Dividend Notices"),
    ("役員異動について", "GOVERNANCE & LEADERSHIP", "Governance & Senior Personnel Changes"),
    ("M&A実施について", "CORPORATE STRATEGY & RESTRUCTURING", "M&A, Alliances & Restructuring"),
    ("株式分割について", "CORPORATE FINANCE", "Stock Splits (Forward/Reverse)"),
    ("未知のタイトル例", "OTHER", ""),
    ("業績予想修正に関するお知らせ", "EARNINGS & PERFORMANCE, CORRECTIONS & ERRATA", "Earnings Corrections, Earnings Forecasts, Performance Variance Analysis"),
]


@query("japanese_titles", "SELECT o_orderkey, title, parent_text, sub_text FROM orders JOIN (VALUES " + ", ".join(f"({i}, '{a}', '{p}', '{s}')" for i, (a, p, s) in enumerate(TITLES)) + ") v(k, title, parent_text, sub_text) ON k = o_orderkey % 7")
def japanese_titles(t):
    titles = t.raw("orders").select("o_orderkey", one_of(F.col("o_orderkey"), [a for a, _, _ in TITLES]).alias("title"))
    return classify.classify_titles(titles, "title").select("o_orderkey", "title", "parent_text", "sub_text")


@query("company_sectors", "WITH c AS (SELECT c_custkey, c_mktsegment AS en, CASE WHEN c_nationkey % 4 <> 0 THEN lower(c_mktsegment) END AS ja FROM customer), s AS (SELECT row_number() OVER (ORDER BY en, ja NULLS FIRST) AS id, en, ja FROM (SELECT DISTINCT en, ja FROM c)) SELECT c.c_custkey, s.id AS sector_id FROM c LEFT JOIN s ON c.en = s.en AND c.ja = s.ja")
def company_sectors(t):
    rows = t.raw("customer").select("c_custkey", F.col("c_mktsegment").alias("en"), F.when(F.col("c_nationkey") % 4 != 0, F.lower("c_mktsegment")).alias("ja"))
    return views.with_sectors(rows, ["en", "ja"]).select("c_custkey", "sector_id")


@query("exchanges", "SELECT coalesce(mic, 'XXXX') AS mic, e AS name_en, coalesce(ja, e) AS name_ja FROM (SELECT DISTINCT " + list_sql("o_orderkey", ["TSE", "NSE", "SSE", "FSE", "OTC", None]) + " AS e FROM orders) LEFT JOIN (VALUES " + ", ".join(f"('{e}', '{m}', '{j}')" for e, m, j in views.EXCHANGES) + ") x(en, mic, ja) ON en = e WHERE e IS NOT NULL")
def exchanges(t):
    rows = t.raw("orders").select(one_of(F.col("o_orderkey"), ["TSE", "NSE", "SSE", "FSE", "OTC", None]).alias("exchange"))
    return views.exchanges(rows, "exchange")


@query("migrated_classes", "WITH d AS (SELECT o_orderpriority AS c, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderstatus END AS s FROM orders), k AS (SELECT row_number() OVER (ORDER BY c) AS id, c FROM (SELECT DISTINCT c FROM d WHERE c IS NOT NULL AND c <> '')) SELECT DISTINCT k.id AS category_id, k.c AS category, d.s AS subcategory FROM d JOIN k USING (c) WHERE d.s IS NOT NULL AND d.s <> ''")
def migrated_classes(t):
    rows = t.raw("orders").select(F.col("o_orderpriority").alias("category"), F.when(F.col("o_orderkey") % 4 == 0, "").otherwise(F.col("o_orderstatus")).alias("subcategory"))
    return views.class_tables(rows, "category", "subcategory")[1]


@query("migrated_filings", ", reports AS (SELECT DISTINCT l_orderkey AS disclosure_id FROM lineitem) SELECT r.disclosure_id, c.id AS company_id, CAST(CAST(d.disclosure_date - INTERVAL 3 MONTH AS DATE) AS VARCHAR) AS period_start, CAST(d.disclosure_date AS VARCHAR) AS period_end FROM reports r JOIN disclosures d ON r.disclosure_id = d.id JOIN companies c ON d.company_code = c.ticker")
def migrated_filings(t):
    reports = t.raw("lineitem").select(F.col("l_orderkey").alias("disclosure_id")).distinct()
    out = views.filings_of_reports(reports, t.disclosures(), t.companies().select("id", F.col("ticker").alias("company_code")))
    return out.select("disclosure_id", "company_id", F.col("period_start").cast("string").alias("period_start"), F.col("period_end").cast("string").alias("period_end"))


EVENTS = "WITH e AS (SELECT user_id, event_id, ts, list_extract(['processing', 'completed', 'failed', 'retry', 'odd'], event_id % 5 + 1) AS status FROM events), b AS (SELECT *, coalesce(lag(status) OVER (PARTITION BY user_id ORDER BY ts, event_id), 'pending') AS before FROM e)"


def moves(t: Tables):
    return t.raw("events").select("user_id", "event_id", "ts", one_of(F.col("event_id"), ["processing", "completed", "failed", "retry", "odd"]).alias("status"))


@query("status_violations", EVENTS + " SELECT event_id, before AS status_before, status FROM b WHERE NOT ((before = 'pending' AND status = 'processing') OR (before = 'processing' AND status IN ('completed', 'failed', 'retry')) OR (before IN ('completed', 'retry') AND status = 'processing') OR (before = 'failed' AND status IN ('processing', 'retry')))")
def status_violations(t):
    return tracking.violations(moves(t), "user_id", ["ts", "event_id"]).select("event_id", "status_before", "status")


@query("work_rates", work.FOLD + "SELECT n, round(n / s, 6) AS files_per_second, round(c / s, 6) AS chunks_per_second, round((m - n) * s / n, 2) AS seconds_left FROM (SELECT count(*) FILTER (WHERE status IN ('completed', 'failed')) AS n, sum(duration) AS s, sum(chunks) AS c, count(*) AS m FROM fold)")
def work_rates(t):
    out = tracking.rates(work.states(t))
    return out.select("n", F.round("files_per_second", 6).alias("files_per_second"), F.round("chunks_per_second", 6).alias("chunks_per_second"), F.round("seconds_left", 2).alias("seconds_left"))


@query("status_reset_ids", work.FOLD + "SELECT id, CASE WHEN id IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') THEN 'pending' ELSE status END AS status FROM fold")
def status_reset_ids(t):
    ids = t.raw("orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("id"))
    return tracking.reset(work.states(t), "id", ids).select("id", "status")


@query("statement_order", "SELECT year, quarter, n, row_number() OVER (ORDER BY year DESC, quarter DESC) AS place FROM (SELECT year(o_orderdate) AS year, quarter(o_orderdate) AS quarter, count(*) AS n FROM orders GROUP BY 1, 2)")
def statement_order(t):
    from pyspark.sql import Window as W

    rows = t.raw("orders").groupBy(F.year("o_orderdate").cast("long").alias("year"), F.quarter("o_orderdate").cast("long").alias("quarter")).agg(F.count(F.lit(1)).alias("n"))
    return rows.withColumn("place", F.row_number().over(W.orderBy(F.desc("year"), F.desc("quarter"))))


@query("primary_files", "SELECT l_orderkey, min(name) AS name FROM (SELECT l_orderkey, '0' || l_linenumber || '-' || l_partkey || CASE WHEN l_linestatus = 'O' THEN '.HTM' ELSE '.xml' END AS name FROM lineitem) WHERE lower(name) LIKE '%.htm' OR lower(name) LIKE '%.html' GROUP BY 1")
def primary_files(t):
    name = F.concat(F.lit("0"), F.col("l_linenumber").cast("string"), F.lit("-"), F.col("l_partkey").cast("string"), F.when(F.col("l_linestatus") == "O", ".HTM").otherwise(".xml"))
    files = t.raw("lineitem").select("l_orderkey", name.alias("name"), F.concat(F.lit("dir/"), name).alias("path"))
    return xbrl.primary_file(files, "l_orderkey", "path").select("l_orderkey", F.element_at(F.split("path", "/"), -1).alias("name"))


@query("statement_files", "SELECT kind, count(*) AS n FROM (SELECT CASE WHEN k IN (0, 1, 2) THEN 'read' ELSE 'left' END AS kind FROM (SELECT l_partkey % 7 AS k FROM lineitem)) GROUP BY 1")
def statement_files(t):
    names = ["a.xbrl", "0101-acbs01-ixbrl.htm", "b.xml", "a-def.xml", "a-pre.xml", "c.htm", "a-lab.xml"]
    kind = F.when(xbrl.is_statement_file(one_of(F.col("l_partkey"), names)), "read").otherwise("left")
    return t.raw("lineitem").groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("merged_metadata", """SELECT c_custkey, '{"a":"' || CASE WHEN c_custkey % 3 = 0 THEN 'x' ELSE 'old' END || '","b":"' || c_mktsegment || '"' || CASE WHEN c_custkey % 3 = 0 THEN ',"c":"new"' ELSE '' END || '}' AS metadata FROM customer""")
def merged_metadata(t):
    old = F.create_map(F.lit("a"), F.lit("old"), F.lit("b"), F.col("c_mktsegment"))
    new = F.when(F.col("c_custkey") % 3 == 0, F.create_map(F.lit("a"), F.lit("x"), F.lit("c"), F.lit("new")))
    return t.raw("customer").select("c_custkey", F.to_json(text.merged_metadata(old, new)).alias("metadata"))


@query("file_digests", "SELECT doc_id, sha256(text) AS sha256, md5(lower(lang) || '|' || source || '|5') AS cache_key FROM documents")
def file_digests(t):
    return t.raw("documents").select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), retrieval.cache_key(F.col("lang"), F.col("source"), F.lit("5")).alias("cache_key"))


@query("unit_vectors", "SELECT vec_id, CAST(i AS INTEGER) AS i, round(e[i + 1] / sqrt(list_dot_product(e, e)), 6) AS x FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), LATERAL (SELECT unnest(range(len(e))) AS i)")
def unit_vectors(t):
    unit = classify.normalised(F.col("embedding").cast("array<double>"))
    return t.raw("embeddings").select("vec_id", F.posexplode(unit).alias("i", "x")).withColumn("x", F.round("x", 6))


@query("next_rows", f"WITH {LINES} SELECT doc_id, line, lead(content) OVER (PARTITION BY doc_id ORDER BY line) AS next FROM lines")
def next_rows(t):
    from pyspark.sql import Window as W

    return lines(t).select("doc_id", "line", F.lead("content").over(W.partitionBy("doc_id").orderBy("line")).alias("next"))


@query("standard_chunks", f"WITH {CHUNKS} SELECT doc_id, chunk_index, length(content) AS char_length, 'fixed' AS method, NULL::INTEGER AS page_number FROM chunks UNION ALL SELECT doc_id, CAST(i AS INTEGER), length(c), 'line', CAST(i // 10 AS INTEGER) FROM (SELECT doc_id, unnest(range(len(l))) AS i, unnest(l) AS c FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))")
def standard_chunks(t):
    fixed = chunks(t).withColumn("method", F.lit("fixed"))
    by_line = lines(t).select("doc_id", F.col("line").alias("chunk_index"), "content", F.lit("line").alias("method"), F.floor(F.col("line") / 10).cast("int").alias("page_number"))
    return text.standard_chunks(by_line, fixed).select("doc_id", "chunk_index", F.length("content").cast("long").alias("char_length"), "method", "page_number")


SPACE = r"[ \t\n\r\f\v\x{1c}-\x{1f}\x{85}\p{Z}]"


def regexes(column: str, rules) -> str:
    for pattern, new in rules:
        column = f"regexp_replace({column}, '{pattern}', '{new}', 'g')"
    return column


#: The same for texts without Japanese signs, and without the look-around that the oracle's engine lacks.
ROWS_SQL = [(rf"({SPACE}|\||^)\d{{1,2}}:{SPACE}*", r"\1"), (rf"\d{{1,2}}:{SPACE}*(\()", r"\1"), (rf"\d{{1,2}}:{SPACE}*([-+]?\d{{1,3}}{SPACE})", r"\1")]
MARKS_SQL = [
    (rf"(?m)^{SPACE}*[-–—]+?{SPACE}*\d+{SPACE}*[-–—]+{SPACE}*$", ""), (rf"(?m)^{SPACE}*\d+{SPACE}*$", ""), (rf"(?:{SPACE}|[.。]){SPACE}*[-–—]{SPACE}*\d+{SPACE}*[-–—]{SPACE}+", " "),
    (rf"{SPACE}+[-–—]{SPACE}*\d{{1,2}}{SPACE}*[-–—]{SPACE}+", " "), (rf"[.。]{SPACE}+[-–—]{SPACE}*\d{{1,2}}{SPACE}*[-–—]{SPACE}+", ". "), (r"\.{4,}", ""),
    (rf"(?m)^{SPACE}*(?:\.|{SPACE}){{10,}}{SPACE}*$", ""), (rf"{SPACE}+(?:\.|{SPACE}){{6,}}{SPACE}+", " "), (rf"{SPACE}+\({SPACE}*", "("), (rf"{SPACE}+\){SPACE}*", ") "), (rf"{SPACE}+", " "),
]
NORMAL_SQL = r"trim(regexp_replace(regexp_replace(regexp_replace(text, '(\d),(\d{3})', '\1\2', 'g'), '(\d),(\d{3})', '\1\2', 'g'), '[ \t\n\r\f\v]+', ' ', 'g'))"


@query("pdf_clean", f"SELECT doc_id, trim({regexes(regexes(NORMAL_SQL, ROWS_SQL), MARKS_SQL)}) AS cleaned FROM documents")
def pdf_clean(t):
    return documents(t).select("doc_id", cleaning.clean_page(F.col("text")).alias("cleaned"))


@query("report_clean", rf"SELECT doc_id, trim({regexes(regexes('text', ROWS_SQL), [(r'(\d),(\d{3})', r'\1\2'), (r'(\d),(\d{3})', r'\1\2'), (r'[ \t\n\r\f\v]+', ' ')])}) AS cleaned FROM documents")
def report_clean(t):
    return documents(t).select("doc_id", cleaning.clean_report(F.col("text")).alias("cleaned"))


@query("ocr_clean")
def ocr_clean(t):
    return documents(t).select("doc_id", cleaning.without_noise(F.col("text")).alias("cleaned"))


PART_SQL = f"""p AS (SELECT *, length(content) AS n, greatest(1, length(content) // 3) AS k, {count_sql('0-9', 'content')} AS dg, {count_sql('.,|△▲%-', 'content')} AS fin, {count_sql('|:()[' + chr(92) + ']', 'content')} AS tab, {count_sql('|', 'content')} AS pipes, {count_sql('|:0-9.,()△▲ ' + chr(9) + '-', 'content')} AS plain, {SECTION_OF} AS sec,
  trim(content, ' ' || chr(9) || chr(10) || chr(13)) AS c, list_filter(list_transform(string_split(content, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13))), lambda x: x <> '') AS ls FROM chunks), m AS (
  SELECT *, length(c) >= 10 AND (dg / n > 0.15 OR fin / n > 0.10 OR (dg + fin) / n > 0.20 OR tab / n > 0.05 OR (dg + fin) / n > 0.15 OR (len(ls) >= 3 AND len(list_filter(ls, lambda x: {count_sql('0-9.,|△▲%-', 'x')} / length(x) > 0.5)) / len(ls) > 0.6)) AS part,
    list_filter(regexp_split_to_array(content, '[ \\t\\n\\r\\f\\v]+'), lambda x: x <> '') AS ws FROM p)"""


@query("quality_reason", f"""WITH {CHUNKS}, {PART_SQL} SELECT doc_id, chunk_index, CASE WHEN n < 50 OR k < 15 THEN 'fragment' WHEN part AND n > 400 AND chunk_index % 2 = 0 THEN 'mostly_numeric_large' WHEN part AND n > 200 AND dg / n > 0.35 THEN 'mostly_numeric_medium' WHEN part AND n BETWEEN 101 AND 200 AND dg / n > 0.5 THEN 'mostly_numeric_small' WHEN part AND n <= 100 AND dg / n > 0.6 THEN 'mostly_numeric_tiny'
  WHEN sec = 'balance_sheet' AND chunk_index % 2 = 0 AND dg / n > 0.25 THEN 'section_specific_numeric' WHEN plain / n > 0.8 THEN 'table_pattern' WHEN len(ws) > 10 AND len(list_distinct(ws)) / len(ws) < 0.3 THEN 'low_information' WHEN regexp_matches(c, '^([|]|[2-9]:)') THEN 'continuation_fragment' WHEN n < 100 THEN 'very_short' ELSE 'passed' END AS reason FROM m""")
def quality_reason(t):
    i = F.col("chunk_index")
    section = F.when(i % 7 == 3, "table_of_contents").when(i % 7 == 5, "balance_sheet").otherwise("x")
    n, content = F.length("content"), F.col("content")
    return chunks(t).select("doc_id", "chunk_index", cleaning.quality_reason(content, F.lit("general"), section, n, text.tokens(content), i % 2 == 0).alias("reason"))


def reasons(t: Tables):
    i = F.col("chunk_index") % 7
    section = F.when(i == 3, "table_of_contents").when(i == 5, "balance_sheet").otherwise("x")
    return chunks(t).select("doc_id", text.removal_reason(F.col("content"), section).alias("reason"))


@query("removal_counts", f"""WITH {CHUNKS}, q AS (SELECT *, {SECTION_OF} AS sec, length(content) AS n, {count_sql('|', 'content')} AS p, ({count_sql('|', 'content')} + {count_sql('0-9', 'content')}) / length(content) AS s, trim(content, ' ' || chr(9) || chr(10) || chr(13)) AS c, list_filter(regexp_split_to_array(trim(lower(content), ' ' || chr(9) || chr(10) || chr(13)), '[ \\t\\n\\r\\f\\v]+'), lambda x: x <> '') AS ws FROM chunks)
SELECT reason, count(*) AS n FROM (SELECT CASE WHEN sec = 'table_of_contents' THEN 'table_of_contents' WHEN n < 100 THEN 'very_short' WHEN n > 200 THEN CASE WHEN s > 0.35 THEN 'mostly_numeric' END WHEN starts_with(c, '|') OR regexp_matches(c, '^[2-7]:') OR (p > 20 AND n < 500) THEN 'continuation_fragments' WHEN len(ws) > 10 AND len(list_distinct(ws)) / len(ws) < 0.3 THEN 'low_information' END AS reason FROM q) WHERE reason IS NOT NULL GROUP BY 1""")
def removal_counts(t):
    return cleaning.removal_counts(reasons(t), "reason")


@query("chunk_distribution", f"WITH {CHUNKS}, r AS (SELECT d.lang, d.source, greatest(1, length(content) // 3) AS k, length(content) >= 50 AS v FROM chunks JOIN documents d USING (doc_id)) SELECT 'lang' AS kind, lang AS value, count(*) AS n, min(k) AS min_tokens, max(k) AS max_tokens, round(avg(k), 4) AS avg_tokens, round(100.0 * count(*) FILTER (WHERE v) / count(*), 4) AS vector_pct FROM r GROUP BY 2 UNION ALL SELECT 'source', source, count(*), min(k), max(k), round(avg(k), 4), round(100.0 * count(*) FILTER (WHERE v) / count(*), 4) FROM r GROUP BY 2")
def chunk_distribution(t):
    rows = chunks(t).join(t.raw("documents").select("doc_id", "lang", "source"), "doc_id")
    return text.distribution(rows, ["lang", "source"], text.tokens(F.col("content")).cast("long"), F.length("content") >= 50)


@query("chunks_bullets")
def chunks_bullets(t):
    return cleaning.chunked(documents(t), "doc_id", "text", cleaning.bullets)


@query("chunks_paragraphs")
def chunks_paragraphs(t):
    return cleaning.chunked(lines(t).select(F.concat_ws(":", "doc_id", "line").alias("paragraph"), "content"), "paragraph", "content", cleaning.paragraphs)


@query("self_repeats")
def self_repeats(t):
    return documents(t).select("doc_id", cleaning.without_self_repeats(F.col("text")).alias("text"))


@query("heading_groups_pdf", f"""WITH {LINES}, g AS (SELECT *, CASE line % 4 WHEN 0 THEN 'no_heading' WHEN 1 THEN 'notes' WHEN 2 THEN 'balance_sheet x' ELSE 'result' END AS h, length(content) AS n, CASE WHEN length(content) > 0 THEN {count_sql('0-9|', 'content')} / length(content) ELSE 0 END AS s, doc_id % 2 * (line % 8) AS sec FROM lines), t AS (
  SELECT doc_id, h, count(*) AS size, avg(n) AS mean, avg(s) AS share, count(DISTINCT sec) AS secs, min(line) AS first FROM g GROUP BY 1, 2), j AS (
  SELECT *, CASE WHEN size = 1 THEN 'keep_all' WHEN size > 2 AND share > 0.2 AND mean > 300 THEN 'remove_all' WHEN size > 2 AND mean < 200 THEN 'keep_most_informative' WHEN secs > 1 THEN 'keep_all' WHEN share > 0.15 THEN 'remove_all' ELSE 'keep_longest' END AS decision FROM t), p AS (
  SELECT g.*, j.decision, j.first, CASE WHEN j.decision = 'keep_most_informative' AND length(trim(content, ' ' || chr(9) || chr(13))) >= 10 AND ({count_sql('0-9', 'content')} / n > 0.15 OR {count_sql('.,|△▲%-', 'content')} / n > 0.1 OR ({count_sql('0-9', 'content')} + {count_sql('.,|△▲%-', 'content')}) / n > 0.15 OR {count_sql('|:()[' + chr(92) + ']', 'content')} / n > 0.05) THEN 0 ELSE n END AS worth FROM g JOIN j USING (doc_id, h) WHERE j.decision <> 'remove_all'), b AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, h ORDER BY worth DESC, line) AS best FROM p)
SELECT doc_id, line, decision, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY first, line) - 1 AS INTEGER) AS new_index FROM b WHERE decision = 'keep_all' OR best = 1""")
def heading_groups_pdf(t):
    heading = F.concat(one_of(F.col("line"), ["", "1. Notes", "貸借対照表 X (3)", "  Result   12"]))
    rows = lines(t).withColumns({"heading": heading, "page": F.lit(1), "section": F.col("doc_id") % 2 * (F.col("line") % 8)})
    out = cleaning.heading_decisions(rows, "doc_id", "heading", "content", "page", "section", "line")
    return out.select("doc_id", "line", "decision", "new_index")


def said_sql(r: finance.Ratio) -> str:
    """The text of a ratio's band, numbers as both engines print them."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    shown = lambda x: f"replace(replace({quoted(x)}, '{{}}', printf('{r.shown}', value * {float(r.times)!r}::DOUBLE)), '{{days}}', printf('%.0f', 365 / value))"
    bands = " ".join(f"WHEN {'TRUE' if limit is None else f'value < {limit}'} THEN {shown(x)}" for limit, x in r.text)
    return f"SELECT id, fiscal_year, metric AS name, CASE WHEN abs(value) > 1e12 THEN regexp_replace(CASE {bands} END, '-?[0-9.]+', '#', 'g') ELSE CASE {bands} END END AS interpretation FROM m WHERE metric = {quoted(r.name)}"


@query("metrics_interpretation", financial.METRICS + " UNION ALL ".join(map(said_sql, finance.RATIOS)))
def metrics_interpretation(t):
    """Numbers beyond what a double tells apart are shown as `#`, as engines print their last digits differently."""
    rows = finance.analyse(financial.records(t)).select("id", "fiscal_year", F.explode("metrics").alias("m"))
    text = F.when(F.abs("m.value") > 1e12, F.regexp_replace("m.interpretation", "-?[0-9.]+", "#")).otherwise(F.col("m.interpretation"))
    return rows.select("id", "fiscal_year", "m.name", text.alias("interpretation"))


@query("metrics_risks", financial.METRICS + "SELECT r.id, r.fiscal_year, coalesce(n, 0) AS n_risks FROM rec r LEFT JOIN (SELECT id, fiscal_year, least(5, count(*)) AS n FROM m WHERE risk_level IN ('HIGH', 'VERY_HIGH') GROUP BY 1, 2) USING (id, fiscal_year)")
def metrics_risks(t):
    return finance.analyse(financial.records(t)).select("id", "fiscal_year", F.size("risks").cast("long").alias("n_risks"))


@query("unseen_labels", LABELLED + "SELECT l.category, count(*) AS n FROM labelled l WHERE l.p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50 AND l_returnflag = 'R') GROUP BY 1")
def unseen_labels(t):
    seen = t.raw("lineitem").where("l_quantity = 50 and l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey")).distinct()
    return labelled(t).join(seen, "p_partkey", "left_anti").groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query("centroid_shares", "WITH c AS (SELECT label, count(*) AS n, count(*) FILTER (WHERE label = 0) AS o FROM embeddings GROUP BY 1) SELECT label, n, round(100.0 * n / (SELECT sum(n) FROM c), 4) AS pct FROM c")
def centroid_shares(t):
    from pyspark.sql import Window as W

    rows = t.raw("embeddings").groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return rows.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(W.partitionBy()), 4))


def listed(t: Tables, cells, *, detail=None):
    """Orders as the rows of HTML tables, one for each customer."""
    row = lambda cs: F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cs], F.lit("</tr>"))
    rows = t.raw("orders").select("o_custkey", "o_orderkey", F.concat(row(cells), row([detail]) if detail is not None else F.lit("")).alias("tr"))
    pages = rows.groupBy("o_custkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("o_orderkey", "tr"))), lambda x: x["tr"]), "").alias("trs"))
    return html.table_rows(pages.select("o_custkey", F.concat(F.lit("<html><table>"), "trs", F.lit("</table></html>")).alias("html")), "o_custkey", "html")


def minute(key, bad):
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.when(key % 7 == 0, bad).otherwise(F.concat(two(F.floor(key % 1440 / 60)), F.lit(":"), two(key % 60)))


TIME_SQL = "CASE WHEN o_orderkey % 7 = 0 THEN '00:00' ELSE lpad(CAST((o_orderkey % 1440) // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') END"


def listing(t: Tables):
    key = F.col("o_orderkey")
    cells = [minute(key, "25:99"), F.col("o_custkey").cast("string"), F.concat(F.lit("&nbsp;"), F.col("o_orderstatus"), F.lit(" &amp; Co ")), F.concat_ws(" ", F.col("o_orderpriority"), key.cast("string")), F.concat(F.lit("<a href='x"), key.cast("string"), F.lit(".zip'>X</a>"))]
    return html.listing(listed(t, cells), "o_custkey", F.lit("2024-02-14").cast("date"))


@query("html_listing", f"SELECT o_custkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INTEGER) AS row_index, '2024-02-14' AS day, {TIME_SQL} AS time, CAST(o_custkey AS VARCHAR) AS company_code, o_orderstatus || ' & Co' AS company_name, o_orderpriority || ' ' || o_orderkey AS title, 'x' || o_orderkey || '.zip' AS xbrl_url FROM orders")
def html_listing(t):
    return listing(t).select("o_custkey", "row_index", F.col("disclosure_date").cast("string").alias("day"), "time", "company_code", "company_name", "title", "xbrl_url")


@query("html_search", f"SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day, {TIME_SQL} AS time, o_orderstatus AS company_name, 'd' || o_orderkey AS detail FROM orders WHERE o_orderkey % 11 <> 0")
def html_search(t):
    key = F.col("o_orderkey")
    stamp = F.concat(F.when(key % 11 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy/MM/dd")), F.lit(" "), minute(key, "late"))
    rows = listed(t, [stamp, F.col("o_custkey").cast("string"), F.col("o_orderstatus"), F.col("o_orderpriority")], detail=F.concat(F.lit("d"), key.cast("string")))
    return html.search_rows(rows, "o_custkey").select("o_custkey", F.col("disclosure_date").cast("string").alias("day"), "time", "company_name", "detail")


@query("title_hours", f"SELECT time, o_orderpriority || ' ' || o_orderkey AS title FROM (SELECT *, {TIME_SQL} AS time FROM orders) WHERE time >= '09:00' AND time <= '15:00'")
def title_hours(t):
    return html.titles(listing(t), 9, 15)


@query("time_window", f"SELECT time, count(*) AS n FROM (SELECT {TIME_SQL} AS time FROM orders) WHERE time BETWEEN '08:30' AND '17:05' GROUP BY 1")
def time_window(t):
    return html.between_times(listing(t), "08:30", "17:05").groupBy("time").agg(F.count(F.lit(1)).alias("n"))


@query("listing_pages", "WITH f AS (SELECT DISTINCT l_suppkey AS k, l_partkey % 5 AS page FROM lineitem WHERE l_quantity = 50), s AS (SELECT s_suppkey AS k, unnest(range(5)) AS page FROM supplier) SELECT s.k, s.page FROM s WHERE NOT EXISTS (SELECT 1 FROM s x WHERE x.k = s.k AND x.page <= s.page AND NOT EXISTS (SELECT 1 FROM f WHERE f.k = x.k AND f.page = x.page))")
def listing_pages(t):
    pages = t.raw("supplier").select(F.col("s_suppkey").alias("k"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(4).cast("long"))).alias("page"))
    rows = t.raw("lineitem").where("l_quantity = 50").select(F.col("l_suppkey").alias("k"), (F.col("l_partkey") % 5).alias("page"))
    return html.before_first_empty(pages, rows, "k", "page").select("k", "page")


@query("instance_facts", "SELECT l_orderkey, 'p:c' || l_linenumber AS name, 'CurrentYearDuration' AS context, CASE WHEN l_linestatus = 'O' THEN 'JPY' ELSE '' END AS unit, '6' AS scale, CASE WHEN l_returnflag = 'R' THEN '-' END AS sign, CAST(l_partkey AS VARCHAR) || ' & ' || l_suppkey AS text FROM lineitem UNION ALL SELECT l_orderkey, 'p:whole', 'c', '', '0', NULL, CAST(count(*) AS VARCHAR) || ' in all' FROM lineitem GROUP BY 1")
def instance_facts(t):
    fact = F.concat(F.lit("<ix:nonFraction name='p:c"), F.col("l_linenumber").cast("string"), F.lit("' contextRef='CurrentYearDuration' scale='6'"), F.when(F.col("l_linestatus") == "O", " unitRef='JPY'").otherwise(""), F.when(F.col("l_returnflag") == "R", " sign='-'").otherwise(""), F.lit("><b>"), F.col("l_partkey").cast("string"), F.lit("</b> &amp; "), F.col("l_suppkey").cast("string"), F.lit("</ix:nonFraction>"))
    whole = lambda n: F.concat(F.lit("<ix:nonNumeric name='p:whole' contextref='c'>"), n.cast("string"), F.lit("<ix:nonNumeric name='p:inner'></ix:nonNumeric> in all</ix:nonNumeric>"))
    pages = t.raw("lineitem").groupBy("l_orderkey").agg(F.array_join(F.collect_list(fact), "").alias("facts"), F.count(F.lit(1)).alias("n"))
    return packages.instance_facts(pages.select("l_orderkey", F.concat("facts", whole(F.col("n"))).alias("html")), "l_orderkey", "html").drop("position")


@query("embedded_documents", "WITH c AS (SELECT doc_id, substring(text, CAST(i AS INTEGER) * 4000 + 1, 4000) AS x FROM documents, LATERAL (SELECT unnest(range((length(text) + 3999) // 4000)) AS i) WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)) SELECT doc_id, round(avg(length(x)), 6) AS size, round(avg(length(x) - length(replace(x, 'e', ''))), 6) AS es FROM c GROUP BY 1")
def embedded_documents(t):
    failed = t.raw("labels").where("toxic = 1").select("doc_id")
    out = retrieval.embedded(documents(t), "doc_id", "text", lambda texts: [(len(x), x.count("e")) for x in texts], failed)
    return out.select("doc_id", F.round(F.col("embedding")[0], 6).alias("size"), F.round(F.col("embedding")[1], 6).alias("es"))


@query("markdown_tables", r"SELECT o_custkey, '| o_orderkey | o_orderstatus | o_orderpriority |' || chr(10) || '|---|---|---|' || chr(10) || string_agg('| ' || o_orderkey || ' | ' || o_orderstatus || ' | ' || o_orderpriority || ' |', chr(10) ORDER BY o_orderkey) AS markdown FROM orders GROUP BY 1")
def markdown_tables(t):
    return tables.markdown(t.raw("orders"), "o_custkey", ["o_orderkey", "o_orderstatus", "o_orderpriority"], "o_orderkey")


@query("value_ranges", "WITH c AS (SELECT o_orderpriority AS k, o_custkey AS v, count(*) AS n FROM orders GROUP BY 1, 2), p AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY k ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 200 AS r FROM c) SELECT k AS o_orderpriority, min(v) AS first, max(v) AS last, CAST(sum(n) AS BIGINT) AS n FROM p GROUP BY k, r")
def value_ranges(t):
    return views.value_ranges(t.raw("orders"), "o_orderpriority", "o_custkey", 200)
