"""Queries over filings, facts and disclosures, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import ingest, views, xbrl
from ledgerloom.operators.stored import MaintainedView, StoredTable
from ledgerloom.plans.bind import BIND, CONTEXTS, Tables
from ledgerloom.shared import drop_folder, forget, new_folder, written

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    """Register a function of Tables as a query, with SQL for its oracle after the bindings."""

    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = f"WITH {BIND}\n{sql}" if not sql.lstrip().startswith(",") else f"WITH {BIND}{sql}"
        return f

    return add


FLAT = """, flat AS (
  SELECT f.*, g.company_id, c.ticker, c.company_name_english, s.filing_id, g.disclosure_id, g.period_end, g.fiscal_year, g.fiscal_quarter, g.amendment_flag,
    coalesce(n.std_label_en, n.local_name) AS canonical_name, coalesce(u.unit_code, 'JPY_Mil') AS unit_code, coalesce(u.scale, 6) AS scale, coalesce(u.currency, 'JPY') AS currency,
    coalesce(x.period_base, 'Current') AS period_base, coalesce(x.period_type, 'Duration') AS period_type, x.fiscal_span, x.consolidated, x.forecast_variant,
    CASE WHEN s.statement_role_en = 'Summary' THEN 'Summary' ELSE 'Attachment' END AS section_type,
    CAST(d.disclosure_date || ' ' || d.time || ':00' AS TIMESTAMP) AS filing_timestamp
  FROM facts f JOIN sections s ON f.section_id = s.id JOIN filings g ON s.filing_id = g.id JOIN disclosures d ON g.disclosure_id = d.id JOIN companies c ON g.company_id = c.id
  LEFT JOIN units u ON f.unit_id = u.id LEFT JOIN concepts n ON f.concept_id = n.id LEFT JOIN contexts x ON f.context_id = x.context_id)
"""
COLUMNS = "company_id ticker company_name_english filing_id disclosure_id section_id concept_id context_id value period_end fiscal_year fiscal_quarter amendment_flag canonical_name unit_code scale currency period_base period_type fiscal_span consolidated forecast_variant section_type filing_timestamp".split()
#: Dates and decimals leave the engine as text and doubles, which both engines write alike.
SHOWN = {"value": "double", "period_end": "string", "filing_timestamp": "string"}
PLAIN = ", ".join(f"CAST({c} AS {'DOUBLE' if SHOWN[c] == 'double' else 'VARCHAR'}) AS {c}" if c in SHOWN else c for c in COLUMNS)
TIES = "l_orderkey l_linenumber l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_shipdate".split()


def shown(df):
    return df.select(*[F.col(c).cast(SHOWN[c]).alias(c) if c in SHOWN else c for c in COLUMNS])


def placed(t: Tables):
    return views.placed_facts(t.facts(), t.sections(), t.filings(), t.disclosures(), t.companies())


def described(t: Tables, rows):
    return views.described(rows, t.units(), t.concepts(), t.contexts())


def flat(t: Tables):
    return described(t, placed(t))


@query("facts_flat", FLAT + f"SELECT {PLAIN} FROM flat")
def facts_flat(t):
    return shown(flat(t))


@query("facts_cleaned", FLAT + f"""SELECT {PLAIN} FROM (
  SELECT *, row_number() OVER (PARTITION BY company_id, period_end, concept_id, context_id ORDER BY amendment_flag DESC NULLS FIRST,
    CASE section_type WHEN 'Attachment' THEN 2 ELSE 1 END DESC, filing_timestamp DESC NULLS FIRST, {', '.join(f'{c} DESC' for c in TIES)}) AS rn
  FROM flat) WHERE rn = 1""")
def facts_cleaned(t):
    """Names and dimensions are joined to the winners, so that they are not shuffled."""
    return shown(described(t, views.facts_cleaned(placed(t), F.col("fact_order"))))


@query("company_theta_match", """SELECT d.id, d.company_code, c.id AS company_id FROM disclosures d LEFT JOIN companies c
  ON d.company_code = c.ticker OR (length(d.company_code) = 5 AND left(d.company_code, 4) = c.ticker)""")
def company_theta_match(t):
    return views.company_match(t.disclosures(), t.companies()).select("id", "company_code", "company_id")


@query("unprocessed_filings", """SELECT d.id, d.title FROM disclosures d WHERE d.has_xbrl AND NOT EXISTS (SELECT 1 FROM sections s WHERE s.filing_id = d.id)""")
def unprocessed_filings(t):
    return t.disclosures().where("has_xbrl").join(t.sections().select(F.col("filing_id").alias("id")), "id", "left_anti").select("id", "title")


@query("labelled_disclosures", """SELECT count(*) AS n FROM disclosures WHERE id IN (SELECT filing_id FROM sections WHERE statement_role_en = 'Summary')""")
def labelled_disclosures(t):
    told = t.sections().where("statement_role_en = 'Summary'").select(F.col("filing_id").alias("id"))
    return t.disclosures().join(told, "id", "left_semi").agg(F.count(F.lit(1)).alias("n"))


@query("amendment_parent", """, m AS (
  SELECT f.*, coalesce(amendment_flag, FALSE) OR EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = f.disclosure_id AND o.o_orderpriority = '1-URGENT' AND o.o_orderkey % 2 = 0) AS corr FROM filings f)
SELECT id, company_id, corr AS amendment_flag, CASE WHEN corr THEN min(CASE WHEN NOT corr THEN id END) OVER (PARTITION BY company_id, period_start, period_end, has_consolidated, accounting_standard) END AS parent_filing_id FROM m""")
def amendment_parent(t):
    corrected = t.raw("orders").where("o_orderpriority = '1-URGENT' and o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("disclosure_id"))
    return views.amendments(t.filings(), corrected).select("id", "company_id", "amendment_flag", "parent_filing_id")


@query("latest_disclosures_topn", """SELECT id, CAST(disclosure_date AS VARCHAR) AS disclosure_date, time, title FROM disclosures ORDER BY disclosures.disclosure_date DESC NULLS FIRST, time DESC NULLS FIRST, id LIMIT 100""")
def latest_disclosures_topn(t):
    return t.disclosures().orderBy(F.col("disclosure_date").desc_nulls_first(), F.col("time").desc_nulls_first(), "id").limit(100).select("id", F.col("disclosure_date").cast("string").alias("disclosure_date"), "time", "title")


@query("concept_fallback", """, q AS (
  SELECT DISTINCT l_partkey % 50 AS k, l_linenumber % 4 AS v FROM lineitem), n AS (
  SELECT id, replace(taxonomy_prefix, '_cor', CASE WHEN id % 2 = 0 THEN '_cor' ELSE '' END) AS taxonomy_prefix, local_name FROM concepts), w AS (
  SELECT k, v, CASE v WHEN 0 THEN 'jpigp_cor' WHEN 1 THEN 'jppfs_cor' WHEN 2 THEN 'jpdei' ELSE 'unknown' END AS p, c.local_name FROM q JOIN concepts c ON c.id = k)
SELECT k, v, CASE WHEN v = 3 THEN local_name ELSE p || ':' || local_name END AS qname, concept_id FROM (
  SELECT w.k, w.v, w.p, w.local_name, n.id AS concept_id, row_number() OVER (PARTITION BY w.k, w.v ORDER BY t.o, n.id) AS rn
  FROM w, LATERAL (SELECT * FROM (VALUES (0, w.p), (1, 'jppfs'), (2, 'jpcrp'), (3, 'jpdei'), (4, CASE WHEN w.p LIKE '%\\_cor' ESCAPE '\\' THEN left(w.p, length(w.p) - 4) END)) z(o, prefix)) t
  JOIN n ON n.taxonomy_prefix = t.prefix AND n.local_name = w.local_name) WHERE rn = 1""")
def concept_fallback(t):
    names = t.concepts()
    known = names.withColumn("taxonomy_prefix", F.when(F.col("id") % 2 == 0, F.col("taxonomy_prefix")).otherwise(F.replace("taxonomy_prefix", F.lit("_cor"), F.lit(""))))
    keys = t.raw("lineitem").select((F.col("l_partkey") % 50).alias("k"), (F.col("l_linenumber") % 4).alias("v")).distinct()
    prefix = F.when(F.col("v") == 0, "jpigp_cor").when(F.col("v") == 1, "jppfs_cor").when(F.col("v") == 2, "jpdei")
    facts = keys.join(names.select(F.col("id").alias("k"), F.col("local_name").alias("name")), "k")
    facts = facts.select("k", "v", F.when(F.col("v") == 3, F.col("name")).otherwise(F.concat_ws(":", prefix, "name")).alias("qname"))
    return xbrl.concept_ids(facts, known, "qname").select("k", "v", "qname", "concept_id")


@query("context_parse", f"""SELECT l_linenumber, l_context AS context_id,
  CASE WHEN l_context LIKE '%Instant%' THEN 'Instant' ELSE 'Duration' END AS period_type,
  regexp_extract(replace(replace(split_part(l_context, '_', 1), 'Instant', ''), 'Duration', ''), '[A-Z][a-z]*') AS period_base,
  CASE WHEN split_part(l_context, '_', 1) LIKE '%YTD%' THEN 0 WHEN split_part(l_context, '_', 1) LIKE '%Year%' THEN 99 WHEN split_part(l_context, '_', 1) LIKE '%Q3%' THEN 3 END AS fiscal_span,
  CASE WHEN l_context LIKE '%NonConsolidated%' THEN FALSE WHEN l_context LIKE '%Consolidated%' THEN TRUE END AS consolidated,
  CASE WHEN l_context LIKE '%ResultMember%' THEN 'Result' WHEN l_context LIKE '%ForecastMember%' THEN 'Forecast' WHEN l_context LIKE '%UpperMember%' THEN 'Upper' END AS forecast_variant, n
FROM (SELECT l_linenumber, list_extract([{', '.join(f"'{c}'" for c in CONTEXTS)}], l_linenumber) AS l_context, count(*) AS n FROM lineitem GROUP BY 1) WHERE l_context NOT LIKE '%Prior%'""")
def context_parse(t):
    counts = t.raw("lineitem").groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n"))
    out = counts.withColumn("context_id", F.element_at(F.array(*map(F.lit, CONTEXTS)), F.col("l_linenumber"))).where(xbrl.is_current(F.col("context_id")))
    return out.withColumns(xbrl.context_parts(F.col("context_id")))


NAMES = ["0105010-qcci13-tse-qcediffr-{}-ixbrl.htm", "0101010-acbs01-tse-{}-ixbrl.htm", "0102010-snpl05-tse-{}-ixbrl.htm", "tse-rvfc-{}-ixbrl.htm", "tse-rvdf-{}-ixbrl.htm", "Summary/tse-{}-ixbrl.htm", "0103010-bs05-tse-{}-ixbrl.htm", "attachment/qualitative{}.htm"]


@query("section_decode", f"""SELECT p.p_partkey, p.path, r.role, r.role_en, r.period_prefix, r.consolidated, r.layout_code
FROM (SELECT p_partkey, replace(list_extract([{', '.join(f"'{n}'" for n in NAMES)}], p_partkey % 8 + 1), '{{}}', CAST(p_partkey AS VARCHAR)) AS path, p_partkey % 8 AS k FROM part) p
JOIN (VALUES (0, 'ComprehensiveIncome', 'Comprehensive income', 'q', TRUE, 13), (1, 'BalanceSheet', 'Balance sheet', 'a', TRUE, 1), (2, 'ProfitLoss', 'Profit-and-loss', 's', FALSE, 5),
  (3, 'EarningsForecastRevision', 'Earnings forecast revision', NULL, NULL, NULL), (4, 'DividendForecastRevision', 'Dividend forecast revision', NULL, NULL, NULL), (5, 'Summary', 'Summary', NULL, NULL, NULL), (7, 'Narrative', 'Narrative', NULL, NULL, NULL))
  r(k, role, role_en, period_prefix, consolidated, layout_code) USING (k)""")
def section_decode(t):
    key = F.col("p_partkey")
    path = F.replace(F.element_at(F.array(*map(F.lit, NAMES)), (key % 8 + 1).cast("int")), F.lit("{}"), key.cast("string"))
    return xbrl.sections(t.raw("part").select("p_partkey", path.alias("path")), "path").select("p_partkey", "path", "role", "role_en", "period_prefix", "consolidated", "layout_code")


@query("unit_map", """SELECT o_orderkey, u, s, CASE WHEN u LIKE '%JPY%' THEN CASE s WHEN 6 THEN 1 WHEN 3 THEN 3 ELSE 2 END WHEN u = 'USD' THEN 4 WHEN u = 'Shares' THEN 5 WHEN u = 'Pure' THEN 6 WHEN s = 6 THEN 1 WHEN s = 3 THEN 3 ELSE 2 END AS unit_id
FROM (SELECT o_orderkey, list_extract(['JPY', 'USD', 'Shares', 'Pure', '', 'xJPYx'], o_orderkey % 6 + 1) AS u, CAST(CASE (o_orderkey // 6) % 3 WHEN 0 THEN 6 WHEN 1 THEN 3 ELSE 0 END AS INTEGER) AS s FROM orders)""")
def unit_map(t):
    key = F.col("o_orderkey")
    rows = t.raw("orders").select(key, F.element_at(F.array(*map(F.lit, ["JPY", "USD", "Shares", "Pure", "", "xJPYx"])), (key % 6 + 1).cast("int")).alias("u"), F.element_at(F.array(*map(F.lit, [6, 3, 0])), (F.floor(key / 6) % 3 + 1).cast("int")).alias("s"))
    return rows.withColumn("unit_id", xbrl.unit_id(F.col("u"), F.col("s")))


@query("fiscal_quarter_map", """SELECT q, CASE WHEN upper(q) IN ('Q1', 'FIRSTQUARTER') THEN 1 WHEN upper(q) IN ('Q2', 'SECONDQUARTER', 'HALFYEAR') THEN 2 WHEN upper(q) IN ('Q3', 'THIRDQUARTER') THEN 3 ELSE 99 END AS fiscal_quarter, count(*) AS n
FROM (SELECT CASE o_orderkey % 7 WHEN 0 THEN 'Q1' WHEN 1 THEN 'FirstQuarter' WHEN 2 THEN 'HalfYear' WHEN 3 THEN 'q3' WHEN 4 THEN 'ThirdQuarter' WHEN 5 THEN 'FY' END AS q FROM orders) GROUP BY q""")
def fiscal_quarter_map(t):
    q = F.element_at(F.array(*[F.lit(x) for x in ("Q1", "FirstQuarter", "HalfYear", "q3", "ThirdQuarter", "FY", None)]), (F.col("o_orderkey") % 7 + 1).cast("int"))
    return t.raw("orders").select(q.alias("q")).groupBy("q").agg(F.count(F.lit(1)).alias("n")).withColumn("fiscal_quarter", xbrl.fiscal_quarter(F.col("q")))


@query("numeric_coerce", """SELECT o_orderkey, raw, sign, CASE WHEN v IS NULL THEN NULL WHEN sign = '-' OR raw LIKE '%△%' THEN -v ELSE v END AS value FROM (
  SELECT *, CASE WHEN replace(replace(trim(raw), ',', ''), '△', '') IN ('', '－', '―') THEN NULL ELSE TRY_CAST(replace(replace(trim(raw), ',', ''), '△', '') AS DOUBLE) END AS v FROM (
  SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN '1,' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') WHEN 1 THEN '△' || CAST(o_orderkey AS VARCHAR) WHEN 2 THEN ' ' || CAST(o_orderkey AS VARCHAR) || '.5 ' WHEN 3 THEN '－' WHEN 4 THEN 'abc' ELSE '' END AS raw,
    CASE WHEN o_orderkey % 4 = 1 THEN '-' END AS sign FROM orders))""")
def numeric_coerce(t):
    key, text = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    raw = F.when(key % 6 == 0, F.concat(F.lit("1,"), F.lpad((key % 1000).cast("string"), 3, "0"))).when(key % 6 == 1, F.concat(F.lit("△"), text)).when(key % 6 == 2, F.concat(F.lit(" "), text, F.lit(".5 "))).when(key % 6 == 3, "－").when(key % 6 == 4, "abc").otherwise("")
    rows = t.raw("orders").select(key, raw.alias("raw"), F.when(key % 4 == 1, "-").alias("sign"))
    return rows.withColumn("value", xbrl.number(F.col("raw"), F.col("sign")))


@query("path_derive", r"""SELECT id, 'base/' || strftime(disclosure_date, '%Y-%m-%d') || '/' || replace(time, ':', '-') || '_' || company_code || '_' ||
  left(regexp_replace(regexp_replace(regexp_replace(title || ' <a:b>', '[<>:"/\\|?*]', '_', 'g'), '_+', '_', 'g'), '^[_ ]+|[_ ]+$', '', 'g'), 200) || '.zip' AS path FROM disclosures""")
def path_derive(t):
    return t.disclosures().select("id", xbrl.file_path("base", F.col("disclosure_date"), F.col("time"), F.col("company_code"), F.concat("title", F.lit(" <a:b>")), "zip").alias("path"))


@query("era_period", """SELECT o_orderkey, title, CASE o_orderkey % 4 WHEN 0 THEN 2000 + o_orderkey % 30 WHEN 1 THEN o_orderkey % 9 + 2018 WHEN 2 THEN o_orderkey % 31 + 1988 END AS fiscal_year,
  CASE o_orderkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 2 WHEN 3 THEN 3 ELSE 4 END AS quarter, o_orderkey % 3 = 0 AS is_correction FROM (
  SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(2000 + o_orderkey % 30 AS VARCHAR) || '年' WHEN 1 THEN '令和' || CAST(o_orderkey % 9 AS VARCHAR) || '年' WHEN 2 THEN '平成' || CAST(o_orderkey % 31 AS VARCHAR) || '年' ELSE '' END ||
    CASE o_orderkey % 5 WHEN 0 THEN '第１四半期' WHEN 1 THEN '第2四半期' WHEN 2 THEN '中間期' WHEN 3 THEN '第3四半期' ELSE '通期' END || CASE WHEN o_orderkey % 3 = 0 THEN '（訂正）' ELSE '' END AS title FROM orders)""")
def era_period(t):
    key = F.col("o_orderkey")
    year = F.when(key % 4 == 0, F.concat((key % 30 + 2000).cast("string"), F.lit("年"))).when(key % 4 == 1, F.concat(F.lit("令和"), (key % 9).cast("string"), F.lit("年"))).when(key % 4 == 2, F.concat(F.lit("平成"), (key % 31).cast("string"), F.lit("年"))).otherwise("")
    part = F.element_at(F.array(*map(F.lit, ["第１四半期", "第2四半期", "中間期", "第3四半期", "通期"])), (key % 5 + 1).cast("int"))
    title = F.concat(year, part, F.when(key % 3 == 0, "（訂正）").otherwise(""))
    rows = t.raw("orders").select(key, title.alias("title"))
    return rows.select("o_orderkey", "title", xbrl.era_year(F.col("title")).cast("long").alias("fiscal_year"), xbrl.title_quarter(F.col("title")).alias("quarter"), xbrl.is_correction(F.col("title")).alias("is_correction"))


OLD = "o_orderkey % 2 = 0"
KEY = "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS k, CAST(o_orderdate AS DATE) AS d, o_orderpriority AS p, o_orderkey AS id"


def arrivals(t: Tables):
    rows = t.raw("orders").select(F.when(F.col("o_orderkey") % 11 != 0, F.col("o_custkey")).alias("k"), F.to_date("o_orderdate").alias("d"), F.col("o_orderpriority").alias("p"), F.col("o_orderkey").alias("id"))
    return rows.where("id % 2 = 0"), rows.where("id % 2 <> 0")


@query("insert_absent", f""", a AS (SELECT {KEY} FROM orders WHERE {OLD}), b AS (SELECT {KEY} FROM orders WHERE NOT ({OLD}))
SELECT k, p, id FROM (SELECT *, row_number() OVER (PARTITION BY k, p ORDER BY id) AS rn FROM b) b WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM a WHERE a.k IS NOT DISTINCT FROM b.k AND a.p = b.p)""")
def insert_absent(t):
    old, new = arrivals(t)
    return ingest.insert_absent(old, new, ["k", "p"], [F.col("id")]).select("k", "p", "id")


@query("insert_ignore_nulls", f""", a AS (SELECT {KEY} FROM orders WHERE {OLD}), b AS (SELECT {KEY} FROM orders WHERE NOT ({OLD}))
SELECT k, p, id FROM (SELECT *, row_number() OVER (PARTITION BY k, p ORDER BY id) AS rn FROM b) b WHERE k IS NULL OR (rn = 1 AND NOT EXISTS (SELECT 1 FROM a WHERE a.k = b.k AND a.p = b.p))""")
def insert_ignore_nulls(t):
    old, new = arrivals(t)
    return ingest.insert_ignoring_conflicts(old, new, ["k", "p"], [F.col("id")]).select("k", "p", "id")


@query("upsert", f""", a AS (SELECT o_custkey AS k, max(o_orderkey) AS id FROM orders WHERE {OLD} GROUP BY 1), b AS (SELECT o_custkey AS k, o_orderkey AS id FROM orders WHERE NOT ({OLD}))
SELECT k, id FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT k, max(id) FROM b GROUP BY 1""")
def upsert(t):
    rows = t.raw("orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("id"))
    old = rows.where("id % 2 = 0").groupBy("k").agg(F.max("id").alias("id"))
    return ingest.upsert(old, rows.where("id % 2 <> 0"), ["k"], [F.desc("id")])


@query("upsert_partitions", f""", a AS (SELECT o_custkey AS k, max(o_orderkey) AS id FROM orders WHERE {OLD} GROUP BY 1), b AS (SELECT o_custkey AS k, o_orderkey AS id FROM orders WHERE NOT ({OLD}))
SELECT k, id, CAST(NULL AS VARCHAR) AS updated_at FROM a WHERE k NOT IN (SELECT k FROM b) UNION ALL SELECT k, max(id), '2024-05-01 00:00:00' FROM b GROUP BY 1""")
def upsert_partitions(t):
    rows = t.raw("orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("id"))
    old = rows.where("id % 2 = 0").groupBy("k").agg(F.max("id").alias("id")).withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
    table = StoredTable.create(old, new_folder(rows.sparkSession, "orders"), ["k"], parts=16)
    table.upsert(rows.where("id % 2 <> 0"), [F.desc("id")], at=F.lit("2024-05-01 00:00:00").cast("timestamp_ntz"))
    return table.read().withColumn("updated_at", F.col("updated_at").cast("string"))


@query("delete_partitions", """SELECT o_orderkey AS id, o_custkey AS k FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def delete_partitions(t):
    table = StoredTable.create(t.raw("orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("k")), new_folder(t.raw("orders").sparkSession, "orders"), ["id"], parts=16)
    table.delete(t.raw("lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id")))
    return table.read()


@query("facts_view_batches", FLAT + f""", batched AS (SELECT * REPLACE (CASE WHEN l_orderkey % 5 <> 0 AND l_orderkey % 11 < 3 THEN 2 * value ELSE value END AS value) FROM flat WHERE l_orderkey % 5 = 0 OR l_orderkey % 7 NOT BETWEEN 1 AND 3)
SELECT {PLAIN} FROM (
  SELECT *, row_number() OVER (PARTITION BY company_id, period_end, concept_id, context_id ORDER BY amendment_flag DESC NULLS FIRST,
    CASE section_type WHEN 'Attachment' THEN 2 ELSE 1 END DESC, filing_timestamp DESC NULLS FIRST, {', '.join(f'{c} DESC' for c in TIES)}) AS rn
  FROM batched) WHERE rn = 1""")
def facts_view_batches(t):
    """The view of facts by precedence after three batches that add, change and delete facts, kept up batch by batch.

    Facts are stored without names and dimensions, which come to the view in the end, and older versions go batch by batch.
    """
    rows, last = placed(t), F.col("fact_order")
    facts = written(rows.select(*[c for c in COLUMNS if c in rows.columns], "unit_id", "fact_order"), "facts")
    spark, key = facts.sparkSession, F.col("fact_order.l_orderkey")
    base = StoredTable.create(facts.where(key % 5 != 0), new_folder(spark, "facts"), ["fact_order"], by=views.STATED, parts=16, spread=1)
    view = MaintainedView.create(base, new_folder(spark, "view"), views.precedence(last))
    stays = (key % 5 != 0) & ~(key % 7).between(1, 3)
    for batch in range(3):
        new = facts.where(key % 15 == 5 * batch)
        changed = facts.where(stays & (key % 11 == batch)).withColumn("value", (2 * F.col("value")).cast(facts.schema["value"].dataType))
        gone = facts.where((key % 5 != 0) & (key % 7 == batch + 1))
        view.apply(new.unionByName(changed), gone, [last])
        base.vacuum()
        view.view.vacuum()
    forget(facts)
    drop_folder(spark, base.folder)
    return shown(described(t, view.view.read()))


@query("has_xbrl_update", """SELECT CAST(count(*) FILTER (WHERE has_xbrl <> there) AS BIGINT) AS updated, CAST(count(*) FILTER (WHERE has_xbrl = there) AS BIGINT) AS unchanged FROM (SELECT has_xbrl, id IN (SELECT l_orderkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01') AS there FROM disclosures)""")
def has_xbrl_update(t):
    files = t.raw("lineitem").where(F.col("l_shipdate") < "1996-01-01").select(F.col("l_orderkey").alias("disclosure_id"))
    return ingest.found_files(t.disclosures(), files).agg(F.count_if("changed").alias("updated"), F.count_if(~F.col("changed")).alias("unchanged"))


@query("sector_codes", """SELECT 'TSE' || lpad(CAST(row_number() OVER (ORDER BY sector_english) AS VARCHAR), 4, '0') AS code, sector_english FROM (SELECT DISTINCT sector_english FROM companies)""")
def sector_codes(t):
    rows = views.numbered(t.companies().select("sector_english").distinct(), "no", ["sector_english"])
    return rows.select(F.concat(F.lit("TSE"), F.lpad(F.col("no").cast("string"), 4, "0")).alias("code"), "sector_english")


@query("migration_labels", """, cat AS (SELECT row_number() OVER (ORDER BY r_name) AS cid, r_name AS cname FROM region), sub AS (SELECT n_nationkey AS sid, n_name AS sname, r_name AS scat FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT o.o_orderkey AS disclosure_id, cat.cid AS category_id, sub.sid AS subcat_id FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN cat ON cat.cname = r.r_name LEFT JOIN sub ON sub.sname = CASE WHEN o.o_orderkey % 4 = 0 THEN NULL ELSE n.n_name END AND sub.scat = cat.cname""")
def migration_labels(t):
    region, nation = t.raw("region"), t.raw("nation")
    categories = views.numbered(region.select(F.col("r_name").alias("category")), "category_id", ["category"])
    named = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    subs = named.select(F.col("n_nationkey").alias("subcat_id"), F.col("n_name").alias("subcategory"), F.col("r_name").alias("category"))
    rows = t.raw("orders").join(t.raw("customer"), F.col("o_custkey") == F.col("c_custkey")).join(named, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.select(F.col("o_orderkey").alias("disclosure_id"), F.col("r_name").alias("category"), F.when(F.col("o_orderkey") % 4 != 0, F.col("n_name")).alias("subcategory"))
    return rows.join(categories, "category").join(subs, ["category", "subcategory"], "left").select("disclosure_id", "category_id", "subcat_id")
