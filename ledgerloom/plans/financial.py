"""Queries over financial records and period tables, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import finance, timeseries
from ledgerloom.plans.bind import Tables

QUERIES, ORACLES = {}, {}

#: Fields of a customer's year as sums of its line items; a field without rows is null.
PARTS = {"everything": "TRUE", "n": "l_returnflag = 'N'", "r": "l_returnflag = 'R'", "a": "l_returnflag = 'A'", "o": "l_linestatus = 'O'", "f": "l_linestatus = 'F'", **{f"l{i}": f"l_linenumber = {i}" for i in range(1, 8)}}
FIELDS = {"revenue": "everything", "gross_profit": "n", "operating_income": "r - a", "ebitda": "o", "net_income": "l1 - l7", "total_assets": "everything * 2", "current_assets": "f", "inventory": "l2", "accounts_receivable": "l3", "total_debt": "a", "current_liabilities": "l4", "shareholders_equity": "f - l5", "free_cash_flow": "l6", "working_capital": "f - l4", "market_cap": "everything + n", "enterprise_value": "everything * 3"}
RECORDS = "parts AS (SELECT o_custkey AS id, CAST(year(o_orderdate) AS INTEGER) AS fiscal_year, " + ", ".join(f"CAST(sum(CASE WHEN {c} THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS {k}" for k, c in PARTS.items()) + " FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2), rec AS (SELECT id, fiscal_year, " + ", ".join(f"{e} AS {k}" for k, e in FIELDS.items()) + " FROM parts)"


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def records(t: Tables):
    joined = t.raw("orders").join(t.raw("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    sums = joined.groupBy(F.col("o_custkey").alias("id"), F.year("o_orderdate").alias("fiscal_year")).agg(*[F.sum(F.when(F.expr(c), price)).cast("double").alias(k) for k, c in PARTS.items()])
    return sums.select("id", "fiscal_year", *[F.expr(e).alias(k) for k, e in FIELDS.items()])


def ratio_sql(r: finance.Ratio) -> str:
    there = " AND ".join(f"coalesce({f}, 0) <> 0" for f in r.needs.split())
    risk = "NULL::VARCHAR"
    if r.risk:
        sign = "<=" if r.name == "Debt-to-Equity" else "<"
        risk = "CASE " + " ".join(f"WHEN v {sign} {x} THEN '{k}'" for x, k in r.risk if x is not None) + f" ELSE '{r.risk[-1][1]}' END"
    score = f"least(1.0::DOUBLE, greatest(0.0::DOUBLE, (v - {r.slope[0]}) * {r.slope[1]!r}::DOUBLE))" if r.slope else "0.5::DOUBLE"
    strong = f"v {r.strong[0]} {r.strong[1]} AND v <> 0" if r.strong else "FALSE"
    return f"SELECT id, fiscal_year, {finance.RATIOS.index(r)} AS ord, '{r.name}' AS metric, '{r.category}' AS category, v AS value, {risk} AS risk_level, {r.weight}::DOUBLE AS weight, {score} AS score, {strong} AS strong FROM (SELECT id, fiscal_year, ({r.top}) / ({r.under}) AS v FROM rec WHERE {there} AND ({r.under}) > 0)"


METRICS = f"WITH {RECORDS}, m AS (" + "\nUNION ALL ".join(map(ratio_sql, finance.RATIOS)) + ")\n"


@query("metrics_long", METRICS + "SELECT id, fiscal_year, metric, category, value FROM m")
def metrics_long(t):
    return finance.metrics_long(records(t), "id", "fiscal_year").drop("risk_level")


@query("metrics_score", METRICS + "SELECT r.id, r.fiscal_year, round(coalesce(s, 50.0), 4) AS overall_score FROM rec r LEFT JOIN (SELECT id, fiscal_year, sum(score * weight) / sum(weight) * 100 AS s FROM m GROUP BY 1, 2) x ON r.id = x.id AND r.fiscal_year = x.fiscal_year")
def metrics_score(t):
    return finance.analyse(records(t)).select("id", "fiscal_year", F.round("overall_score", 4).alias("overall_score"))


@query("metrics_risk", METRICS + "SELECT id, fiscal_year, metric, risk_level FROM m WHERE risk_level IS NOT NULL")
def metrics_risk(t):
    return finance.metrics_long(records(t), "id", "fiscal_year").where("risk_level is not null").select("id", "fiscal_year", "metric", "risk_level")


@query("metrics_thesis", METRICS + """, p AS (SELECT id, fiscal_year, max(CASE WHEN metric = 'ROE' THEN value END) AS roe, max(CASE WHEN metric = 'P/E Ratio' THEN value END) AS pe, max(CASE WHEN metric = 'Debt-to-Equity' THEN value END) AS de FROM m GROUP BY 1, 2)
SELECT r.id, r.fiscal_year, coalesce(nullif(concat_ws('. ', CASE WHEN roe > 0.15 THEN 'Strong return on equity indicates efficient capital allocation' WHEN roe > 0.10 THEN 'Moderate profitability with room for improvement' WHEN roe <> 0 THEN 'Below-average profitability raises concerns about management effectiveness' END,
  CASE WHEN pe < 15 THEN 'Attractive valuation with potential upside' WHEN pe > 25 THEN 'Premium valuation requires strong execution to justify' END, CASE WHEN de > 1.0 THEN 'Elevated leverage increases financial risk' WHEN de <> 0 THEN 'Conservative balance sheet provides downside protection' END), ''), 'Requires deeper analysis for investment thesis') AS thesis
FROM rec r LEFT JOIN p ON r.id = p.id AND r.fiscal_year = p.fiscal_year""")
def metrics_thesis(t):
    return finance.analyse(records(t)).select("id", "fiscal_year", "thesis")


@query("metrics_opportunities", METRICS + "SELECT r.id, r.fiscal_year, coalesce(n, 0) AS n_opportunities, coalesce(names, '') AS names FROM rec r LEFT JOIN (SELECT id, fiscal_year, CAST(count(*) AS INTEGER) AS n, string_agg(metric, '|' ORDER BY ord) AS names FROM (SELECT *, row_number() OVER (PARTITION BY id, fiscal_year ORDER BY ord) AS rn FROM m WHERE strong) WHERE rn <= 5 GROUP BY 1, 2) x ON r.id = x.id AND r.fiscal_year = x.fiscal_year")
def metrics_opportunities(t):
    out = finance.analyse(records(t))
    return out.select("id", "fiscal_year", F.size("opportunities").alias("n_opportunities"), F.array_join(F.transform("opportunities", lambda x: F.regexp_extract(x, "^(.*?): ", 1)), "|").alias("names"))


@query("kpi_margin_pivot", """WITH k AS (SELECT l_suppkey, max(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS r, max(CASE WHEN l_returnflag = 'N' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS n FROM lineitem GROUP BY 1)
SELECT l_suppkey, CAST(r AS DOUBLE) AS "R", CAST(n AS DOUBLE) AS "N", CAST(round(CAST(r AS DECIMAL(38,4)) * 100 / CAST(nullif(n, 0) AS DECIMAL(38,4)), 1) AS DOUBLE) AS margin FROM k""")
def kpi_margin_pivot(t):
    rows = t.raw("lineitem").withColumn("price", F.col("l_extendedprice").cast("decimal(18,2)"))
    out = timeseries.margin_pivot(rows, ["l_suppkey"], "l_returnflag", "price", ["R", "N"])
    return out.select("l_suppkey", F.col("R").cast("double").alias("R"), F.col("N").cast("double").alias("N"), timeseries.percent_of(F.col("R"), F.col("N")).cast("double").alias("margin"))


ORDER = "l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax"


@query("statement_pivot", "WITH x AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_linestatus, l_returnflag ORDER BY " + ", ".join(f"{c} DESC" for c in ORDER.split(", ")) + """) AS rn FROM lineitem)
SELECT l_suppkey, l_linestatus, max(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END) AS "A", max(CASE WHEN l_returnflag = 'N' THEN l_extendedprice END) AS "N", max(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS "R" FROM x WHERE rn = 1 GROUP BY 1, 2""")
def statement_pivot(t):
    return timeseries.statement_pivot(t.raw("lineitem"), ["l_suppkey", "l_linestatus"], "l_returnflag", "l_extendedprice", ORDER.split(", "), ["A", "N", "R"])


@query("ytd_to_quarter", """WITH q AS (SELECT o_custkey AS k, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(quarter(o_orderdate) AS INTEGER) AS q, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM orders GROUP BY 1, 2, 3),
c AS (SELECT k, y, q, sum(v) OVER (PARTITION BY k, y ORDER BY q) AS v FROM q)
SELECT c.k, c.y, c.q, CAST(c.v - coalesce(b.v, 0) AS DOUBLE) AS v FROM c LEFT JOIN c b ON b.k = c.k AND b.y = c.y AND b.q = c.q - 1""")
def ytd_to_quarter(t):
    from pyspark.sql import Window as W

    rows = t.raw("orders").groupBy(F.col("o_custkey").alias("k"), F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("v"))
    ytd = rows.withColumn("v", F.sum("v").over(W.partitionBy("k", "y").orderBy("q")))
    return timeseries.quarters(ytd, ["k"], "y", "q", ["v"]).withColumn("v", F.col("v").cast("double"))


@query("period_override", """SELECT k, y, id, is_correction FROM (SELECT *, row_number() OVER (PARTITION BY k, y ORDER BY is_correction DESC, d DESC, id) AS rn FROM (SELECT o_custkey AS k, CAST(year(o_orderdate) AS INTEGER) AS y, o_orderkey AS id, o_orderstatus = 'P' AS is_correction, CAST(o_orderdate AS DATE) AS d FROM orders)) WHERE rn = 1""")
def period_override(t):
    rows = t.raw("orders").select(F.col("o_custkey").alias("k"), F.year("o_orderdate").alias("y"), F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "P").alias("is_correction"), F.to_date("o_orderdate").alias("d"))
    return timeseries.period_records(rows, ["k", "y"], F.col("d"), F.asc("id")).drop("d")


@query("metric_choice", f"""SELECT l_suppkey, value, match_quality, context_quality FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY match_quality DESC, context_quality DESC, {ORDER}) AS rn FROM (
  SELECT *, l_extendedprice AS value, CASE WHEN name = 'NetSales' THEN 3 WHEN name LIKE '%NetSales' THEN 2 WHEN name LIKE '%NetSales%' THEN 1 END AS match_quality, CASE WHEN cons THEN 2 WHEN cons IS NULL THEN 1 END AS context_quality FROM (
    SELECT *, CASE l_linenumber WHEN 1 THEN 'NetSales' WHEN 2 THEN 'OperatingNetSales' WHEN 3 THEN 'NetSalesGrowth' ELSE 'Other' END AS name, CASE l_returnflag WHEN 'R' THEN TRUE WHEN 'A' THEN FALSE END AS cons FROM lineitem)) WHERE match_quality IS NOT NULL AND context_quality IS NOT NULL) WHERE rn = 1""")
def metric_choice(t):
    n = F.col("l_linenumber")
    rows = t.raw("lineitem").withColumn("name", F.when(n == 1, "NetSales").when(n == 2, "OperatingNetSales").when(n == 3, "NetSalesGrowth").otherwise("Other")).withColumn("cons", F.when(F.col("l_returnflag") == "R", True).when(F.col("l_returnflag") == "A", False))
    return timeseries.best_value(rows, ["l_suppkey"], F.lit("NetSales"), "name", "l_extendedprice", "cons", ORDER.split(", "))


@query("consolidated_preferred", f"""WITH x AS (SELECT *, CASE l_returnflag WHEN 'R' THEN TRUE WHEN 'A' THEN FALSE END AS cons FROM lineitem), y AS (
  SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY CASE WHEN cons THEN 0 ELSE 1 END, {ORDER}) AS rn FROM x) SELECT l_partkey, l_extendedprice AS value, coalesce(cons, FALSE) AS is_consolidated FROM y WHERE rn = 1""")
def consolidated_preferred(t):
    rows = t.raw("lineitem").withColumn("cons", F.when(F.col("l_returnflag") == "R", True).when(F.col("l_returnflag") == "A", False))
    return timeseries.preferred(rows, ["l_partkey"], "cons", "l_extendedprice", ORDER.split(", "))


@query("statement_split", """SELECT kind, count(*) AS n FROM (SELECT CASE WHEN l_linestatus = 'O' THEN 'balance' WHEN p_name LIKE '%a%' THEN 'cashflow' ELSE 'income' END AS kind FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY 1""")
def statement_split(t):
    rows = t.raw("lineitem").join(t.raw("part"), F.col("l_partkey") == F.col("p_partkey"))
    concept = F.when(F.col("p_name").contains("a"), F.concat("p_name", F.lit("CashFlow"))).otherwise("x")
    return rows.select(timeseries.statement_kind(F.when(F.col("l_linestatus") == "O", "Instant").otherwise("Duration"), concept).alias("kind")).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
