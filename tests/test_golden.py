"""Golden cases of rules, contexts, sections, ratios, precedence, states and ranks."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import classify, finance, ingest, retrieval, text, tracking, views, xbrl


def column(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(build(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("title", "parents", "subs"),
    [
        ("決算短信", "EARNINGS & PERFORMANCE", "Earnings Reports"),
        ("配当のお知らせ", "CORPORATE FINANCE", "Dividend Notices"),
        ("役員異動について", "GOVERNANCE & LEADERSHIP", "Governance & Senior Personnel Changes"),
        ("M&A実施について", "CORPORATE STRATEGY & RESTRUCTURING", "M&A, Alliances & Restructuring"),
        ("株式分割について", "CORPORATE FINANCE", "Stock Splits (Forward/Reverse)"),
        ("未知のタイトル例", "OTHER", ""),
        ("業績予想修正に関するお知らせ", "EARNINGS & PERFORMANCE, CORRECTIONS & ERRATA", "Earnings Corrections, Earnings Forecasts, Performance Variance Analysis"),
        (None, "OTHER", ""),
    ],
)
def test_titles(spark, title, parents, subs):
    out = classify.classify_titles(spark.createDataFrame([(1, title)], "id int, title string"), "title")
    assert tuple(out.select("parent_text", "sub_text").first()) == (parents, subs)


def test_labels_drop_parents_without_subcategory(spark):
    out = classify.classify_titles(spark.createDataFrame([(1, "業績予想修正に関するお知らせ"), (2, "未知")], "id int, title string"), "title")
    rows = {tuple(r) for r in classify.label_rows(out, "id").collect()}
    assert rows == {(1, "EARNINGS & PERFORMANCE", s) for s in ("Earnings Corrections", "Earnings Forecasts", "Performance Variance Analysis")} | {(2, "OTHER", None)}


@pytest.mark.parametrize(
    ("context", "parts"),
    [
        ("CurrentAccumulatedQ3Duration_ConsolidatedMember_ResultMember", ("Current", "Duration", 3, True, "Result")),
        ("CurrentYearDuration_ConsolidatedMember_ResultMember", ("Current", "Duration", 99, True, "Result")),
        ("NextYearDuration_NonConsolidatedMember_ForecastMember", ("Next", "Duration", 99, False, "Forecast")),
        ("CurrentYTDDuration", ("Current", "Duration", 0, None, None)),
        ("FilingDateInstant", ("Filing", "Instant", None, None, None)),
    ],
)
def test_contexts(spark, context, parts):
    df = spark.createDataFrame([(context,)], "c string")
    assert tuple(df.select(*[c.alias(k) for k, c in xbrl.context_parts(F.col("c")).items()]).first()) == parts


def test_prior_contexts_are_not_loaded(spark):
    assert column(spark, "Prior1YearInstant", xbrl.is_current) is False


@pytest.mark.parametrize(
    ("path", "expected"),
    [
        ("a/0105010-qcci13-tse-qcediffr-67580-2023-12-31-01-2024-02-14-ixbrl.htm", ("ComprehensiveIncome", "q", True, 13)),
        ("a/0101010-acbs01-tse-x-ixbrl.htm", ("BalanceSheet", "a", True, 1)),
        ("a/0102010-snpl05-tse-x-ixbrl.htm", ("ProfitLoss", "s", False, 5)),
        ("a/tse-rvfc-x-ixbrl.htm", ("EarningsForecastRevision", None, None, None)),
        ("Summary/x-ixbrl.htm", ("Summary", None, None, None)),
        ("a/0103010-bs05-tse-x-ixbrl.htm", None),
        ("a/qualitative.htm", ("Narrative", None, None, None)),
    ],
)
def test_sections(spark, path, expected):
    row = xbrl.sections(spark.createDataFrame([(path,)], "path string"), "path").select("role", "period_prefix", "consolidated", "layout_code").first()
    assert (tuple(row) if row else None) == expected


@pytest.mark.parametrize(("raw", "sign", "value"), [("1,234", None, 1234.0), ("△500", None, -500.0), ("500", "-", -500.0), ("△500", "-", -500.0), ("－", None, None), ("―", None, None), ("", None, None), ("abc", None, None), ("nan", None, None), (None, None, None)])
def test_numbers(spark, raw, sign, value):
    df = spark.createDataFrame([(raw, sign)], "a string, b string")
    assert df.select(xbrl.number(F.col("a"), F.col("b"))).first()[0] == value


@pytest.mark.parametrize(("unit", "scale", "expected"), [("JPY", 6, 1), ("JPY", 3, 3), ("JPY", 0, 2), ("USD", 0, 4), ("shares", 0, 5), ("pure", 0, 6), ("", 6, 1), ("", 0, 2), ("other", 3, 3), (None, None, 2)])
def test_units(spark, unit, scale, expected):
    df = spark.createDataFrame([(unit, scale)], "a string, b int")
    assert df.select(xbrl.unit_id(F.col("a"), F.col("b"))).first()[0] == expected


def test_concepts_fall_back(spark):
    concepts = spark.createDataFrame([(1, "jppfs", "NetSales"), (2, "jpigp", "Assets"), (3, "tse", "Own")], "id int, taxonomy_prefix string, local_name string")
    facts = spark.createDataFrame([("tse:Own",), ("jpigp_cor:Assets",), ("NetSales",), ("x:NetSales",), ("x:Nothing",)], "q string")
    assert {tuple(r) for r in xbrl.concept_ids(facts, concepts, "q").collect()} == {("tse:Own", 3), ("jpigp_cor:Assets", 2), ("NetSales", 1), ("x:NetSales", 1)}


def test_normalise(spark):
    assert column(spark, "①売上高△１，０００円（注）", text.normalise) == "1.売上高-1000円(注)"
    assert column(spark, "売上高△1,000円", text.normalise) == "売上高-1000円"
    assert column(spark, None, text.normalise) is None
    once = column(spark, "②　ａｂｃ 「x」 1,234,567", text.normalise)
    assert column(spark, once, text.normalise) == once


def test_row_numbers_and_tokens(spark):
    assert column(spark, "2: 売上", text.without_row_numbers) == "売上"
    assert column(spark, "-84 Company", text.without_row_numbers) == "-84 Company"
    assert [column(spark, x, text.tokens) for x in ("", "ab", "x" * 31)] == [0, 1, 10]


SAMPLE = dict(revenue=110000.0, gross_profit=44000.0, operating_income=8850.0, ebitda=11000.0, net_income=5400.0, total_assets=75000.0, current_assets=24000.0, inventory=7500.0, accounts_receivable=10000.0, total_debt=20000.0, current_liabilities=12000.0, shareholders_equity=40000.0, free_cash_flow=7500.0, working_capital=15000.0, market_cap=100000.0, enterprise_value=110000.0)


def test_company_sample(spark):
    out = finance.analyse(spark.createDataFrame([tuple(SAMPLE.values())], ", ".join(f"{k} double" for k in SAMPLE))).first()
    values = {m["name"]: round(m["value"], 6) for m in out["metrics"]}
    assert len(values) == 22
    assert values["P/E Ratio"] == 18.518519 and values["ROIC"] == 0.10325 and values["Interest Coverage (Est.)"] == 22.125 and values["FCF/Net Income"] == 1.388889
    assert round(sum(m["weight"] for m in out["metrics"]), 2) == 1.22
    assert round(out["overall_score"], 2) == 55.33
    assert out["risks"] == [] and [x.split(":")[0] for x in out["opportunities"]] == ["EV/EBITDA", "Current Ratio"]
    assert out["thesis"] == "Moderate profitability with room for improvement. Conservative balance sheet provides downside protection"


def test_company_without_figures(spark):
    out = finance.analyse(spark.createDataFrame([tuple([None] * len(SAMPLE))], ", ".join(f"{k} double" for k in SAMPLE))).first()
    assert (out["metrics"], out["overall_score"], out["thesis"]) == ([], 50.0, "Requires deeper analysis for investment thesis")


def test_precedence(spark):
    rows = [(1, False, "Attachment", datetime(2024, 1, 1)), (2, False, "Summary", datetime(2024, 1, 1)), (3, True, "Summary", datetime(2023, 1, 1)), (4, None, "Summary", datetime(2023, 1, 1)), (5, True, "Attachment", None)]
    df = spark.createDataFrame(rows, "fact int, amendment_flag boolean, section_type string, filing_timestamp timestamp").withColumns({"company_id": F.lit(1), "period_end": F.lit("2023"), "concept_id": F.lit(1), "context_id": F.lit("c")})
    order = []
    while not df.isEmpty():
        order.append(views.facts_cleaned(df, F.col("fact")).first()["fact"])
        df = df.where(F.col("fact") != order[-1])
    assert order == [4, 5, 3, 1, 2]


def test_amendments(spark):
    rows = [(1, 1, None, False), (2, 2, None, True), (3, 3, None, None), (4, 4, "x", True)]
    df = spark.createDataFrame(rows, "id int, disclosure_id int, accounting_standard string, amendment_flag boolean").withColumns({"company_id": F.lit(1), "period_start": F.lit(1), "period_end": F.lit(2), "has_consolidated": F.lit(None).cast("boolean")})
    out = views.amendments(df, spark.createDataFrame([(3,)], "disclosure_id int"))
    assert {tuple(r) for r in out.select("id", "parent_filing_id", "amendment_flag").collect()} == {(1, None, False), (2, 1, True), (3, 1, True), (4, None, True)}


def test_company_match_keeps_both(spark):
    d = spark.createDataFrame([(1, "13010"), (2, "1301"), (3, None), (4, "99999")], "id int, company_code string")
    c = spark.createDataFrame([(7, "1301"), (8, "13010")], "id int, ticker string")
    assert {tuple(r) for r in views.company_match(d, c).select("id", "company_id").collect()} == {(1, 7), (1, 8), (2, 7), (3, None), (4, None)}


def test_status_fold(spark):
    t = lambda h: datetime(2024, 1, 1, h)
    rows = [(1, t(1), "processing", None, None, None, None), (1, t(2), "completed", "xbrl", 3.5, 12, None), (1, t(3), "failed", None, 9.0, 1, "boom")]
    out = tracking.fold(spark.createDataFrame(rows, "id int, ts timestamp, status string, method string, duration double, chunks int, error string"), "id", ["ts"]).first()
    assert (out["status"], out["method"], out["chunks"], out["duration"], out["error"]) == ("failed", "xbrl", 12, 3.5, "boom")


def test_rerank(spark):
    rows = [(i, s, date(2024, 1, 1), "title", "c", "x") for i, s in enumerate((0.9, 0.8, 0.7, 0.6))]
    hits = spark.createDataFrame(rows, "id int, score double, date date, title string, code string, category string")
    out = [round(r["final_score"], 6) for r in retrieval.rerank(hits, query_type="simple", terms=[], as_of="2024-02-01").collect()]
    assert out == [0.9, 0.8, 0.7, 0.55]
    out = retrieval.rerank(hits, query_type="simple", terms=["tit", "tit"], as_of="2024-02-01").first()
    assert round(out["final_score"], 6) == 1.0


def test_query_analysis(spark):
    out = retrieval.analyse_queries(spark.createDataFrame([("7203 の配当 trend 最近",)], "q string"), "q").first()
    assert out["query_type"] == "temporal" and out["companies"] == ["7203"] and out["times"] == ["最近"]
    assert out["terms"] == ["配当"] and out["expanded"].split(" ")[:2] == ["7203", "の配当"]


def test_writes(spark):
    old = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    new = spark.createDataFrame([(1, "x"), (2, "c"), (2, "d"), (None, "e"), (None, "f")], "k int, v string")
    order = [F.asc("v")]
    assert {tuple(r) for r in ingest.insert_absent(old, new, ["k"], order).collect()} == {(2, "c")}
    assert {tuple(r) for r in ingest.insert_ignoring_conflicts(old, new, ["k"], order).collect()} == {(2, "c"), (None, "e"), (None, "f")}
    assert {tuple(r) for r in ingest.upsert(old, new.where("k is not null"), ["k"], [F.desc("v")]).collect()} == {(None, "b"), (1, "x"), (2, "d")}
    assert {tuple(r) for r in ingest.without(old, F.col("k") == 1).collect()} == {(None, "b")}


def test_near_duplicates_keep_the_longer(spark):
    base = "The company reports that its sales grew in every region during the quarter. "
    rows = [(1, 0, base * 2, "x"), (1, 1, base * 2 + "More.", "x"), (1, 2, "A wholly different paragraph about dividends and buybacks of shares.", "x"), (2, 0, base * 2, "x")]
    out = text.near_duplicates(spark.createDataFrame(rows, "d int, i int, t string, k string"), "d", "t", "i", "k")
    assert {(r["d"], r["i"]) for r in out.collect()} == {(1, 1), (1, 2), (2, 0)}
