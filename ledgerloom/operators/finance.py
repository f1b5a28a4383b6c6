"""Ratios, bands, score, thesis, risks and opportunities of wide financial records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Statement and market fields of a record, all of them nullable numbers.
FIELDS = "revenue gross_profit operating_income ebitda net_income total_assets current_assets inventory accounts_receivable total_debt current_liabilities shareholders_equity free_cash_flow working_capital market_cap enterprise_value".split()

Band = tuple[float | None, str]


@dataclass(frozen=True)
class Ratio:
    """value = top / under, for records where all fields in `needs` are set and not 0 and `under` is positive."""

    name: str
    category: str
    top: str
    under: str
    needs: str
    text: tuple[Band, ...]  # limits from below and what to say; None: everything above
    shown: str = "%.1f"
    times: float = 1.0
    weight: float = 0.02
    slope: tuple[float, float] | None = None  # score = (value - first) * second, between 0 and 1
    strong: tuple[str, float] | None = None  # ">=" or "<=" and the limit
    risk: tuple[Band, ...] = ()


# Definitions, limits, texts, weights and slopes of the ratios, in their order.
RATIOS = [
    Ratio("P/E Ratio", "valuation", "market_cap", "net_income", "market_cap net_income", ((10, "Low P/E of {} suggests undervaluation or poor growth prospects"), (20, "Moderate P/E of {} indicates reasonable valuation"), (30, "High P/E of {} suggests growth expectations or overvaluation"), (None, "Very high P/E of {} indicates strong growth expectations or speculative premium")), weight=0.10, slope=(30, -1 / 25), strong=("<=", 15)),
    Ratio("EV/EBITDA", "valuation", "enterprise_value", "ebitda", "enterprise_value ebitda", ((8, "Low EV/EBITDA of {} suggests potential undervaluation"), (15, "Moderate EV/EBITDA of {} indicates fair valuation"), (None, "High EV/EBITDA of {} suggests premium valuation")), weight=0.10, slope=(20, -1 / 15), strong=("<=", 10)),
    Ratio("P/B Ratio", "valuation", "market_cap", "shareholders_equity", "market_cap shareholders_equity", ((1, "P/B below 1.0 ({}) suggests trading below book value"), (3, "Moderate P/B of {} indicates reasonable valuation relative to assets"), (None, "High P/B of {} suggests premium to book value")), weight=0.05),
    Ratio("P/S Ratio", "valuation", "market_cap", "revenue", "market_cap revenue", ((1, "Low P/S of {} suggests potential value opportunity"), (3, "Moderate P/S of {} indicates reasonable revenue multiple"), (None, "High P/S of {} suggests premium revenue valuation"))),
    Ratio("EV/Sales", "valuation", "enterprise_value", "revenue", "enterprise_value revenue", ((None, "Enterprise value is {}x annual sales"),)),
    Ratio("ROE", "profitability", "net_income", "shareholders_equity", "net_income shareholders_equity", ((0.05, "Low ROE of {}% indicates poor equity efficiency"), (0.15, "Moderate ROE of {}% shows reasonable profitability"), (None, "Strong ROE of {}% indicates excellent equity efficiency")), times=100, weight=0.15, slope=(0, 5), strong=(">=", 0.15), risk=((0, "VERY_HIGH"), (0.05, "HIGH"), (0.10, "MODERATE"), (0.20, "LOW"), (None, "VERY_LOW"))),
    Ratio("ROA", "profitability", "net_income", "total_assets", "net_income total_assets", ((0.02, "Low ROA of {}% suggests poor asset utilization"), (0.08, "Moderate ROA of {}% indicates reasonable asset efficiency"), (None, "Strong ROA of {}% shows excellent asset utilization")), times=100),
    Ratio("ROIC", "profitability", "operating_income * 0.7", "shareholders_equity + total_debt", "operating_income shareholders_equity total_debt", ((0.08, "Low ROIC of {}% suggests value destruction"), (0.15, "Moderate ROIC of {}% indicates value creation"), (None, "Excellent ROIC of {}% shows strong value creation")), times=100, weight=0.15, slope=(0, 5), strong=(">=", 0.15)),
    Ratio("Gross Margin", "profitability", "gross_profit", "revenue", "gross_profit revenue", ((None, "Gross margin of {}% indicates pricing power and cost efficiency"),), times=100),
    Ratio("Operating Margin", "profitability", "operating_income", "revenue", "operating_income revenue", ((None, "Operating margin of {}% shows operational efficiency"),), times=100, weight=0.08, slope=(0, 5), strong=(">=", 0.15)),
    Ratio("Net Margin", "profitability", "net_income", "revenue", "net_income revenue", ((None, "Net margin of {}% reflects overall profitability"),), times=100),
    Ratio("Debt-to-Equity", "leverage", "total_debt", "shareholders_equity", "total_debt shareholders_equity", ((0.3, "Conservative debt level ({}) indicates low financial risk"), (0.8, "Moderate debt level ({}) shows balanced capital structure"), (None, "High debt level ({}) indicates elevated financial risk")), shown="%.2f", weight=0.10, slope=(1, -1 / 0.8), strong=("<=", 0.3), risk=((0.2, "VERY_LOW"), (0.5, "LOW"), (1.0, "MODERATE"), (2.0, "HIGH"), (None, "VERY_HIGH"))),
    Ratio("Debt-to-Assets", "leverage", "total_debt", "total_assets", "total_debt total_assets", ((None, "Debt represents {}% of total assets"),), times=100),
    Ratio("Interest Coverage (Est.)", "leverage", "operating_income", "total_debt * 0.02", "operating_income total_debt", ((2, "Low interest coverage ({}x) indicates financial stress"), (5, "Moderate interest coverage ({}x) shows adequate protection"), (None, "Strong interest coverage ({}x) indicates low default risk")), weight=0.05),
    Ratio("Current Ratio", "leverage", "current_assets", "current_liabilities", "current_assets current_liabilities", ((1, "Current ratio below 1.0 ({}) indicates liquidity concern"), (2, "Adequate current ratio ({}) shows reasonable liquidity"), (None, "Strong current ratio ({}) indicates excellent liquidity")), shown="%.2f", weight=0.07, slope=(0.5, 1 / 1.5), strong=(">=", 2.0)),
    Ratio("Quick Ratio", "leverage", "current_assets - inventory", "current_liabilities", "current_assets inventory current_liabilities", ((None, "Quick ratio of {} measures immediate liquidity"),), shown="%.2f"),
    Ratio("FCF Margin", "quality", "free_cash_flow", "revenue", "free_cash_flow revenue", ((0.05, "Low FCF margin ({}%) suggests cash generation concerns"), (0.15, "Moderate FCF margin ({}%) indicates adequate cash generation"), (None, "Strong FCF margin ({}%) shows excellent cash generation")), times=100, weight=0.10, slope=(0, 5), strong=(">=", 0.15)),
    Ratio("FCF/Net Income", "quality", "free_cash_flow", "net_income", "free_cash_flow net_income", ((0.8, "FCF/NI ratio of {} suggests earnings quality concerns"), (1.2, "FCF/NI ratio of {} indicates good earnings quality"), (None, "FCF/NI ratio of {} shows conservative accounting")), shown="%.2f"),
    Ratio("Working Capital/Sales", "quality", "working_capital", "revenue", "working_capital revenue", ((None, "Working capital is {}% of sales"),), times=100),
    Ratio("Asset Turnover", "efficiency", "revenue", "total_assets", "revenue total_assets", ((0.5, "Low asset turnover ({}) suggests poor asset utilization"), (1.5, "Moderate asset turnover ({}) indicates reasonable efficiency"), (None, "High asset turnover ({}) shows excellent asset efficiency")), shown="%.2f", weight=0.05),
    Ratio("Inventory Turnover", "efficiency", "revenue * 0.7", "inventory", "revenue inventory", ((None, "Inventory turns {}x per year ({days} days)"),)),
    Ratio("Receivables Turnover", "efficiency", "revenue", "accounts_receivable", "revenue accounts_receivable", ((None, "Collects receivables {}x per year ({days} days DSO)"),)),
]


def banded(value: Column, bands: tuple[Band, ...], show, closed: bool = False) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for limit, text in bands:
        below = F.lit(True) if limit is None else value <= limit if closed else value < limit
        out = out.when(below, show(text))
    return out


def printed(value: Column, shown: str) -> Column:
    """A number with the decimals of `%.1f` and the like, from its exact binary value, halves to the even digit: as C prints it and format_string does not."""
    places = int(shown[2:-1])
    return F.call_function("format_number", value, F.lit("0" + "." * (places > 0) + "0" * places))


def metric(r: Ratio) -> Column:
    """A struct of one ratio, null where a record does not have what it takes."""
    there = F.expr(r.under) > 0
    for f in r.needs.split():
        there = there & (F.coalesce(F.col(f), F.lit(0.0)) != 0)
    value = F.expr(f"double({r.top})") / F.expr(f"double({r.under})")

    def show(text: str) -> Column:
        args = [printed(value * r.times, r.shown)] + ([printed(365 / value, "%.0f")] if "{days}" in text else [])
        return F.format_string(text.replace("%", "%%").replace("{}", "%s").replace("{days}", "%s"), *args)

    # Debt bands are open above their limits, those of ROE below.
    risk = banded(value, r.risk, F.lit, closed=r.name == "Debt-to-Equity") if r.risk else F.lit(None).cast("string")
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (value - r.slope[0]) * r.slope[1])) if r.slope else F.lit(0.5)
    strong = F.lit(False) if not r.strong else (value >= r.strong[1]) if r.strong[0] == ">=" else (value <= r.strong[1])
    parts = {"name": F.lit(r.name), "category": F.lit(r.category), "value": value, "interpretation": banded(value, r.text, show), "risk_level": risk, "weight": F.lit(r.weight), "score": score, "strong": strong & (value != 0)}
    return F.when(there, F.struct(*[c.alias(k) for k, c in parts.items()]))


def analyse(records: DataFrame) -> DataFrame:
    """Adds metrics (array of structs), overall_score, thesis, risks and opportunities.

    All is one projection over a record. The score is 100 times the weighted mean of
    the ratios' scores, 50 without ratios; risks and opportunities are at most five.
    """
    out = records.withColumn("metrics", F.array_compact(F.array(*[metric(r) for r in RATIOS])))
    total = F.aggregate("metrics", F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("w")), lambda a, m: F.struct((a["s"] + m["score"] * m["weight"]).alias("s"), (a["w"] + m["weight"]).alias("w")))
    value = lambda name: F.get(F.filter("metrics", lambda m: m["name"] == name), F.lit(0))["value"]
    roe, pe, debt = value("ROE"), value("P/E Ratio"), value("Debt-to-Equity")
    parts = [
        F.when(roe > 0.15, "Strong return on equity indicates efficient capital allocation").when(roe > 0.10, "Moderate profitability with room for improvement").when(roe != 0, "Below-average profitability raises concerns about management effectiveness"),
        F.when(pe < 15, "Attractive valuation with potential upside").when(pe > 25, "Premium valuation requires strong execution to justify"),
        F.when(debt > 1.0, "Elevated leverage increases financial risk").when(debt != 0, "Conservative balance sheet provides downside protection"),
    ]
    thesis = F.concat_ws(". ", *parts)
    line = lambda m: F.concat(m["name"], F.lit(": "), m["interpretation"])
    first = lambda keep: F.slice(F.transform(F.filter("metrics", keep), line), 1, 5)
    return out.withColumns(
        {
            "overall_score": F.when(total["w"] > 0, total["s"] / total["w"] * 100).otherwise(50.0),
            "thesis": F.when(thesis == "", "Requires deeper analysis for investment thesis").otherwise(thesis),
            "risks": first(lambda m: m["risk_level"].isin("HIGH", "VERY_HIGH")),
            "opportunities": first(lambda m: m["strong"]),
        }
    )


def metrics_long(records: DataFrame, *keys: str) -> DataFrame:
    """One row per record and ratio that it has."""
    rows = records.select(*keys, F.explode(F.array(*[metric(r) for r in RATIOS])).alias("m")).where("m is not null")
    return rows.select(*keys, F.col("m.name").alias("metric"), F.col("m.category").alias("category"), F.col("m.value").alias("value"), F.col("m.risk_level").alias("risk_level"))
