"""Contexts, sections, filings and facts of structured reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Codes of statements with role, Japanese and English name, and of periods.
STATEMENTS = {
    "bs": ("BalanceSheet", "貸借対照表", "Balance sheet"),
    "pl": ("ProfitLoss", "損益計算書", "Profit-and-loss"),
    "ci": ("ComprehensiveIncome", "包括利益計算書", "Comprehensive income"),
    "pc": ("CombinedPLCI", "損益及び包括利益計算書", "Combined PL & CI"),
    "fs": ("FinancialSummary", "要約財政状態計算書", "Condensed BS"),
    "ss": ("ChangesInEquity", "株主資本等変動計算書", "Changes in equity"),
    "cf": ("CashFlows", "キャッシュ・フロー計算書", "Cash flows"),
    "sg": ("SegmentInformation", "セグメント情報", "Segment info"),
    "nb": ("BSNotes", "貸借対照表関係注記", "BS notes"),
    "nc": ("PLCINotes", "損益及び包括利益計算書関係注記", "PL & CI notes"),
    "np": ("PLNotes", "損益計算書関係注記", "PL notes"),
    "ds": ("DividendSchedule", "配当関係注記", "Dividend schedule"),
    "qualitative": ("Narrative", "ナラティブ", "Narrative"),
}
OTHER_SECTIONS = {"summary": ("Summary", "サマリー", "Summary"), "rvdf": ("DividendForecastRevision", "配当予想修正", "Dividend forecast revision"), "rvfc": ("EarningsForecastRevision", "業績予想修正", "Earnings forecast revision")}
PERIODS = {"ac": "a", "an": "a", "qc": "q", "qn": "q", "sc": "s", "sn": "s"}
FALLBACK_PREFIXES = ("jppfs", "jpcrp", "jpdei")


def is_current(context: Column) -> Column:
    """Contexts of earlier periods are not loaded."""
    return ~context.contains("Prior")


def context_parts(context: Column) -> dict[str, Column]:
    """Columns period_base, period_type, fiscal_span, consolidated, forecast_variant of a context's id."""
    parts = F.split(context, "_")
    token = F.get(parts, F.lit(0))
    token = F.when(token.contains("Instant"), F.replace(token, F.lit("Instant"), F.lit(""))).otherwise(F.replace(token, F.lit("Duration"), F.lit("")))
    word = F.regexp_extract(token, "[A-Z][a-z]*", 0)
    span = F.when(token.contains("YTD"), 0).when(token.contains("Year"), 99).when(token.contains("Q1"), 1).when(token.contains("Q2") | token.contains("HalfYear"), 2).when(token.contains("Q3"), 3)
    told = F.filter(parts, lambda p: p.contains("Consolidated"))
    variant = lambda p: F.when(p.contains("ResultMember"), "Result").when(p.contains("ForecastMember"), "Forecast").when(p.contains("UpperMember"), "Upper").when(p.contains("LowerMember"), "Lower")
    return {
        "period_base": F.when(token == "", None).when(word != "", word).otherwise(F.get(F.split(token, " "), F.lit(0))),
        "period_type": F.when(context.contains("Instant"), "Instant").otherwise("Duration"),
        "fiscal_span": span,
        "consolidated": ~F.try_element_at(told, F.lit(-1)).contains("NonConsolidated"),
        "forecast_variant": F.try_element_at(F.array_compact(F.transform(parts, variant)), F.lit(-1)),
    }


def sections(files: DataFrame, path: str) -> DataFrame:
    """Files that are sections, with role (and names), period_prefix, consolidated and layout_code.

    In order: a path with `summary`, forecast revisions, a coded attachment, a path
    with `qualitative`; all else is no section.
    """
    p = F.lower(F.col(path))
    name = F.element_at(F.split(p, "/"), -1)
    code = F.regexp_extract(name, r"\d+-([a-z]{2,4}\d{2})-tse-", 1)
    prefix = F.substring(code, 1, 2)
    statement = F.regexp_extract(F.substring(code, 3, 10), r"^([a-z]*)\d+$", 1)
    revision = name.endswith("ixbrl.htm")
    coded = F.lit(None).cast("string")
    for k in STATEMENTS:
        coded = F.when(statement == k, F.lit(k)).otherwise(coded) if k != "qualitative" else coded
    kind = F.when(p.contains("summary"), "summary").when(revision & name.contains("-rvdf-"), "rvdf").when(revision & name.contains("-rvfc-"), "rvfc")
    kind = kind.when(code != "", coded).when(p.contains("qualitative"), "qualitative")
    known = STATEMENTS | OTHER_SECTIONS
    pick = lambda i: F.element_at(F.create_map(*[F.lit(x) for k, v in known.items() for x in (k, v[i])]), F.col("_kind"))
    out = files.withColumn("_kind", kind).where(F.col("_kind").isNotNull())
    has_code = F.col("_kind").isin([k for k in STATEMENTS if k != "qualitative"])
    period = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in PERIODS.items() for x in kv]), prefix), F.lit("a"))
    whole = F.when(prefix.isin(list(PERIODS)), F.substring(prefix, 2, 1) == "c").otherwise(True)
    return out.withColumns({"role": pick(0), "role_ja": pick(1), "role_en": pick(2), "period_prefix": F.when(has_code, period), "consolidated": F.when(has_code, whole), "layout_code": F.when(has_code, F.try_to_number(F.regexp_extract(code, r"(\d+)$", 1), F.lit("99")).cast("int"))}).drop("_kind")


def concept_ids(facts: DataFrame, concepts: DataFrame, qname: str) -> DataFrame:
    """Facts with concept_id by qualified name: as it is, with common prefixes, or without `_cor`; others are dropped.

    The candidates of a fact become rows of an equality join with the dictionary;
    the first candidate found wins.
    """
    q = F.col(qname)
    prefix = F.when(q.contains(":"), F.substring_index(q, ":", 1)).otherwise("unknown")
    local = F.when(q.contains(":"), F.expr(f"substring({qname}, instr({qname}, ':') + 1)")).otherwise(q)
    tries = F.array(prefix, *map(F.lit, FALLBACK_PREFIXES), F.when(prefix.endswith("_cor"), F.expr(f"regexp_replace(substring_index({qname}, ':', 1), '_cor$', '')")))
    rows = facts.withColumn("_row", F.monotonically_increasing_id())
    found = rows.select("_row", local.alias("local_name"), F.posexplode(tries).alias("_try", "taxonomy_prefix")).where("taxonomy_prefix is not null")
    found = found.join(concepts.select("taxonomy_prefix", "local_name", F.col("id").alias("concept_id")), ["taxonomy_prefix", "local_name"])
    best = found.groupBy("_row").agg(F.min_by("concept_id", F.struct("_try", "concept_id")).alias("concept_id"))
    return rows.join(best, "_row").drop("_row")


def number(text: Column, sign: Column) -> Column:
    """The number of a fact's text: group signs dropped, negative by its sign or a triangle, null if it is none."""
    cut = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
    plain = F.replace(F.replace(cut, F.lit(","), F.lit("")), F.lit("△"), F.lit(""))
    value = F.when(~plain.isin("", "－", "―"), plain.try_cast("double"))
    value = F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)
    return F.when(F.coalesce(sign == "-", F.lit(False)) | text.contains("△"), -value).otherwise(value)


def unit_id(unit: Column, scale: Column) -> Column:
    u = F.lower(F.coalesce(unit, F.lit("")))
    by_scale = F.when(scale == 6, 1).when(scale == 3, 3).otherwise(2)
    return F.when(u.contains("jpy"), by_scale).when(u.contains("usd"), 4).when(u.contains("shares"), 5).when(u.contains("pure"), 6).otherwise(by_scale)


def fiscal_quarter(period: Column) -> Column:
    p = F.upper(period)
    return F.when(p.isin("Q1", "FIRSTQUARTER"), 1).when(p.isin("Q2", "SECONDQUARTER", "HALFYEAR"), 2).when(p.isin("Q3", "THIRDQUARTER"), 3).otherwise(99)


def era_year(title: Column) -> Column:
    """The year that a title names, in western or Japanese years."""
    year = lambda p: F.nullif(F.regexp_extract(title, p, 1), F.lit("")).cast("int")
    return F.coalesce(year(r"(\d{4})年"), year(r"令和(\d+)年") + 2018, year(r"平成(\d+)年") + 1988)


def title_quarter(title: Column) -> Column:
    has = lambda *words: F.greatest(*[title.contains(w) for w in words]) if len(words) > 1 else title.contains(words[0])
    return F.when(has("第1四半期", "第１四半期"), 1).when(has("第2四半期", "第２四半期", "中間期"), 2).when(has("第3四半期", "第３四半期"), 3).otherwise(4)


def is_correction(title: Column) -> Column:
    return title.contains("(訂正") | title.contains("（訂正")


def safe_name(name: Column) -> Column:
    """A file name without signs that file systems refuse."""
    t = F.regexp_replace(F.regexp_replace(name, r'[<>:"/\\|?*]', "_"), "_+", "_")
    return F.substring(F.regexp_replace(t, "^[_ ]+|[_ ]+$", ""), 1, 200)


def file_path(base: str, date: Column, time: Column, code: Column, title: Column, ending: str) -> Column:
    day = F.date_format(date, "yyyy-MM-dd")
    return F.concat(F.lit(base.rstrip("/") + "/"), day, F.lit("/"), F.replace(time, F.lit(":"), F.lit("-")), F.lit("_"), code, F.lit("_"), safe_name(title), F.lit("." + ending))


def company_code(code: Column) -> Column:
    return F.when(F.length(code) == 4, F.concat(code, F.lit("0"))).otherwise(code)


def first_facts(facts: DataFrame, order: list[Column]) -> DataFrame:
    """The first fact of each section, concept and context."""
    key = W.partitionBy("section_id", "concept_id", "context_id").orderBy(*order)
    return facts.withColumn("_n", F.row_number().over(key)).where("_n = 1").drop("_n")


def item_type(raw: Column) -> Column:
    """The kind of a concept by the type of its element, null for kinds that are not loaded."""
    t = F.lower(F.element_at(F.split(raw, ":"), -1))
    excluded = ["stringitemtype", "textblockitemtype", "dateitemtype", "anyuriitemtype", "numberofcompaniesitemtype", "nonnegativeintegeritemtype", "booleanitemtype"]
    kinds = F.when(t.contains("monetary"), "monetary").when(t.contains("string") | t.contains("text"), "string").when(t.contains("decimal") | t.contains("number"), "decimal").when(t.contains("date"), "date").when(t.contains("boolean"), "boolean")
    return F.when(~t.isin(excluded), kinds)


def labels(links: DataFrame) -> DataFrame:
    """(package, local_name, label) of rows (package, kind, a, b, position) of a label linkbase.

    loc rows have label and concept, label rows id and text, arc rows from and to. A
    label reaches its concept through arcs, or else by the pattern of its id.
    """
    part = lambda kind, a, b: links.where(F.col("kind") == kind).select("package", F.col("a").alias(a), F.col("b").alias(b), "position")
    loc = part("loc", "from", "local_name").groupBy("package", "from").agg(F.max_by("local_name", "position").alias("local_name"))
    text = part("label", "to", "label").groupBy("package", "to").agg(F.max_by("label", "position").alias("label"), F.min_by("label", "position").alias("first"), F.min("position").alias("at"))
    arc = part("arc", "from", "to")
    by_arc = arc.join(loc, ["package", "from"]).join(text, ["package", "to"]).groupBy("package", "local_name").agg(F.max_by("label", arc["position"]).alias("by_arc"))
    guess = text.withColumn("local_name", F.regexp_extract("to", r"^[^_]+_(.+?)(?:_label.*)?$", 1)).where("local_name <> ''").groupBy("package", "local_name").agg(F.min_by("first", "at").alias("by_id"))
    return by_arc.join(guess, ["package", "local_name"], "full").select("package", "local_name", F.coalesce("by_arc", "by_id").alias("label"))


def url_id(url: Column) -> Column:
    """The id that the last part of an address names, null if it is no `.pdf`."""
    return F.nullif(F.regexp_extract(F.element_at(F.split(url, "/"), -1), r"(?s)^(.*)\.pdf$", 1), F.lit(""))


def mirror_url(base: str, code: Column, identifier: Column) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), code, F.lit("/"), identifier, F.lit(".pdf"))


def flag(text: Column) -> Column:
    """A yes or no as reports write it; empty: unknown."""
    return F.when(text != "", F.lower(text).isin("true", "1", "yes", "y"))


def user_period(text: Column) -> Column:
    """(year, quarter) of a period as people write it; the fourth quarter if none is named, null without a year."""
    t = F.replace(F.upper(text), F.lit("\u3000"), F.lit(" "))
    number = lambda p: F.nullif(F.regexp_extract(t, p, 1), F.lit("")).cast("int")
    year = F.coalesce(number(r"(\d{4})"), number(r"令和(\d+)年") + 2018, number(r"平成(\d+)年") + 1988)
    wide = F.translate(F.regexp_extract(t, "第([１-４])四半期", 1), "１２３４", "1234")
    half = F.when(t.contains("中間") | t.contains("INTERIM") | t.contains("HALF"), 2)
    quarter = F.coalesce(number("Q([1-4])"), number("([1-4])Q"), number("-([1-4])"), number("第([1-4])四半期"), F.nullif(wide, F.lit("")).cast("int"), half, F.lit(4))
    return F.when(year != 0, F.struct(year.alias("year"), quarter.alias("quarter")))


def summary_quarter(header: Column, context: Column) -> Column:
    """The quarter of a summary: that of its header if it is one to four, else by its context's id, 99 for a year."""
    told = F.when(F.trim(header).rlike(r"^\d+$"), F.trim(header).try_cast("int"))
    low = F.lower(context)
    by_id = F.when(low.contains("accumulatedq3"), 3).when(low.contains("accumulatedq2"), 2).when(low.contains("accumulatedq1"), 1).otherwise(99)
    return F.when(told.between(1, 4), told).otherwise(by_id)


def filled(first: DataFrame, second: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows of both by key: fields of the first, those it lacks from the second; the second as a whole where the first has no row."""
    other = second.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    return first.join(other, key, "full").select(key, *[F.coalesce(c, f"_{c}").alias(c) for c in columns])


def is_valid_context(context: Column, period: Column) -> Column:
    """Whether a context is of the current period and consolidated, or names no member; by its kind of period."""
    low = F.lower(context)
    whole = low.contains("consolidatedmember") | ~low.contains("member")
    flow = (period == "duration") & (low.contains("current") | low.contains("result")) & low.contains("duration")
    stock = (period == "instant") & low.contains("current") & low.contains("instant")
    return ~low.contains("nonconsolidatedmember") & whole & (flow | stock)


def with_figures(sections: DataFrame, role: str) -> DataFrame:
    """Sections without narrative ones, which hold no facts."""
    return sections.where(F.col(role).isNull() | (F.col(role) != "ナラティブ"))


def primary_file(files: DataFrame, key: str, path: str) -> DataFrame:
    """The page of each package whose name, whatever its folder, comes first."""
    name = F.element_at(F.split(path, "/"), -1)
    return files.where(F.lower(name).rlike(r"\.html?$")).groupBy(key).agg(F.min_by(path, F.struct(name, F.col(path))).alias(path))


def is_statement_file(path: Column) -> Column:
    """Whether a file of a package holds statements: instances, inline pages and XML but for linkbases."""
    low = F.lower(path)
    return low.endswith(".xbrl") | low.endswith("-ixbrl.htm") | (low.endswith(".xml") & ~low.rlike("def|pre|cal|lab"))
