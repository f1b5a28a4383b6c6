"""Small column functions: names, dates, paths, formats, headings, file choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Headings and their sections, in order; the order decides among partial matches.
HEADINGS = [
    ("今後の見通し", "outlook"),
    ("重要な後発事象", "subsequent_event"),
    ("配当方針", "capital_policy"),
    ("経営成績等の概況", "performance"),
    ("会計基準の選択に関する基本的な考え方", "accounting_policy"),
    ("1．経営成績等の概況", "performance"),
    ("（1）当期の経営成績の概況", "performance"),
    ("（2）当期の財政状態の概況", "financial_position"),
    ("（3）今後の見通し", "outlook"),
    ("2．会計基準の選択に関する基本的な考え方", "accounting_policy"),
    ("3．連結財務諸表及び主な注記", "financial_statements"),
    ("（1）連結財政状態計算書", "balance_sheet"),
    ("（2）連結損益計算書及び連結包括利益計算書", "income_statement"),
    ("（3）連結持分変動計算書", "equity_statement"),
    ("（4）連結キャッシュ・フロー計算書", "cash_flow"),
    ("（5）連結財務諸表に関する注記事項", "notes"),
    ("①　国内損害保険事業", "segment_analysis"),
    ("②　海外保険事業", "segment_analysis"),
    ("③　国内生命保険事業", "segment_analysis"),
    ("④　介護事業", "segment_analysis"),
    ("1.報告セグメントの概要", "segment_analysis"),
    ("2.報告セグメントごとの収益、利益または損失その他の項目の金額の算定方法", "segment_analysis"),
    ("3.報告セグメントごとの収益、利益または損失その他の項目の金額に関する情報", "segment_analysis"),
    ("4.製品およびサービスごとの情報", "segment_analysis"),
    ("セグメント情報", "segment_analysis"),
    ("１株当たり情報", "per_share_info"),
    ("1.基本的1株当たり当期利益", "per_share_info"),
    ("2.希薄化後 1株当たり当期利益", "per_share_info"),
    ("(重要な後発事象)", "capital_policy"),
    ("(1) 収益", "geographical_analysis"),
    ("(2) 非流動資産", "geographical_analysis"),
    ("IFRSへの移行に関する開示", "ifrs_transition"),
    ("1.遡及適用に対する免除規定", "ifrs_transition"),
    ("2.IFRS第1号の遡及適用に対する強制的な例外規定", "ifrs_transition"),
    ("3.日本基準からIFRSへの調整", "ifrs_transition"),
    ("(1) 企業結合", "ifrs_transition"),
    ("(3) 移行日前に認識した金融商品の指定", "ifrs_transition"),
    ("(4) 保険契約", "ifrs_transition"),
    ("(5) 借手のリース", "ifrs_transition"),
    ("(1) 「現金及び現金同等物」", "accounting_policy"),
    ("(6) 「金利収益」および「その他の投資損益」", "accounting_policy"),
    ("(8) 「その他の収益」および「その他の費用」", "accounting_policy"),
    ("(10) 連結の範囲", "accounting_policy"),
    ("(11) 報告期間の統一", "accounting_policy"),
    ("(13) 金融商品の分類および測定", "accounting_policy"),
    ("(15) 借手のリース", "accounting_policy"),
    ("(17) 保険契約および再保険契約", "accounting_policy"),
    ("(18) 確定給付制度に係る確定給付制度債務", "accounting_policy"),
    ("(19) 株式給付信託(BBT)", "accounting_policy"),
    ("(21) 繰延税金資産および繰延税金負債", "accounting_policy"),
    ("(14) ヘッジ会計", "risk_management"),
    ("継続企業の前提に関する注記", "going_concern"),
    ("追加情報", "regulatory_compliance"),
    ("添付資料の目次", "table_of_contents"),
]
HEADING_WORDS = [
    ("ifrs_transition", ["ifrs", "会計", "基準", "測定", "認識", "遡及", "移行", "調整", "企業結合", "連結", "現金及び現金同等物"]),
    ("segment_analysis", ["セグメント", "事業", "報告", "収益", "地域"]),
    ("per_share_info", ["株", "1株", "eps", "希薄化"]),
    ("risk_management", ["リスク", "ヘッジ", "デリバティブ"]),
    ("capital_policy", ["株式", "配当", "自己株式", "資本", "後発"]),
    ("accounting_policy", ["金融商品", "リース", "保険契約", "給付", "税金"]),
]


def heading_section(heading: Column, known=HEADINGS, words=HEADING_WORDS) -> Column:
    """The section of a heading: an exact one, then the first that holds it or lies in it, then by keywords."""
    key = F.regexp_replace(F.coalesce(heading, F.lit("")), r"(?U)\s+", "")
    out = F.when(key == "", "unknown")
    exact = dict(known)
    out = out.when(key.isin(list(exact)), F.element_at(F.create_map(*[F.lit(x) for kv in exact.items() for x in kv]), key))
    for name, section in known:
        out = out.when(F.lit(name).contains(key) | key.contains(name), section)
    low = F.lower(key)
    for section, some in words:
        found = F.lit(False)
        for w in some:
            found = found | low.contains(w)
        out = out.when(found, section)
    return out.otherwise("general")


def day_list(df: DataFrame, first: str, last: str, name: str = "day") -> DataFrame:
    """A row for each day of a span, both ends included, the latest first."""
    return df.withColumn(name, F.explode(F.sequence(F.col(last), F.col(first), F.expr("INTERVAL -1 DAY"))))


def rebased(path: Column, old: str, new: str) -> Column:
    """Absolute paths as they are; others below the new base, without the old one if they begin with it."""
    old, new = old.rstrip("/"), new.rstrip("/")
    inside = (path == old) | path.startswith(old + "/")
    rest = F.when(inside, F.substring(path, F.lit(len(old) + 2), F.length(path))).otherwise(path)
    return F.when(path.isNull() | path.startswith("/"), path).otherwise(F.concat_ws("/", F.lit(new), F.nullif(rest, F.lit(""))))


def english_part(name: Column) -> Column:
    """The part of `English [Japanese]` before the brackets."""
    found = F.regexp_extract(name, r"^(.+?)\s*\[(.+?)\]$", 1)
    return F.trim(F.when(found != "", found).otherwise(name))


def japanese_part(name: Column) -> Column:
    return F.nullif(F.trim(F.regexp_extract(name, r"^(.+?)\s*\[(.+?)\]$", 2)), F.lit(""))


def shown_value(value: Column, places: int = 0) -> Column:
    """A number with group signs, `-` for none."""
    return F.when(value.isNull(), "-").otherwise(F.format_number(value, places))


def package_code(name: Column) -> Column:
    """The company code in a package's name: between underscores, else the first five or six digits."""
    first = F.regexp_extract(name, r"_(\d{4,6})_", 1)
    return F.when(first != "", first).otherwise(F.coalesce(F.nullif(F.regexp_extract(name, r"(\d{5,6})", 1), F.lit("")), F.lit("000000")))


def package_date(name: Column) -> Column:
    """The end of the month that a package's name tells, null without one."""
    year, month = (F.nullif(F.regexp_extract(name, r"(\d{4})年(\d{1,2})月", i), F.lit("")).cast("int") for i in (1, 2))
    return F.last_day(F.when(month.between(1, 12), F.make_date(year, month, F.lit(1))))


def file_choice(xbrl: Column, pdf: Column, has_narrative: Column, prefer_xbrl: bool = True, need_narrative: bool = True) -> Column:
    """(path, method) of the file to read: the report if preferred and there, else the document, else the report, else none."""
    ok = F.coalesce(xbrl != "", F.lit(False)) & (F.coalesce(has_narrative, F.lit(False)) if need_narrative else F.lit(True))
    there = F.coalesce(pdf != "", F.lit(False))
    pick = lambda p, m: F.struct(p.alias("path"), F.lit(m).alias("method"))
    out = F.when(ok, pick(xbrl, "xbrl")).when(there, pick(pdf, "pdf")) if prefer_xbrl else F.when(there, pick(pdf, "pdf")).when(ok, pick(xbrl, "xbrl"))
    return out.otherwise(pick(F.lit(""), "none"))


def document_kind(pages: DataFrame, key: str, page: str, text: str, first: int = 3) -> DataFrame:
    """Whether the first pages of a document are text, image or mixed, by how much text they have."""
    n = F.length(F.trim(F.coalesce(F.col(text), F.lit(""))))
    some = pages.where(F.col(page) < first).groupBy(key).agg(F.avg(n).alias("_mean"), (F.count_if(n > 50) / F.count(F.lit(1))).alias("_share"))
    kind = F.when((F.col("_mean") > 200) & (F.col("_share") > 0.5), "text").when((F.col("_mean") < 50) & (F.col("_share") < 0.3), "image").otherwise("mixed")
    return some.select(key, kind.alias("kind"))


def longest_context(contexts: DataFrame, key: str, name: str, start: str, end: str, order: str) -> DataFrame:
    """The context of the longest span of each key, then the latest end, then the first."""
    days = F.datediff(end, start)
    rows = contexts.where(days.isNotNull())
    return rows.groupBy(key).agg(F.max_by(name, F.struct(days, F.col(end), -F.col(order))).alias(name))


def mean_vector(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, vector): the mean by component of the vectors of each key."""
    parts = vectors.select(key, F.posexplode(F.col(vector).cast("array<double>")).alias("_i", "_x")).groupBy(key, "_i").agg(F.avg("_x").alias("_x"))
    return parts.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_x"))), lambda p: p["_x"]).alias(vector))
