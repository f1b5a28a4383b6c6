"""Query analysis, filtered vector search, re-ranking and snippets."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.operators.classify import cosine, doubles

# Terms of queries and what they stand for, in order.
TERMS = {
    "earnings": ["決算", "業績", "売上", "収益", "利益", "営業利益", "純利益", "経常利益"],
    "revenue": ["売上高", "売上", "収益", "営業収益", "売上収入"],
    "profit": ["利益", "純利益", "営業利益", "経常利益", "当期純利益"],
    "operating_income": ["営業利益", "営業収益"],
    "net_income": ["純利益", "当期純利益", "最終利益"],
    "dividend": ["配当", "配当金", "配当性向", "増配", "減配", "特別配当"],
    "buyback": ["自己株式取得", "株式買戻し", "自社株買い"],
    "split": ["株式分割", "株式併合"],
    "merger": ["合併", "買収", "M&A", "統合"],
    "guidance": ["業績予想", "業績見通し", "計画", "予測", "見込み", "修正"],
    "forecast": ["予想", "見通し", "計画", "予測", "見込み"],
    "revision": ["修正", "変更", "見直し", "上方修正", "下方修正"],
    "market_share": ["市場シェア", "シェア", "市場占有率"],
    "competition": ["競合", "競争", "ライバル"],
    "expansion": ["拡大", "展開", "進出", "成長"],
    "debt": ["負債", "借入", "有利子負債", "借入金"],
    "cash": ["現金", "キャッシュ", "現金同等物"],
    "assets": ["資産", "総資産", "流動資産", "固定資産"],
    "equity": ["純資産", "株主資本", "自己資本"],
    "quarterly": ["四半期", "Q1", "Q2", "Q3", "Q4", "第1四半期", "第2四半期", "第3四半期", "第4四半期"],
    "annual": ["年間", "通期", "年度", "期", "年次"],
    "monthly": ["月次", "月間", "毎月"],
}
TIMES = ["最近", "直近", "最新", "今回", "前年", "前期", "昨年", "去年", "過去", "来年", "次期", "将来", "今後", "予定", "比較", "対比", "前年同期", "同期"]
METRICS = ["利益率", "売上高", "ROE", "ROA", "営業利益率", "配当利回り"]
TYPES = [
    ("comparative", ["compare", "vs", "versus", "比較", "対比"]),
    ("temporal", ["trend", "change", "increase", "decrease", "変化", "推移", "増加", "減少", "recent", "last", "latest", "quarter", "最近", "直近"]),
    ("analytical", ["analysis", "performance", "ratio", "分析", "業績", "指標"]),
]


def contains_any(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def query_type(query: Column) -> Column:
    text = F.lower(query)
    out = F.when(F.lit(False), F.lit("simple"))
    for name, words in TYPES:
        out = out.when(contains_any(text, words), name)
    return out.otherwise("simple")


def query_terms(query: Column, terms: dict[str, list[str]] = TERMS) -> Column:
    """Terms found, once for every way in which a query finds them."""
    text, found = F.lower(query), []
    for name, words in terms.items():
        found.append(F.when(text.contains(name.replace("_", " ")), F.array(*map(F.lit, words))).otherwise(F.array().cast("array<string>")))
        found.append(F.array_compact(F.array(*[F.when(query.contains(w) | text.contains(w.lower()), F.lit(w)) for w in words])))
    return F.flatten(F.array(*found))


def expanded_query(query: Column, terms: dict[str, list[str]] = TERMS) -> Column:
    """The query and the terms that it brings with it, each once and in their order."""
    text, found = F.lower(query), [F.array(query)]
    none = F.array().cast("array<string>")
    for name, words in terms.items():
        found.append(F.when(text.contains(name), F.array(*map(F.lit, words))).otherwise(none))
        found.append(F.when(contains_any(query, words), F.array(F.lit(name), *map(F.lit, words))).otherwise(none))
    return F.array_join(F.array_distinct(F.flatten(F.array(*found))), " ")


def analyse_queries(queries: DataFrame, query: str) -> DataFrame:
    q = F.col(query)
    found = lambda words: F.array_compact(F.array(*[F.when(q.contains(w), F.lit(w)) for w in words]))
    return queries.withColumns({"query_type": query_type(q), "terms": query_terms(q), "companies": F.regexp_extract_all(q, F.lit(r"(?U)\b(\d{4})\b"), F.lit(1)), "times": found(TIMES), "metrics": found(METRICS), "expanded": expanded_query(q)})


def predicate(filters: dict, columns: dict[str, str]) -> Column:
    """Equality, membership (a list) or a range (a pair) on the columns that the filters name; None adds nothing."""
    out = F.lit(True)
    for name, wanted in filters.items():
        c = F.col(columns.get(name, name))
        if isinstance(wanted, tuple):
            low, high = wanted
            out = out & (F.lit(True) if low is None else c >= low) & (F.lit(True) if high is None else c <= high)
        elif isinstance(wanted, list):
            out = out & c.isin(wanted)
        elif wanted is not None:
            out = out & (c == wanted)
    return out


def vector_search(vectors: DataFrame, key: str, vector: str, query: list[float], k: int = 150, least: float = 0.01, where: Column | None = None) -> DataFrame:
    """The k rows most similar to a query vector, by cosine over `least`; ties to the smaller key.

    The filter is below the score, which is a projection; the end is one top-k, of
    which each task sends k rows.
    """
    rows = vectors if where is None else vectors.where(where)
    scored = rows.withColumn("score", cosine(doubles(F.col(vector)), F.array(*[F.lit(float(x)) for x in query])))
    return scored.where(F.col("score") > least).orderBy(F.desc("score"), F.asc(key)).limit(k)


def rerank(hits: DataFrame, *, query_type: str, terms: list[str], as_of, key: str = "id") -> DataFrame:
    """Hits (id, score, date, title, code, category) with boosts and penalties, best first.

    Recent hits rise for temporal queries, hits whose title holds a term rise once for
    each time the term is listed, reports rise for comparisons, and hits of a company
    that has more than two better ones sink.
    """
    boost = F.lit(0.0)
    if query_type == "temporal":
        age = F.datediff(F.lit(as_of).cast("date"), F.col("date"))
        boost = boost + F.when(age < 30, 0.1).when(age < 90, 0.05).otherwise(0.0)
    for term in terms:
        boost = boost + F.when(F.col("title").contains(term), 0.05).otherwise(0.0)
    if query_type == "comparative":
        boost = boost + F.when(F.col("category") == "earnings", 0.1).otherwise(0.0)
    stage = F.row_number().over(W.orderBy(F.desc("score"), F.asc(key)))  # of 150 hits at most
    earlier = F.row_number().over(W.partitionBy("code").orderBy("stage_rank")) - 1
    out = hits.withColumn("stage_rank", stage).withColumn("earlier", earlier)
    out = out.withColumn("final_score", F.col("score") + boost - F.when(F.col("earlier") > 2, 0.05 * (F.col("earlier") - 2)).otherwise(0.0))
    return out.orderBy(F.desc("final_score"), F.asc("stage_rank"))


def snippet(text: Column, chars: int = 2000, least: int = 20, lines: int = 3) -> Column:
    """The first lines of some length among the first characters of a text."""
    cut = F.transform(F.split(F.substring(text, 1, chars), "\n"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))
    return F.array_join(F.slice(F.filter(cut, lambda x: F.length(x) > least), 1, lines), " ")


def company_statistics(disclosures: DataFrame) -> DataFrame:
    return disclosures.groupBy("company_code").agg(F.count_distinct("id").alias("n_disclosures"), F.min("disclosure_date").alias("first_date"), F.max("disclosure_date").alias("last_date"))



def cache_key(query: Column, filters: Column, k: Column) -> Column:
    return F.md5(F.concat_ws("|", query, filters, k.cast("string")).cast("binary"))


def embedded(documents: DataFrame, key: str, text: str, model, failed: DataFrame | None = None, size: int = 4000, rows: int = 500) -> DataFrame:
    """(key, embedding): the mean of a model's vectors of each document's pieces of `size` characters.

    model maps a list of texts to as many lists of numbers and is called with up to
    `rows` of them. Documents listed in failed are left out, and those without text.
    """
    from ledgerloom.functions.columns import mean_vector
    from ledgerloom.operators.text import fixed_chunks

    @F.pandas_udf("array<double>")
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            found = [[float(x) for x in v] for i in range(0, len(s), rows) for v in model(s.iloc[i : i + rows].tolist())]
            yield pd.Series(found, dtype=object)

    wanted = documents if failed is None else documents.join(failed.select(key).distinct(), key, "left_anti")
    pieces = fixed_chunks(wanted.where(F.length(text) > 0), key, text, size)
    return mean_vector(pieces.select(key, vectors("content").alias("embedding")), key, "embedding")
