"""Text of disclosures: normalisation, features, categories, chunks, quality and duplicates."""

from __future__ import annotations

import difflib
import re
import unicodedata
from collections import Counter
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.operators.retrieval import contains_any

# Signs replaced one by one, and those replaced by several signs.
SINGLE = (
    "△▲％－−–—～〜∼０１２３４５６７８９（）［］｛｝「」『』：；，．？！／＋＝＜＞＊＃＠＆\u3000\u00a0\u2009\u200a\u2002\u2003",
    "--%----~~~0123456789()[]{}\"\"'':;,.?!/+=<>*#@&      ",
)
SEVERAL = dict(zip("①②③④⑤⑥⑦⑧⑨⑩", [f"{i}." for i in range(1, 11)]))
CIRCLED = re.compile(f"([{''.join(SEVERAL)}])")


def compatible(text: str) -> str:
    """Compatibility form of all but the circled numbers, which normalise() spells out; signs that belong together are composed."""
    if text.isascii() or unicodedata.is_normalized("NFKC", text):
        return text
    return "".join(x if x in SEVERAL else unicodedata.normalize("NFKC", x) for x in CIRCLED.split(text))


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out once, however often f reads it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def nfkc(text: Column) -> Column:
    """Compatibility form; no built-in has it."""

    @F.pandas_udf("string")
    def form(s: pd.Series) -> pd.Series:
        return s.map(compatible, na_action="ignore")

    return form(text)


#: All full-width ASCII signs, and others with one of their own.
PLAIN = ("".join(chr(0xFF01 + i) for i in range(94)) + "\u3000「」『』", "".join(chr(0x21 + i) for i in range(94)) + " \"\"''")


def spelled(text: Column) -> Column:
    """One spelling for full-width letters, numbers and punctuation; triangles and white space stay."""
    t = F.translate(text, *PLAIN)
    for old, new in SEVERAL.items():
        t = F.replace(t, F.lit(old), F.lit(new))
    return t


def normalise(text: Column, compatibility: bool = True) -> Column:
    """One spelling for full-width signs, dashes, quotes and numbers; white space as single spaces."""
    t = F.translate(text, "\u3000", " ")
    t = F.translate(nfkc(t) if compatibility else t, *SINGLE)
    for old, new in SEVERAL.items():
        t = F.replace(t, F.lit(old), F.lit(new))
    t = F.regexp_replace(t, r"(?U)(?<=\d),(?=\d{3})", "")
    return strip(F.regexp_replace(t, r"(?U)\s+", " "))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def without_row_numbers(text: Column) -> Column:
    """Text without a leading `2:` as tables number their rows; a sign before digits stays."""
    return F.regexp_replace(text, r"^\s*\d{1,2}:\s*", "")


def tokens(text: Column) -> Column:
    """A third of the characters, one at least; none for none."""
    n = F.length(text)
    return F.when(n == 0, 0).otherwise(F.greatest(F.lit(1), F.floor(n / 3).cast("int")))


def ratio(text: Column, pattern: str) -> Column:
    """The share of a text that matches; null for an empty text, as for null."""
    return F.regexp_count(text, F.lit(pattern)) / F.nullif(F.length(text), F.lit(0))


def signs(text: Column, some: str) -> Column:
    """How many of some signs a text has."""
    return F.length(text) - F.length(F.translate(text, some, ""))


DIGIT, MONEY, TABLE, JAPANESE = r"\p{Nd}", ".,|-△▲%", "|:()[]", "[぀-ヿ一-龯]"


def is_numeric(text: Column) -> Column:
    """Whether a chunk is mostly numbers or table."""
    lines = F.transform(F.split(text, "\n"), strip)
    dense = F.size(F.filter(lines, lambda x: (F.length(x) > 5) & ((F.regexp_count(x, F.lit(DIGIT)) + signs(x, MONEY + ":()[]")) / F.length(x) > 0.5)))
    by_line = (F.size(lines) > 1) & (dense / F.size(lines) > 0.6)
    shares = F.struct(ratio(text, DIGIT).alias("digits"), (signs(text, MONEY) / F.length(text)).alias("money"), (signs(text, TABLE) / F.length(text)).alias("table"), ratio(text, JAPANESE).alias("ja"))
    told = bound(shares, lambda s: (s["digits"] > 0.15) | (s["money"] > 0.10) | (s["digits"] + s["money"] > 0.20) | ((s["table"] > 0.05) & (s["ja"] < 0.5)) | ((s["ja"] < 0.25) & (s["digits"] + s["money"] > 0.15)))
    return F.when(text.isNull() | (F.length(strip(text)) < 20), False).otherwise(told | by_line)


NUMERIC = r"[\p{Nd}.,|\-△▲]"


def should_vectorise(text: Column, section: Column, length: Column, n_tokens: Column, numeric: Column | None, sections=("table", "financial_summary")) -> Column:
    """Whether a chunk is worth a vector; without a numeric flag its share of numbers decides, by length."""
    share = ratio(text, NUMERIC)
    tiers = ((length > 400) & (share > 0.25)) | ((length > 200) & (share > 0.35)) | ((length > 100) & (share > 0.50)) | (share > 0.60)
    out = F.when(tiers if numeric is None else F.when(numeric.isNull(), tiers).otherwise(numeric), False)
    out = out.when((length < 50) | (n_tokens < 15), False)
    out = out.when(section.isin(*sections) & (share > 0.25), False)
    out = out.when((F.length(strip(text)) > 0) & (ratio(text, r"[|:0-9.,()\-△▲ \t]") > 0.80), False)
    return out.otherwise(True)


# Keywords of sections and content types, first match first.
SECTIONS = [
    ("outlook", ["見通し", "予想", "予測", "見込み", "計画", "目標"]),
    ("capital_policy", ["配当", "自己株式", "株主還元", "資本政策", "後発事象"]),
    ("segment_analysis", ["セグメント", "事業", "報告", "収益", "地域"]),
    ("per_share_info", ["株", "1株", "eps", "希薄化"]),
    ("accounting_policy", ["会計", "基準", "ifrs", "日本基準", "測定", "認識"]),
    ("financial_position", ["財政状態", "キャッシュ", "資産", "負債"]),
    ("performance", ["経営成績", "業績", "損益", "売上", "利益"]),
]
SECTION_OF_TYPE = {"financial_summary": "performance", "management_discussion": "performance", "table": "financial_statements", "organizational": "notes", "regulatory": "regulatory_compliance", "risk_factors": "risk_management", "business_overview": "segment_analysis", "equity_matters": "capital_policy", "notes": "notes", "header_footer": "general"}
#: (type, keywords of the heading, keywords of the text)
TYPES = [
    ("forecast", ["見通し", "予想", "予測", "見込み", "計画", "目標"], ["次連結会計年度", "来期", "予想", "見込み", "予測", "次期"]),
    ("capital_policy", ["配当", "自己株式", "株主還元", "資本政策", "後発事象"], ["配当", "自己株式", "株主還元", "資本効率", "株式分割"]),
    ("risk_management", ["リスク", "ヘッジ", "リスク管理"], ["ヘッジ", "リスク", "デリバティブ", "金利リスク", "為替リスク"]),
    ("accounting_policy", ["会計", "基準", "ifrs", "日本基準", "測定", "認識"], ["会計処理", "測定方法", "ifrs", "会計基準", "償却", "減価償却"]),
    ("segment_analysis", ["セグメント", "事業", "損害保険", "生命保険", "介護"], ["セグメント", "事業部門", "報告セグメント", "保険事業"]),
    ("per_share_metrics", ["1株当たり", "株当たり", "eps"], ["1株当たり", "期中平均", "希薄化", "株式数"]),
    ("geographical_analysis", ["地域", "国内", "海外", "収益"], ["日本", "海外", "国内", "所在地", "地域別"]),
    ("management_discussion", ["経営成績", "業績", "財政状態"], ["世界経済", "経営環境", "市場環境", "業績"]),
    ("financial_position", ["財政状態", "キャッシュ", "資産", "負債"], ["資産合計", "資本合計", "キャッシュフロー", "現金"]),
    ("financial_metrics", [], ["売上", "利益", "収益", "損失", "百万円", "億円"]),
    ("regulatory_compliance", ["継続企業", "注記", "法人税", "税率"], ["法律", "規制", "適時開示", "法人税法"]),
]
TABLE_WORDS = ["株式", "割当", "譲渡制限", "取締役", "監査等委員", "報酬", "新株予約権"]
TABLE_PATTERN = r"(?U)株\s*数|金\s*額|[0-9,]+\s*円|[0-9,]+\s*株"
GOVERNANCE = ["取締役", "ガバナンス", "経営陣", "監査", "組織変更", "人事異動"]
BUSINESS = ["事業", "業務", "製品", "サービス", "市場", "顧客", "販売"]
NOTES = ["注記", "補足", "説明", "詳細", "参考"]
FRONT = ["各位", "会社名", "代表者", "コード"]
SIZES = {"table": 800, "financial_summary": 600, "organizational": 400, "regulatory": 500, "management_discussion": 700, "risk_factors": 500, "business_overview": 600, "equity_matters": 500, "notes": 400, "header_footer": 200, "general": 500}
TRANSITION = ["日本基準", "IFRS", "表示組替", "認識および測定の差異", "調整額", "移行日", "前連結会計年度", "当連結会計年度", "資本に対する調整", "包括利益に対する調整"]
UNIT_PHRASES = ["(単位:", "百万円)", "自 2023年", "至 2024年", "至 2025年"]


def section_code(text: Column, content_type: Column, ladder=SECTIONS) -> Column:
    low = F.lower(text)
    out = F.when(F.lit(False), F.lit(""))
    for name, words in ladder:
        out = out.when(contains_any(low, words), name)
    return out.otherwise(chosen(content_type, SECTION_OF_TYPE, F.lit("general")))


def chosen(value: Column, table: dict, last: Column) -> Column:
    out = F.when(F.lit(False), last)
    for k, v in table.items():
        out = out.when(value == k, F.lit(v))
    return out.otherwise(last)


def content_type(text: Column, heading: Column, page: Column, types=TYPES) -> Column:
    """The first type whose keywords are in the heading or the text, then what tables and the rest look like."""
    t = F.regexp_replace(F.lower(text), r"(?U)\s+", " ")
    h = F.regexp_replace(F.lower(F.coalesce(heading, F.lit(""))), r"(?U)\s+", " ")
    out = F.when(F.lit(False), F.lit(""))
    for name, in_heading, in_text in types:
        found = contains_any(t, in_text)
        out = out.when(found | contains_any(h, in_heading) if in_heading else found, name)
    piped = t.contains("|") & contains_any(t, ["\\d+", "百万円", "千円"])
    out = out.when(piped | (contains_any(t, TABLE_WORDS) & t.rlike(TABLE_PATTERN)), "financial_table")
    out = out.when(contains_any(t, GOVERNANCE), "corporate_governance").when(contains_any(t, BUSINESS), "business_overview")
    out = out.when(contains_any(t, NOTES) | (page > 10), "notes")
    return out.when((F.length(t) < 100) & contains_any(t, FRONT), "header_footer").otherwise("general")


def chunk_size(content: Column, length: Column) -> Column:
    base = chosen(content, SIZES, F.lit(500))
    large = F.least(F.floor(base * 13 / 10), F.lit(900)).cast("int")
    return F.when(length < 200, length).when(length < 800, F.least(base, F.lit(400))).when(length > 3000, large).otherwise(base)


def fixed_chunks(df: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(key, chunk_index, content): pieces of `size` characters, the last one shorter."""
    n = F.ceil(F.length(text) / size).cast("int")
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return df.select(key, F.col(text), F.explode(starts).alias("chunk_index")).select(key, "chunk_index", F.substring(F.col(text), F.col("chunk_index") * size + 1, F.lit(size)).alias("content"))


def word_chunks(df: DataFrame, key: str, text: str, size: int, overlap: int) -> DataFrame:
    """(key, chunk_index, content): windows of `size` words, each starting `overlap` words before the last ended."""
    step = size - overlap
    words = F.filter(F.split(F.col(text), r"\s+"), lambda w: w != "")
    rows = df.select(key, words.alias("_words"))
    n = F.greatest(F.lit(1), F.ceil((F.size("_words") - overlap) / step).cast("int"))
    rows = rows.where(F.size("_words") > 0).select(key, "_words", F.explode(F.sequence(F.lit(0), n - 1)).alias("chunk_index"))
    return rows.select(key, "chunk_index", F.array_join(F.slice("_words", F.col("chunk_index") * step + 1, F.lit(size)), " ").alias("content"))


SENTENCE = re.compile(r"[^。！？!?.\n]*(?:[。！？!?.\n]|\Z)")


def pack(text: str | None, size: int, least: int = 30) -> list[str]:
    """Sentences in order, as many in a chunk as fit; a longer sentence is cut; chunks below `least` go."""
    out, held = [], ""
    for sentence in SENTENCE.findall(text or ""):
        if len(held) + len(sentence) > size:
            if held:
                out.append(held)
            cut = (len(sentence) - 1) // size * size
            out += [sentence[i : i + size] for i in range(0, cut, size)]
            held, sentence = "", sentence[cut:]
        held += sentence
    return [x.strip() for x in [*out, held] if len(x.strip()) >= least]


def sentence_chunks(df: DataFrame, key: str, text: str, size: int = 600) -> DataFrame:
    """(key, chunk_index, content) by pack(), in Arrow batches."""

    @F.pandas_udf("array<string>")
    def packed(s: pd.Series) -> pd.Series:
        return s.map(lambda x: pack(x, size))

    return df.select(key, F.posexplode(packed(F.col(text))).alias("chunk_index", "content"))


def low_information(text: Column) -> Column:
    low = strip(F.lower(text))
    words = F.filter(F.split(low, r"(?U)\s+"), lambda w: w != "")
    dull = (F.size(words) > 10) & (F.size(F.array_distinct(words)) / F.size(words) < 0.3)
    units = contains_any(text, UNIT_PHRASES) & (F.length(text) < 200)
    dates = low.rlike(r"(?U)^[（\(]?自?\s*\d{4}年\d{1,2}月\d{1,2}日.*至?\s*\d{4}年\d{1,2}月\d{1,2}日[）\)]?$")
    return dull | units | dates


def removal_reason(text: Column, section: Column) -> Column:
    """Why a chunk is dropped, or null. Chunks over 200 characters are not looked at after the numbers rule."""
    n, pipes = F.length(text), F.regexp_count(text, F.lit(r"\|"))
    share = (pipes + F.regexp_count(text, F.lit(DIGIT))) / n
    numeric = ((n > 1000) & (share > 0.20)) | ((n > 500) & (share > 0.25)) | (share > 0.35)
    cut = strip(text).startswith("|") | strip(text).rlike("^[2-7]:") | ((pipes > 20) & (n < 500))
    out = F.when(section == "table_of_contents", "table_of_contents").when(n < 100, "very_short")
    out = out.when(section.isin("balance_sheet", "cash_flow") & (n > 800), "mega_tables").when((section == "equity_statement") & (n > 1000), "mega_tables")
    out = out.when(contains_any(text, TRANSITION) & (n > 800) & (pipes > 15), "mega_tables")
    out = out.when(n > 200, F.when(numeric, "mostly_numeric"))
    return out.when(cut, "continuation_fragments").when(low_information(text), "low_information")


def exact_duplicates(chunks: DataFrame, group: str, content: str, order: str) -> DataFrame:
    """The first chunk of each content in a group, numbered anew."""
    digest = F.sha2(F.col(content).cast("binary"), 256)
    first = chunks.withColumn("_d", digest).withColumn("_n", F.row_number().over(W.partitionBy(group, "_d").orderBy(order))).where("_n = 1").drop("_n", "_d")
    return first.withColumn("new_index", F.row_number().over(W.partitionBy(group).orderBy(order)) - 1)


def heading_groups(chunks: DataFrame, group: str, heading: str, content: str, order: str) -> DataFrame:
    """Of chunks under one heading the longest, or none if they look like a table cut in parts."""
    key = W.partitionBy(group, "_h")
    n = F.length(content)
    share = F.regexp_count(F.col(content), F.lit(r"[\p{Nd}|]")) / n
    marked = chunks.withColumn("_h", strip(F.col(heading))).withColumns({"_large": F.count(F.when(n > 500, 1)).over(key), "_share": F.avg(F.when(n > 500, share)).over(key), "_size": F.count(F.lit(1)).over(key)})
    best = F.row_number().over(key.orderBy(n.desc(), F.asc(order)))
    table = (F.col("_size") > 1) & (F.col("_large") > 1) & (F.col("_share") > 0.15)
    return marked.withColumn("_n", best).where((F.col("_n") == 1) & ~F.coalesce(table, F.lit(False))).drop("_h", "_large", "_share", "_size", "_n")


def alike(a: str, b: str, least: float) -> bool:
    """Whether the similarity of two texts is above `least`; cheap upper bounds come first."""
    m = difflib.SequenceMatcher(None, a, b)
    return m.real_quick_ratio() > least and m.quick_ratio() > least and m.ratio() > least


class Grams:
    """Counts of signs and of hashed pairs, triples and fours of signs in some texts, which bound what difflib finds in common.

    The blocks that two texts share are in order and do not overlap, so a block of s signs takes s - 1 pairs, s - 2 triples and s - 3
    fours that both have. Each holds a sign that difflib looks for (in a second text of 200 signs or more, those that are no more than a hundredth of it)
    but one at the very start, as a block goes on until signs differ. Hashes that clash raise the bounds only.
    """

    def __init__(self, texts: list[str], buckets: int = 2048):
        self.texts, self.size = texts, np.array([len(x) for x in texts], np.int64)
        kind = np.uint16 if self.size.max(initial=0) < 1 << 16 else np.uint32
        signs = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        of = np.repeat(np.arange(len(texts)), self.size)
        names, signs = np.unique(signs, return_inverse=True)
        self.one = self.counted(of, signs, len(names), kind)
        sought = (self.size < 200) | (self.one <= self.size // 100 + 1)
        self.sought = np.where(sought, self.one, 0).astype(kind)
        pair = signs[:-1] * 0x9E3779B1 + signs[1:] * 0x85EBCA6B
        triple = pair[:-1] * 31 + signs[2:] * 0xC2B2AE35
        four = triple[:-1] * 31 + signs[3:] * 0x27D4EB2F
        self.more = [self.counted(of[q:][same := of[q:] == of[:-q]], (code[same] >> 12) & (buckets - 1), buckets, kind) for q, code in ((1, pair), (2, triple), (3, four))]

    def counted(self, of: np.ndarray, code: np.ndarray, codes: int, kind: type) -> np.ndarray:
        """How often each code is in each text: a row for each code."""
        out = np.zeros((codes, len(self.size)), kind)
        cuts = np.arange(0, len(self.size) + 1, 256)
        for at, begin, end in zip(cuts, np.searchsorted(of, cuts), np.searchsorted(of, cuts + 256)):
            n = min(256, len(self.size) - at)
            out[:, at : at + n] = np.bincount(code[begin:end] * n + of[begin:end] - at, minlength=codes * n).reshape(codes, n)
        return out

    def passing(self, a: int, others: np.ndarray, need: np.ndarray) -> np.ndarray:
        """Those of others (each as the second text) that may have more signs than it needs in blocks shared with text a; the finer grams look at what the coarser ones left."""

        def common(counts: np.ndarray, own: np.ndarray) -> np.ndarray:
            some = own[:, a].nonzero()[0]
            return np.minimum(counts[some[:, None], others], own[some, a][:, None]).sum(0, dtype=np.int64)

        found = [common(self.one, self.one)]
        left = found[0] > need
        others, need, found = others[left], need[left], [c[left] for c in found]
        if not len(others):
            return others
        blocks = common(self.sought, self.one) + 1
        for q, counts in enumerate(self.more, 1):
            found.append(common(counts, counts))
            left = found[q] + q * blocks > need
            others, need, blocks, found = others[left], need[left], blocks[left], [c[left] for c in found]
            if not len(others):
                return others
        return others[[self.in_order(a, b, n, c) for b, n, c in zip(others.tolist(), need.tolist(), zip(*found))]]

    def in_order(self, a: int, b: int, need: float, found) -> bool:
        """Whether text b as the second one may have more signs than needed, as the signs that blocks hold stand in one order in both texts."""
        x, y = self.texts[a], self.texts[b]
        signs = {c for c, n in Counter(y).items() if len(y) < 200 or n <= len(y) // 100 + 1}
        blocks = subsequence([c for c in x if c in signs], [c for c in y if c in signs]) + 1
        return all(c + q * blocks > need for q, c in enumerate(found))

    def following(self, most: float) -> np.ndarray:
        """Whether each text but the last may share a part over `most` of the shorter one with the next."""
        need = most * np.minimum(self.size[:-1], self.size[1:]) * (1 - 1e-9)
        common = lambda a, b: np.minimum(a[:, :-1], b[:, 1:]).sum(0, dtype=np.int64)
        found, blocks = [common(self.one, self.one), *(common(c, c) for c in self.more)], common(self.one, self.sought) + 1
        may = np.all([c + q * blocks > need for q, c in enumerate(found)], axis=0)
        for i in np.flatnonzero(may):
            may[i] = self.in_order(i, i + 1, need[i], [c[i] for c in found])
        return may


def subsequence(a: list[str], b: list[str]) -> int:
    """The length of the longest common subsequence, all places of a at once."""
    places, whole = {}, (1 << len(a)) - 1
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    free = whole
    for c in b:
        met = free & places.get(c, 0)
        free = ((free + met) | (free - met)) & whole
    return len(a) - free.bit_count()


def of_groups(rows: DataFrame, group: list[str], keep: Callable[..., list[int]], *columns: str) -> DataFrame:
    """Of the rows of each group, which are held at once, those in the places that keep() tells.

    Many groups go to Python together: keep() gets where each of them ends, and their columns one group after the other.
    """
    packed = rows.groupBy(*group).agg(F.collect_list(F.struct(*rows.columns)).alias("_rows")).select("_rows")

    def run(batches):
        for b in batches:
            lists = b.column("_rows")
            flat, ends = lists.flatten(), np.cumsum(lists.value_lengths().to_numpy())
            kept = sorted(keep(ends.tolist(), *(flat.field(c).to_pylist() for c in columns)))
            yield pa.RecordBatch.from_struct_array(flat.take(pa.array(kept, pa.int64())))

    return packed.mapInArrow(run, rows.schema)


def near_duplicates(chunks: DataFrame, group: str, content: str, order: str, kind: str, threshold: float = 0.80) -> DataFrame:
    """Chunks of each group that no longer chunk contains or resembles.

    Order decides, so a group is one call; groups are the chunks of one document. A
    chunk that lies within an accepted one (and is 5 % shorter) goes, or one whose
    sizes differ by less than 40 % and whose similarity passes the threshold of
    their kinds and sizes. Only pairs that Grams lets pass are compared.
    """

    def limit(a: str, b: str, x: str, y: str) -> float:
        t = threshold - 0.05 * (a == b == "financial_summary") + 0.05 * (a in ("notes", "general") or b in ("notes", "general"))
        return t - 0.1 * ((len(x) + len(y)) / 2 < 100)

    def keep(texts: list[str], places: list, kinds: list[str]) -> list[int]:
        # Longest first. A text is compared with the kept ones before it.
        by = sorted(range(len(texts)), key=lambda i: (-len(texts[i]), places[i]))
        texts, kinds = [texts[i].strip() for i in by], [kinds[i] for i in by]
        grams, kept = Grams(texts), np.zeros(len(by), bool)
        size, notes, summary = grams.size, np.array([k in ("notes", "general") for k in kinds], bool), np.array([k == "financial_summary" for k in kinds], bool)

        def goes(i: int) -> bool:
            near = kept[:i] & (np.minimum(size[:i], size[i]) >= 30)
            if any(texts[i] in texts[j] for j in np.flatnonzero(near & (size[i] < 0.95 * size[:i]))):
                return True
            near &= np.minimum(size[:i], size[i]) >= 0.6 * np.maximum(size[:i], size[i]) * (1 - 1e-9)
            near = np.flatnonzero(near)
            both = size[near] + size[i]
            least = threshold - 0.05 * (summary[i] & summary[near]) + 0.05 * (notes[i] | notes[near]) - 0.1 * (both < 200)
            for j in grams.passing(i, near, (least - 1e-9) * both / 2):
                x, y = texts[i], texts[j]
                if min(len(x), len(y)) / max(len(x), len(y)) >= 0.6 and difflib.SequenceMatcher(None, x, y).ratio() > limit(kinds[i], kinds[j], x, y):
                    return True
            return False

        for i in range(len(by)):
            kept[i] = not goes(i)
        return [by[i] for i in np.flatnonzero(kept)]

    def keep_each(ends: list[int], *values: list) -> list[int]:
        return [begin + i for begin, end in zip([0, *ends], ends) for i in keep(*[v[begin:end] for v in values])]

    return of_groups(chunks, [group], keep_each, content, order, kind)


def language_mix(text: Column) -> Column:
    """Whether a text is Japanese, English, mixed or other, by its letters."""
    letters = F.regexp_count(text, F.lit(r"\p{L}"))
    ja, en = F.regexp_count(text, F.lit(JAPANESE)), F.regexp_count(text, F.lit("[A-Za-z]"))
    a, b = ja / F.when(letters > 0, letters), en / F.when(letters > 0, letters)
    return F.when((a >= 0.3) & (b >= 0.3), "mixed").when(a > 0.7, "ja").when(b > 0.7, "en").otherwise("ja")


def shared(a: str, b: str) -> float:
    """The part of the shorter text that lies in blocks common to both, in order."""
    least = min(len(a), len(b))
    return sum(m.size for m in difflib.SequenceMatcher(None, a, b).get_matching_blocks()) / least if least else 0.0


def overlapping(chunks: DataFrame, group: list[str], content: str, order: str, most: float = 0.6) -> DataFrame:
    """Chunks of a page without those that repeat the last one kept; of two the longer stays.

    What is compared depends on what was kept, so a page is one call.
    """

    def keep(ends: list[int], texts: list[str], places: list) -> list[int]:
        by = [i for begin, end in zip([0, *ends], ends) for i in sorted(range(begin, end), key=lambda i: (places[i] is None, places[i]))]
        texts, out = [texts[i] for i in by], []
        may = np.concatenate([Grams(texts[i : i + 256]).following(most) for i in range(0, len(texts), 255)]) if texts else []
        for begin, end in zip([0, *ends], ends):
            kept = []
            for i in range(begin, end):
                last = kept[-1] if kept else None
                if kept and (may[last] or last < i - 1) and shared(texts[last], texts[i]) > most:
                    if len(texts[i]) > len(texts[last]):
                        kept[-1] = i
                else:
                    kept.append(i)
            out += kept
        return [by[i] for i in out]

    return of_groups(chunks, group, keep, content, order)


def standard_chunks(*kinds: DataFrame) -> DataFrame:
    """Chunks of several origins as one table; columns that an origin lacks are null."""
    out = kinds[0]
    for k in kinds[1:]:
        out = out.unionByName(k, allowMissingColumns=True)
    return out


def merged_metadata(old: Column, new: Column) -> Column:
    """A map with the entries of both; the newer value of a key counts. Null maps have none."""
    none = F.create_map().cast("map<string,string>")
    a, b = F.coalesce(old, none), F.coalesce(new, none)
    own = F.transform_values(a, lambda k, v: F.coalesce(F.element_at(b, k), v))
    return F.map_concat(own, F.map_filter(b, lambda k, _: ~F.map_contains_key(a, k)))


def distribution(rows: DataFrame, columns: list[str], n_tokens: Column, vector: Column) -> DataFrame:
    """(kind, value, n, min, max and mean tokens, percent worth a vector) of each value of some columns, in one pass."""
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("value")) for c in columns]))
    sized = rows.select(values.alias("v"), n_tokens.alias("k"), vector.alias("w"))
    pct = F.round(100.0 * F.count_if("w") / F.count(F.lit(1)), 4)
    return sized.groupBy("v.kind", "v.value").agg(F.count(F.lit(1)).alias("n"), F.min("k").alias("min_tokens"), F.max("k").alias("max_tokens"), F.round(F.avg("k"), 4).alias("avg_tokens"), pct.alias("vector_pct"))
