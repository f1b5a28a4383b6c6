"""Cleaning of extracted pages and tables: row numbers, footers, recognition noise, reasons, chunks and headings."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.operators import text as T

#: Unicode classes, and line ends as in the dialect that the patterns are written for.
FLAGS = "(?Ud)"

# Patterns and what replaces them, in the order in which they apply.
ROW_NUMBERS = [
    (r"(\s|\||^)\d{1,2}:\s*", "$1"),
    (r"\d{1,2}:\s*(?=[぀-ゟ゠-ヿ一-龯])", ""),
    (r"\d{1,2}:\s*(?=\()", ""),
    (r"\d{1,2}:\s*(?=[-+]?\d{1,3}\s)", ""),
]
TABLE_NUMBER = r"^([1-9]|1[0-9])\s+(?=[぀-ゟ゠-ヿ一-龯].*\|)"
PAGE_MARKS = [
    (r"(?m)^\s*[-–—]+?\s*\d+\s*[-–—]+\s*$", ""),
    (r"(?m)^\s*\d+\s*$", ""),
    (r"[\s\.\。]\s*[-–—]\s*\d+\s*[-–—]\s+", " "),
    (r"\s+[-–—]\s*\d{1,2}\s*[-–—]\s+", " "),
    (r"[\.\。]\s+[-–—]\s*\d{1,2}\s*[-–—]\s+", ". "),
    (r"\.{4,}", ""),
    (r"(?m)^\s*[.\s]{10,}\s*$", ""),
    (r"\s+[.\s]{6,}\s+", " "),
    (r"\)\s*の\s*本割当株式", ")の本割当株式"),
    (r"\)\s*、\s*", ")、"),
    (r"\s+\(\s*", "("),
    (r"\s+\)\s*", ") "),
    (r"(\d+)\s*,\s*(\d+)\s*,\s*(\d+)\s*円", "$1,$2,$3円"),
    (r"(\d+)\s+円", "$1円"),
    (r"(\d+)\s+株", "$1株"),
    (r"(\d+)\s+名", "$1名"),
    (r"各\s+位\s+各\s+位", "各位"),
    (r"株\s*式\s*会\s*社\s+株\s*式\s*会\s*社", "株式会社"),
]
NOISE = [
    r"\b[a-zA-Z]{2,8}\s+(?=[0-9億万円千百十])",
    r"(?<=[0-9億万円千百十])\s+[a-zA-Z]{2,8}\b",
    r"\b[a-zA-Z]{2,8}\s+(?=[の、。で])",
    r"\biRRE\s+BW\b",
    r"\ba\s+pes\b",
    r"\bgar\.\b",
    r"\bep\s+i=\b",
    r"\bnoagl\s+\d+\b",
    r"\bsg\s+器\s+al\b",
    r"\bzisl\s+id\b",
    r"\beh\s+nish\s+\d+\b",
    r"\biA\s+回\b",
    r"\bTT\s+\d+\s+[A-Z][a-z]+\b",
    r"\bHT\s+\d+\b",
    r"\|\s*[a-zA-Z]{1,3}\s*\|",
    r"[。\s]+[a-zA-Z]{1,4}[。\s]+",
    r"\|\s*\d+\s*\|\s*",
    r"\|\s*、\s*\|",
    r"\s*\|\s*\|+\s*",
    r"=\s*i=\s*",
    r"\|\s*\d{1,3}\|\s*",
    r"開\s+売上高",
    r"有力\s*\|",
    r"人回藤想\s*\|",
    r"\@\s*業績",
    r"\.{3,}《\.{2,}",
    r"_\s*\(",
    r"増減額\d+-[A-Z]\)",
    r"今回修正予想[A-Z]\)",
    r"前発想\s+",
    r"[a-zA-Z]\s*器\s*[a-zA-Z]",
    r"\b[a-zA-Z]+\d+[a-zA-Z]+\b",
    r"\b[bcdfghjklmnpqrstvwxyzBCDFGHJKLMNPQRSTVWXYZ]{2,4}\b",
]
MISREAD = [("6-", "(B-A)"), ("増減額6-", "増減額(B-A)"), ("今回修正予想B)", "今回修正予想(B)"), ("前発想", "前回発表予想"), ("20 ", "% "), (" 阿部 ", " ")]
TABLE_REST = [
    (r"\|\s*\d{1,4}\s*\|", " "),
    (r"\|\s*\|\s*\|+", " "),
    (r"\|\s*[、。]\s*\|", " "),
    (r"\s+\|\s+", " "),
    (r"^\|\s*", ""),
    (r"\s*\|$", ""),
    (r"[。\s]{3,}", " "),
    (r"\s+\d{1,3}\s+\|", " "),
    (r"\|\s+\d{1,3}\s+", " "),
    (r"\s{2,}", " "),
    (r"\s+([、。])", "$1"),
]


def applied(text: Column, rules: Iterable[tuple[str, str]]) -> Column:
    for pattern, new in rules:
        text = F.regexp_replace(text, FLAGS + pattern, new)
    return text


def where_there(text: Column, told: Callable[[Column], Column], rules: Iterable[tuple[str, str]]) -> Column:
    """The rules on texts that hold what all their matches hold; the others are not gone through."""
    return T.bound(text, lambda x: F.when(told(x), applied(x, rules)).otherwise(x))


def has_digit(text: Column) -> Column:
    return text.rlike(FLAGS + r"\d")


def without_row_labels(text: Column) -> Column:
    """Text without the numbers that tables give their rows (`2:`), years, times and signs left as they are."""
    out = where_there(text, lambda x: x.contains(":"), ROW_NUMBERS)
    return where_there(out, lambda x: F.regexp_count(x, F.lit(r"\|")) > 2, [(TABLE_NUMBER, "")])


def clean_report(text: Column) -> Column:
    """Text of a structured report: one spelling, no row numbers."""
    t = T.spelled(text)
    t = F.replace(without_row_labels(t), F.lit("△"), F.lit("-"))
    return T.strip(applied(t, [(r"(?<=\d),(?=\d{3})", ""), (r"\s+", " ")]))


def clean_page(text: Column) -> Column:
    """Text of a page: one spelling, and no row numbers, page numbers or leaders."""
    t = without_row_labels(T.normalise(text))
    t = where_there(t, has_digit, PAGE_MARKS[:5])
    t = where_there(t, lambda x: x.contains("...."), PAGE_MARKS[5:6])
    t = where_there(t, lambda x: x.rlike(FLAGS + r"[.\s]{8}"), PAGE_MARKS[6:8])
    t = where_there(t, lambda x: x.contains("(") | x.contains(")"), PAGE_MARKS[8:12])
    t = where_there(t, has_digit, PAGE_MARKS[12:16])
    t = where_there(t, lambda x: x.contains("各") | x.contains("株"), PAGE_MARKS[16:])
    return T.strip(applied(t, [(r"\s+", " ")]))


def without_noise(text: Column) -> Column:
    """Text that was read from an image, without what is no text; common misreadings mended."""
    t = applied(text, [(p, " ") for p in NOISE])
    for wrong, right in MISREAD:
        t = F.replace(t, F.lit(wrong), F.lit(right))
    return T.strip(applied(t, TABLE_REST))


def is_numeric_part(text: Column) -> Column:
    """Whether a part of a page is mostly numbers or table; by lines only from three lines on."""
    lines = F.filter(F.transform(F.split(text, "\n"), T.strip), lambda x: x != "")
    dense = F.filter(lines, lambda x: (F.regexp_count(x, F.lit(T.DIGIT)) + T.signs(x, T.MONEY)) / F.length(x) > 0.5)
    counts = F.struct(F.length(text).alias("n"), F.regexp_count(text, F.lit(T.DIGIT)).alias("digits"), T.signs(text, T.MONEY).alias("money"), T.signs(text, T.TABLE).alias("table"), F.regexp_count(text, F.lit(T.JAPANESE)).alias("ja"))
    told = T.bound(counts, lambda c: (c["digits"] / c["n"] > 0.15) | (c["money"] / c["n"] > 0.10) | ((c["digits"] + c["money"]) / c["n"] > 0.20) | ((c["table"] / c["n"] > 0.05) & (c["ja"] / c["n"] < 0.5)) | ((c["ja"] / c["n"] < 0.25) & ((c["digits"] + c["money"]) / c["n"] > 0.15)))
    by_line = (F.size(lines) >= 3) & (F.size(dense) / F.size(lines) > 0.6)
    return F.when(text.isNull() | (F.length(T.strip(text)) < 10), False).otherwise(told | by_line)


# Words of tables of a change of standards, and of headings of tables.
TRANSITION = ["日本基準", "IFRS", "表示組替", "認識および測定の差異", "調整額", "移行日", "国際財務報告基準", "会計基準の変更", "移行前", "移行後", "基準変更", "会計方針の変更"]
FORMAT_WORDS = ["(単位:", "百万円)", "千円)", "億円)", "前連結会計年度", "当連結会計年度", "自 ", "至 ", "期間"]
DATE_SPAN = r"\d{4}年\d{1,2}月\d{1,2}日.*\d{4}年\d{1,2}月\d{1,2}日"


def held(text: Column, words: list[str]) -> Column:
    n = F.lit(0)
    for w in words:
        n = n + F.when(text.contains(w), 1).otherwise(0)
    return n


def says_little(text: Column, length: Column) -> Column:
    words = F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")
    dull = T.bound(words, lambda w: (F.size(w) > 10) & (F.size(F.array_distinct(w)) / F.size(w) < 0.30))
    return dull | ((length < 200) & (held(text, FORMAT_WORDS) >= 2)) | ((length < 150) & text.rlike(FLAGS + DATE_SPAN))


def quality_reason(text: Column, kind: Column, section: Column, length: Column, n_tokens: Column, numeric: Column) -> Column:
    """Why a chunk is not worth a vector, by the first of ten rules, or `passed`."""
    return T.bound(F.regexp_count(text, F.lit(T.DIGIT)) / F.length(text), lambda share: reason_by(share, text, kind, section, length, n_tokens, numeric))


def reason_by(share: Column, text: Column, kind: Column, section: Column, length: Column, n_tokens: Column, numeric: Column) -> Column:
    """The same where the share of digits is known.

    Whether a part is mostly numbers takes long to tell, so it is asked once, and only of parts of some size and share.
    """
    pipes, cut = T.signs(text, "|"), T.strip(text)
    # A large chunk that is not known as numeric is judged as a medium one.
    sized = F.when((length > 400) & numeric, "large").when((length > 200) & (share > 0.35), "medium").when(length.between(101, 200) & (share > 0.50), "small").when((length <= 100) & (share > 0.60), "tiny")
    out = F.when(section.isin("balance_sheet", "cash_flow") & numeric & (share > 0.25), "section_specific_numeric")
    out = out.when(T.signs(text, "|:0123456789.,()-△▲ \t") / F.length(text) > 0.80, "table_pattern")
    out = out.when(kind.isin("financial_position", "financial_table") & (length > 800), "mega_table")
    out = out.when((kind == "capital_policy") & (length > 1000) & (pipes > 15), "mega_equity_table")
    out = out.when((length >= 800) & (pipes >= 15) & (held(text, TRANSITION) >= 3), "ifrs_transition")
    out = out.when(says_little(text, length), "low_information")
    out = out.when(cut.rlike(r"^(\||[2-9]:)"), "continuation_fragment")
    out = out.when(length < 100, "very_short").otherwise("passed")
    return F.coalesce(F.when((length < 50) | (n_tokens < 15), "fragment"), F.when(sized.isNotNull() & is_numeric_part(text), F.concat(F.lit("mostly_numeric_"), sized)), out)


def removal_counts(reasons: DataFrame, reason: str) -> DataFrame:
    """(reason, n) of rows that have one."""
    return reasons.where(F.col(reason).isNotNull()).groupBy(reason).agg(F.count(F.lit(1)).alias("n"))


# Phrases that announce a list.
LISTS = [r"主に次の差異があります。", r"主な項目は次のとおり", r"以下の.*について", r"次のとおり.*あります", r"主な内容は以下の.*です", r"詳細は以下の.*となります", r"具体的には.*以下の.*です"]
SENTENCE_END = re.compile("(?<=[。！？])")
NEW_TOPIC = re.compile(r"(?<=。)\s+(?=[IFRS第|日本基準|当社グループ|.*について|.*項目|.*事項])")


def packed(units: Iterable[str], fits: Callable[[str], bool], cut: Callable[[str], list[str]]) -> list[str]:
    """Units joined by spaces while they fit. One that does not fit alone is cut if it comes first, and else begins a chunk."""
    out, chunk = [], ""
    for unit in filter(None, map(str.strip, units)):
        longer = f"{chunk} {unit}" if chunk else unit
        if fits(longer):
            chunk = longer
        elif chunk:
            out.append(chunk)
            chunk = unit
        else:
            out += cut(unit)
    return [*out, chunk] if chunk else out


def windows(text: str, size: int, step: int) -> list[str]:
    words = text.split()
    return [" ".join(words[i : i + size]) for i in range(0, len(words), step)]


def in_sentences(text: str, words: int) -> list[str]:
    return packed(SENTENCE_END.split(text), lambda s: len(s.split()) <= words, lambda s: windows(s, words, words - min(20, words // 4)))


def in_parts(text: str, words: int, lists: list[str]) -> list[str]:
    """A long text by the points of an announced list, else by paragraphs, topics or sentences."""
    points = re.split("・(?=[^・])", text) if any(re.search(p, text) for p in lists) else []
    if len(points) < 2:
        points = text.split("\n\n")
    if len(points) == 1:
        points = NEW_TOPIC.split(text)
    if len(points) == 1:
        points = [s.strip() + "." for s in text.split(". ") if s.strip()]
        points[-1:] = [re.sub(r"\.\.$", ".", x) for x in points[-1:]]
    return packed(points, lambda s: len(s.split()) <= words, lambda s: in_sentences(s, words))


def at_most(text: str, size: int) -> list[str]:
    """A text in pieces of whole sentences of up to `size` characters; a longer sentence by words, a fifth as many."""
    return [text] if len(text) <= size else packed(SENTENCE_END.split(text), lambda s: len(s) <= size, lambda s: windows(s, size // 5, size // 5))


def bullets(text: str | None, size: int = 500, least: int = 30) -> list[str]:
    """Chunks of a page's text of up to `size` characters, by lists, paragraphs and sentences."""
    words = int(size / 3.5)
    if not text:
        return []
    if len(text) > 4 * words:
        chunks = in_parts(text, words, LISTS)
    else:
        chunks = [text] if len(text.split()) <= words else windows(text, words, words - min(50, words // 4))
    return [c for x in chunks for c in at_most(x, size) if len(c.strip()) >= least]


def paragraphs(text: str | None, words: int = 400, overlap: int = 50, most: int = 650, size: int = 600, shortest: int = 50, least: int = 30) -> list[str]:
    """Chunks of a report's paragraph; short paragraphs and chunks are dropped, long ones cut."""
    if not text or len(text.strip()) < shortest:
        return []
    if len(text) > 4 * words:
        chunks = in_parts(text, words, LISTS[:4])
    else:
        chunks = [text] if len(text.split()) <= words else windows(text, words, words - overlap)
    chunks = [x for x in chunks if len(x.strip()) >= least]
    return [c for x in chunks for c in (at_most(x, size) if len(x) > most else [x]) if len(c.strip()) >= least]


def chunked(df: DataFrame, key: str, text: str, cut: Callable[..., list[str]] = bullets, **options) -> DataFrame:
    """(key, chunk_index, content) by bullets() or paragraphs(), in Arrow batches."""

    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: cut(x, **options))

    return df.select(key, F.posexplode(run(F.col(text))).alias("chunk_index", "content"))


class Blocks:
    """Blocks of a text, and which of them may be alike to another by the grams that they share.

    Texts of lengths a and b with a ratio above r have more than r (a + b) / 2 = m letters in common runs, in order. Between two
    runs lies a letter that is in none, so there are at most 1 + a + b - 2 m runs, and at least m - (q - 1) runs of one's
    q-grams lie in them. All that share as many with a block are found by counting places in lists of the grams; the others
    cannot be alike. If the bound is not positive, all are given.
    """

    def __init__(self, ratio: float, q: int = 5, again: int = 3):
        self.ratio, self.q, self.again = ratio, q, again
        self.texts, self.sets, self.lengths = [], [], array("i")
        self.lists: dict[str, array] = {}

    def add(self, b: str) -> None:
        for g in set(grams(b, self.q)):
            self.lists.setdefault(g, array("i")).append(len(self.texts))
        self.texts.append(b)
        self.sets.append(frozenset(grams(b, self.again)))
        self.lengths.append(len(b))

    def near(self, b: str) -> list[str]:
        """The blocks that may be alike to b, in the order in which they came: by grams of q letters in the lists, and then by shorter ones."""
        if not self.texts:
            return []
        found = [np.frombuffer(self.lists[g], np.intc) for g in grams(b, self.q) if g in self.lists]
        shared = np.bincount(np.concatenate(found), minlength=len(self.texts)) if found else np.zeros(len(self.texts), int)
        lengths = np.frombuffer(self.lengths, np.intc)
        common = np.floor(self.ratio * (lengths + len(b)) / 2)  # one less than the least number of letters in common
        runs = 1 + lengths + len(b) - 2 * common
        short = grams(b, self.again)
        return [self.texts[i] for i in np.flatnonzero(shared >= common - (self.q - 1) * runs) if sum(map(self.sets[i].__contains__, short)) >= common[i] - (self.again - 1) * runs[i]]


def grams(b: str, q: int) -> list[str]:
    return [b[i : i + q] for i in range(len(b) - q + 1)]


def once(text: str | None, least: int = 20, block: int = 100, step: int = 50) -> str | None:
    """A text without sentences that it repeats and, if they are a fifth of it, without blocks much like earlier ones."""
    if not text or len(text) < 100:
        return text
    sentences = [x.strip() for x in re.split("(?<=[。！？．])", text) if x.strip()]
    if len(sentences) < 3:
        return text
    seen, kept = set(), []
    for s in sentences:
        flat = " ".join(s.split())
        if len(flat) < least or flat not in seen:
            kept.append(s)
        if len(flat) >= least:
            seen.add(flat)
    whole = " ".join(kept)
    blocks = [whole[i : i + block] for i in range(0, len(whole), step)]
    new, known = [], Blocks(0.9)
    for b in blocks:
        if len(b) <= step:
            new.append(b)
        elif not any(T.alike(b, x, 0.9) for x in known.near(b)):
            new.append(b)
            known.add(b)
    return re.sub(r"\s{2,}", " ", "".join(new)).strip() if len(new) < 0.8 * len(blocks) else whole


def without_self_repeats(text: Column) -> Column:
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(once)

    return run(text)


# Names of statements in headings.
STATEMENTS = [("貸借対照表", "balance_sheet"), ("バランスシート", "balance_sheet"), ("損益計算書", "income_statement"), ("キャッシュフロー", "cash_flow"), ("キャッシュ・フロー", "cash_flow"), ("株主資本", "equity"), ("資本", "equity"), ("連結", "consolidated"), ("単体", "standalone")]


def heading_key(heading: Column) -> Column:
    """What headings of one section have in common: no numbers around them, statements by one name."""
    h = applied(T.strip(heading), [(r"\s+", " "), (r"\s*\(?\d+\)?\s*$", ""), (r"^[\d\s\-\.\(\)]+", "")])
    for name, key in STATEMENTS:
        h = F.replace(h, F.lit(name), F.lit(key))
    return F.when(heading.isNull() | (heading == ""), "no_heading").otherwise(F.lower(h))


def heading_decisions(chunks: DataFrame, group: str, heading: str, content: str, page: str, section: str, order: str) -> DataFrame:
    """Chunks that stay of those under one heading of a document, numbered anew in new_index, with the decision.

    Groups are judged by sums of their chunks; only those of long chunks over several
    pages are compared pair by pair, a group in a call.
    """
    rows = chunks.withColumn("_h", heading_key(F.col(heading))).withColumn("_n", F.length(content))
    numbers = (F.regexp_count(F.col(content), F.lit(T.DIGIT)) + T.signs(F.col(content), "|")) / F.col("_n")
    distinct = lambda c: F.count_distinct(c) + F.max(F.when(F.col(c).isNull(), 1).otherwise(0))
    told = rows.groupBy(group, "_h").agg(F.count(F.lit(1)).alias("_size"), F.avg("_n").alias("_mean"), F.avg(F.when(F.col("_n") > 0, numbers).otherwise(0.0)).alias("_share"), distinct(page).alias("_pages"), distinct(section).alias("_sections"), F.min(order).alias("_first"))
    wide = (F.col("_size") > 1) & (F.col("_mean") > 500) & (F.col("_pages") > 1)

    def repeats(pdf: pd.DataFrame) -> pd.DataFrame:
        texts = pdf[content].tolist()
        found = any(T.shared(a, b) > 0.8 for i, a in enumerate(texts) for b in texts[i + 1 :])
        return pdf.iloc[:1][[group, "_h"]].assign(_repeats=found)

    kind = chunks.schema[group].dataType.simpleString()
    compared = rows.join(told.where(wide).select(group, "_h"), [group, "_h"], "left_semi").groupBy(group, "_h").applyInPandas(repeats, f"{group} {kind}, _h string, _repeats boolean")
    table = (F.col("_size") > 2) & (F.col("_share") > 0.20) & (F.col("_mean") > 300)
    small = (F.col("_size") > 2) & (F.col("_mean") < 200)
    decision = (
        F.when(F.col("_size") == 1, "keep_all").when(table, "remove_all").when(wide & F.coalesce("_repeats", F.lit(False)), "remove_all")
        .when(small, "keep_most_informative").when(F.col("_sections") > 1, "keep_all").when((F.col("_pages") == 1) & (F.col("_share") > 0.15), "remove_all").otherwise("keep_longest")
    )
    judged = told.join(compared, [group, "_h"], "left").select(group, "_h", "_first", decision.alias("decision"))
    worth = F.when((F.col("decision") == "keep_most_informative") & is_numeric_part(F.col(content)), 0).otherwise(F.col("_n"))
    best = F.row_number().over(W.partitionBy(group, "_h").orderBy(F.desc("_worth"), F.asc(order)))
    kept = rows.join(judged.where("decision <> 'remove_all'"), [group, "_h"]).withColumn("_worth", worth).withColumn("_best", best)
    kept = kept.where((F.col("decision") == "keep_all") | (F.col("_best") == 1))
    index = F.row_number().over(W.partitionBy(group).orderBy("_first", order)) - 1
    return kept.withColumn("new_index", index).drop("_h", "_n", "_first", "_worth", "_best")
