"""Cleaning of pages against plain Python, and choices of chunks and headings by hand."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import cleaning, text, tracking, xbrl


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.select("i", f(F.col("t")).alias("v")).orderBy("i").select("v").collect()]


def python(pattern):
    return re.sub(r"\$(\d)", r"\\\1", pattern)


def applied(value, rules):
    for pattern, new in rules:
        value = re.sub(pattern, python(new), value)
    return value


PIECES = ["売上高", "12: ", "3:(", " - 5 - ", "....", "|", "| |", "①", "△1,234", "ｶﾞｽ", "abc 12", "12 xyz ", "。", " ", "\n", "(注) ", ")、 ", "各 位 各 位", "7 円", "é", "TT 29 Cid", "器", "20 ", "6-A", "= i= ", "1 項目 | 2 | 3 | 4", "３４", "x1y", "の"]


def strings(seed, n=80):
    rng = random.Random(seed)
    return ["", " ", *("".join(rng.choice(PIECES) for _ in range(rng.randint(1, 14))) for _ in range(n))]


def test_noise_goes_as_in_python(spark):
    def plain(t):
        t = applied(t, [(p, " ") for p in cleaning.NOISE])
        for wrong, right in cleaning.MISREAD:
            t = t.replace(wrong, right)
        return applied(t, cleaning.TABLE_REST).strip()

    values = [v.replace("①", "1.") for v in strings(1)]  # as normalise() leaves them; Python takes circled numbers for letters
    assert column(spark, values, cleaning.without_noise) == [plain(v) for v in values]


def test_row_numbers_and_page_marks_go_as_in_python(spark):
    def rows(t):
        t = applied(t, cleaning.ROW_NUMBERS)
        return re.sub(cleaning.TABLE_NUMBER, "", t) if t.count("|") > 2 else t

    values = strings(2)
    normal = column(spark, values, text.normalise)
    assert column(spark, values, cleaning.without_row_labels) == [rows(v) for v in values]
    assert column(spark, values, cleaning.clean_page) == [applied(applied(rows(v), cleaning.PAGE_MARKS), [(r"\s+", " ")]).strip() for v in normal]


def test_half_width_signs_are_composed(spark):
    assert column(spark, ["ｶﾞ①ﾊﾟ", "が", None], text.normalise) == ["ガ1.パ", "が", None]
    assert column(spark, ["2: 売上高 １,２３４　△５"], cleaning.clean_report) == ["売上高 1234 -5"]


def test_reasons(spark):
    values = ["short", "1234567890 " * 60, "| " + "word soup with many different words inside of it " * 3, "単語 " * 40, "これは十分に長い文章です" * 20]
    f = lambda t: cleaning.quality_reason(t, F.lit("general"), F.lit("x"), F.length(t), text.tokens(t), F.lit(True))
    assert column(spark, values, f) == ["fragment", "mostly_numeric_large", "continuation_fragment", "low_information", "passed"]


def test_chunks_by_bullets():
    point = "項目の説明です。" * 12
    whole = "主な項目は次のとおりです。" + "".join(f"・{i}{point}" for i in range(8))
    chunks = cleaning.bullets(whole, 500)
    assert all(30 <= len(c) <= 500 for c in chunks) and "".join(chunks).count("説明") == 96
    assert cleaning.bullets("tiny") == [] and cleaning.bullets(None) == []
    assert cleaning.bullets("one two three four five six seven eight") == ["one two three four five six seven eight"]


def test_chunks_by_paragraphs():
    assert cleaning.paragraphs("x" * 49) == [] and cleaning.paragraphs("y " * 30) == ["y " * 30]
    chunks = cleaning.paragraphs("長い文です。" * 150)
    assert all(len(c) <= 600 for c in chunks) and sum(c.count("長") for c in chunks) == 150


def test_packing_keeps_a_long_unit_that_follows_another():
    fits = lambda s: len(s) <= 5
    assert cleaning.packed(["ab", "cd", "toolong", "e"], fits, lambda s: [s[:5], s[5:]]) == ["ab cd", "toolong", "e"]
    assert cleaning.packed(["toolong", "", "e"], fits, lambda s: [s[:5], s[5:]]) == ["toolo", "ng", "e"]


def test_texts_lose_what_they_repeat(spark):
    a, b, c = "これは二十文字を超える長い文章の例でありますから。", "別の長い文章で、これも二十文字を超えています。", "三つ目の文章はまったく違うことを述べているものです。"
    assert column(spark, [a + b + a + c + b], cleaning.without_self_repeats) == [f"{a} {b} {c}"]
    assert column(spark, [a + a, None, a], cleaning.without_self_repeats) == [a + a, None, a]
    block = "".join(f"{i:03d}-{chr(65 + i % 26)}" for i in range(20))
    out = cleaning.once("文。" + "文。" + (block + " ") * 12)
    assert len(out) < len(block) * 6


@pytest.mark.parametrize(
    "sizes, pages, sections, digits, expected",
    [
        ([400, 400, 400], [1, 1, 1], ["a"] * 3, True, []),
        ([600, 600], [1, 2], ["a"] * 2, False, []),  # alike over pages
        ([50, 90, 60], [1, 1, 1], ["a"] * 3, False, [1]),
        ([300, 250], [1, 1], ["a", "b"], False, [0, 1]),
        ([300, 350], [1, 1], ["a"] * 2, True, []),
        ([300, 350], [1, 1], ["a"] * 2, False, [1]),
        ([80], [1], ["a"], True, [0]),
    ],
)
def test_headings(spark, sizes, pages, sections, digits, expected):
    rows = [(1, i, "12. 貸借対照表 (4)" if i % 2 else "貸借対照表", ("1" if digits else "あ") * n, p, s) for i, (n, p, s) in enumerate(zip(sizes, pages, sections))]
    df = spark.createDataFrame(rows, "d long, i int, h string, c string, p int, s string")
    out = cleaning.heading_decisions(df, "d", "h", "c", "p", "s", "i").orderBy("new_index").collect()
    assert [r["i"] for r in out] == expected


def test_periods_as_people_write_them(spark):
    values = ["令和6年第1四半期", "平成31年 Q3", "2024 half", "fy2023", "2024-3", "Q2", ""]
    out = column(spark, values, xbrl.user_period)
    assert [tuple(x) if x else None for x in out] == [(2024, 1), (2019, 3), (2024, 2), (2023, 4), (2024, 3), None, None]


def test_states_may_follow(spark):
    rows = [(1, 1, "processing"), (1, 2, "completed"), (1, 3, "failed"), (2, 1, "completed"), (3, 1, "processing"), (3, 2, None)]
    out = tracking.violations(spark.createDataFrame(rows, "k int, o int, status string"), "k", ["o"]).collect()
    assert sorted((r["k"], r["o"]) for r in out) == [(1, 3), (2, 1), (3, 2)]
