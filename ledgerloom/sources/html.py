"""HTML sources: listing pages, narrative sections, tables as lines."""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")


class Reader(HTMLParser):
    """Headings with the text below them, and the cells of table rows."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.sections, self.rows = [], []
        self.heading, self.body, self.cells, self.links = [], [], None, []
        self.inside, self.skip = None, 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skip += 1
        elif tag in HEADINGS:
            self.close_section()
            self.inside = tag
        elif tag == "tr":
            self.close_row()
            self.cells, self.links = [], []
        elif tag in ("td", "th") and self.cells is not None:
            self.cells.append("")
        elif tag == "a" and self.cells:
            self.links += [v for k, v in attrs if k == "href" and v]
        if tag in ("p", "div", "br", "li", "tr"):
            self.body.append("\n")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        elif tag == self.inside:
            self.inside = None
        elif tag in ("tr", "table"):
            self.close_row()

    def handle_data(self, data):
        if self.skip:
            return
        if self.cells:
            self.cells[-1] += data
        (self.heading if self.inside else self.body).append(data)

    def close_section(self):
        text = "\n".join(x for x in (" ".join(y.split()) for y in "".join(self.body).split("\n")) if x)
        if self.heading or text:
            self.sections.append((" ".join("".join(self.heading).split()), text))
        self.heading, self.body = [], []

    def close_row(self):
        if self.cells:
            self.rows.append(([" ".join(c.replace("\xa0", " ").split()) for c in self.cells], self.links))
        self.cells, self.links = None, []


def read(source: str | None) -> Reader:
    r = Reader()
    r.feed(source or "")
    r.close()
    r.close_row()
    r.close_section()
    return r


def sections(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, section_index, heading, content) of each page, in order; a page that is null has none."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            rows = [(k, i, h, t) for k, x in zip(b.column(0).to_pylist(), b.column(1)) for i, (h, t) in enumerate(read(x.as_py()).sections)]
            yield pa.record_batch([pa.array([r[0] for r in rows], b.column(0).type), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.string())], names=[key, "section_index", "heading", "content"])

    return pages.select(key, html).mapInArrow(run, f"{key} {kind}, section_index int, heading string, content string")


def table_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, row_index, cells, links) of all table rows, in order."""
    kind = pages.schema[key].dataType.simpleString()
    texts = pa.list_(pa.string())

    def run(batches):
        for b in batches:
            rows = [(k, i, c, a) for k, x in zip(b.column(0).to_pylist(), b.column(1)) for i, (c, a) in enumerate(read(x.as_py()).rows)]
            yield pa.record_batch([pa.array([r[0] for r in rows], b.column(0).type), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], texts), pa.array([r[3] for r in rows], texts)], names=[key, "row_index", "cells", "links"])

    return pages.select(key, html).mapInArrow(run, f"{key} {kind}, row_index int, cells array<string>, links array<string>")


def table_lines(rows: DataFrame, key: str) -> DataFrame:
    """Rows of a table as `column: value | ...`, by the names in its first row; without names the cells alone."""
    head = F.first("cells").over(W.partitionBy(key).orderBy("row_index"))
    named = F.zip_with("cells", "_head", lambda c, h: F.when(c.isNull() | (c == ""), None).when(h.isNull() | (h == ""), c).otherwise(F.concat(h, F.lit(": "), c)))
    out = rows.withColumn("_head", head).where("row_index > 0")
    return out.select(key, "row_index", F.array_join(F.array_compact(named), " | ").alias("line"))


def clock(text: Column) -> Column:
    """HH:mm, and 00:00 for what is no time of day."""
    t = F.trim(text)
    return F.when(t.rlike(r"^([01]?\d|2[0-3]):[0-5]\d$"), F.lpad(t, 5, "0")).otherwise("00:00")


def listing(rows: DataFrame, key: str, day: Column) -> DataFrame:
    """Disclosures of listing rows of five cells (time, code, name, title, mark), of which links are files."""
    cell = lambda i: F.trim(F.get("cells", F.lit(i)))
    out = rows.where(F.size("cells") >= 4)
    return out.select(key, "row_index", day.alias("disclosure_date"), clock(cell(0)).alias("time"), cell(1).alias("company_code"), cell(2).alias("company_name"), cell(3).alias("title"), F.get(F.filter("links", lambda x: x.endswith(".zip")), F.lit(0)).alias("xbrl_url")).where("company_code <> '' and title <> ''")


def search_rows(rows: DataFrame, key: str) -> DataFrame:
    """Disclosures of search results: rows of four cells, each followed by a row with its details.

    A time that is none is 00:00, a date that is none drops the row.
    """
    next_row = W.partitionBy(key).orderBy("row_index")
    cell = lambda i: F.trim(F.get("cells", F.lit(i)))
    out = rows.withColumn("detail", F.array_join(F.lead("cells").over(next_row), " ")).where(F.size("cells") == 4)
    stamp = F.split(cell(0), r"\s+")
    date = F.try_to_timestamp(F.get(stamp, F.lit(0)), F.lit("yyyy/MM/dd")).cast("date")
    return out.select(key, "row_index", date.alias("disclosure_date"), clock(F.coalesce(F.get(stamp, F.lit(1)), F.lit(""))).alias("time"), cell(1).alias("company_code"), cell(2).alias("company_name"), cell(3).alias("title"), "detail").where("disclosure_date is not null")


def between_times(df: DataFrame, first: str | None, last: str | None) -> DataFrame:
    """Rows whose time is within the window, both ends included."""
    out = df if first is None else df.where(F.col("time") >= first)
    return out if last is None else out.where(F.col("time") <= last)


def before_first_empty(pages: DataFrame, rows: DataFrame, key: str, page: str) -> DataFrame:
    """Pages of each listing up to the first that has no rows or is not there; what comes after it is not part of the listing."""
    filled = rows.select(key, page).distinct()
    place = F.row_number().over(W.partitionBy(key).orderBy(page))
    first = F.min(page).over(W.partitionBy(key))
    run = filled.withColumn("_gap", F.col(page) - place).withColumn("_first", first).where(F.col("_gap") == F.col("_first") - 1).select(key, page)
    starts = pages.groupBy(key).agg(F.min(page).alias("_start"))
    begins = run.groupBy(key).agg(F.min(page).alias("_begin")).join(starts, key).where("_begin = _start").select(key)
    return pages.join(run.join(begins, key), [key, page])


def titles(rows: DataFrame, first_hour: int, last_hour: int, whole_last: bool = False) -> DataFrame:
    """Times and titles of a listing within a window of hours: up to the last hour's first minute, or all of it."""
    hour, minute = F.substring("time", 1, 2).cast("int"), F.substring("time", 4, 2).cast("int")
    end = hour <= last_hour if whole_last else (hour < last_hour) | ((hour == last_hour) & (minute == 0))
    return rows.where((hour >= first_hour) & end).select("time", "title")
