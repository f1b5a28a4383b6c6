"""Spreadsheets: zip files of SpreadsheetML, read by streaming their XML."""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the format: built-in numbers of formats that show dates.
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
ROWS = "sheet string, row int, cells array<string>, error string"


def local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def elements(z: zipfile.ZipFile, name: str, tag: str) -> Iterator[ElementTree.Element]:
    """The elements of a tag in a member, one by one; each is let go when the next is asked for."""
    with z.open(name) as f:
        path = []
        for event, e in ElementTree.iterparse(f, ("start", "end")):
            if event == "start":
                path.append(e)
                continue
            path.pop()
            if local(e.tag) == tag:
                yield e
                e.clear()
                if path:
                    path[-1].remove(e)


def text_of(e: ElementTree.Element) -> str:
    """The runs of a text without what shows how it is read."""
    if local(e.tag) in ("rPh", "phoneticPr"):
        return ""
    return (e.text or "" if local(e.tag) == "t" else "") + "".join(map(text_of, e))


def column_of(reference: str) -> int:
    """The number of the column of a cell such as AB12, from 0."""
    n = 0
    for c in re.match(r"[A-Z]*", reference)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def day_of(number: float, from_1904: bool) -> str:
    """A number of days as a date, with a time if there is one; in the usual count a day that never was comes after the 59th."""
    base = dt.datetime(1904, 1, 1) if from_1904 else dt.datetime(1899, 12, 31) if number < 60 else dt.datetime(1899, 12, 30)
    at = base + dt.timedelta(seconds=round(number * 86400))
    return at.isoformat(" ") if at.time() != dt.time() else at.date().isoformat()


def plain(number: str) -> str:
    """A number without an empty fraction."""
    try:
        x = float(number)
    except ValueError:
        return number
    return str(int(x)) if x == int(x) and abs(x) < 1 << 53 else repr(x)


def date_styles(z: zipfile.ZipFile) -> set[int]:
    """The numbers of cell styles that show dates."""
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ElementTree.fromstring(z.read("xl/styles.xml"))
    own = {int(e.get("numFmtId")): re.sub(r'"[^"]*"|\\.|\[(?![hms]+\])[^\]]*\]', "", e.get("formatCode", "")) for e in root.iter() if local(e.tag) == "numFmt"}
    dates = DATE_FORMATS | {i for i, code in own.items() if re.search(r"[dmyhs]", code, re.I) and not re.search("general", code, re.I)}
    cells = next((e for e in root if local(e.tag) == "cellXfs"), ())
    return {i for i, x in enumerate(cells) if int(x.get("numFmtId", 0)) in dates}


def rows_of(content: bytes) -> Iterator[tuple[str, int, list[str | None]]]:
    """(sheet, row, cells) of all rows that hold anything, as texts; sparse rows are filled with nulls up to their last cell."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = [text_of(e) for e in elements(z, "xl/sharedStrings.xml", "si")] if "xl/sharedStrings.xml" in z.namelist() else []
        dates, book = date_styles(z), ElementTree.fromstring(z.read("xl/workbook.xml"))
        from_1904 = any(local(e.tag) == "workbookPr" and e.get("date1904") in ("1", "true") for e in book.iter())
        targets = {e.get("Id"): e.get("Target") for e in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels")).iter() if e.get("Id")}
        for sheet in (e for e in book.iter() if local(e.tag) == "sheet"):
            target = targets[sheet.get(RELATION)]
            at = 0
            for row in elements(z, target.lstrip("/") if target.startswith("/") else f"xl/{target}", "row"):
                at = int(row.get("r", at + 1))
                cells: list[str | None] = []
                for c in (e for e in row if local(e.tag) == "c"):
                    n = column_of(c.get("r")) if c.get("r") else len(cells)
                    cells += [None] * (n + 1 - len(cells))
                    cells[n] = value_of(c, shared, dates, from_1904)
                if any(x is not None for x in cells):
                    yield sheet.get("name"), at, cells


def value_of(c: ElementTree.Element, shared: list[str], dates: set[int], from_1904: bool) -> str | None:
    kind = c.get("t", "n")
    if kind == "inlineStr":
        return "".join(text_of(e) for e in c if local(e.tag) == "is")
    value = next((e.text for e in c if local(e.tag) == "v"), None)
    if value is None:
        return None
    if kind == "s":
        return shared[int(value)]
    if kind == "b":
        return "true" if value == "1" else "false"
    if kind == "e":
        return None
    if kind == "n" and int(c.get("s", 0)) in dates:
        return day_of(float(value), from_1904)
    return plain(value) if kind == "n" else value


def workbook_rows(books: DataFrame, key: str, content: str) -> DataFrame:
    """(key, sheet, row, cells, error) of workbooks held as bytes; one that cannot be read is a row with an error, a null one has none."""
    kind = books.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            for k, x in zip(b.column(0), b.column(1)):
                x, rows = x.as_py(), []
                try:
                    rows = [(*r, None) for r in rows_of(x)] if x is not None else []
                except (zipfile.BadZipFile, ElementTree.ParseError, KeyError, IndexError, ValueError, RuntimeError) as e:
                    rows = [(None, None, None, str(e)[:200])]
                cols = list(zip(*rows)) or [[]] * 4
                kinds = (pa.string(), pa.int32(), pa.list_(pa.string()), pa.string())
                yield pa.record_batch([pa.array([k.as_py()] * len(rows), b.column(0).type), *(pa.array(c, t) for c, t in zip(cols, kinds))], names=[key, "sheet", "row", "cells", "error"])

    return books.select(key, content).mapInArrow(run, f"{key} {kind}, {ROWS}")


def read_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all workbooks below a path, by `path`."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", "true").load(path)
    return workbook_rows(files, "path", "content")


def records(rows: DataFrame, key: str, required: list[str], optional: list[str] = ()) -> DataFrame:
    """(key, sheet, row, the columns) of sheets whose first row names all required and optional columns; others have none.

    Texts are trimmed and empty ones are null. Rows without one of the required are left out.
    """
    names = [*required, *optional]
    head = rows.where("error is null").groupBy(key, "sheet").agg(F.min_by("cells", "row").alias("head"), F.min("row").alias("first"))
    fits = F.lit(True)
    for n in names:
        fits = fits & F.array_contains("head", n)
    found = rows.join(head.where(fits), [key, "sheet"]).where("row > first")

    def cell(name: str) -> Column:
        text = F.regexp_replace(F.get("cells", F.array_position("head", name).cast("int") - 1), r"(?U)^\s+|\s+$", "")
        return F.when(text != "", text).alias(name)

    out = found.select(key, "sheet", "row", *map(cell, names))
    for n in required:
        out = out.where(F.col(n).isNotNull())
    return out
