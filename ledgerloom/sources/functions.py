"""The parsers as table functions of SQL: SELECT ... FROM t, LATERAL parse_ixbrl(t.html)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, NullType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ledgerloom.sources.html import read
from ledgerloom.sources.packages import facts_of, links_of, schema_of


def asked(argument: AnalyzeArgument, *kinds) -> None:
    """Refuses a column of another type when the query is analysed, not when it runs."""
    if not isinstance(argument.dataType, (*kinds, NullType)):
        raise TypeError(f"one of {', '.join(k().simpleString() for k in kinds)} is asked for, not {argument.dataType.simpleString()}")


def names_of(argument: AnalyzeArgument | None) -> list[str]:
    """The names in a constant text, separated by commas."""
    if argument is None or argument.value is None:
        if argument is not None and not argument.isConstantExpression:
            raise TypeError("the names have to be a constant")
        return []
    return [x.strip() for x in argument.value.split(",") if x.strip()]


class ParseIxbrl:
    """parse_ixbrl(source [, names]): the facts of an instance in their order.

    Without names a row (position, name, context, unit, scale, sign, text) for each fact; with a constant list of names, such as
    'NetSales, Assets', a row (context, NetSales, Assets) for each context, in the order of first mention, with the first value of each by the
    local part of its name; the columns follow from the names when the query is analysed. A null source has no rows.
    """

    def __init__(self):
        self.names: list[str] | None = None

    @staticmethod
    def analyze(source: AnalyzeArgument, names: AnalyzeArgument | None = None) -> AnalyzeResult:
        asked(source, StringType)
        wanted = names_of(names)
        if len({w.lower() for w in wanted}) < len(wanted):
            raise ValueError("a name is listed twice")
        if wanted:
            schema = StructType().add("context", StringType())
            for name in wanted:
                schema = schema.add(name, StringType())
        else:
            schema = StructType().add("position", IntegerType())
            for name in ("name", "context", "unit", "scale", "sign", "text"):
                schema = schema.add(name, StringType())
        return AnalyzeResult(schema=schema)

    def eval(self, source: str, names: str | None = None) -> Iterator[tuple]:
        wanted = [x.strip() for x in (names or "").split(",") if x.strip()]
        if not wanted:
            yield from ((i, *f) for i, f in enumerate(facts_of(source or "")))
            return
        found: dict[str, dict[str, str]] = {}
        for name, context, _, _, _, text in facts_of(source or ""):
            tag = name.rsplit(":", 1)[-1]
            if tag in wanted and text is not None:
                found.setdefault(context, {}).setdefault(tag, text)
        yield from ((context, *map(values.get, wanted)) for context, values in found.items())


class ParseLinkbase:
    """parse_linkbase(content): (kind, a, b, error) of a label linkbase (loc, label, arc) or a schema (concept), as text or bytes.

    What is not well formed is one row of kind 'error'. Null has no rows.
    """

    @staticmethod
    def analyze(content: AnalyzeArgument) -> AnalyzeResult:
        asked(content, StringType, BinaryType)
        schema = StructType()
        for name in ("kind", "a", "b", "error"):
            schema = schema.add(name, StringType())
        return AnalyzeResult(schema=schema)

    def eval(self, content) -> Iterator[tuple]:
        if content is None:
            return
        content = content.encode() if isinstance(content, str) else bytes(content)
        try:
            rows = [(*r, None) for r in links_of(content)]
            if not rows and re.search(rb"<[^>]*schema[\s>]", content):
                rows = [("concept", n, t, None) for n, t in schema_of(content)]
        except ElementTree.ParseError as e:
            rows = [("error", None, None, str(e)[:200])]
        yield from rows


class ParseHtmlSections:
    """parse_html_sections(html): (section_index, heading, content) of a page, in order. Null has no rows."""

    @staticmethod
    def analyze(html: AnalyzeArgument) -> AnalyzeResult:
        asked(html, StringType)
        return AnalyzeResult(schema=StructType().add("section_index", IntegerType()).add("heading", StringType()).add("content", StringType()))

    def eval(self, html: str) -> Iterator[tuple]:
        if html is not None:
            yield from ((i, heading, content) for i, (heading, content) in enumerate(read(html).sections))


class ParseHtmlTable:
    """parse_html_table(html): (row_index, cells, links) of all table rows of a page, in order. Null has no rows."""

    @staticmethod
    def analyze(html: AnalyzeArgument) -> AnalyzeResult:
        asked(html, StringType)
        return AnalyzeResult(schema=StructType().add("row_index", IntegerType()).add("cells", ArrayType(StringType())).add("links", ArrayType(StringType())))

    def eval(self, html: str) -> Iterator[tuple]:
        if html is not None:
            yield from ((i, cells, links) for i, (cells, links) in enumerate(read(html).rows))


FUNCTIONS = {"parse_ixbrl": ParseIxbrl, "parse_linkbase": ParseLinkbase, "parse_html_sections": ParseHtmlSections, "parse_html_table": ParseHtmlTable}


def register(spark: SparkSession) -> None:
    """Makes the functions known to SQL in a session; rows go to and from them in Arrow batches."""
    for name, kind in FUNCTIONS.items():
        spark.udtf.register(name, udtf(kind, useArrow=True))
