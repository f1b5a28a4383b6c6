"""Structured-report packages: zip files of inline instances, schemas and linkbases."""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from html import unescape
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FACT = re.compile(r"<(?P<tag>[\w:.-]+)(?P<attrs>(?:\s+[\w:.-]+\s*=\s*(?:\"[^\"]*\"|'[^']*'))*\s+context[rR]ef\s*=\s*(?:\"[^\"]*\"|'[^']*')(?:\s+[\w:.-]+\s*=\s*(?:\"[^\"]*\"|'[^']*'))*)\s*(?P<empty>/?)>")
ATTRIBUTE = re.compile(r"([\w:.-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)')")
ROWS = "package string, path string, kind string, position long, a string, b string, c string, d string, e string, f string, error string"
XLINK = "{http://www.w3.org/1999/xlink}"


def plain(text: str) -> str:
    return unescape(re.sub(r"<[^>]*>", "", text) if "<" in text else text)


def tags(tag: str, known: dict = {}) -> re.Pattern:
    """Opening and closing tags of a name; some that were asked for before are known."""
    if tag not in known:
        if len(known) >= 256:
            known.clear()
        known[tag] = re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*?(/?)>")
    return known[tag]


def own_end(source: str, tag: str, start: int) -> int:
    """Where the closing tag of an element that is open at start begins, -1 without one."""
    depth = 1
    for m in tags(tag).finditer(source, start):
        depth += -1 if m[1] else 0 if m[2] else 1
        if not depth:
            return m.start()
    return -1


def facts_of(source: str):
    """(name, context, unit, scale, sign, text) of every element that refers to a context, in order.

    Elements are found by their attributes, so that documents that are not well
    formed, and attribute names in lower case, are read too. A fact may hold others of
    its name; its text goes on to its own end.
    """
    for m in FACT.finditer(source):
        a = {k.lower(): x or y for k, x, y in ATTRIBUTE.findall(m["attrs"])}
        text = None
        if not m["empty"]:
            end = own_end(source, m["tag"], m.end())
            text = plain(source[m.end() : end]) if end >= 0 else None
        yield a.get("name", ""), a.get("contextref", ""), a.get("unitref", ""), a.get("scale", "0"), a.get("sign"), text


def local(tag) -> str:
    return tag.rsplit("}", 1)[-1] if isinstance(tag, str) else ""


def schema_of(content: bytes):
    """(name, type) of the elements that a schema declares."""
    for e in ElementTree.fromstring(content).iter():
        if local(e.tag) == "element" and e.get("name"):
            yield e.get("name"), e.get("type") or ""


def links_of(content: bytes):
    """(kind, a, b) of a label linkbase: locators, labels and arcs; verbose labels are left out."""
    for e in ElementTree.fromstring(content).iter():
        kind = local(e.tag)
        if kind == "loc" and e.get(f"{XLINK}href") and e.get(f"{XLINK}label"):
            yield "loc", e.get(f"{XLINK}label"), e.get(f"{XLINK}href").split("#")[-1].split(":")[-1]
        elif kind == "label":
            name, text = e.get(f"{XLINK}label") or e.get("id", ""), (e.text or "").strip()
            if name and text and "verbose" not in e.get(f"{XLINK}role", "").lower():
                yield "label", name, text
        elif kind == "labelArc":
            yield "arc", e.get(f"{XLINK}from"), e.get(f"{XLINK}to")


def rows_of(package: str, path: str, content: bytes) -> list[tuple]:
    """Tagged rows of one file; a file that cannot be read is one row with an error."""
    low, out = path.lower(), []
    try:
        if low.endswith(".xsd"):
            out = [("concept", n, t, None, None, None, None) for n, t in schema_of(content)]
        elif re.search(r"lab[^/]*\.xml$", low):
            out = [(k, a, b, None, None, None, None) for k, a, b in links_of(content)]
        elif low.endswith((".htm", ".html", ".xbrl")):
            out = [("fact", *f) for f in facts_of(content.decode("utf-8", "replace"))]
        out = [("file", None, None, None, None, None, None), *out]
    except (ElementTree.ParseError, ValueError) as e:
        return [(package, path, "file", 0, None, None, None, None, None, None, str(e)[:200])]
    return [(package, path, r[0], i, *r[1:], None) for i, r in enumerate(out)]


def read_packages(spark: SparkSession, path: str) -> DataFrame:
    """Tagged rows of all packages below a path: files, facts, concepts and label links.

    One pass over the zips. kind says what a to f are: fact (name, context, unit,
    scale, sign, text), concept (name, type), loc, label and arc (two ends). A zip
    that cannot be opened is one row with an error.
    """
    arrow = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in ROWS.split(", ")])

    def run(batches):
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1)):
                try:
                    with zipfile.ZipFile(io.BytesIO(content.as_py())) as z:
                        rows = [r for n in sorted(z.namelist()) if not n.endswith("/") for r in rows_of(name, n, z.read(n))]
                except (zipfile.BadZipFile, zlib.error, RuntimeError) as e:
                    rows = [(name, None, "package", 0, None, None, None, None, None, None, str(e)[:200])]
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)] if rows else [pa.array([], f.type) for f in arrow], schema=arrow)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(run, ROWS)


def facts(rows: DataFrame) -> DataFrame:
    return rows.where("kind = 'fact'").select("package", "path", "position", F.col("a").alias("name"), F.col("b").alias("context_id"), F.col("c").alias("unit"), F.col("d").try_cast("int").alias("scale"), F.col("e").alias("sign"), F.col("f").alias("text"))


def first_values(rows: DataFrame, tags: list[str]) -> DataFrame:
    """The first value of each tag (by the local part of a fact's name) in a package, as columns."""
    named = facts(rows).withColumn("tag", F.element_at(F.split("name", ":"), -1)).where(F.col("tag").isin(tags) & F.col("text").isNotNull())
    return named.groupBy("package").pivot("tag", tags).agg(F.min_by(F.trim("text"), F.struct("path", "position")))


def linkbase(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("kind").isin("loc", "label", "arc")).select("package", "kind", "a", "b", "position")


def instance_facts(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, position, name, context, unit, scale, sign, text) of the tagged facts of instances held as text."""
    kind = pages.schema[key].dataType.simpleString()
    names = ["name", "context", "unit", "scale", "sign", "text"]

    def run(batches):
        for b in batches:
            rows = [(k, i, *f) for k, x in zip(b.column(0).to_pylist(), b.column(1)) for i, f in enumerate(facts_of(x.as_py() or ""))]
            cols = list(zip(*rows)) or [[]] * 8
            yield pa.record_batch([pa.array(cols[0], b.column(0).type), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.string()) for c in cols[2:])], names=[key, "position", *names])

    return pages.select(key, html).mapInArrow(run, f"{key} {kind}, position int, " + ", ".join(f"{n} string" for n in names))
