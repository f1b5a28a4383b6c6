"""Queries over parsers as SQL, packages as a data source and spreadsheets, with their oracles."""

from __future__ import annotations

import contextlib
import io
import zipfile

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import functions as F

from ledgerloom.operators import xbrl
from ledgerloom.plans.bind import Tables
from ledgerloom.shared import new_folder
from ledgerloom.sources import functions, package_source, packages, tables, workbooks

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def in_sql(rows, statement: str, **named):
    """What a statement gives over rows, as {rows}, and other tables."""
    functions.register(rows.sparkSession)
    return rows.sparkSession.sql(statement, rows=rows, **named)


def instances(t):
    """An instance for each order: its lines as facts, which are made where the lines of an order have met."""

    def fact(x):
        return F.concat(F.lit("<ix:nonFraction name='p:c"), x["l_linenumber"].cast("string"), F.lit("' contextRef='"), x["l_returnflag"], F.lit("' scale='6'"), F.when(x["l_linestatus"] == "O", " unitRef='JPY'").otherwise(""), F.lit("><b>"), x["l_partkey"].cast("string"), F.lit("</b> &amp; "), x["l_suppkey"].cast("string"), F.lit("</ix:nonFraction>"))

    lines = F.collect_list(F.struct("l_linenumber", "l_returnflag", "l_linestatus", "l_partkey", "l_suppkey"))
    return t.raw("lineitem").groupBy("l_orderkey").agg(lines.alias("lines")).select("l_orderkey", F.array_join(F.array_sort(F.transform("lines", fact)), "").alias("html"))


@query("sql_ixbrl", "SELECT l_orderkey, 'p:c' || l_linenumber AS name, l_returnflag AS context, CASE WHEN l_linestatus = 'O' THEN 'JPY' ELSE '' END AS unit, '6' AS scale, CAST(NULL AS VARCHAR) AS sign, CAST(l_partkey AS VARCHAR) || ' & ' || l_suppkey AS text FROM lineitem")
def sql_ixbrl(t):
    return in_sql(instances(t), "SELECT l_orderkey, f.name, f.context, f.unit, f.scale, f.sign, f.text FROM {rows} AS r, LATERAL parse_ixbrl(r.html) AS f")


FIRST = "min(CASE WHEN l_linenumber = {0} THEN v END)"


@query("sql_ixbrl_columns", "WITH v AS (SELECT l_orderkey, l_returnflag, l_linenumber, arg_min(CAST(l_partkey AS VARCHAR) || ' & ' || l_suppkey, '<ix:nonFraction name=''p:c' || l_linenumber || ''' contextRef=''' || l_returnflag || ''' scale=''6''' || CASE WHEN l_linestatus = 'O' THEN ' unitRef=''JPY''' ELSE '' END || '><b>' || l_partkey || '</b> &amp; ' || l_suppkey || '</ix:nonFraction>') AS v FROM lineitem WHERE l_linenumber IN (1, 2) GROUP BY 1, 2, 3) SELECT l_orderkey, l_returnflag AS context, " + FIRST.format(1) + " AS c1, " + FIRST.format(2) + " AS c2 FROM v GROUP BY 1, 2")
def sql_ixbrl_columns(t):
    return in_sql(instances(t), "SELECT l_orderkey, f.* FROM {rows} AS r, LATERAL parse_ixbrl(r.html, 'c1, c2') AS f")


@query("sql_linkbase", "SELECT r_name, 'loc' AS kind, 'L' || n_nationkey AS a, n_name AS b FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT r_name, 'label', 'T' || n_nationkey, lower(n_name) FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT r_name, 'arc', 'L' || n_nationkey, 'T' || n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey")
def sql_linkbase(t):
    key = F.col("n_nationkey").cast("string")
    link = F.concat(F.lit("<link:loc xlink:href='s.xsd#p:"), F.col("n_name"), F.lit("' xlink:label='L"), key, F.lit("'/><link:label xlink:label='T"), key, F.lit("'>"), F.lower("n_name"), F.lit("</link:label><link:label xlink:label='V' xlink:role='x/verboseLabel'>no</link:label><link:labelArc xlink:from='L"), key, F.lit("' xlink:to='T"), key, F.lit("'/>"))
    rows = t.raw("nation").join(t.raw("region"), F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.array_join(F.collect_list(link), "").alias("links"))
    rows = rows.select("r_name", F.concat(F.lit("<link:linkbase xmlns:link='l' xmlns:xlink='http://www.w3.org/1999/xlink'>"), "links", F.lit("</link:linkbase>")).alias("xml"))
    return in_sql(rows, "SELECT r_name, f.kind, f.a, f.b FROM {rows} AS r, LATERAL parse_linkbase(r.xml) AS f")


@query("sql_html_sections", "SELECT c_nationkey, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment) - 1 AS INTEGER) AS section_index, c_mktsegment AS heading, string_agg(c_name || ' & co', chr(10) ORDER BY c_custkey) AS content FROM customer GROUP BY c_nationkey, c_mktsegment")
def sql_html_sections(t):
    line = F.concat(F.lit("<p>"), F.col("c_name"), F.lit(" &amp; co</p>"))
    parts = t.raw("customer").groupBy("c_nationkey", "c_mktsegment").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", line.alias("line")))), lambda x: x["line"]), "").alias("body"))
    one = F.concat(F.lit("<h2>"), F.col("c_mktsegment"), F.lit("</h2>"), "body")
    pages = parts.groupBy("c_nationkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_mktsegment", one.alias("part")))), lambda x: x["part"]), "").alias("html"))
    return in_sql(pages, "SELECT c_nationkey, f.section_index, f.heading, f.content FROM {rows} AS r, LATERAL parse_html_sections(r.html) AS f")


def zipped(files: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in files.items():
            z.writestr(name, text)
    return out.getvalue()


def put_zips(rows, folder: str, more: dict[str, str]) -> str:
    """Writes rows (k, name, content), those of a k in one task, as members of p<k>.zip, one by one as they come, and some more."""
    root = folder if ":" in folder.split("/")[0] else f"file://{folder}"

    def run(batches):
        system, path = fs.FileSystem.from_uri(root)
        system.create_dir(path)
        with contextlib.ExitStack() as stack:
            books = {}
            for b in batches:
                for k, name, content in zip(*(b.column(c).to_pylist() for c in ("k", "name", "content"))):
                    if k not in books:
                        books[k] = stack.enter_context(zipfile.ZipFile(stack.enter_context(system.open_output_stream(f"{path}/p{k}.zip")), "w", zipfile.ZIP_DEFLATED))
                        for n, text in more.items():
                            books[k].writestr(n, text)
                    books[k].writestr(name, content)
        yield pa.record_batch([pa.array(list(books), pa.int32())], names=["k"])

    rows.select("k", "name", "content").mapInArrow(run, "k int").write.format("noop").mode("overwrite").save()
    return root


@query("packages_source", "SELECT 'p' || (l_orderkey % 50) || '.zip' AS package, 'p:c' || l_linenumber AS name, l_returnflag AS context, CAST(l_partkey AS VARCHAR) || ' & ' || l_suppkey AS text FROM lineitem")
def packages_source(t):
    """The facts of fifty packages, read by the data source."""
    found = packages.facts(packaged(t).where("kind = 'fact'"))
    return found.select(F.element_at(F.split("package", "/"), -1).alias("package"), "name", F.col("context_id").alias("context"), "text")


def packaged(t):
    """Fifty packages of instances, a schema and a broken linkbase, as the data source reads them."""
    rows = instances(t).select((F.col("l_orderkey") % 50).cast("int").alias("k"), F.concat(F.col("l_orderkey").cast("string"), F.lit("-ixbrl.htm")).alias("name"), F.col("html").alias("content"))
    spark = rows.sparkSession
    root = put_zips(rows.repartitionById(50, "k"), new_folder(spark, "packages"), {"s.xsd": "<schema><element name='a' type='b'/></schema>", "x-lab.xml": "not well formed"})
    package_source.register(spark)
    return spark.read.format("report_packages").option("runBytes", 1 << 16).load(root)


SHEET = "<worksheet xmlns='http://schemas.openxmlformats.org/spreadsheetml/2006/main'><sheetData>{}</sheetData></worksheet>"


@query("workbook_records", "SELECT c_nationkey, CAST(c_custkey AS VARCHAR) AS company_code, trim(c_name) AS name_en, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS name_ja, CAST(CAST(DATE '2024-01-01' + CAST(c_custkey % 300 AS INTEGER) AS DATE) AS VARCHAR) AS listed FROM customer WHERE c_custkey % 7 > 0")
def workbook_records(t):
    """Companies of a workbook for each nation: names by shared strings, dates by style, missing and blank cells."""
    names = t.raw("customer").groupBy("c_nationkey").agg(F.collect_list(F.struct("c_custkey", "c_name", "c_mktsegment")).alias("rows"))

    def book(batches):
        for b in batches:
            out = []
            for rows in b.column("rows").to_pylist():
                strings = ["name_en", "listed", "company_code", "name_ja"] + [x for r in rows for x in (f" {r['c_name']} ", r["c_mktsegment"])]
                lines = ["<row r='1'><c r='A1' t='s'><v>0</v></c><c r='B1' t='s'><v>1</v></c><c r='C1' t='s'><v>2</v></c><c r='E1' t='s'><v>3</v></c></row>"]
                for i, r in enumerate(rows):
                    n, k = i + 3, r["c_custkey"]
                    cells = f"<c r='A{n}' t='s'><v>{4 + 2 * i}</v></c><c r='B{n}' s='1'><v>{45292 + k % 300}</v></c>"
                    cells += f"<c r='C{n}'><v>{k}.0</v></c>" if k % 7 else f"<c r='C{n}' t='inlineStr'><is><t> </t></is></c>"
                    cells += f"<c r='E{n}' t='s'><v>{5 + 2 * i}</v></c>" if k % 3 else ""
                    lines.append(f"<row r='{n}'>{cells}</row>")
                out.append(
                    zipped(
                        {
                            "xl/workbook.xml": "<workbook xmlns:r='http://schemas.openxmlformats.org/officeDocument/2006/relationships'><sheets><sheet name='S' r:id='r1'/></sheets></workbook>",
                            "xl/_rels/workbook.xml.rels": "<Relationships><Relationship Id='r1' Target='worksheets/sheet1.xml'/></Relationships>",
                            "xl/styles.xml": "<styleSheet><cellXfs><xf numFmtId='0'/><xf numFmtId='14'/></cellXfs></styleSheet>",
                            "xl/sharedStrings.xml": "<sst>" + "".join(f"<si><t>{s}</t></si>" for s in strings) + "</sst>",
                            "xl/worksheets/sheet1.xml": SHEET.format("".join(lines)),
                        }
                    )
                )
            yield pa.record_batch([b.column("c_nationkey"), pa.array(out, pa.binary())], names=["c_nationkey", "content"])

    books = names.mapInArrow(book, "c_nationkey int, content binary")
    rows = workbooks.records(workbooks.workbook_rows(books, "c_nationkey", "content"), "c_nationkey", ["company_code", "name_en"], ["name_ja", "listed"])
    return rows.select("c_nationkey", "company_code", "name_en", "name_ja", "listed")


@query("companies_csv", "SELECT CAST(c_custkey AS VARCHAR) AS ticker, CASE WHEN c_custkey % 5 > 0 THEN c_name || ', \"Inc\"' END AS name, CASE WHEN c_custkey % 4 > 0 THEN CAST(CAST(DATE '2020-01-01' + CAST(c_custkey % 900 AS INTEGER) AS DATE) AS VARCHAR) END AS listed_date, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment || '|' || c_nationkey END AS aliases FROM customer WHERE c_custkey % 5 > 0")
def companies_csv(t):
    """Companies written as a CSV file and read again, with blanks, quotes, days and lists."""
    k = F.col("c_custkey")
    day = F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (k % 900).cast("int")), "M/d/yyyy")
    name = F.when(k % 5 > 0, F.concat(F.lit("  "), "c_name", F.lit(', "Inc" '))).otherwise("  ")
    rows = t.raw("customer").select(k.cast("string").alias("ticker"), name.alias("name"), F.when(k % 4 > 0, day).otherwise("no day").alias("listed_date"), F.when(k % 3 > 0, F.concat("c_mktsegment", F.lit(" ; ;"), F.col("c_nationkey").cast("string"))).otherwise(" ; ").alias("aliases"))
    folder = new_folder(rows.sparkSession, "companies")
    rows.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder)
    out = tables.required(tables.read_companies(rows.sparkSession, folder), "ticker", "name")
    return out.select("ticker", "name", F.col("listed_date").cast("string").alias("listed_date"), F.array_join("aliases", "|").alias("aliases"))


@query("written_tables", " UNION ALL ".join(f"SELECT '{kind}' AS kind, o_orderkey, o_orderstatus, o_totalprice FROM orders" for kind in ("parquet", "orc", "json", "csv")))
def written_tables(t):
    """Orders written in each kind of file, by status, and read again."""
    rows, out = t.raw("orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), None
    for kind in ("parquet", "orc", "json", "csv"):
        folder = new_folder(rows.sparkSession, f"orders-{kind}")
        tables.write(rows, folder, kind, ["o_orderstatus"])
        reader = rows.sparkSession.read.schema("o_orderkey long, o_totalprice double, o_orderstatus string").option("header", True)
        one = getattr(reader, kind)(folder).select(F.lit(kind).alias("kind"), *rows.columns)
        out = one if out is None else out.unionByName(one)
    return out


KINDS = ["x:monetaryItemType", "x:stringItemType", "nonnumeric:textBlockItemType", "x:decimalItemType", "x:dateItemType", "x:numberItemType", "perShareItemType", "longTextType", "bool:booleanFlag"]


@query("concept_types", "SELECT p_partkey, CASE p_partkey % 9 WHEN 0 THEN 'monetary' WHEN 3 THEN 'decimal' WHEN 5 THEN 'decimal' WHEN 7 THEN 'string' WHEN 8 THEN 'boolean' END AS kind FROM part")
def concept_types(t):
    raw = F.element_at(F.array(*map(F.lit, KINDS)), (F.col("p_partkey") % 9 + 1).cast("int"))
    return t.raw("part").select("p_partkey", xbrl.item_type(raw).alias("kind"))


@query("label_links", "SELECT r_name AS package, n_name AS local_name, CASE WHEN n_nationkey % 3 = 0 THEN lower(n_name) ELSE 'by id ' || n_nationkey END AS label FROM nation JOIN region ON n_regionkey = r_regionkey")
def label_links(t):
    """Labels that reach their concept by an arc, or by the pattern of their id where there is none."""
    rows = t.raw("nation").join(t.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    key, name, by_arc = F.col("n_nationkey").cast("string"), F.col("n_name"), F.col("n_nationkey") % 3 == 0
    link = lambda kind, a, b, at: F.struct(F.lit(kind).alias("kind"), a.alias("a"), b.alias("b"), (F.col("n_nationkey") * 4 + at).cast("long").alias("position"))
    loc, arc = link("loc", F.concat(F.lit("L"), key), name, 0), link("arc", F.concat(F.lit("L"), key), F.concat(F.lit("T"), key), 1)
    text = F.when(by_arc, link("label", F.concat(F.lit("T"), key), F.lower(name), 2)).otherwise(link("label", F.concat(F.lit("p_"), name, F.lit("_label_x")), F.concat(F.lit("by id "), key), 2))
    links = rows.select(F.col("r_name").alias("package"), F.explode(F.array(loc, arc, text)).alias("x")).select("package", "x.*")
    return xbrl.labels(links).select("package", "local_name", "label")


@query("package_values", "WITH v AS (SELECT l_orderkey % 50 AS k, l_linenumber AS n, CAST(l_partkey AS VARCHAR) || ' & ' || l_suppkey AS v, l_orderkey || '-ixbrl.htm' AS path, '<ix:nonFraction name=''p:c' || l_linenumber || ''' contextRef=''' || l_returnflag || ''' scale=''6''' || CASE WHEN l_linestatus = 'O' THEN ' unitRef=''JPY''' ELSE '' END || '><b>' || l_partkey || '</b> &amp; ' || l_suppkey AS f FROM lineitem) SELECT 'p' || k || '.zip' AS package, arg_min(v, (path, f)) FILTER (WHERE n = 1) AS c1, arg_min(v, (path, f)) FILTER (WHERE n = 2) AS c2 FROM v GROUP BY k")
def package_values(t):
    """The first value of two tags in each package."""
    found = packages.first_values(packaged(t).where("kind = 'fact'"), ["c1", "c2"])
    return found.withColumn("package", F.element_at(F.split("package", "/"), -1))
