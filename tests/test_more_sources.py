"""Table functions, the package source and spreadsheets: odd rows, errors and what is never opened."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans.sources import SHEET, zipped
from ledgerloom.sources import functions, package_source, packages, workbooks

FILES = {
    "a-ixbrl.htm": "<ix:nonFraction name='p:Sales' contextRef='c1' unitRef='JPY'>1,000</ix:nonFraction><ix:nonFraction name='p:Sales' contextRef='c2'>5</ix:nonFraction><x name='q:Other' contextref='c1'/>",
    "dir/s.xsd": "<s:schema xmlns:s='x'><s:element name='Sales' type='money'/></s:schema>",
    "dir/s-lab.xml": "<l xmlns:x='http://www.w3.org/1999/xlink'><loc x:href='s.xsd#p:Sales' x:label='L'/><label x:label='T'>Sales of all</label><labelArc x:from='L' x:to='T'/></l>",
    "b-lab.xml": "<not well formed",
    "read.me": "text",
}


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "one.zip").write_bytes(zipped(FILES))
    (tmp_path / "in" / "two.zip").write_bytes(zipped({f"{i}.htm": FILES["a-ixbrl.htm"] * 50 for i in range(9)}))
    (tmp_path / "bad.zip").write_bytes(b"no zip")
    (tmp_path / "empty.zip").write_bytes(zipped({}))
    return str(tmp_path)


def rows(df):
    return sorted(((r["package"].rsplit("/", 1)[-1], *r[1:]) for r in df.select("package", "path", "kind", "position", "a", "b", "c", "d", "e", "f", "error").collect()), key=str)


@pytest.mark.parametrize("run_bytes", [1 << 30, 1000])
def test_source_gives_what_packages_give(spark, folder, run_bytes):
    package_source.register(spark)
    ours = spark.read.format("report_packages").option("runBytes", run_bytes).load(folder)
    assert rows(ours) == rows(packages.read_packages(spark, folder))
    for kind in ("fact", "concept", "label", "file", "package"):
        assert rows(ours.where(F.col("kind") == kind)) == rows(packages.read_packages(spark, folder).where(F.col("kind") == kind))
    assert ours.rdd.getNumPartitions() > (5 if run_bytes == 1000 else 2)


def test_a_filter_on_kind_opens_no_other_member(spark, tmp_path):
    """The bytes of the instance are spoilt: who opens it gets an error."""
    raw = bytearray(zipped({"a-ixbrl.htm": "<x name='n' contextRef='c'>spoilt</x>" * 40, "s.xsd": FILES["dir/s.xsd"]}))
    at = raw.index(b"a-ixbrl.htm") + 20
    raw[at : at + 10] = b"\xff" * 10
    (tmp_path / "x.zip").write_bytes(bytes(raw))
    package_source.register(spark)
    source = spark.read.format("report_packages").load(str(tmp_path))
    assert source.where("error is not null").count() == 1
    reader = package_source.PackageReader({"path": str(tmp_path)})
    from pyspark.sql.datasource import EqualTo, In

    assert list(reader.pushFilters([EqualTo(("kind",), "concept"), In(("kind",), ("concept", "label"))])) and reader.kinds == {"concept"}
    assert not reader.wanted("a-ixbrl.htm") and reader.wanted("s.xsd")
    opened = [b.column("path").to_pylist() for run in reader.partitions() for b in reader.read(run)]
    assert opened == [["s.xsd", "s.xsd"]]
    assert [(r["a"], r["b"]) for r in source.where("kind = 'concept'").collect()] == [("Sales", "money")]


@pytest.mark.parametrize("before", [b"", b"sent before the package"])
def test_a_run_reads_its_own_part_of_the_directory(tmp_path, monkeypatch, before):
    """Runs of a package know where their entries are, none looks through all of them, and members go on together."""
    n = 70_000  # more than the records of small archives can count
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        for i in range(n):
            z.writestr(f"{i}.xsd", "<schema><element name='a'/></schema>")
    (tmp_path / "x.zip").write_bytes(before + (tmp_path / "x.zip").read_bytes())
    reader = package_source.PackageReader({"path": str(tmp_path), "runBytes": 50_000})
    runs = reader.partitions()
    assert sum(r.count for r in runs) == n and max(r.count for r in runs) < 2000
    infos = []
    monkeypatch.setattr(zipfile.ZipInfo, "_decodeExtra", lambda self, *_: infos.append(self.filename), raising=False)
    batches = [b for r in (runs[0], runs[-1]) for b in reader.read(r)]
    assert len(infos) <= runs[0].count + runs[-1].count and len(batches) == 2
    assert batches[0].column("path")[0].as_py() == "0.xsd" and f"{n - 1}.xsd" in batches[1].column("path").to_pylist()
    monkeypatch.setattr(package_source, "MOST", 4)
    assert 1 < len(reader.partitions()) <= 8


def test_table_functions(spark):
    functions.register(spark)
    df = spark.createDataFrame([(1, FILES["a-ixbrl.htm"]), (2, ""), (3, None)], "id int, x string")
    sql = lambda q: [tuple(r) for r in spark.sql(q, t=df).collect()]
    assert sql("SELECT id, f.name, f.context, f.text FROM {t} AS t, LATERAL parse_ixbrl(t.x) AS f ORDER BY f.position") == [(1, "p:Sales", "c1", "1,000"), (1, "p:Sales", "c2", "5"), (1, "q:Other", "c1", None)]
    assert sorted(sql("SELECT id, f.* FROM {t} AS t, LATERAL parse_ixbrl(t.x, 'Sales, Missing') AS f")) == [(1, "c1", "1,000", None), (1, "c2", "5", None)]
    links = spark.createDataFrame([(FILES["dir/s-lab.xml"],), (FILES["dir/s.xsd"],), (FILES["b-lab.xml"],), (None,)], "x string")
    out = [tuple(r)[:3] for r in spark.sql("SELECT f.* FROM {t} AS t, LATERAL parse_linkbase(t.x) AS f", t=links).collect()]
    assert sorted(out, key=str) == sorted([("loc", "L", "Sales"), ("label", "T", "Sales of all"), ("arc", "L", "T"), ("concept", "Sales", "money"), ("error", None, None)], key=str)
    page = spark.createDataFrame([("<h1>A</h1><p>b</p><table><tr><td>c</td><td>d</td></tr></table>",), (None,)], "x string")
    assert [tuple(r) for r in spark.sql("SELECT f.heading, f.content FROM {t} AS t, LATERAL parse_html_sections(t.x) AS f", t=page).collect()][0][0] == "A"
    assert [r["cells"] for r in spark.sql("SELECT f.cells FROM {t} AS t, LATERAL parse_html_table(t.x) AS f", t=page).collect()] == [["c", "d"]]


@pytest.mark.parametrize("call", ["parse_ixbrl(t.id)", "parse_ixbrl(t.x, t.x)", "parse_ixbrl(t.x, 'a, A')", "parse_html_sections(t.id)"])
def test_table_functions_refuse_when_analysed(spark, call):
    functions.register(spark)
    df = spark.createDataFrame([(1, "x")], "id int, x string")
    with pytest.raises(Exception, match="asked for|constant|twice"):
        spark.sql(f"SELECT f.* FROM {{t}} AS t, LATERAL {call} AS f", t=df)


BOOK = {
    "xl/workbook.xml": "<workbook xmlns:r='http://schemas.openxmlformats.org/officeDocument/2006/relationships'><sheets><sheet name='First' r:id='r1'/><sheet name='Second' r:id='r2'/></sheets></workbook>",
    "xl/_rels/workbook.xml.rels": "<Relationships><Relationship Id='r1' Target='worksheets/sheet1.xml'/><Relationship Id='r2' Target='/xl/worksheets/sheet2.xml'/></Relationships>",
    "xl/styles.xml": "<styleSheet><numFmts><numFmt numFmtId='170' formatCode='yyyy\"y\"mm'/><numFmt numFmtId='171' formatCode='[Red]0.00'/></numFmts><cellXfs><xf numFmtId='0'/><xf numFmtId='170'/><xf numFmtId='171'/></cellXfs></styleSheet>",
    "xl/sharedStrings.xml": "<sst><si><t>company_code</t></si><si><t>name_en</t></si><si><r><t>rich </t></r><r><t>text</t></r><rPh><t>reading</t></rPh></si></sst>",
    "xl/worksheets/sheet1.xml": SHEET.format("<row r='2'><c r='B2' t='s'><v>0</v></c><c r='AA2' t='s'><v>1</v></c></row><row r='4'><c r='B4'><v>7203</v></c><c r='AA4' t='s'><v>2</v></c></row><row r='5'><c r='B5'><v>1</v></c><c r='AA5' t='inlineStr'><is><t>  </t></is></c></row><row r='6'/>"),
    "xl/worksheets/sheet2.xml": SHEET.format("<row><c s='1'><v>45292.5</v></c><c s='2'><v>1.5</v></c><c t='b'><v>1</v></c><c t='e'><v>#N/A</v></c><c t='str'><v>f</v></c><c s='1'><v>59</v></c><c s='1'><v>61</v></c></row>"),
}


def test_workbooks(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(zipped(BOOK))
    (tmp_path / "b.xlsx").write_bytes(b"no book")
    (tmp_path / "c.xlsx").write_bytes(zipped(BOOK | {"xl/sharedStrings.xml": "<sst/>"}))
    out = workbooks.read_workbooks(spark, str(tmp_path)).withColumn("path", F.element_at(F.split("path", "/"), -1)).cache()
    own = [(r["sheet"], r["row"], r["cells"]) for r in out.where("path = 'a.xlsx'").collect()]
    none = [None] * 24
    assert own == [("First", 2, [None, "company_code", *none, "name_en"]), ("First", 4, [None, "7203", *none, "rich text"]), ("First", 5, [None, "1", *none, "  "]), ("Second", 1, ["2024-01-01 12:00:00", "1.5", "true", None, "f", "1900-02-28", "1900-03-01"])]
    assert {r["path"] for r in out.where("error is not null").collect()} == {"b.xlsx", "c.xlsx"}
    assert [tuple(r) for r in workbooks.records(out, "path", ["company_code"], ["name_en"]).orderBy("row").collect()] == [("a.xlsx", "First", 4, "7203", "rich text"), ("a.xlsx", "First", 5, "1", None)]
    assert [r["company_code"] for r in workbooks.records(out, "path", ["company_code", "name_en"]).collect()] == ["7203"]
    assert workbooks.records(out, "path", ["company_code", "missing"]).count() == 0
    assert workbooks.workbook_rows(spark.createDataFrame([(1, None)], "id int, x binary"), "id", "x").count() == 0


def test_large_sheets_are_streamed():
    """A sheet of many rows is never a tree as a whole."""
    lines = "".join(f"<row r='{i}'><c r='A{i}'><v>{i}</v></c></row>" for i in range(1, 20_001))
    book = zipped(BOOK | {"xl/worksheets/sheet1.xml": SHEET.format(lines)})
    assert sum(1 for s, *_ in workbooks.rows_of(book) if s == "First") == 20_000
    with zipfile.ZipFile(io.BytesIO(book)) as z:
        kept = [len(list(e)) for e in workbooks.elements(z, "xl/worksheets/sheet1.xml", "row")]
    assert kept and max(kept) == 0 or max(kept) == 1
