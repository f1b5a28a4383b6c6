"""Packages, listings, tables and streams."""

import os
import zipfile

from pyspark.sql import functions as F

from ledgerloom.operators import xbrl
from ledgerloom.sources import html, packages, tables
from ledgerloom.streaming import events

INSTANCE = '<html><body><p>x<ix:nonfraction name="jppfs_cor:NetSales" contextRef="CurrentYearDuration" unitRef="JPY" scale="6" sign="-">1,<b>234</b></ix:nonfraction><ix:nonnumeric contextref="FilingDateInstant" name="tse-ed-t:FilingDate">2024-02-14</ix:nonnumeric><br></body>'
SCHEMA = '<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="Own" type="xbrli:monetaryItemType"/><xs:element name="Text" type="nonnum:textBlockItemType"/></xs:schema>'
LABELS = '<l xmlns:x="http://www.w3.org/1999/xlink"><loc x:href="a.xsd#tse_Own" x:label="loc1"/><label x:label="lab1" x:role="r">Own sales</label><label x:label="lab_Other_label" x:role="r">Other</label><label x:label="lab2" x:role="verboseLabel">Long</label><labelArc x:from="loc1" x:to="lab1"/></l>'


def test_packages(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("Summary/s-ixbrl.htm", INSTANCE)
        z.writestr("x.xsd", SCHEMA)
        z.writestr("x-lab.xml", LABELS)
        z.writestr("bad.xsd", "<broken")
    (tmp_path / "b.zip").write_bytes(b"no zip")
    rows = packages.read_packages(spark, str(tmp_path)).cache()
    facts = {(r["name"], r["context_id"], r["unit"], r["scale"], r["sign"], r["text"]) for r in packages.facts(rows).collect()}
    assert facts == {("jppfs_cor:NetSales", "CurrentYearDuration", "JPY", 6, "-", "1,234"), ("tse-ed-t:FilingDate", "FilingDateInstant", "", 0, None, "2024-02-14")}
    assert packages.first_values(rows, ["FilingDate", "Missing"]).select("FilingDate", "Missing").first() == ("2024-02-14", None)
    kinds = rows.where("kind = 'concept'").select("a", xbrl.item_type(F.col("b")).alias("t")).collect()
    assert {tuple(r) for r in kinds} == {("Own", "monetary"), ("Text", None)}
    assert {(r["local_name"], r["label"]) for r in xbrl.labels(packages.linkbase(rows)).collect()} == {("tse_Own", "Own sales"), ("Other", "Other")}
    assert rows.where("error is not null").count() == 2
    rows.unpersist()


LISTING = "<table><tr><td>15:30</td><td>13010</td><td>A&nbsp;Co</td><td><a href='x.pdf'>決算短信</a></td><td><a href='081.zip'>X</a></td></tr><tr><td>soon</td><td>1302</td><td>B</td><td>配当</td><td></td></tr></table>"


def test_listing(spark):
    pages = spark.createDataFrame([(1, LISTING), (2, None), (3, "")], "id int, html string")
    out = html.listing(html.table_rows(pages, "id", "html"), "id", F.lit("2024-01-05").cast("date"))
    assert [(r["time"], r["company_code"], r["company_name"], r["title"], r["xbrl_url"]) for r in out.orderBy("row_index").collect()] == [("15:30", "13010", "A Co", "決算短信", "081.zip"), ("00:00", "1302", "B", "配当", None)]
    assert html.between_times(out, "15:30", "15:30").count() == 1


def test_sections_and_lines(spark):
    page = "<h2>Results</h2><p>Good   year</p><h2>Table</h2><table><tr><th>Item</th><th>Value</th></tr><tr><td>Sales</td><td>10</td></tr></table>"
    pages = spark.createDataFrame([(1, page)], "id int, html string")
    assert [(r["heading"], r["content"]) for r in html.sections(pages, "id", "html").orderBy("section_index").collect()][0] == ("Results", "Good year")
    assert html.table_lines(html.table_rows(pages, "id", "html"), "id").first()["line"] == "Item: Sales | Value: 10"


def test_tables(spark, tmp_path):
    (tmp_path / "c.csv").write_text("ticker,aliases,listing_date\n1301, a ; b;;,3/9/2001\n1302,,\n", encoding="utf-8-sig")
    rows = tables.read_companies(spark, str(tmp_path / "c.csv")).orderBy("ticker").collect()
    assert rows[0]["aliases"] == ["a", "b"] and str(rows[0]["listing_date"]) == "2001-03-09" and rows[1]["aliases"] is None
    (tmp_path / "c.json").write_text('{"NetSales": {"taxonomy_prefix": "jppfs", "std_label_en": "Net sales"}}')
    assert tables.read_concepts(spark, str(tmp_path / "c.json")).first()["local_name"] == "NetSales"
    for kind in ("parquet", "orc", "json", "csv"):
        tables.write(spark.range(3), str(tmp_path / kind), kind)
        assert spark.read.format(kind).load(str(tmp_path / kind)).count() >= 3


def test_stream_ingest_is_idempotent(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, "a", 1), (1, "a", 2), (None, "b", 3)], "code int, title string, at int").write.parquet(src)
    for attempt in range(2):
        stream = spark.readStream.schema("code int, title string, at int").parquet(src)
        events.ingest_absent(stream, out, ["code", "title"], ["at"], str(tmp_path / f"cp{attempt}")).awaitTermination()
    assert {tuple(r) for r in spark.read.parquet(out).collect()} == {(1, "a", 1), (None, "b", 3)}


def test_stream_windows_equal_batch(spark, tmp_path):
    from conftest import SF

    batch = spark.read.parquet(f"{SF}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "user_id")
    batch.coalesce(1).write.parquet(str(tmp_path / "ev"))
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "ev"))
    query = events.window_counts(stream, "ts", "1 hour", ["event_type"]).writeStream.outputMode("complete").format("memory").queryName("counts").trigger(availableNow=True).start()
    query.awaitTermination()
    expected = events.window_counts(batch, "ts", "1 hour", ["event_type"])
    assert sorted(map(tuple, spark.table("counts").collect())) == sorted(map(tuple, expected.collect()))


def test_facts_that_hold_facts(spark):
    page = "<ix:nonNumeric name='a' contextRef='c'>one <ix:nonNumeric name='b' contextRef='c'>two</ix:nonNumeric> three <ix:nonNumericX/></ix:nonNumeric><ix:nonNumeric name='d' contextRef='c'>open"
    out = packages.instance_facts(spark.createDataFrame([(1, page), (2, None)], "id int, html string"), "id", "html").orderBy("position").collect()
    assert [(r["name"], r["text"]) for r in out] == [("a", "one two three "), ("b", "two"), ("d", None)]


def test_pages_end_at_the_first_empty_one(spark):
    pages = spark.createDataFrame([(k, p) for k in "abc" for p in range(1, 5)], "k string, p int")
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("a", 4), ("b", 2), ("b", 3)], "k string, p int")
    assert sorted(map(tuple, html.before_first_empty(pages, rows, "k", "p").collect())) == [("a", 1), ("a", 2)]


def test_chain_of_new_rows(spark, tmp_path):
    """Rows that arrive are labelled and counted once, whatever comes again."""
    derive = {
        "labels": lambda new, made: new.select("id", F.upper("title").alias("label")),
        "facts": lambda new, made: new.join(made["labels"], "id").select("id", F.length("label").alias("n")),
    }
    source, root = tmp_path / "in", str(tmp_path / "out")
    for part in ([(1, "a"), (1, "a"), (2, "bb")], [(2, "again"), (3, "ccc")], [(3, "ccc")]):
        spark.createDataFrame(part, "id long, title string").coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema("id long, title string").parquet(str(source))
        events.ingest_chain(stream, root, ["id"], ["title"], str(tmp_path / "check"), derive).awaitTermination()
    read = lambda name: sorted(tuple(r) for r in spark.read.parquet(f"{root}/{name}").drop("batch").collect())
    assert read("rows") == [(1, "a"), (2, "bb"), (3, "ccc")] and read("labels") == [(1, "A"), (2, "BB"), (3, "CCC")] and read("facts") == [(1, 1), (2, 2), (3, 3)]


def test_many_classes_meet_vectors_in_blocks(spark):
    from ledgerloom.operators import classify

    vectors = spark.createDataFrame([(i, [1.0, i / 10, (i % 3) / 3]) for i in range(30)], "id int, v array<double>")
    classes = spark.createDataFrame([(j, [1.0, j / 4, 0.2]) for j in range(12)], "label int, centroid array<double>")
    one = classify.nearest_centroid(vectors, "id", "v", classes, "label").orderBy("id").collect()
    many = classify.nearest_centroid(vectors, "id", "v", classes, "label", most=3).orderBy("id").collect()
    assert one == many and len({r["category"] for r in one}) > 3
