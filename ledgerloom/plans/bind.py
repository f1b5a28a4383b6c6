"""Domain tables derived from the test tables, as DataFrames and as SQL for the oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The seed rows of units, and contexts with their parts.
UNITS = [(1, "JPY", 6, "JPY_Mil"), (2, "JPY", 0, "JPY"), (3, "JPY", 3, "JPY_Thou"), (4, "USD", 6, "USD_Mil"), (5, "SHR", 0, "Shares"), (6, "PUR", 0, "Pure"), (7, "PUR", -2, "Percent")]
CONTEXTS = [
    "CurrentAccumulatedQ3Duration_ConsolidatedMember_ResultMember",
    "CurrentYearDuration_ConsolidatedMember_ResultMember",
    "NextYearDuration_NonConsolidatedMember_ForecastMember",
    "CurrentYTDDuration",
    "FilingDateInstant",
    "InterimInstant_NonConsolidatedMember_UpperMember",
    "Prior1YearInstant",
]
#: The context after the first five is left out of the table, so that the views' defaults show.
DIMS = [
    (CONTEXTS[0], "Current", "Duration", 3, True, "Result"),
    (CONTEXTS[1], "Current", "Duration", 99, True, "Result"),
    (CONTEXTS[2], "Next", "Duration", 99, False, "Forecast"),
    (CONTEXTS[3], "Current", "Duration", 0, None, None),
    (CONTEXTS[4], "Filing", "Instant", None, None, None),
]


class Tables:
    """The test tables of one folder and the domain tables bound to them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def literal(self, rows: list[tuple], schema: str) -> DataFrame:
        """A small table of constants, made of SQL values so that no Python runs for it."""
        names = [c.split() for c in schema.split(", ")]
        show = lambda v, t: f"CAST(NULL AS {t})" if v is None else f"CAST('{v}' AS {t})"
        values = ", ".join("(" + ", ".join(show(v, t) for v, (_, t) in zip(r, names)) + ")" for r in rows)
        return self.spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(n for n, _ in names)})")

    def companies(self) -> DataFrame:
        c, n, r = self.raw("customer"), self.raw("nation"), self.raw("region")
        joined = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        return joined.select(F.col("c_custkey").alias("id"), F.lpad(F.col("c_custkey").cast("string"), 4, "0").alias("ticker"), F.col("c_name").alias("company_name_english"), F.col("c_mktsegment").alias("sector_english"), F.col("r_name").alias("exchange"))

    def disclosures(self) -> DataFrame:
        key, minute = F.col("o_orderkey"), F.col("o_orderkey") % 1440
        two = lambda c: F.lpad(c.cast("string"), 2, "0")
        return self.raw("orders").select(
            key.alias("id"),
            F.to_date("o_orderdate").alias("disclosure_date"),
            F.concat(two(F.floor(minute / 60)), F.lit(":"), two(minute % 60)).alias("time"),
            F.concat(F.lpad(F.col("o_custkey").cast("string"), 4, "0"), F.when(key % 2 == 0, "0").otherwise("")).alias("company_code"),
            F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("title"),
            (key % 3 != 0).alias("has_xbrl"),
        )

    def filings(self) -> DataFrame:
        key, year = F.col("o_orderkey"), F.year("o_orderdate")
        return (
            self.raw("orders")
            .select(
                key.alias("id"),
                F.col("o_custkey").alias("company_id"),
                key.alias("disclosure_id"),
                F.make_date(year, F.lit(1), F.lit(1)).alias("period_start"),
                F.make_date(year, F.lit(12), F.lit(31)).alias("period_end"),
                year.alias("fiscal_year"),
                F.element_at(F.array(*map(F.lit, (1, 2, 3, 99))), (key % 4 + 1).cast("int")).alias("fiscal_quarter"),
                F.when(key % 5 == 0, None).when(key % 5 <= 2, "JGAAP").otherwise("IFRS").alias("accounting_standard"),
                F.when(key % 7 == 0, None).otherwise(key % 7 < 4).alias("has_consolidated"),
                F.when(F.col("o_orderstatus") == "P", True).when(F.col("o_orderstatus") == "F", False).alias("amendment_flag"),
            )
        )

    def _section_id(self):
        flag = F.when(F.col("l_returnflag") == "R", 0).when(F.col("l_returnflag") == "A", 2).otherwise(4)
        return F.col("l_orderkey") * 10 + flag + F.when(F.col("l_linestatus") == "O", 1).otherwise(0)

    def sections(self) -> DataFrame:
        role = F.when(F.col("l_returnflag") == "R", "Summary").when(F.col("l_returnflag") == "A", "Balance sheet").otherwise("Profit-and-loss")
        rows = self.raw("lineitem").select("l_orderkey", "l_returnflag", "l_linestatus").distinct()
        return rows.select(self._section_id().alias("id"), F.col("l_orderkey").alias("filing_id"), role.alias("statement_role_en"), F.concat(F.lower("l_returnflag"), F.lit("/"), F.lower("l_linestatus"), F.lit("-ixbrl.htm")).alias("rel_path"))

    def facts(self) -> DataFrame:
        context = F.element_at(F.array(*map(F.lit, CONTEXTS)), F.col("l_linenumber"))
        unit = F.when(F.col("l_linestatus") == "O", 1).when(F.col("l_linenumber") % 2 == 0, 4).otherwise(9)
        tie = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
        return self.raw("lineitem").select(self._section_id().alias("section_id"), (F.col("l_partkey") % 50).cast("int").alias("concept_id"), context.alias("context_id"), unit.alias("unit_id"), F.col("l_extendedprice").cast("decimal(38,2)").alias("value"), tie.alias("fact_order"))

    def concepts(self) -> DataFrame:
        """Fifty concepts, each of all parts whose key leaves its number."""
        key = F.col("id")
        rows = self.raw("part").groupBy((F.col("p_partkey") % 50).cast("int").alias("id")).agg(F.min("p_name").alias("local_name"), F.max(F.concat_ws(" ", "p_brand", "p_type")).alias("label"), F.min(F.lower("p_type")).alias("item_type"))
        prefix = F.element_at(F.array(*map(F.lit, ("jppfs_cor", "jpcrp_cor", "jpdei_cor", "tse-ed-t"))), key % 4 + 1)
        return rows.select("id", prefix.alias("taxonomy_prefix"), "local_name", F.when(key % 3 != 0, F.col("label")).alias("std_label_en"), "item_type")

    def units(self) -> DataFrame:
        return self.literal(UNITS, "id INT, currency STRING, scale INT, unit_code STRING")

    def contexts(self) -> DataFrame:
        return self.literal(DIMS, "context_id STRING, period_base STRING, period_type STRING, fiscal_span INT, consolidated BOOLEAN, forecast_variant STRING")


def _values(rows: list[tuple]) -> str:
    show = lambda v: "NULL" if v is None else str(v).upper() if isinstance(v, bool) else f"'{v}'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(map(show, r)) + ")" for r in rows)


SECTION_ID = "l_orderkey * 10 + CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 2 ELSE 4 END + CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END"

#: Common table expressions of the same tables for DuckDB.
BIND = f"""
companies AS (
  SELECT c_custkey AS id, lpad(CAST(c_custkey AS VARCHAR), 4, '0') AS ticker, c_name AS company_name_english, c_mktsegment AS sector_english, r_name AS exchange
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
disclosures AS (
  SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS disclosure_date,
    lpad(CAST((o_orderkey % 1440) // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST((o_orderkey % 1440) % 60 AS VARCHAR), 2, '0') AS time,
    lpad(CAST(o_custkey AS VARCHAR), 4, '0') || CASE WHEN o_orderkey % 2 = 0 THEN '0' ELSE '' END AS company_code,
    o_orderpriority || ' ' || o_orderstatus AS title, o_orderkey % 3 <> 0 AS has_xbrl
  FROM orders),
filings AS (
  SELECT o_orderkey AS id, o_custkey AS company_id, o_orderkey AS disclosure_id,
    make_date(year(o_orderdate), 1, 1) AS period_start, make_date(year(o_orderdate), 12, 31) AS period_end, CAST(year(o_orderdate) AS INTEGER) AS fiscal_year,
    CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 99 END AS fiscal_quarter,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 <= 2 THEN 'JGAAP' ELSE 'IFRS' END AS accounting_standard,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey % 7 < 4 END AS has_consolidated,
    CASE o_orderstatus WHEN 'P' THEN TRUE WHEN 'F' THEN FALSE END AS amendment_flag
  FROM orders),
sections AS (
  SELECT DISTINCT {SECTION_ID} AS id, l_orderkey AS filing_id,
    CASE l_returnflag WHEN 'R' THEN 'Summary' WHEN 'A' THEN 'Balance sheet' ELSE 'Profit-and-loss' END AS statement_role_en,
    lower(l_returnflag) || '/' || lower(l_linestatus) || '-ixbrl.htm' AS rel_path
  FROM lineitem),
facts AS (
  SELECT {SECTION_ID} AS section_id, CAST(l_partkey % 50 AS INTEGER) AS concept_id,
    list_extract([{", ".join(f"'{c}'" for c in CONTEXTS)}], l_linenumber) AS context_id,
    CASE WHEN l_linestatus = 'O' THEN 1 WHEN l_linenumber % 2 = 0 THEN 4 ELSE 9 END AS unit_id,
    CAST(l_extendedprice AS DECIMAL(38, 2)) AS value,
    l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate
  FROM lineitem),
concepts AS (
  SELECT id, list_extract(['jppfs_cor', 'jpcrp_cor', 'jpdei_cor', 'tse-ed-t'], id % 4 + 1) AS taxonomy_prefix, local_name, CASE WHEN id % 3 <> 0 THEN label END AS std_label_en, item_type
  FROM (SELECT CAST(p_partkey % 50 AS INTEGER) AS id, min(p_name) AS local_name, max(p_brand || ' ' || p_type) AS label, min(lower(p_type)) AS item_type FROM part GROUP BY 1)),
units AS (SELECT * FROM (VALUES {_values(UNITS)}) t(id, currency, scale, unit_code)),
contexts AS (SELECT * FROM (VALUES {_values(DIMS)}) t(context_id, period_base, period_type, fiscal_span, consolidated, forecast_variant))"""
