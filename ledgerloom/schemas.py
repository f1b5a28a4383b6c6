"""Tables of the domain, and checks of keys that must return no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TABLES = {
    "companies": "id INT, ticker STRING, company_name_english STRING, company_name_japanese STRING, sector_english STRING, exchange STRING",
    "disclosures": "id BIGINT, disclosure_date DATE, time STRING, company_code STRING, company_name STRING, title STRING, has_xbrl BOOLEAN",
    "xbrl_filings": "id BIGINT, company_id BIGINT, disclosure_id BIGINT, period_start DATE, period_end DATE, fiscal_year INT, fiscal_quarter INT, period_type STRING, accounting_standard STRING, has_consolidated BOOLEAN, industry_code STRING, amendment_flag BOOLEAN, parent_filing_id BIGINT",
    "filing_sections": "id BIGINT, filing_id BIGINT, rel_path STRING, period_prefix STRING, consolidated BOOLEAN, layout_code INT, statement_role_ja STRING, statement_role_en STRING",
    "financial_facts": "id BIGINT, section_id BIGINT, concept_id INT, context_id STRING, unit_id INT, value DECIMAL(38,2)",
    "concepts": "id INT, taxonomy_prefix STRING, local_name STRING, std_label_en STRING, std_label_ja STRING, item_type STRING",
    "context_dims": "context_id STRING, period_base STRING, period_type STRING, fiscal_span INT, consolidated BOOLEAN, forecast_variant STRING",
    "units": "id INT, currency STRING, scale INT, unit_code STRING",
    "disclosure_labels": "disclosure_id BIGINT, category_id INT, subcat_id INT, labeled_at TIMESTAMP",
    "document_chunks": "disclosure_id BIGINT, chunk_index INT, content STRING, content_type STRING, section_code STRING, heading_text STRING, char_length INT, tokens INT, vectorize BOOLEAN, is_numeric BOOLEAN, disclosure_hash STRING, source_file STRING, page_number INT, metadata MAP<STRING,STRING>",
    "status_events": "disclosure_id BIGINT, ts TIMESTAMP, status STRING, method STRING, duration DOUBLE, chunks INT",
}


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once; as in SQL, keys with nulls never clash."""
    whole = [F.col(k).isNotNull() for k in keys]
    return df.where(all_of(whole)).groupBy(*keys).count().where("count > 1")


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key is not null and not found in the parent table."""
    return df.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def outside(df: DataFrame, column: str, allowed: list) -> DataFrame:
    """Rows whose value is not null and not allowed."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(allowed))


def all_of(conditions: list) -> F.Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out
