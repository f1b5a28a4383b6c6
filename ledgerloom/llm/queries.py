"""The queries of the corpus operators, as __spark_entry__.py registers them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import byte_bpe, decontaminate, html_extract, jaccard_join, language, mixing, point_in_time, resampling, secrets, sharding, suffix_dedup, topk, toxicity
from ledgerloom.llm.common import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.op3(table(spark, sf_dir, "documents"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.op4(table(spark, sf_dir, "embeddings"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op5(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.op6(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), ["doc_id"])


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.op9(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.op11(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.op12(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_point_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return point_in_time.op13(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_secret_scan": op2_secret_scan,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_topk": op4_topk,
    "op5_mixing": op5_mixing,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_sharding": op8_sharding,
    "op9_decontamination": op9_decontamination,
    "op10_html_extraction": op10_html_extraction,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_point_in_time": op13_point_in_time,
}
ORACLES: dict[str, str] = {
    "op3_jaccard_join": jaccard_join.OP3_SQL,
    "op4_topk": topk.OP4_SQL,
    "op6_suffix_dedup": suffix_dedup.OP6_SQL,
    "op9_decontamination": decontaminate.OP9_SQL,
    "op12_importance_resampling": resampling.OP12_SQL,
    "op13_point_in_time": point_in_time.OP13_SQL,
}
