"""The corpus pipeline: documents through five stages, each written as Parquet and read again.

Of the stages, the first three filter. They drop toxic documents, all but one
document of every near-duplicate component, and contaminated documents; all
others go through with the columns and values they had. The fourth repeats or
leaves out documents so that sources meet their token targets, and the last
stores them in shards and tells where each is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import common, decontaminate, jaccard_join, mixing, sharding, toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold.

    Null and empty texts, and all documents where there are no labels to learn from,
    stay. Whole texts are scored, however long. Rows that are repeated stay as often as
    they come, if they stay. Null ids are scored as others. No documents: no rows.
    """
    scored = toxicity.score_toxicity(docs, common.table(spark, sf_dir, "labels"), keep=COLUMNS)
    return scored.where("predicted = 0").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies.

    It is the one of the smallest id; documents without an id come after all others,
    and of one id the one whose columns have the least hash. Of rows that are equal in
    all columns one stays. Null and empty texts are near copies of nothing, so all that
    differ in some column stay. No documents: no rows.
    """
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64(*COLUMNS).alias("a"), F.xxhash64(F.lit(1), *COLUMNS).alias("b"))
    keyed = docs.select(key.alias("key"), *COLUMNS)
    joined = common.written(jaccard_join.jaccard_components(keyed, id_col="key"), "components")
    first = joined.where("key = component_id").groupBy("key").agg((F.count(F.lit(1)) > 1).alias("several"))
    kept = keyed.join(first, "key")
    if first.where("several").isEmpty():
        return kept.select(*COLUMNS)
    once = kept.where("several").select(*COLUMNS).dropDuplicates()
    return kept.where("not several").select(*COLUMNS).unionByName(once)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark passages.

    Null and empty texts, and all documents where the benchmark is empty, stay. Whole
    texts are compared, however long. Repeated rows are judged alike. Null ids are
    judged as others. No documents: no rows.
    """
    found = decontaminate.contamination(docs, common.table(spark, sf_dir, "benchmark"), keep=COLUMNS)
    return found.where(~decontaminate.is_contaminated()).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, none to two times.

    Null sources are a source; null and empty texts are taken once. Rows that tie are
    told apart by their ids. No documents: no rows.
    """
    return mixing.repeated(docs, COLUMNS)


def store_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of a new shard store: each document and the shard that holds it.

    Rows are stored as they are, with nulls, repeats and texts of any length. No
    documents: no rows.
    """
    return sharding.shard(docs.select(*COLUMNS), ["doc_id", "source", "n_chars"])


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", store_shards),
]

#: The scores of the first stage and the tilt of the fourth have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = common.table(spark, sf_dir, "documents")
    before = []
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
        common.forget(*before)  # a stage is written, so what it was made of is not needed
        before = [docs]
    return docs
