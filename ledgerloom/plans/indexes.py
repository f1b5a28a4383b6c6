"""Queries over indexes of vectors and words, with their oracles."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.operators import text_index, vector_index
from ledgerloom.plans.bind import Tables
from ledgerloom.shared import new_folder

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def hits(df):
    return df.select(F.col("query").alias("query_id"), F.col("key").alias("vec_id"), F.col("rank").cast("int").alias("rank"), F.round("score", 6).alias("score"))


@query("vector_ivf")
def vector_ivf(t):
    """The ten nearest of every vector whose number is divisible by 20, by inverted lists of all vectors."""
    vectors = t.raw("embeddings")
    index = vector_index.InvertedLists.build(vectors, new_folder(vectors.sparkSession, "ivf"), key="vec_id", vector="embedding", lists=100)
    return hits(index.search(vectors.where("vec_id % 20 = 0"), key="vec_id", vector="embedding", k=10, probes=50))


@query("vector_graph")
def vector_graph(t):
    """The same by neighbour graphs."""
    vectors = t.raw("embeddings")
    index = vector_index.NeighbourGraphs.build(vectors, new_folder(vectors.sparkSession, "graph"), key="vec_id", vector="embedding")
    return hits(index.search(vectors.where("vec_id % 20 = 0"), key="vec_id", vector="embedding", k=10))


EXACT = """SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, round(s, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank FROM (
    SELECT q.vec_id AS query_id, v.vec_id, round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])), 12) AS s FROM embeddings q, embeddings v WHERE q.vec_id % 20 = 0))
WHERE rank <= 10"""


@query("vector_ivf_all_lists", EXACT)
def vector_ivf_all_lists(t):
    """The same where every list is probed: what a scan of all rows finds."""
    vectors = t.raw("embeddings")
    index = vector_index.InvertedLists.build(vectors, new_folder(vectors.sparkSession, "ivf"), key="vec_id", vector="embedding", lists=20)
    return hits(index.search(vectors.where("vec_id % 20 = 0"), key="vec_id", vector="embedding", k=10, probes=20))


CENTROIDS = "c AS (SELECT row_number() OVER (ORDER BY label) - 1 AS list, embedding AS c FROM (SELECT label, arg_min(embedding, vec_id) AS embedding FROM embeddings GROUP BY 1))"


@query("ivf_lists", f"WITH {CENTROIDS} SELECT vec_id, CAST(list AS INTEGER) AS list FROM (SELECT vec_id, list, row_number() OVER (PARTITION BY vec_id ORDER BY round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(c AS DOUBLE[])), 12) DESC, list) AS n FROM embeddings, c) WHERE n = 1")
def ivf_lists(t):
    """The list of every vector, where the first vector of each label is a centroid."""
    vectors = t.raw("embeddings")
    first = vectors.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("embedding"))
    given = vector_index.unit_rows(first, "label", "embedding").orderBy("key").collect()  # one row for each label
    rows = vector_index.unit_rows(vectors, "vec_id", "embedding")
    return vector_index.nearest_lists(rows, np.array([r["v"] for r in given])).select(F.col("key").alias("vec_id"), "list")


def suffix_sql(word: str, rules) -> str:
    return "CASE " + " ".join(f"WHEN {word} LIKE '%{end}' AND length({word}) >= {before + len(end)} THEN left({word}, length({word}) - {len(end)}) || '{new}'" for end, new, before in rules) + f" ELSE {word} END"


STOPS = ", ".join(f"'{w}'" for w in text_index.STOP_WORDS)


def postings_sql(name: str, table: str, key: str) -> str:
    """Terms of a table's texts with their places: (key, term, place)."""
    return f"""{name}w AS (SELECT {key}, unnest(w) AS w, unnest(range(len(w))) AS place FROM (SELECT {key}, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS w FROM {table})),
{name}p AS (SELECT {key}, place, {suffix_sql('p', text_index.PLURALS)} AS p FROM (SELECT {key}, place, w AS p FROM {name}w WHERE w NOT IN ({STOPS}))),
{name} AS (SELECT {key}, place, {suffix_sql('p', text_index.ENDINGS)} AS term FROM {name}p)"""


def indexed(t):
    docs = t.raw("documents")
    return text_index.TextIndex.build(docs, new_folder(docs.sparkSession, "words"), key="doc_id", text="text")


@query("text_index", f"WITH {postings_sql('d', 'documents', 'doc_id')} SELECT term, count(DISTINCT doc_id) AS df, count(*) AS n, CAST(sum(place) AS BIGINT) AS places, min(doc_id) AS first_doc FROM d GROUP BY 1")
def text_index_terms(t):
    """All terms with the number of texts and places that hold them."""
    lists = indexed(t).table("postings")
    return lists.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("n"), F.sum(F.aggregate("positions", F.lit(0).cast("long"), lambda a, x: a + x)).alias("places"), F.min("doc").alias("first_doc"))


SEARCH = f"""WITH {postings_sql('d', 'documents', 'doc_id')}, {postings_sql('q', 'benchmark', 'item_id')},
n AS (SELECT documents.doc_id, count(term) AS len FROM documents LEFT JOIN d USING (doc_id) GROUP BY 1), a AS (SELECT count(*) AS total, avg(len) AS average FROM n),
f AS (SELECT term, doc_id, count(*) AS tf FROM d GROUP BY ALL), g AS (SELECT term, count(*) AS df FROM f GROUP BY 1),
s AS (SELECT item_id, f.doc_id, sum(CAST(round(1e6 * ln(1 + (total - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * (tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len / average)))) AS BIGINT)) AS score
  FROM (SELECT DISTINCT item_id, term FROM q) JOIN f USING (term) JOIN g USING (term) JOIN n USING (doc_id), a GROUP BY ALL)
SELECT item_id, doc_id, CAST(score AS BIGINT) AS score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s) WHERE rank <= 10"""


@query("text_search", SEARCH)
def text_search(t):
    """The ten documents that match each benchmark text best."""
    return indexed(t).search(t.raw("benchmark"), key="item_id", text="text").select(F.col("query").alias("item_id"), F.col("doc").alias("doc_id"), "score", F.col("rank").cast("int").alias("rank"))
