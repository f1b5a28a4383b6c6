"""Indexes of vectors and words: recall against brute force, hot lists, odd rows."""

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from ledgerloom.operators import text_index, vector_index
from ledgerloom.shared import new_folder


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.read.parquet(f"{SF}/embeddings.parquet")


def nearest(vectors, k):
    rows = sorted((r["vec_id"], r["embedding"]) for r in vectors.collect())
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    score = (x @ x.T).round(12)
    return {int(i): set(ids[np.lexsort((ids, -score[n]))[:k]].tolist()) for n, i in enumerate(ids)}


def recall(found, truth):
    got = {}
    for r in found.collect():
        got.setdefault(r["query"], set()).add(r["key"])
    return np.mean([len(got.get(q, set()) & t) / len(t) for q, t in truth.items()])


def test_recall_over_every_vector(spark, vectors):
    truth = nearest(vectors, 10)
    lists = vector_index.InvertedLists.build(vectors, new_folder(spark, "ivf"), key="vec_id", vector="embedding", lists=20, slice_rows=7)
    assert max(lists.slices.values()) > 2  # lists are cut into slices
    assert recall(lists.search(vectors, key="vec_id", vector="embedding", probes=15, block=50), truth) >= 0.9
    assert recall(lists.search(vectors, key="vec_id", vector="embedding", probes=20, block=50), truth) == 1
    graphs = vector_index.NeighbourGraphs.build(vectors, new_folder(spark, "graph"), key="vec_id", vector="embedding", shard_rows=200, degree=12)
    nodes = spark.read.parquet(f"{graphs.folder}/nodes")
    assert nodes.count() == len(truth) and nodes.agg(F.max(F.size("near"))).first()[0] <= 24 and nodes.select("shard").distinct().count() > 1
    assert recall(graphs.search(vectors, key="vec_id", vector="embedding", block=100), truth) >= 0.9


def test_only_probed_lists_are_read(spark, vectors):
    lists = vector_index.InvertedLists.build(vectors, new_folder(spark, "ivf"), key="vec_id", vector="embedding", lists=10)
    plan = lists.search(vectors.where("vec_id = 3"), key="vec_id", vector="embedding", probes=2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [list" in plan


def test_odd_vectors(spark):
    """Null, empty, zero and non-finite vectors are in no list; copies tie by key."""
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [None, 1.0]), (None, [1.0, 1.0]), (9, [])]
    df = spark.createDataFrame(rows, "id long, v array<double>").withColumn("list", F.lit("clash"))
    lists = vector_index.InvertedLists.build(df, new_folder(spark, "ivf"), key="id", vector="v", lists=2)
    found = {(r["query"], r["rank"]): r["key"] for r in lists.search(df, key="id", vector="v", k=2, probes=2).collect()}
    assert found == {(1, 1): 1, (1, 2): 2, (2, 1): 1, (2, 2): 2, (3, 1): 3, (3, 2): 1}
    graphs = vector_index.NeighbourGraphs.build(df, new_folder(spark, "graph"), key="id", vector="v")
    assert {(r["query"], r["rank"]): r["key"] for r in graphs.search(df, key="id", vector="v", k=2).collect()} == found
    none = df.limit(0)
    assert vector_index.InvertedLists.build(none, new_folder(spark, "ivf"), key="id", vector="v").search(df, key="id", vector="v").count() == 0
    assert vector_index.NeighbourGraphs.build(none, new_folder(spark, "graph"), key="id", vector="v").search(df, key="id", vector="v").count() == 0


@pytest.mark.parametrize("word, expected", [("classes", "class"), ("companies", "company"), ("glass", "glass"), ("bonus", "bonus"), ("reports", "report"), ("reporting", "report"), ("reported", "report"), ("gas", "gas"), ("nationalization", "nationalize"), ("relational", "relate"), ("quickly", "quick"), ("statements", "state")])
def test_stems(spark, word, expected):
    assert spark.range(1).select(text_index.stem(F.lit(word)).alias("s")).first()["s"] == expected


def test_text_search_of_odd_rows(spark):
    docs = [(1, "Revenue rises and revenue grows"), (2, "The revenue of a company"), (3, None), (4, ""), (5, "the and of"), (6, "company reports, REPORTED report"), (7, "Umsatz für Österreich")]
    df = spark.createDataFrame(docs, "id long, body string").withColumn("term", F.lit("clash"))
    index = text_index.TextIndex.build(df, new_folder(spark, "words"), key="id", text="body")
    asked = spark.createDataFrame([("a", "revenue reports"), ("b", "the"), ("c", None), ("d", "unknownword"), ("e", "österreich Österreich")], "q string, body string")
    found = [(r["query"], r["doc"], r["rank"]) for r in index.search(asked, key="q", text="body", k=3).orderBy("query", "rank").collect()]
    assert found == [("a", 6, 1), ("a", 1, 2), ("a", 2, 3), ("e", 7, 1)]
    assert sorted(map(tuple, index.phrase("revenue", "rises").collect())) == [(1, 0)]
    assert text_index.TextIndex.build(df.limit(0), new_folder(spark, "words"), key="id", text="body").search(asked, key="q", text="body").count() == 0


def test_pruned_search_equals_all_scores(spark):
    """Frequent terms are not essential once rare ones give k texts; what is found stays the same."""
    import random

    rng = random.Random(1)
    docs = [(i, " ".join(["common"] * rng.randint(1, 4) + [f"w{rng.randint(0, 30)}x" for _ in range(rng.randint(1, 30))])) for i in range(300)]
    df = spark.createDataFrame(docs, "id long, body string")
    index = text_index.TextIndex.build(df, new_folder(spark, "words"), key="id", text="body", head=20)
    asked = spark.createDataFrame([(i, f"common w{i}x w{i + 9}x") for i in range(12)], "q long, body string")
    found = sorted((r["query"], r["rank"], r["doc"], r["score"]) for r in index.search(asked, key="q", text="body", k=5).collect())
    lists = index.table("postings").join(index.table("terms"), "term").select("term", "doc", text_index.weight(F.col("df"), index.total, F.col("part")).alias("w")).collect()
    expected = []
    for q in range(12):
        score = {}
        for r in lists:
            if r["term"] in ("common", f"w{q}x", f"w{q + 9}x"):
                score[r["doc"]] = score.get(r["doc"], 0) + r["w"]
        best = sorted(score.items(), key=lambda x: (-x[1], x[0]))[:5]
        expected += [(q, n + 1, d, s) for n, (d, s) in enumerate(best)]
    assert found == expected
