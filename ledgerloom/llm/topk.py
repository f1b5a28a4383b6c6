"""Exact top-k inner products with MaxScore over shards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.common import written

BLOCKS = "dim int, block long, n int, ids binary, data binary"


def packed(batches, rows: int):
    """Rows (id, v) as blocks of `rows` vectors of one length; the number of a block comes from its partition."""
    waiting: dict[int, tuple[list, list]] = {}
    made, part = 0, TaskContext.get().partitionId() << 33

    def block(dim):
        nonlocal made
        ids, vectors = waiting.pop(dim)
        made += 1
        out = [np.array(ids, np.int64).tobytes(), np.stack(vectors).tobytes()]
        return pa.record_batch([pa.array([dim], pa.int32()), pa.array([part + made], pa.int64()), pa.array([len(ids)], pa.int32()), pa.array(out[:1], pa.binary()), pa.array(out[1:], pa.binary())], names=["dim", "block", "n", "ids", "data"])

    for b in batches:
        for i, v in zip(b.column("id").to_pylist(), b.column("v")):
            v = v.values.to_numpy(zero_copy_only=False)
            ids, vectors = waiting.setdefault(len(v), ([], []))
            ids.append(i)
            vectors.append(v)
            if len(ids) == rows:
                yield block(len(v))
    for dim in list(waiting):
        yield block(dim)


class Shard:
    """Vectors as postings by component, with the bounds that MaxScore needs."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.postings = np.ascontiguousarray(vectors[order].T)
        self.low, self.high = self.postings.min(1), self.postings.max(1)

    def search(self, query: np.ndarray, own: int, k: int, floor: int | None = None, step: int = 8) -> list[tuple[int, int]]:
        """The k best (score, id) of floor at least, ties to smaller ids, without rows of the query's own id.

        A component of the query adds its weight times a value between the shard's
        bounds. Terms go in descending order of that spread. Terms are non-essential
        if, with the least that all others add, the most that they add does not reach
        the threshold: no vector gets in by them alone. The others are traversed for
        all vectors; non-essential ones are then probed, some at a time, for those
        vectors alone whose score and the most that is left reach the threshold,
        which is floor at first and rises to the k-th best score with the least that
        is left.
        """
        lowest, highest = np.minimum(query * self.low, query * self.high), np.maximum(query * self.low, query * self.high)
        terms = np.argsort(lowest - highest, kind="stable")
        most = np.append(np.cumsum(highest[terms][::-1])[::-1], 0)
        least = np.append(np.cumsum(lowest[terms][::-1])[::-1], 0)
        alive = np.flatnonzero(self.ids != own)
        if floor is None:  # the best of some vectors, scored whole, are a threshold
            some = alive[:: max(1, len(alive) // (16 * k))]
            if len(some) >= k:
                floor = int(np.partition(query @ self.postings[:, some], len(some) - k)[len(some) - k])
        at = len(terms)
        if floor is not None:
            reach = least[0] - least + most  # the first terms at their least, the others at their most
            at = int(np.searchsorted(-reach, -floor, side="right"))
        at = min(max(at, 1), len(terms))
        score = (query[terms[:at]] @ self.postings[terms[:at]])[alive]
        while True:
            threshold = floor
            if len(alive) > k:
                risen = int(np.partition(score, len(score) - k)[len(score) - k] + least[at])
                threshold = risen if floor is None else max(floor, risen)
            if threshold is not None:
                keep = score + most[at] >= threshold
                if not keep.all():
                    alive, score = alive[keep], score[keep]
            if at >= len(terms):
                break
            some = terms[at : at + step]
            score = score + query[some] @ self.postings[some][:, alive]
            at += len(some)
        best = np.lexsort((self.ids[alive], -score))[:k]
        return [(int(score[i]), int(self.ids[alive[i]])) for i in best]


def arrays(r: dict, ids: str, data: str) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(r[ids], np.int64), np.frombuffer(r[data], np.int64).reshape(-1, r["dim"])


def top_k(vectors: DataFrame, queries: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, scale: int = 256, shard_rows: int = 8192, query_rows: int = 4096) -> DataFrame:
    """The k rows of greatest integer inner product for each query row, exactly.

    Components x become floor(scale * x). Vectors are packed into shards, queries
    into blocks. Every block first meets one shard of its length, whose k-th best
    score is a threshold for each query; it then meets all shards, each pair in a
    task by itself (the stated query set against all rows), which answers with
    MaxScore from that threshold on, and the shards'
    answers are merged by a window whose partial form keeps k rows each. A task
    holds a shard and a block: 8 bytes for each component of their rows.

    Vectors that are null or hold nulls or components that are not finite take no
    part, neither do rows with a null id; vectors of any length are compared with
    those of their own. Ties go to the smaller id. Rows of the query's own id are no
    candidates; other repeated rows each count. Scores are 64-bit integers. No
    rows or no queries: no rows. Other columns are ignored.

    Returns query_id, rank, id_col, score.
    """

    def whole(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
        finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        return rows.where(F.col("id").isNotNull() & F.col("x").isNotNull() & finite & (F.size("x") > 0)).select("id", F.transform("x", lambda x: F.floor(x * scale).cast("long")).alias("v"))

    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = written(whole(vectors).mapInArrow(lambda b: packed(b, shard_rows), BLOCKS), "shards")
    blocks = written(whole(queries).mapInArrow(lambda b: packed(b, query_rows), BLOCKS), "queries")
    named = shards.select("dim", F.col("block").alias("shard"), F.col("ids").alias("shard_ids"), F.col("data").alias("shard_data"))
    first = shards.groupBy("dim").agg(F.min("block").alias("shard")).join(named, ["dim", "shard"])

    def floors(batches):
        """Blocks with the k-th best score of each query in one shard, the least number if it has fewer."""
        for b in batches:
            for r in b.to_pylist():
                known = Shard(*arrays(r, "shard_ids", "shard_data"))
                found = [known.search(v, q, k) for q, v in zip(*map(list, arrays(r, "ids", "data")))]
                floor = np.array([x[-1][0] if len(x) == k else np.iinfo(np.int64).min for x in found], np.int64)
                yield pa.record_batch([pa.array([r["dim"]], pa.int32()), pa.array([r["block"]], pa.int64()), pa.array([r["ids"]], pa.binary()), pa.array([r["data"]], pa.binary()), pa.array([floor.tobytes()], pa.binary())], names=["dim", "block", "ids", "data", "floors"])

    met = blocks.join(first, "dim").repartition(parts, "dim", "block").select("dim", "block", "ids", "data", "shard_ids", "shard_data")
    ready = written(met.mapInArrow(floors, "dim int, block long, ids binary, data binary, floors binary"), "floors")
    pairs = ready.select("dim", "block").join(shards.select("dim", F.col("block").alias("shard")), "dim")
    grid = pairs.join(named, ["dim", "shard"]).join(ready, ["dim", "block"]).repartition(parts, "dim", "shard", "block")

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                known, (ids, queries) = Shard(*arrays(r, "shard_ids", "shard_data")), arrays(r, "ids", "data")
                least = np.iinfo(np.int64).min
                found = [(q, s, i) for q, v, f in zip(ids.tolist(), queries, np.frombuffer(r["floors"], np.int64).tolist()) for s, i in known.search(v, q, k, None if f == least else f)]
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found)] if found else [pa.array([], pa.int64())] * 3, names=["query_id", "score", "found"])

    near = grid.select("dim", "shard_ids", "shard_data", "ids", "data", "floors").mapInArrow(run, "query_id long, score long, found long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), F.asc("found")))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("found").alias(id_col), "score")


def op4(vectors: DataFrame) -> DataFrame:
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), e AS (
  SELECT vec_id, unnest(range(len(v))) AS i, unnest(v) AS x, len(v) AS n FROM v
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(sum(q.x * d.x) AS BIGINT) AS score
  FROM e q JOIN e d ON q.i = d.i AND q.n = d.n AND q.vec_id <> d.vec_id
  WHERE q.vec_id % 50 = 0
  GROUP BY 1, 2
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""
