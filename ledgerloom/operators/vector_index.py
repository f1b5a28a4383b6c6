"""Vector search by an index: inverted lists of k-means, and neighbour graphs."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.shared import forget, written


def unit_rows(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, v): vectors of length one; null vectors, those with null or non-finite numbers and those of length zero are left out."""
    v = F.col(vector).cast("array<double>")
    length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    rows = vectors.select(F.col(key).alias("key"), v.alias("v"), length.alias("length")).where("key is not null and length > 0 and length < double('infinity') and size(v) > 0")
    return rows.select("key", F.transform("v", lambda x: x / F.col("length")).alias("v"))


def matrix(column) -> np.ndarray:
    """A list column as rows of a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def nearest_lists(rows: DataFrame, centroids: np.ndarray, probes: int = 1) -> DataFrame:
    """rows (key, v) once for each of the `probes` lists of greatest inner product, with `list`; ties to the smaller list."""
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches):
        for b in batches:
            near = np.argsort(-(matrix(b.column("v")) @ centroids.T).round(12), axis=1, kind="stable")[:, :probes]
            at = pa.array(np.repeat(np.arange(b.num_rows), near.shape[1]))
            yield pa.record_batch([b.column("key").take(at), b.column("v").take(at), pa.array(near.ravel().astype(np.int32))], names=["key", "v", "list"])

    return rows.select("key", "v").mapInArrow(run, f"key {kind}, v array<double>, list int")


def lloyd(rows: DataFrame, lists: int, iterations: int = 10, least_move: float = 1e-3) -> np.ndarray:
    """Centroids of unit length of all rows (key, v), at most `lists` of them.

    The first are the vectors of `lists` keys of least hash. Each iteration reads all rows, adds them up
    task by task and list by list, and sends a sum for each list and dimension; it ends when no centroid moves by
    more than `least_move`. A list that gets no rows keeps its centroid. Only centroids reach the driver.
    """
    first = rows.orderBy(F.xxhash64("key"), "key").limit(lists).collect()
    at = np.unique(np.array([r["v"] for r in first]), axis=0) if first else np.zeros((0, 1))
    for _ in range(iterations if len(at) else 0):

        def sums(batches, at=at):
            total, count = np.zeros_like(at), np.zeros(len(at), np.int64)
            for b in batches:
                x = matrix(b.column("v"))
                near = np.argmax((x @ at.T).round(12), axis=1)
                np.add.at(total, near, x)
                count += np.bincount(near, minlength=len(at))
            some = np.flatnonzero(count)
            dims = at.shape[1]
            yield pa.record_batch([pa.array(np.repeat(some, dims).astype(np.int32)), pa.array(np.tile(np.arange(dims), len(some)).astype(np.int32)), pa.array(total[some].ravel())], names=["list", "dim", "total"])

        new = np.zeros_like(at)
        for r in rows.select("v").mapInArrow(sums, "list int, dim int, total double").groupBy("list", "dim").agg(F.sum("total").alias("total")).toLocalIterator():
            new[r["list"], r["dim"]] = r["total"]
        length = np.linalg.norm(new, axis=1, keepdims=True)
        new = np.where(length > 0, new / np.where(length > 0, length, 1), at).round(9)
        moved = np.abs(new - at).max()
        at = new
        if moved <= least_move:
            break
    return at


def top_of(hits: DataFrame, k: int) -> DataFrame:
    """The k hits (query, key, score) of each query, best first, ties to the smaller key, with `rank`."""
    order = W.partitionBy("query").orderBy(F.desc("score"), "key")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


#: Scores of queries and rows that are held at once.
SCORES = 1 << 20


def scored(left: pa.Table, right: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of queries (left) and rows (right): places of the k best rows of each query, as (query, row, score). Some queries at a time meet all rows."""
    asked, rows, out = matrix(left.column("v")), matrix(right.column("v")).T, []
    step = max(1, SCORES // max(1, rows.shape[1]))
    for at in range(0, len(asked), step):
        score = (asked[at : at + step] @ rows).round(12)
        if score.shape[1] > k:
            cut = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
            q, r = np.nonzero(score >= cut[:, None])
        else:
            q, r = (x.ravel() for x in np.indices(score.shape))
        out.append((q + at, r, score[q, r]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


class InvertedLists:
    """Vectors filed by the nearest of some centroids, a folder of files for each list.

    `postings` is partitioned by list; a list of many rows is dealt to slices of at most
    about `slice_rows` by a hash of the key, so that no list, however hot, meets in one task. `lists` tells the size
    and the centroid of each list, which are as many numbers as lists times dimensions.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        rows = spark.read.parquet(f"{folder}/lists").orderBy("list").collect()
        self.centroids = np.array([r["centroid"] for r in rows]) if rows else np.zeros((0, 1))
        self.slices = {r["list"]: r["slices"] for r in rows}

    @classmethod
    def build(cls, vectors: DataFrame, folder: str, *, key: str, vector: str, lists: int = 100, iterations: int = 10, slice_rows: int = 1 << 16, centroids: np.ndarray | None = None) -> InvertedLists:
        """Writes the index of all vectors; see unit_rows for those that are left out. Repeated keys are filed as often as they come."""
        spark = vectors.sparkSession
        rows = written(unit_rows(vectors, key, vector), "unit")
        at = lloyd(rows, lists, iterations) if centroids is None else centroids
        filed = written(nearest_lists(rows, at), "filed") if len(at) else written(rows.withColumn("list", F.lit(0)), "filed")
        sizes = {r["list"]: r["n"] for r in filed.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
        slices = [-(-sizes.get(i, 0) // slice_rows) or 1 for i in range(len(at))]
        table = [(i, sizes.get(i, 0), slices[i], [float(x) for x in c]) for i, c in enumerate(at)]
        spark.createDataFrame(table, "list int, n long, slices int, centroid array<double>").coalesce(1).write.parquet(f"{folder}/lists")
        cut = filed.withColumn("slice", slice_of(slices))
        cut.repartition("list", "slice").write.partitionBy("list").parquet(f"{folder}/postings")
        forget(rows, filed)
        return cls(spark, folder)

    def search(self, queries: DataFrame, *, key: str, vector: str, k: int = 10, probes: int = 10, block: int = 4096) -> DataFrame:
        """(query, key, score, rank): for each query the k most similar of the rows in the `probes` lists nearest to it, by cosine.

        Only the folders of lists that some query probes are read. Each slice of a list meets the queries that
        probe it in blocks of about `block`; of each block and slice k rows of a query go on. As many probes as lists
        give what a scan of all rows gives. A query itself is found if it is filed.
        """
        asked = written(nearest_lists(unit_rows(queries, key, vector), self.centroids, probes), "asked") if len(self.centroids) else None
        if asked is None:
            return queries.select(F.col(key).alias("query"), F.col(key).alias("key"), F.lit(0.0).alias("score"), F.lit(1).alias("rank")).limit(0)
        wanted = {r["list"]: r["n"] for r in asked.groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect()}
        blocks = [-(-wanted.get(i, 0) // block) or 1 for i in range(len(self.centroids))]
        filed = self.spark.read.parquet(f"{self.folder}/postings").where(F.col("list").isin(sorted(wanted)))
        number = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("list") + 1)
        left = asked.withColumn("block", slice_of(blocks)).withColumn("slice", F.explode(F.sequence(F.lit(0), number([self.slices[i] for i in range(len(blocks))]) - 1)))
        right = filed.withColumn("block", F.explode(F.sequence(F.lit(0), number(blocks) - 1)))
        kinds = asked.schema["key"].dataType.simpleString(), filed.schema["key"].dataType.simpleString()

        def best(a: pa.Table, b: pa.Table) -> pa.Table:
            q, r, s = scored(a, b, k)
            return pa.table([a.column("key").take(pa.array(q)), b.column("key").take(pa.array(r)), pa.array(s)], names=["query", "key", "score"])

        parts = ["list", "slice", "block"]
        hits = left.groupBy(*parts).cogroup(right.groupBy(*parts)).applyInArrow(best, f"query {kinds[0]}, key {kinds[1]}, score double")
        return top_of(hits, k)


def slice_of(numbers: list[int]) -> Column:
    """A number from 0 up to that of the row's list, by a hash of the key."""
    return F.pmod(F.xxhash64("key"), F.element_at(F.array(*map(F.lit, numbers or [1])), F.col("list") + 1)).cast("int")


# Neighbour graphs


def best_edges(edges: DataFrame, most: int) -> DataFrame:
    """Of edges (shard, a, b, score) the best of each node, each neighbour once."""
    once = edges.groupBy("shard", "a", "b").agg(F.max("score").alias("score"))
    order = W.partitionBy("shard", "a").orderBy(F.desc("score"), "b")
    return once.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= most).drop("_n")


def neighbours_met(rows: DataFrame, edges: DataFrame, degree: int) -> DataFrame:
    """Edges (shard, a, b, score) between all that are neighbours of one node, where they are better than the worst that a has."""
    back = edges.unionByName(edges.select("shard", F.col("b").alias("a"), F.col("a").alias("b"), "score"))
    worst = edges.groupBy("shard", F.col("a").alias("b")).agg(F.min("score").alias("worst"))
    near = best_edges(back, 2 * degree).select("shard", "a", "b").join(rows.select("shard", F.col("no").alias("b"), "v"), ["shard", "b"]).join(worst, ["shard", "b"])
    groups = near.groupBy("shard", "a").agg(F.collect_list(F.struct("b", "v", "worst")).alias("met"))

    def run(batches):
        for batch in batches:
            found = [[], [], [], []]
            for shard, met in zip(batch.column("shard").to_pylist(), batch.column("met")):
                part = met.values
                no, v, low = part.field("b").to_numpy(), matrix(part.field("v")), part.field("worst").to_numpy()
                score = (v @ v.T).round(12)
                i, j = np.nonzero((score > low[:, None]) & (no[:, None] != no[None, :]))
                for out, x in zip(found, (np.full(len(i), shard), no[i], no[j], score[i, j])):
                    out.append(x)
            yield pa.record_batch([pa.array(np.concatenate([np.zeros(0, t), *x]).astype(t)) for x, t in zip(found, (np.int32, np.int64, np.int64, np.float64))], names=["shard", "a", "b", "score"])

    return groups.select("shard", "met").mapInArrow(run, "shard int, a long, b long, score double")


def neighbour_graph(rows: DataFrame, degree: int, rounds: int = 8, least: float = 0.005) -> DataFrame:
    """Edges (shard, a, b, score): about the `degree` nearest rows of each row (shard, no, v) in its shard, by NN-descent.

    no counts the rows of a shard from 0. Random edges are replaced by better ones among the neighbours of
    neighbours, round by round, until a round replaces less than a share `least` of all. A node meets its 2 * degree
    best neighbours in both directions, so a row that is near to all others draws no more than that.
    """
    size = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    steps = rows.join(F.broadcast(size), "shard").where("n > 1").select("shard", "no", F.explode(F.sequence(F.lit(1), F.lit(degree))).alias("j"), "n")
    start = steps.select("shard", F.col("no").alias("a"), F.pmod(F.col("no") + 1 + F.pmod(F.xxhash64("no", "j"), F.col("n") - 1), F.col("n")).alias("b")).distinct()
    vector = lambda c: rows.select("shard", F.col("no").alias(c), F.col("v").alias(f"v{c}"))
    dot = F.round(F.aggregate(F.zip_with("va", "vb", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x), 12)
    edges = written(start.join(vector("a"), ["shard", "a"]).join(vector("b"), ["shard", "b"]).select("shard", "a", "b", dot.alias("score")), "graph")
    for _ in range(rounds):
        after = written(best_edges(edges.unionByName(neighbours_met(rows, edges, degree)), degree), "graph")
        total, kept = after.count(), after.join(edges, ["shard", "a", "b"], "left_semi").count()
        forget(edges)
        edges = after
        if total - kept <= least * total:
            break
    return edges


def beam(graph: list[np.ndarray], v: np.ndarray, query: np.ndarray, starts: np.ndarray, width: int) -> list[tuple[float, int]]:
    """The best of what a greedy walk meets: it goes on from the best node not left yet, until that is worse than the `width` best."""
    seen = np.zeros(len(v), bool)
    seen[starts] = True
    todo = [(-s, i) for s, i in zip((v[starts] @ query).tolist(), starts.tolist())]
    heapq.heapify(todo)
    best = [(-s, -i) for s, i in todo]  # least score, then greatest number, on top
    heapq.heapify(best)
    while len(best) > width:
        heapq.heappop(best)
    while todo and not (len(best) == width and -todo[0][0] < best[0][0]):
        _, i = heapq.heappop(todo)
        near = graph[i][~seen[graph[i]]]
        seen[near] = True
        for s, j in zip((v[near] @ query).tolist(), near.tolist()):
            if len(best) < width or (s, -j) > best[0]:
                heapq.heappush(todo, (-s, j))
                heapq.heappush(best, (s, -j))
                if len(best) > width:
                    heapq.heappop(best)
    return sorted(((s, -j) for s, j in best), key=lambda x: (-x[0], x[1]))


class NeighbourGraphs:
    """Vectors in shards of about `shard_rows` by a hash of the key, each with a graph of near neighbours.

    `nodes` holds (shard, no, key, v, near) with at most 2 * degree neighbours, forward and back, so that what is near to something
    can be reached from it.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @classmethod
    def build(cls, vectors: DataFrame, folder: str, *, key: str, vector: str, degree: int = 16, rounds: int = 8, shard_rows: int = 1 << 14) -> NeighbourGraphs:
        """Writes the graphs of all vectors; see unit_rows for those that are left out."""
        unit = written(unit_rows(vectors, key, vector), "unit")
        shards = max(math.ceil(unit.count() / shard_rows), 1)
        cut = unit.withColumn("at", F.monotonically_increasing_id()).withColumn("shard", F.pmod(F.xxhash64("key", "at"), F.lit(shards)).cast("int"))
        numbered = F.row_number().over(W.partitionBy("shard").orderBy(F.xxhash64("key"), "at")) - 1
        rows = written(cut.withColumn("no", numbered.cast("long")).drop("at"), "rows")
        edges = neighbour_graph(rows, degree, rounds)
        back = edges.unionByName(edges.select("shard", F.col("b").alias("a"), F.col("a").alias("b"), "score"))
        near = best_edges(back, 2 * degree).groupBy("shard", F.col("a").alias("no")).agg(F.array_sort(F.collect_list("b")).alias("near"))
        nodes = rows.join(near, ["shard", "no"], "left").withColumn("near", F.coalesce("near", F.array().cast("array<long>")))
        sizes = [(r["shard"], r["n"]) for r in rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()]
        unit.sparkSession.createDataFrame(sizes, "shard int, n long").coalesce(1).write.parquet(f"{folder}/shards")
        nodes.repartition("shard").sortWithinPartitions("shard", "no").write.partitionBy("shard").parquet(f"{folder}/nodes")
        forget(unit, rows, edges)
        return cls(vectors.sparkSession, folder)

    def search(self, queries: DataFrame, *, key: str, vector: str, k: int = 10, width: int = 64, starts: int = 16, block: int = 1024) -> DataFrame:
        """(query, key, score, rank): about the k most similar rows of each query, by cosine.

        Each shard meets all queries in blocks of about `block`; in it each query walks the graph from `starts` nodes with a beam of `width`, and
        the best k of all shards are kept.
        """
        shards = [r["shard"] for r in self.spark.read.parquet(f"{self.folder}/shards").collect()]
        if not shards:
            return queries.select(F.col(key).alias("query"), F.col(key).alias("key"), F.lit(0.0).alias("score"), F.lit(1).alias("rank")).limit(0)
        nodes = self.spark.read.parquet(f"{self.folder}/nodes")
        asked = written(unit_rows(queries, key, vector), "asked")
        blocks = -(-asked.count() // block) or 1
        left = asked.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.array(*map(F.lit, shards))))
        right = nodes.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        kinds = asked.schema["key"].dataType.simpleString(), nodes.schema["key"].dataType.simpleString()

        def walk(a: pa.Table, b: pa.Table) -> pa.Table:
            b = b.sort_by("no")
            v, found = matrix(b.column("v")), ([], [], [])
            graph = [np.array(x, np.int64) for x in b.column("near").to_pylist()]
            first = np.unique(np.linspace(0, max(len(v) - 1, 0), starts).astype(np.int64)) if len(v) else np.zeros(0, np.int64)
            for i, q in enumerate(matrix(a.column("v")) if len(v) else []):
                for s, j in beam(graph, v, q, first, max(width, k))[:k]:
                    for out, x in zip(found, (i, j, round(s, 12))):
                        out.append(x)
            return pa.table([a.column("key").take(pa.array(found[0], pa.int64())), b.column("key").take(pa.array(found[1], pa.int64())), pa.array(found[2], pa.float64())], names=["query", "key", "score"])

        parts = ["shard", "block"]
        hits = left.groupBy(*parts).cogroup(right.groupBy(*parts)).applyInArrow(walk, f"query {kinds[0]}, key {kinds[1]}, score double")
        return top_of(hits, k)
