"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import forget, written


def told(edges: DataFrame) -> tuple:
    """What tells two sets of edges apart: their number, and their hashes summed and combined; no shuffle of edges."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(h.cast("decimal(38,0)"))).first())


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of all nodes of edges (a, b), root being the least node of a component.

    Large stars link larger neighbours to the least one, small stars the rest, until
    every node points at its root; each round is a table in the shared folder.
    Neighbours are never brought together: a node's least neighbour is an aggregate
    with partial sums, joined back to its edges.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = told(edges)
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        # a is above all its b: link them and a itself to the least.
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        after = written(small, "edges")
        forget(edges)
        edges, before, seen = after, seen, told(after)
        if seen == before:
            break
    else:
        raise RuntimeError("components did not settle")
    pairs = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return pairs.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
