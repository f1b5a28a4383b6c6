"""Importance resampling towards a target distribution, on hashed word grams."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import forget, pieces, share, written
from ledgerloom.operators.numbering import ranked

#: Bytes to bytes: ASCII letters in lower case, digits and non-ASCII bytes as they are, all else a separator.
KEPT = bytes(32 if b < 0x30 or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


class Dictionary:
    """The words of some texts as integers.

    ids are those of all words on end, bounds the places where each text begins and ends
    among them, and words the letters of each id, a space after each.
    """

    def __init__(self, texts: list[str | None]):
        kept = [b" ".join(t.encode().translate(KEPT).split()) + b" " if t else b"" for t in texts]
        kept = [k if k != b" " else b"" for k in kept]
        raw = b"".join(kept)
        ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 32) + 1
        self.bounds = np.searchsorted(ends, np.cumsum([0, *map(len, kept)]), "right")
        offsets = np.concatenate([[0], ends]).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]).dictionary_encode()
        self.ids, self.words = words.indices.to_numpy().astype(np.int64), words.dictionary.to_pylist()

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(tuples, which, owner): the distinct tuples of n consecutive ids of one text, and for each run of n words its tuple's row and its text."""
        owner = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        if n == 1:
            return np.arange(len(self.words))[:, None], self.ids, owner
        if len(self.ids) < n:
            return np.zeros((0, n), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        same = owner[: len(owner) - n + 1] == owner[n - 1 :]
        which = self.ids[: len(same)][same]
        for k in range(1, n):  # a tuple of k ids has a number of its own, so that a longer one is a pair of numbers
            _, which = np.unique(which * len(self.words) + self.ids[k : k + len(same)][same], return_inverse=True)
        _, first = np.unique(which, return_index=True)
        starts = np.flatnonzero(same)
        return self.ids[starts[first][:, None] + np.arange(n)], which, owner[starts]

    def buckets(self, tuples: np.ndarray, buckets: int) -> np.ndarray:
        """The bucket of each tuple: its words, joined by single spaces, are hashed once."""
        words = self.words
        if tuples.shape[1] == 1:
            return np.fromiter((zlib.crc32(words[i][:-1]) for i in tuples[:, 0].tolist()), np.int64, len(tuples)) % buckets
        return np.fromiter((zlib.crc32(b"".join(map(words.__getitem__, t))[:-1]) for t in tuples.tolist()), np.int64, len(tuples)) % buckets


def features(known: Dictionary, least: int, most: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text) of every feature, run length by run length."""
    for n in range(least, most + 1):
        tuples, which, owner = known.grams(n)
        yield known.buckets(tuples, buckets)[which], owner


def bucket_counts(docs: DataFrame, text_col: str, least: int, most: int, buckets: int, piece: int) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, texts in pieces(b, piece):
                for bucket, _ in features(Dictionary(texts), least, most, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.record_batch([pa.array(there), pa.array(total[there])], names=["bucket", "n"])

    rows = docs.select(F.lit(0).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """The gain of each bucket, from counts (bucket, n) of both sides: how much likelier the target holds it, as floored thousandths of a logarithm, one added to each count."""
    all_, wanted = (float((df.agg(F.sum("n")).first()[0] or 0) + buckets) for df in (docs, target))
    each = docs.select("bucket", F.col("n").alias("s"), F.lit(0).alias("t")).unionByName(target.select("bucket", F.lit(0).alias("s"), F.col("n").alias("t")))
    each = each.unionByName(docs.sparkSession.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).alias("s"), F.lit(0).alias("t")))
    one = lambda c: (F.sum(c) + 1).cast("double")
    gains = each.groupBy("bucket").agg(F.floor(1000 * F.log((one("t") * all_) / (one("s") * wanted))).alias("gain"))
    out = np.zeros(buckets, np.int64)
    for r in gains.collect():  # as many rows as there are buckets
        out[r["bucket"]] = r["gain"]
    return out


def weights(docs: DataFrame, gains: np.ndarray, id_col: str, text_col: str, least: int, most: int, piece: int) -> DataFrame:
    """(id, n_words, n_features, weight): the floored mean gain of each text's features, 0 without any."""
    sent = share(docs.sparkSession, gains)

    def run(batches):
        known = sent()
        for b in batches:
            for ids, texts in pieces(b, piece):
                words = Dictionary(texts)
                count, total = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
                for bucket, owner in features(words, least, most, len(known)):
                    before = np.concatenate([[0], np.cumsum(known[bucket])])
                    edges = np.searchsorted(owner, np.arange(len(texts) + 1))
                    count += np.diff(edges)
                    total += np.diff(before[edges])
                yield pa.record_batch([ids, pa.array(np.diff(words.bounds)), pa.array(count), pa.array(total // np.maximum(count, 1))], names=["id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_words long, n_features long, weight long")


def draw_of(key, seed: int):
    """The random part of a score, a standard Gumbel number in floored thousandths: from a digest of seed and id, so that reruns agree."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def importance_resample(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", least: int = 1, most: int = 1, buckets: int = 10_000, percent: int = 10, min_words: int = 20, seed: int = 2024, piece: int = 4 << 20) -> DataFrame:
    """Documents drawn without replacement, the likelier the more their word grams are those of the target.

    Words are runs of letters, digits and characters beyond ASCII, A-Z in lower case. Features are
    all runs of `least` to `most` words. Words become integers by a dictionary, runs of
    words tuples of them, and each distinct tuple's letters are put together and hashed once; its
    bucket is joined back to all places that hold it. The dictionary is one of `piece` characters
    of texts or one longer text: all documents are read twice, but no word of them is ever
    shuffled; tasks send the sums of buckets alone. The weight of a document is the mean gain
    of its features; a Gumbel number is added, and the highest scores are drawn.

    Null and empty texts: no features, weight 0. Very long texts: whole, at some 50 bytes a word.
    Ties: the smaller id, then fewer features. Null ids: drawn as the empty id, ranked after all others of
    their score. Repeated rows: each is a document. Empty target: all gains come from the documents alone. No documents: no
    rows. Other columns are ignored.

    Returns id_col, n_features, weight, score, rank (1, 2, 3 in the order of drawing, null if not drawn).
    """
    counts = [written(bucket_counts(df, c, least, most, buckets, piece), "buckets") for df, c in ((docs, text_col), (target, target_text_col))]
    gains = bucket_gains(*counts, buckets)
    forget(*counts)
    weighed = written(weights(docs, gains, id_col, text_col, least, most, piece), "weights")
    drawn = percent * weighed.where(F.col("n_words") >= min_words).count() // 100
    scored = weighed.select("id", "n_features", "weight", (F.col("weight") + draw_of(F.col("id"), seed)).alias("score"), (F.col("n_words") >= min_words).alias("may"))
    placed = ranked(scored, "place", [F.col("may").desc(), F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("n_features")])
    forget(weighed)
    return placed.select(F.col("id").alias(id_col), "n_features", "weight", "score", F.when(F.col("may") & (F.col("place") <= drawn), F.col("place")).alias("rank"))


def op12(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return importance_resample(docs, benchmark)


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), f AS (
  SELECT k, w, count(*) AS n FROM (SELECT k, unnest(w) AS w FROM d) GROUP BY ALL
), b AS (
  SELECT w, count(*) AS n FROM (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark) GROUP BY 1
), x AS (
  SELECT DISTINCT w, hex(encode(w)) AS x FROM (SELECT w FROM f UNION SELECT w FROM b)
), c AS (
  SELECT w, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(4 * len(x)), lambda i: CASE WHEN i % 8 = 0 THEN CAST('0x' || x[i // 4 + 1 : i // 4 + 2] AS BIGINT) ELSE 0 END)),
    lambda c, y: CASE WHEN xor(c, y) % 2 = 1 THEN xor(xor(c, y) >> 1, 3988292384) ELSE xor(c, y) >> 1 END)) % 10000 AS bucket
  FROM x
), s AS (
  SELECT bucket, sum(n) AS n FROM f JOIN c USING (w) GROUP BY 1
), t AS (
  SELECT bucket, sum(n) AS n FROM b JOIN c USING (w) GROUP BY 1
), g AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE) / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE))) AS gain
  FROM s LEFT JOIN t USING (bucket)
), m AS (
  SELECT k, floor(sum(gain * n) / sum(n)) AS weight FROM f JOIN c USING (w) JOIN g USING (bucket) GROUP BY 1
), p AS (
  SELECT d.doc_id, len(d.w) AS n, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || sha256('2024:' || CAST(d.doc_id AS VARCHAR))[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS score
  FROM d LEFT JOIN m USING (k)
), r AS (
  SELECT *, row_number() OVER (ORDER BY n >= 20 DESC, score DESC, doc_id) AS place, count(*) FILTER (n >= 20) OVER () AS able FROM p
)
SELECT doc_id, CAST(n AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CASE WHEN n >= 20 AND place <= 10 * able // 100 THEN CAST(place AS BIGINT) END AS rank
FROM r
"""
