"""Removal of byte strings that occur more than once, by bucket-pointer refinement."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import forget, written

#: Length of the grams that make the initial buckets.
GRAM = 64
HIGH, LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)
BASE = 0x9E3779B97F4A7C15
SEGMENT = ("key", "seg", "d", "first", "back", "width")


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93 ^ seed << 1)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def powers(base: int, n: int) -> np.ndarray:
    x, size = np.ones(1, np.uint64), 1
    while size < n:
        x = np.concatenate([x, x * np.uint64(pow(base, size, 1 << 64))])
        size *= 2
    return x


class Hasher:
    """Numbers of strings anywhere in some bytes, as differences of one running sum of a polynomial."""

    def __init__(self):
        self.value = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
        self.power = self.inverse = np.ones(1, np.uint64)

    def __call__(self, raw: np.ndarray) -> "Hashed":
        if len(self.power) < len(raw):
            self.power, self.inverse = powers(BASE, len(raw)), powers(pow(BASE, -1, 1 << 64), len(raw))
        total = np.zeros(len(raw) + 1, np.uint64)
        value = self.value[raw]
        value *= self.power[: len(raw)]
        np.cumsum(value, out=total[1:])
        return Hashed(total, self.inverse)


class Hashed:
    def __init__(self, total: np.ndarray, inverse: np.ndarray):
        self.total, self.inverse = total, inverse

    def grams(self, n: int = GRAM) -> np.ndarray:
        """The bucket of the n bytes from each place on."""
        if len(self.total) <= n:
            return np.zeros(0, np.uint64)
        h = self.total[n:] - self.total[:-n]
        h *= self.inverse[: len(h)]
        return mixed(h)

    def strings(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.total[end] - self.total[first]) * self.inverse[first])


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    n = 1
    while 2 * n <= w:
        v = np.minimum(v[:-n], v[n:])
        n *= 2
    return np.minimum(v[: len(v) - (w - n)], v[w - n :]) if w > n else v


def anchors(raw: np.ndarray, bounds: np.ndarray, length: int, hasher: Hasher):
    """Windows of `length` bytes of some texts, by the least bucket in each.

    raw: the texts' bytes on end; bounds: where they begin, and the end. Returns
    (key, segment, text, at, first, last): for each anchor its bucket, the number of
    the bytes of all windows that it stands for, its text, its place and the first
    and last start of those windows, all in raw. Of equal buckets the last is
    chosen, so that equal windows have equal anchors at equal distances.
    """
    none = (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 4
    if len(raw) < length:
        return none
    hashed = hasher(raw)
    h = hashed.grams()
    low = sliding_min((h & HIGH) | (LOW - np.arange(len(h), dtype=np.uint64)), length - GRAM + 1)
    # Windows may start from a text's beginning to `length` bytes before its end.
    edge = np.zeros(len(low) + 1, np.int32)
    fits = np.diff(bounds) >= length
    np.add.at(edge, bounds[:-1][fits], 1)
    np.add.at(edge, bounds[1:][fits] - length + 1, -1)
    start = np.flatnonzero(np.cumsum(edge[:-1]))
    if not len(start):
        return none
    at = (LOW - (low[start] & LOW)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    first, last, at = start[new], start[np.concatenate([new[1:], [len(start)]]) - 1], at[new]
    back = (at - first).astype(np.uint64)
    segment = mixed(hashed.strings(first, last + length) + back * np.uint64(BASE))
    return h[at], segment, np.searchsorted(bounds, at, "right") - 1, at, first, last


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column of texts without nulls, as Arrow holds them, and their bounds."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, bounds - bounds[0]


def steps(bounds: np.ndarray, length: int, step: int) -> Iterator[tuple[int, np.ndarray, int]]:
    """(first text, bounds, bytes of that text before) of pieces of about `step` bytes; a longer text is cut.

    Each window of a cut text is in one piece alone.
    """
    i, n = 0, len(bounds) - 1
    while i < n:
        j = i + 1
        while j < n and bounds[j + 1] - bounds[i] <= step:
            j += 1
        if j == i + 1 and bounds[j] - bounds[i] > step:
            for s in range(int(bounds[i]), max(int(bounds[j]) - length + 1, int(bounds[i]) + 1), step):
                yield i, np.array([s, min(s + step + length - 1, int(bounds[j]))]), s - int(bounds[i])
        else:
            yield i, bounds[i : j + 1], 0
        i = j


def refined(bucket: np.ndarray, at: np.ndarray, offset: int) -> np.ndarray:
    """The buckets with those of the places `at` refined by the bucket that each points to, `offset` further on.

    Places alone in their bucket are done and keep it.
    """
    at = at[np.bincount(bucket)[bucket[at]] > 1]
    pointer = bucket[at + offset]
    order = np.lexsort((pointer, bucket[at]))
    own, pointer = bucket[at][order], pointer[order]
    new = np.concatenate([[1], (own[1:] != own[:-1]) | (pointer[1:] != pointer[:-1])])[: len(at)]
    out = bucket.copy()
    out[at[order]] = bucket.max(initial=0) + np.cumsum(new)
    return out


def repeated(raw: np.ndarray, bounds: np.ndarray, length: int, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """(starts of the windows of some segments, whether each window occurs more than once among them).

    Initial buckets hold places of equal GRAM bytes. A round sorts each bucket by the
    buckets of the places as far on as its strings are long; the buckets that come
    out are what the next round starts from and what its pointers lead to, so the
    length told apart doubles. The last pointers overlap the string before them.
    """
    _, bucket = np.unique(hasher(raw).grams(), return_inverse=True)
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(raw))
    start, q = np.flatnonzero(left >= length), GRAM
    while 2 * q <= length:
        bucket = refined(bucket, np.flatnonzero(left >= 2 * q), q)
        q *= 2
    if q < length:
        bucket = refined(bucket, start, length - q)
    return start, np.bincount(bucket, minlength=1)[bucket[start]] > 1


def named(raw: np.ndarray, length: int, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """The same refinement where no task sees a whole bucket: numbers of 128 bits name the bucket of each window."""
    h = hasher(raw).grams()
    out = []
    for seed in (1, 2):
        bucket, q = mixed(h, seed), GRAM
        for offset in [*(GRAM << i for i in range(length.bit_length()) if GRAM << (i + 1) <= length), None]:
            offset = length - q if offset is None else offset
            if offset:
                bucket = mixed(bucket[:-offset] * np.uint64(BASE) + bucket[offset:], seed)
                q += offset
        out.append(bucket)
    return out[0], out[1]


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x, pa.int64())


def ints(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.int32), pa.int32())


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def place(start) -> F.Column:
    return F.xxhash64("d", start)


def spots(texts: DataFrame, length: int, step: int) -> DataFrame:
    """Anchors of texts (d, text): SEGMENT for each, and a row without key, with a number in seg, for each text.

    d is a text's digest: a task lists a text once and counts how often it comes.
    """

    def run(batches):
        hasher, done = Hasher(), set()
        for b in batches:
            names = b.column("d").to_pylist()
            many: dict = {}
            for name in names:
                many[name] = many.get(name, 0) + 1
            if len(done) > 200_000:
                done.clear()  # a text that comes again is listed again; places count once
            new = []
            for i, name in enumerate(names):
                if name not in done:
                    done.add(name)
                    new.append(i)
            none = pa.nulls(len(many), pa.int32())
            yield pa.record_batch([pa.nulls(len(many), pa.int64()), pa.array(list(many.values()), pa.int64()), pa.array(list(many), pa.binary()), none, none, none], names=SEGMENT)
            seen = b.column("d").take(pa.array(new, pa.int64())) if len(new) < len(names) else b.column("d")
            column = b.column("text").take(pa.array(new, pa.int64())) if len(new) < len(names) else b.column("text")
            raw, bounds = text_bytes(column)
            for i, some, before in steps(bounds, length, step):
                base = some[0]
                key, seg, text, at, first, last = anchors(raw[base : some[-1]], some - base, length, hasher)
                if len(key):
                    begin = some[:-1][text] - base - before
                    yield pa.record_batch([signed(key), signed(seg), seen.take(pa.array(i + text)), ints(first - begin), ints(at - first), ints(last - first + length)], names=SEGMENT)

    return texts.mapInArrow(run, "key long, seg long, d binary, first int, back int, width int")


def by_key(batches, most: int) -> Iterator[list[tuple]]:
    """Rows (d, first, known, segment) of whole keys, each place once, as many keys at a time as make about `most` bytes."""
    rows, size, held = {}, 0, None
    for b in batches:
        for k, d, first, known, s in zip(b.column("key").to_pylist(), b.column("d").to_pylist(), b.column("first").to_pylist(), b.column("known").to_pylist(), b.column("segment").to_pylist()):
            if k != held and size >= most:
                yield list(rows.values())
                rows, size = {}, 0
            held = k
            if (d, first) not in rows:
                rows[d, first] = (d, first, known, s)
                size += len(s)
    if rows:
        yield list(rows.values())


def spans_of(rows: list[tuple], length: int, hasher: Hasher) -> pa.RecordBatch:
    """Repeated stretches of segments whose buckets are all here, but for segments known to be repeated as a whole."""
    raw = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
    bounds = np.cumsum([0, *(len(r[3]) for r in rows)])
    start, hit = repeated(raw, bounds, length, hasher)
    row = np.searchsorted(bounds, start, "right") - 1
    hit &= ~np.array([r[2] for r in rows], bool)[row]
    joins = (row[1:] == row[:-1]) & hit[1:] & hit[:-1]
    begin = np.flatnonzero(hit & ~np.concatenate([[False], joins]))
    stop = np.flatnonzero(hit & ~np.concatenate([joins, [False]]))
    own = row[begin]
    shift = np.array([r[1] for r in rows], np.int64)[own] - bounds[own]
    return pa.record_batch([pa.array([rows[i][0] for i in own.tolist()], pa.binary()), signed(start[begin] + shift), signed(start[stop] + shift + length)], names=["d", "start", "end"])


def find_repeats(spotted: DataFrame, texts: DataFrame, *, length: int, batch_bytes: int, hot: int) -> list[DataFrame]:
    """Tables (d, start, end) of repeated stretches, in bytes, from the anchors of texts (d, text).

    An anchor's segment is what its windows cover. A bucket whose places all have one
    segment is settled by counting, and so are segments that several places of a
    bucket share: all of each is repeated. Only where a bucket has different segments
    are bytes compared, those of one place for each segment.
    """
    spark = texts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = place(F.col("first") + F.col("back"))
    keys = spotted.where("key is not null").groupBy("key").agg(F.min(at).alias("a"), F.max(at).alias("b"), (F.min("seg") != F.max("seg")).alias("differs"))
    keys = written(keys.where("a <> b").select("key", "differs"), "keys")
    marked = written(spotted.where("key is not null").join(keys, "key"), "marked")
    forget(keys)
    segs = marked.where("differs").groupBy("key", "seg").agg((F.min(at) != F.max(at)).alias("known"), F.min(F.struct("d", "first", "width")).alias("one"))
    segs = written(segs, "segments")
    whole = marked.where("not differs").unionByName(marked.where("differs").join(segs.where("known").select("key", "seg"), ["key", "seg"]))
    whole = whole.select("d", F.col("first").cast("long").alias("start"), (F.col("first") + F.col("width")).cast("long").alias("end"))
    sizes = segs.groupBy("key").agg((F.count(F.lit(1)) > hot).alias("hot"), F.bool_and("known").alias("done"))
    wanted = segs.join(sizes.where("not done"), "key").select("one.d", F.struct("key", "hot", "known", "one.first", "one.width").alias("pick"))
    picks = written(wanted.groupBy("d").agg(F.collect_list("pick").alias("picks")), "picks")

    def cut(batches):
        done = set()
        for b in batches:
            for d, t, picks in zip(b.column("d").to_pylist(), b.column("text"), b.column("picks").to_pylist()):
                if d in done:
                    continue
                if len(done) > 200_000:
                    done.clear()
                done.add(d)
                raw = t.as_buffer()
                cols = [[p[c] for p in picks] for c in ("key", "hot", "known", "first")]
                yield pa.record_batch([*(pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.bool_(), pa.bool_(), pa.int32()))), pa.array([d] * len(picks), pa.binary()), pa.array([raw[p["first"] : p["first"] + p["width"]].to_pybytes() for p in picks], pa.binary())], names=["key", "hot", "known", "first", "d", "segment"])

    found = written(texts.join(picks, "d").select("d", "text", "picks").mapInArrow(cut, "key long, hot boolean, known boolean, first int, d binary, segment binary"), "found")
    cold = found.where("not hot").repartition(parts, "key").sortWithinPartitions("key")

    def refine(batches):
        hasher = Hasher()
        for group in by_key(batches, batch_bytes):
            yield spans_of(group, length, hasher)

    spans = [written(whole, "whole"), written(cold.mapInArrow(refine, "d binary, start long, end long"), "windows")]
    large = found.where("hot")
    if not large.isEmpty():
        spans.append(written(hot_spans(large, length, parts), "windows"))
    forget(marked, segs, picks, found)
    return spans


def hot_spans(found: DataFrame, length: int, parts: int) -> DataFrame:
    """The same for buckets of any number of segments: windows are counted by their names, with partial sums.

    A window that makes up more than its share of all rows is looked up by broadcast,
    of which there are 4 * parts at most, so that none has to meet in one task.
    """

    def windows(batches):
        hasher = Hasher()
        for b in batches:
            for d, first, known, s in zip(b.column("d").to_pylist(), b.column("first").to_pylist(), b.column("known").to_pylist(), b.column("segment")):
                w, x = named(np.frombuffer(s.as_buffer(), np.uint8), length, hasher)
                yield pa.record_batch([signed(w), signed(x), pa.array([d] * len(w), pa.binary()), signed(np.arange(first, first + len(w))), pa.array([known] * len(w))], names=["w", "x", "d", "start", "known"])

    rows = written(found.mapInArrow(windows, "w long, x long, d binary, start long, known boolean"), "rows")
    many = rows.count() // (4 * parts) + 1
    at = place("start")
    twice = written(rows.groupBy("w", "x").agg(F.min(at).alias("a"), F.max(at).alias("b"), F.count(F.lit(1)).alias("n")).where("a <> b").select("w", "x", "n"), "twice")
    heavy = F.broadcast(twice.where(F.col("n") >= many).select("w", "x"))
    asked = rows.where("not known").select("w", "x", "d", "start")
    light = asked.join(heavy, ["w", "x"], "left_anti").join(twice.where(F.col("n") < many).select("w", "x"), ["w", "x"])
    both = asked.join(heavy, ["w", "x"]).unionByName(light)
    return both.select("d", "start", (F.col("start") + length).alias("end"))


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 200, batch_bytes: int = 1 << 20, hot: int = 2048, step: int = 1 << 18) -> DataFrame:
    """Each text without the bytes of any `length`-byte string that also starts elsewhere.

    "Elsewhere" is any other place of any row, its own text included; strings do not
    cross texts and are judged on the input. Bytes are those of UTF-8, so what is
    kept need not be whole characters. Texts that occur in several rows are
    repeated as a whole, if long enough, and otherwise have no such string.

    Every window of `length` bytes is filed under the least of its buckets of GRAM
    bytes, so that one place in 70 bytes or so stands for the windows around it.
    Buckets with several places are refined by bucket pointers; those with more than
    `hot` different segments are not brought together but refined by name. Strings
    are told apart by two 64-bit numbers.

    Null texts: empty. Empty and short texts: kept. Very long texts are worked on in
    overlapping steps of `step` bytes; only their own bytes and spans are held. Repeated rows: repeats of each
    other. Rows with null ids count as any other. Ties cannot matter: all copies of a
    string go, none is preferred. Other columns are ignored. An empty table: no rows.
    length is 128 at least.

    Returns id_col, n_bytes, n_removed, n_spans, kept_sha256, kept (binary), spans
    (start and end of removed stretches in bytes, in turn).
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), F.unhex(F.substring(F.sha2(text.cast("binary"), 256), 1, 32)).alias("d"), text.alias("text"))
    long = texts.where(F.octet_length("text") >= length).select("d", "text")
    spotted = written(spots(long, length, step), "spots")
    spans = find_repeats(spotted, long, length=length, batch_bytes=batch_bytes, hot=hot)
    copies = spotted.where("key is null").groupBy("d").agg(F.sum("seg").alias("copies")).where("copies > 1")
    known = reduce(DataFrame.unionByName, spans).join(copies.select("d"), "d", "left_anti").groupBy("d").agg(F.collect_set(F.struct("start", "end")).alias("spans"), F.lit(False).alias("whole"))
    known = written(known.unionByName(copies.select("d", F.lit(None).cast("array<struct<start:bigint,end:bigint>>").alias("spans"), F.lit(True).alias("whole"))), "known")
    forget(spotted, *spans)

    def shorten(batches):
        for b in batches:
            cols = [[] for _ in range(6)]
            for t, whole, spans in zip(b.column("text"), b.column("whole").to_pylist(), b.column("spans")):
                raw = t.as_py().encode()
                gone = [[0, len(raw)]] if whole else merged([(s["start"], s["end"]) for s in spans.as_py() or []])
                edges = [0, *(x for s in gone for x in s), len(raw)]
                kept = b"".join(raw[a:e] for a, e in zip(edges[::2], edges[1::2]))
                for c, v in zip(cols, (len(raw), len(raw) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept, edges[1:-1])):
                    c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64()))
            yield pa.record_batch([b.column("id"), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])

    out = texts.join(known, "d", "left").select("id", "text", "whole", "spans").mapInArrow(shorten, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<long>")
    return out.withColumnRenamed("id", id_col)


def op6(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


OP6_SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), p AS (
  SELECT doc_id, 500 * p AS first, length(h) // 2 AS n, substring(h, 1000 * p + 1, 1398) AS part FROM d, LATERAL (SELECT unnest(range(length(h) // 1000 + 1)) AS p)
), w AS (
  SELECT doc_id, first + j AS s, md5_number_lower(substring(part, 2 * j + 1, 400)) AS k, md5_number_upper(substring(part, 2 * j + 1, 400)) AS l
  FROM p, LATERAL (SELECT unnest(range(greatest(0, least(500, n - 199 - first)))) AS j)
), r AS (
  SELECT doc_id, s FROM w JOIN (SELECT k, l FROM w GROUP BY k, l HAVING count(*) > 1) USING (k, l)
), i AS (
  SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 200 THEN 0 ELSE 1 END AS fresh FROM r
), g AS (
  SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM i
), spans AS (
  SELECT doc_id, min(s) AS a, max(s) + 200 AS b FROM g GROUP BY doc_id, run
), edges AS (
  SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before, b FROM spans
), cut AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, string_agg(substring(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept, max(b) AS last
  FROM edges JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substring(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""
