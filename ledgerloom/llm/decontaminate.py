"""Benchmark decontamination by winnowing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import with_kept, written
from ledgerloom.llm.hashing import Shingler, grams

#: Bytes to bytes: ASCII letters in lower case, digits and non-ASCII bytes as they are, all else a separator.
KEPT = bytes(32 if b < 0x30 or 0x3A <= b <= 0x40 or 0x5B <= b <= 0x60 or 0x7B <= b <= 0x7F else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(KEPT).split() if text else []


def winnowed(h: np.ndarray, w: int) -> np.ndarray:
    """Positions of the rightmost least hash of every w consecutive ones."""
    if len(h) < w:
        return np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(h, w)
    return np.unique(np.arange(len(view)) + (w - 1 - np.argmin(view[:, ::-1], axis=1)))


#: One for all texts of a worker, as it keeps tables of powers.
HASHER = Shingler(1)


class Words:
    """Words of a text: its letters on end with a space after each word, and where each word begins and what it hashes to."""

    def __init__(self, text: str | None):
        kept = b" ".join(words_of(text)) + b" " if text else b" "
        self.raw = kept if kept != b" " else b""
        self.hashes, self.starts = HASHER.word_hashes(self.raw)

    def __len__(self) -> int:
        return len(self.starts)

    def window(self, at: int, n: int) -> bytes:
        """The letters of n words, spaces included."""
        return self.raw[self.starts[at] : self.starts[at + n] if at + n < len(self.starts) else len(self.raw)]


class Index:
    """Windows of benchmark items in arrays, and the fingerprints that lead to them.

    A window is known by the hash of its words and stands for the place of its
    letters, so that what is found is compared letter by letter. About seven bytes
    for each byte of the items.
    """

    def __init__(self, items: list[tuple[str | None, str | None]], window: int, gram: int):
        self.window, self.gram, self.names = window, gram, sorted({k for k, _ in items if k is not None})
        number = {k: i for i, k in enumerate(self.names)}
        texts: list[bytes] = []
        found: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]] = {}
        prints: list[np.ndarray] = [np.zeros(0, np.uint64)]
        size = 0
        for name, text in items:
            words = Words(text)
            if not len(words):
                continue
            n = min(window, len(words))
            h = grams(words.hashes, n)
            ends = np.append(words.starts, len(words.raw))
            owner = -1 if name is None else number[name]
            found.setdefault(n, []).append((h, words.starts[: len(h)] + size, ends[n:][: len(h)] - words.starts[: len(h)], np.full(len(h), owner)))
            if n == window:
                g = grams(words.hashes, gram)
                prints.append(g[winnowed(g, window - gram + 1)])
            texts.append(words.raw)
            size += len(words.raw)
        self.raw = b"".join(texts)
        self.prints = np.unique(np.concatenate(prints))
        self.windows = {}
        for n, parts in found.items():
            h, at, length, owner = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(h, kind="stable")
            self.windows[n] = h[order], at[order].astype(np.int32), length[order].astype(np.int32), owner[order].astype(np.int32)

    def starts(self, h: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
        """Where windows of n words with the hashes h may start: for whole windows a shared fingerprint lies inside."""
        if n < self.window or not len(h):
            return np.arange(len(h))
        g = grams(hashes, self.gram)
        at = winnowed(g, self.window - self.gram + 1)
        slot = np.searchsorted(self.prints, g[at]).clip(max=len(self.prints) - 1)
        at = at[self.prints[slot] == g[at]]
        near = (at[:, None] - np.arange(self.window - self.gram + 1)).ravel()
        return np.unique(near[(near >= 0) & (near < len(h))])

    def scan(self, words: Words) -> tuple[np.ndarray, set[int]]:
        """Which words are hit, and the numbers of the items that occur."""
        hit, found = np.zeros(len(words), bool), set()
        for n, (known, place, length, owner) in self.windows.items():
            if len(words) < n:
                continue
            h = grams(words.hashes, n)
            starts = self.starts(h, words.hashes, n)
            first = np.searchsorted(known, h[starts])
            there = known[first.clip(max=len(known) - 1)] == h[starts]
            for s, i in zip(starts[there].tolist(), first[there].tolist()):
                own = words.window(s, n)
                while i < len(known) and known[i] == h[s]:
                    if self.raw[place[i] : place[i] + length[i]] == own:
                        hit[s : s + n] = True
                        if owner[i] >= 0:
                            found.add(int(owner[i]))
                    i += 1
        return hit, found


def split_items(items: DataFrame, window: int, most: int) -> DataFrame:
    """(item, words) where texts of more than `most` bytes are in pieces that share window - 1 words with the next."""

    def run(batches):
        for b in batches:
            names, pieces = [], []
            for name, text in zip(b.column("item").to_pylist(), b.column("words")):
                text = text.as_py()
                names.append(name)
                if text is None or len(text) <= most // 4:
                    pieces.append(text)
                    continue
                words = Words(text)
                at = [0]
                while len(words) - at[-1] > window:
                    next_ = int(np.searchsorted(words.starts, words.starts[at[-1]] + most)) - window + 1
                    next_ = max(next_, at[-1] + 1)
                    if next_ + window - 1 >= len(words):
                        break
                    at.append(next_)
                ends = [min(x + window - 1, len(words)) for x in at[1:]] + [len(words)]
                names += [name] * (len(at) - 1)
                pieces += [words.window(x, e - x).decode() if e > x else "" for x, e in zip(at, ends)]
            yield pa.record_batch([pa.array(names, pa.string()), pa.array(pieces, pa.string())], names=["item", "words"])

    return items.mapInArrow(run, "item string, words string")


def runs(hit: np.ndarray) -> list[int]:
    """Starts and ends of the runs of true values, in turn."""
    return np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))).tolist()


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 13, gram: int = 5, index_bytes: int = 16 << 20, keep: tuple[str, ...] = ()) -> DataFrame:
    """Words of docs that lie in a passage shared with a benchmark item.

    Winnowing over word grams of `gram` words keeps the least hash of every
    window - gram + 1 grams, so any shared span of `window` words has a common
    fingerprint; hits are then extended and compared word by word. Items of
    fewer words are one window of their own length and looked up directly.

    The benchmark is indexed in parts of about `index_bytes` of text, dealt by a hash
    of id and text, and longer items in pieces of an eighth of that; each part is
    broadcast, as arrays of some seven times its text. A larger benchmark takes more
    passes, with no shuffle of documents.

    Null and empty texts: no words, no hits. Very long texts: hashed in steps of 1 MB,
    held with 16 bytes for each word. Null item ids: their windows hit,
    but they are not counted among items. Repeated rows: each judged alone. Ties
    cannot matter: all items that occur are told.
    Equal item ids: one item. Empty benchmark: nothing is hit. No documents: no rows.
    Other columns of the inputs are ignored.

    Returns id_col, the columns of docs named in keep, n_words, n_hit, items (array of string, sorted), spans (array
    of word offsets: start, end, start, end and so on).
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("words"))
    items = written(split_items(items, window, max(index_bytes // 8, 1)), "items")
    total = items.agg(F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()[0]
    parts = max(1, -(-2 * total // index_bytes) if total > index_bytes else 1)
    df = with_kept(docs, id_col, text_col, keep)
    kind = df.schema["id"].dataType.simpleString()
    df = df.select("id", "text", F.lit(None).cast("array<int>").alias("spans"), F.lit(None).cast("array<string>").alias("items"))
    for part in range(parts):
        chunk = items.where(F.pmod(F.xxhash64("item", "words"), F.lit(parts)) == part).collect()
        index = spark.sparkContext.broadcast(cloudpickle.dumps(Index([tuple(r) for r in chunk], window, gram)))
        last = part == parts - 1

        def run(batches, index=index, last=last):
            at = cloudpickle.loads(index.value)
            for b in batches:
                n_words, n_hit, spans, names = [], [], [], []
                for text, old, had in zip(b.column("text"), b.column("spans").to_pylist(), b.column("items").to_pylist()):
                    words = Words(text.as_py())
                    hit, found = at.scan(words)
                    for s, e in zip((old or [])[::2], (old or [])[1::2]):
                        hit[s:e] = True
                    n_words.append(len(words))
                    n_hit.append(int(hit.sum()))
                    spans.append(runs(hit))
                    names.append(sorted({at.names[i] for i in found} | set(had or [])))
                out = [b.column("id"), *([] if last else [b.column("text")]), pa.array(spans, pa.list_(pa.int32())), pa.array(names, pa.list_(pa.string())), *([pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64())] if last else [])]
                yield pa.record_batch(out, names=["id", *([] if last else ["text"]), "spans", "items", *(["n_words", "n_hit"] if last else [])])

        df = df.mapInArrow(run, f"id {kind}, spans array<int>, items array<string>, n_words long, n_hit long" if last else f"id {kind}, text string, spans array<int>, items array<string>")
        if not last:
            df = written(df, "decontaminate")
    return df.select(F.col("id.own").alias(id_col), *[F.col(f"id.kept.{c}") for c in keep if c != id_col], "n_words", "n_hit", "items", "spans")


def is_contaminated() -> F.Column:
    """A twentieth of the words, one at least, lies in shared passages."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op9(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = contamination(docs, benchmark)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), is_contaminated().alias("contaminated"))


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s + 1 : s + n], ' ') AS win
  FROM (SELECT item_id, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0), LATERAL (SELECT unnest(range(len(w) - n + 1)) AS s)
), dw AS (
  SELECT doc_id, n, s, array_to_string(w[s + 1 : s + n], ' ') AS win
  FROM d, (SELECT DISTINCT n FROM bw) k, LATERAL (SELECT unnest(range(greatest(0, len(w) - n + 1))) AS s)
), h AS (
  SELECT dw.doc_id, dw.s, dw.n, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win
), hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM h)) GROUP BY 1
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY 1
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""
