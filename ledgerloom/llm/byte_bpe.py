"""Byte-level BPE by backtracking from longest matches."""

from __future__ import annotations

import base64
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import id_text, pieces


#: Above all ranks.
NEVER = 1 << 62


def in_ascii(pattern: str) -> re.Pattern:
    """A pattern of letters, digits and white space for texts of ASCII alone, where plain classes say the same."""
    parts = re.split(r"(\[(?:\\.|[^\]\\])*\])", pattern)
    inner = lambda x: x.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9")
    outer = lambda x: x.replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")
    plain = "".join(inner(x) if i % 2 else outer(x) for i, x in enumerate(parts))
    return regex.compile(pattern) if r"\p" in plain else re.compile(plain, re.A)


class Remembered(dict):
    """Ids of pieces. Short ones are remembered in two halves of a bounded size: when one is full the other goes, and what is asked for again moves over."""

    def __init__(self, bpe: Bpe):
        self.bpe, self.old = bpe, {}

    def __missing__(self, part: str) -> tuple[int, ...]:
        found = self.old.get(part)
        if found is None:
            found = tuple(self.bpe.encode_piece(part.encode()))
        if len(part) <= 64:
            if len(self) >= self.bpe.known:
                self.old = dict(self)
                self.clear()
            self[part] = found
        return found


class Bpe:
    """Encodes pieces of bytes by ranks, as merging adjacent parts by least rank would.

    The automaton finds tokens in bytes written as Latin-1 letters. A sequence of tokens is
    what merging gives if and only if each two neighbours, merged by themselves, stay
    the same two tokens; so the prefix that ends at a place has one sequence at most, and a place
    from which there is no way on is never tried again. Each place is passed once.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, known: int = 3 << 17):
        self.ranks, self.known, self.split = ranks, known, regex.compile(pattern)
        self.split_ascii = in_ascii(pattern)
        self.automaton = ahocorasick.Automaton()
        self.bytes: list[bytes] = [b""] * (max(ranks.values(), default=0) + 1)
        self.shorter = [-1] * len(self.bytes)  # the longest token that begins this one, other than itself
        for b, i in ranks.items():
            self.automaton.add_word(b.decode("latin-1"), i)
            self.bytes[i] = b
            self.shorter[i] = next((ranks[b[:n]] for n in range(len(b) - 1, 0, -1) if b[:n] in ranks), -1)
        self.automaton.make_automaton()
        self.size = [*map(len, self.bytes)]
        self.pairs: defaultdict[int, dict[int, bool]] = defaultdict(dict)  # by the token before, -1 at the start
        self.n_pairs = 0
        self.steps: dict[int, list[tuple[int, bytes, bytes]]] = {}
        self.cache = Remembered(self)

    def steps_of(self, token: int) -> list[tuple[int, bytes, bytes]]:
        """The merges that make a token, in their order: (rank, first part, last part) after each, and before them.

        Tokens that merging never makes of their bytes have fewer steps and end in parts.
        """
        found = self.steps.get(token)
        if found is None:
            b = self.bytes[token]
            parts = [b[i : i + 1] for i in range(len(b))]
            found = [(-1, parts[0], parts[-1])]
            while len(parts) > 1:
                rank, at = min((self.ranks.get(x + y, NEVER), i) for i, (x, y) in enumerate(zip(parts, parts[1:])))
                if rank == NEVER:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                found.append((rank, parts[0], parts[-1]))
            self.steps[token] = found
        return found

    def fits(self, before: int, token: int) -> bool:
        """Whether merging leaves these neighbours as they are; before is -1 at the start.

        Both are merged from their bytes side by side, least rank first and left before
        right, as merging does; they stay neighbours if it never joins the parts at their border.
        """
        right = self.steps_of(token)
        found = right[-1][1] == self.bytes[token]
        if found and before >= 0:
            left, i, j = self.steps_of(before), 0, 0
            while True:
                across = self.ranks.get(left[i][2] + right[j][1], NEVER)
                next_left = left[i + 1][0] if i + 1 < len(left) else NEVER
                next_right = right[j + 1][0] if j + 1 < len(right) else NEVER
                found = across == next_left == next_right == NEVER
                if found or across < next_left and across <= next_right:
                    break
                i, j = (i + 1, j) if next_left <= next_right else (i, j + 1)
        if self.n_pairs >= 2 * self.known:
            for row in self.pairs.values():  # rows stay, as one may be in use
                row.clear()
            self.n_pairs = 0
        self.pairs[before][token] = found
        self.n_pairs += 1
        return found

    def encode_piece(self, part: bytes) -> list[int]:
        if part in self.ranks:
            return [self.ranks[part]]
        longest, size, pairs, shorter = [-1] * (len(part) + 1), self.size, self.pairs, self.shorter
        for end, token in self.automaton.iter(part.decode("latin-1")):
            longest[end - size[token]] = token  # of one start, the longest match ends last; the place before the first is the last
        out: list[int] = []
        dead, at, token, before, most = bytearray(len(part) + 1), 0, longest[-1], -1, len(part)
        while at < most:
            row = pairs[before]
            while token >= 0:
                ok = row.get(token)
                if ok is None:
                    ok = self.fits(before, token)
                if ok and not dead[at + size[token]]:
                    break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += size[token]
                before, token = token, longest[at - 1]
            elif not out:
                raise ValueError("the ranks lack a byte of this text")
            else:
                dead[at] = 1
                token = out.pop()
                at -= size[token]
                before, token = out[-1] if out else -1, shorter[token]
        return out

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        split = self.split_ascii if text.isascii() else self.split
        parts = split.findall(text) if len(text) < 1 << 20 else (m[0] for m in split.finditer(text))
        return np.fromiter(chain.from_iterable(map(self.cache.__getitem__, parts)), np.int32)


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Ranks of a file of lines "base64 rank"; the driver reads it once, so that executors need not have it."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def sent(spark: SparkSession, ranks: dict[bytes, int], make: Callable):
    """A function that gives make(ranks) in a worker; what is made stays with the broadcast as long as the worker keeps that."""
    kept = spark.sparkContext.broadcast(ranks)

    def get():
        ranks = kept.value
        made = getattr(kept, "_made", None)
        if made is None:
            made = kept._made = make(ranks)
        return made

    return get


def encoded(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, id_col: str = "doc_id", text_col: str = "text", piece: int = 4 << 20) -> DataFrame:
    """(id_col, ids array<int>): token ids of whole texts, without special tokens.

    Each match of the pattern is encoded by itself. Its bytes, written as Latin-1 letters, run through
    an automaton of all tokens; from the longest match on, tokens are taken if merging would
    leave them beside the one before, and given back if there is no way on, so that
    a match of any length takes time in proportion to it. Whether two tokens may be neighbours
    is remembered, as are the ids of short matches, up to a bound in each worker.

    Null and empty texts: no ids. Very long texts: whole; matches of a text beyond a megabyte
    are taken one by one. Repeated rows, ties and null ids: each row by itself. No documents: no rows. Other
    columns are ignored.
    """
    own = sent(docs.sparkSession, ranks, lambda ranks: Bpe(ranks, pattern))

    def run(batches: Iterator[pa.RecordBatch]):
        bpe = own()
        for b in batches:
            for ids, texts in pieces(b, piece):
                found = [bpe.encode(t) for t in texts]
                offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
                yield pa.record_batch([ids, pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *found])))], names=["id", "ids"])

    rows = id_text(docs, id_col, text_col)
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>").withColumnRenamed("id", id_col)


def decoded(rows: DataFrame, ranks: dict[bytes, int], *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """rows with `bytes` (binary) beside their ids: what the ids stand for, end to end.

    Null ids arrays: null. Empty ones: no bytes. An id that is no rank fails the job.
    """
    def letters(ranks: dict[bytes, int]) -> pa.Array:
        known = [None] * (max(ranks.values(), default=-1) + 1)
        for b, i in ranks.items():
            known[i] = b
        return pa.array(known, pa.large_binary())

    own = sent(rows.sparkSession, ranks, letters)

    def run(batches: Iterator[pa.RecordBatch]):
        known = own()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                ids = part.column("ids")
                found = known.take(ids.flatten())
                if found.null_count:
                    raise ValueError("an id is no rank")
                ends = np.cumsum(np.concatenate([[0], pc.fill_null(pc.list_value_length(ids), 0).to_numpy()]))
                places = np.frombuffer(found.buffers()[1], np.int64)[ends] if len(found) else np.zeros(len(ends), np.int64)
                out = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(places), found.buffers()[2] or pa.py_buffer(b"")]).cast(pa.binary())
                out = pc.if_else(ids.is_valid(), out, pa.scalar(None, pa.binary()))
                yield pa.record_batch([part.column("id"), ids, out], names=["id", "ids", "bytes"])

    plain = rows.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return plain.mapInArrow(run, f"id {plain.schema['id'].dataType.simpleString()}, ids array<int>, bytes binary").select(F.col("id").alias(id_col), F.col("ids").alias(ids_col), "bytes")


def digest(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def op11(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    ranks = read_ranks(docs.sparkSession, path)
    both = decoded(encoded(docs, ranks, pattern), ranks)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest(F.array_join("ids", ",")).alias("ids_sha256"), digest(F.col("bytes")).alias("decoded_sha256"))
