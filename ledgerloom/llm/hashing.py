"""Hashes of words, word grams and sets of shingles."""

from __future__ import annotations

import numpy as np


def grams(ids: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every n consecutive ids."""
    x = ids.astype(np.uint64)
    h = np.zeros(len(ids) - n + 1, np.uint64)
    for j in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + x[j : len(h) + j] + np.uint64(1)
        h ^= h >> np.uint64(29)
    return h


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bytes of white space; what a byte adds to the hash of its word, capital letters as small ones; a base and its inverse.
SPACE = np.isin(np.arange(256), [0x20, 9, 10, 11, 12, 13])
VALUE = mixed(np.where((np.arange(256) > 0x40) & (np.arange(256) < 0x5B), np.arange(256) + 32, np.arange(256)).astype(np.uint64) + np.uint64(1))
BASE = 0x9E3779B97F4A7C15


class Shingler:
    """Sets of hashed shingles of whole texts, for many texts at once."""

    def __init__(self, words: int, step: int = 1 << 20):
        self.words, self.step = words, step
        self.power = self.inverse = np.ones(1, np.uint64)

    def powers(self, n: int) -> None:
        """The base to the power of all places below n, and the inverses."""
        if len(self.power) < n:
            for name, base in (("power", BASE), ("inverse", pow(BASE, -1, 1 << 64))):
                x, size = np.ones(1, np.uint64), 1
                while size < n:
                    x = np.concatenate([x, x * np.uint64(pow(base, size, 1 << 64))])
                    size *= 2
                setattr(self, name, x)

    def word_hashes(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(hash, start) of every word: polynomials in the base, as differences of one running sum."""
        hashes, starts, pos = [], [], 0
        while pos < len(raw):
            end = min(len(raw), pos + self.step)
            while end < len(raw) and not SPACE[raw[end - 1]]:
                end += 1
            b = np.frombuffer(raw, np.uint8, end - pos, pos)
            self.powers(len(b) + 1)
            space = SPACE[b]
            value = VALUE[b]
            value *= self.power[: len(b)]
            value[space] = 0
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
            edge = np.diff(np.concatenate([[1], space.view(np.int8), [1]]))
            first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
            hashes.append(mixed((total[last] - total[first]) * self.inverse[first]))
            starts.append(first + pos)
            pos = end
        return np.concatenate([np.zeros(0, np.uint64), *hashes]), np.concatenate([np.zeros(0, np.int64), *starts])

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """The distinct shingles of each text, sorted; fewer words than a shingle has are one shingle."""
        parts = [t.encode() if t else b"" for t in texts]
        bounds = np.cumsum([0, *(len(p) + 1 for p in parts)])
        h, start = self.word_hashes(b"\n".join(parts) + b"\n")
        at = np.searchsorted(start, bounds).tolist()
        n = self.words
        g = grams(h, n) if len(h) >= n else h[:0]
        out = []
        for s, e in zip(at[:-1], at[1:]):
            if e - s >= n:
                x = np.sort(g[s : e - n + 1])
                out.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
            else:
                out.append(grams(h[s:e], e - s) ^ np.uint64(e - s) if e > s else h[:0])
        return out
