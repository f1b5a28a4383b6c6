"""Language identification with string kernels, Nyström landmarks and kernel ridge regression."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.common import held_out, id_text, pieces, share, unit, written

#: Orders of the blended spectrum.
ORDERS = (1, 2, 3)
BITS = 18
#: Which code points below U+3000 are letters; those above all count as such.
LETTER = np.array([chr(c).isalpha() for c in range(0x3000)])


def codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in lower case, each text between zeros, and the row of each."""
    parts = [np.frombuffer(("\0" + t.lower().replace("\0", " ") + "\0").encode("utf-32-le"), np.uint32) for t in texts]
    return np.concatenate(parts), np.repeat(np.arange(len(texts)), [len(p) for p in parts])


def spectrum(texts: list[str]):
    """(rows, hashed n-grams) of each order over whole texts; n-grams do not cross texts."""
    chars, row = codes(texts)
    # A run of other signs is one space, so that layout does not count.
    plain = (chars >= 0x3000) | LETTER[np.minimum(chars, 0x2FFF)]
    chars = np.where(plain | (chars == 0), chars, 32)
    keep = np.ones(len(chars), bool)
    keep[1:] = ~((chars[1:] == 32) & (chars[:-1] == 32))
    chars, row = chars[keep].astype(np.uint64), row[keep]
    for n in ORDERS:
        if len(chars) < n:
            continue
        m = len(chars) - n + 1
        h = np.full(m, n, np.uint64)
        whole = np.ones(m, bool)
        for j in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + chars[j : j + m]
            h ^= h >> np.uint64(31)
            whole &= chars[j : j + m] != 0
        yield row[:m][whole], (h[whole] * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - BITS)).astype(np.int64)


def presence(text: str) -> np.ndarray:
    """The distinct hashed n-grams of one text, sorted."""
    mask = np.zeros(1 << BITS, bool)
    for _, grams in spectrum([text]):
        mask[grams] = True
    return np.flatnonzero(mask).astype(np.int32)


def packed_presence(text: str) -> bytes:
    """The same as bits where that is shorter: 32 KB at most."""
    grams = presence(text)
    if 4 * len(grams) < 1 << (BITS - 3):
        return grams.tobytes()
    return np.packbits(np.bincount(grams, minlength=1 << BITS).astype(np.uint8)).tobytes()


def unpacked(found: bytes) -> np.ndarray:
    if len(found) == 1 << (BITS - 3):
        return np.flatnonzero(np.unpackbits(np.frombuffer(found, np.uint8))).astype(np.int32)
    return np.frombuffer(found, np.int32)


@dataclass
class Model:
    """What maps the presence of landmark n-grams to one score for each language.

    A score is the kernel values of a text against the landmarks times a weight for
    each landmark. Kernel values are products of presence and landmarks, so the
    product of landmarks and weights is made once, for all n-grams of the landmarks.
    """

    languages: list[str]
    column: np.ndarray  # hashed n-gram -> row of `weights`, the last one for n-grams that no landmark has
    weights: np.ndarray  # n-grams of the landmarks x languages
    bias: np.ndarray

    def matrix(self, texts: list[str]) -> np.ndarray:
        x = np.zeros((len(texts), len(self.weights) + 1), np.uint8)
        for rows, grams in spectrum(texts):
            x[rows, self.column[grams]] = 1
        return x[:, :-1]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """One regression output for each row and language."""
        x = x.astype(np.float32)
        size = np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
        return x @ self.weights / size + self.bias

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        y = self.scores(self.matrix(texts))
        best = y.argmax(1)
        sure = np.clip((y[np.arange(len(y)), best] + 1) / 2, 0, 1)
        return [self.languages[i] for i in best], sure.astype(float).tolist()


def fit(rows: list[tuple[str, bytes]], *, landmarks: int = 160, ridge: float = 1e-2) -> Model | None:
    """Fit on (language, presence as packed_presence() gives it); None without rows."""
    languages = sorted({k for k, _ in rows})
    if not languages:
        return None
    sets = [unpacked(b) for _, b in rows]
    label = np.array([languages.index(k) for k, _ in rows])
    each = max(1, landmarks // len(languages))
    marks = [i for k in range(len(languages)) for i in np.flatnonzero(label == k)[:each]]
    seen = np.zeros(1 << BITS, bool)
    for i in marks:
        seen[sets[i]] = True
    column = np.where(seen, np.cumsum(seen) - 1, seen.sum()).astype(np.int32)

    def normed(some) -> np.ndarray:
        x = np.zeros((len(some), int(seen.sum()) + 1), np.float32)
        for r, i in enumerate(some):
            x[r, column[sets[i]]] = 1
        x = x[:, :-1]
        return x / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))

    z = normed(marks).T.copy()
    # Nyström features: kernel values against landmarks, whitened by the landmark kernel.
    values, vectors = np.linalg.eigh((z.T @ z).astype(np.float64) + 1e-6 * np.eye(len(marks)))
    keep = values > 1e-5
    white = vectors[:, keep] / np.sqrt(values[keep])
    kernel = np.concatenate([normed(range(s, min(s + 64, len(sets)))) @ z for s in range(0, len(sets), 64)])
    features = kernel.astype(np.float64) @ white
    target = np.where(label[:, None] == np.arange(len(languages)), 1.0, -1.0)
    mean, shift = features.mean(0), target.mean(0)
    a = features - mean
    w = np.linalg.solve(a.T @ a + ridge * len(a) * np.eye(a.shape[1]), a.T @ (target - shift))
    return Model(languages, column, (z @ (white @ w)).astype(np.float32), (shift - mean @ w).astype(np.float32))


def training_rows(docs: DataFrame, *, id_col: str, text_col: str, lang_col: str, per_language: int, languages: int) -> list[tuple[str, bytes]]:
    """The presence sets of the per_language different texts of least hash of each language.

    Texts are told apart by hash, with partial sums, so that copies of one text count
    once and no language's rows are brought together; of more than `languages`
    languages the most frequent ones are learnt. A set is at most 32 KB.
    """
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(~held_out(F.col("id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    hashed = rows.groupBy("lang", F.xxhash64("text").alias("h")).agg(F.count(F.lit(1)).alias("n"))
    hashed = written(hashed, "hashes")
    known = hashed.groupBy("lang").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts")).orderBy(F.desc("n"), "lang").limit(languages)
    # Some four times as many as are taken have so small a hash: few rows are ranked, however many there are.
    near = hashed.join(F.broadcast(known.select("lang", "texts")), "lang").where(unit(F.col("h")) < 4 * per_language / F.col("texts"))
    place = F.row_number().over(W.partitionBy("lang").orderBy("h"))
    # per_language * languages rows of a hash and a name at most.
    drawn = F.broadcast(near.select("lang", "h", place.alias("place")).where(F.col("place") <= per_language).select("lang", "h"))

    def run(batches):
        done = set()
        for b in batches:
            new = [i for i, k in enumerate(zip(b.column("lang").to_pylist(), b.column("h").to_pylist())) if not (k in done or done.add(k))]
            some = b.take(pa.array(new, pa.int64()))
            yield pa.record_batch([some.column("lang"), some.column("h"), pa.array([packed_presence(t.as_py()) for t in some.column("text")], pa.binary())], names=["lang", "h", "grams"])

    found = rows.withColumn("h", F.xxhash64("text")).join(drawn, ["lang", "h"]).select("lang", "h", "text").mapInArrow(run, "lang string, h long, grams binary")
    found = found.groupBy("lang", "h").agg(F.min("grams").alias("grams")).collect()
    return [(r["lang"], bytes(r["grams"])) for r in sorted(found, key=lambda r: (r["lang"], r["h"]))]


def identify(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 300, languages: int = 64, landmarks: int = 160, ridge: float = 1e-2, undetermined: str = "und") -> DataFrame:
    """Language of each whole text.

    The kernel counts the character n-grams (one to three, in lower case, signs as
    spaces; told apart by 18-bit hashes) that two texts share, over all n-grams
    present in landmark texts, and is normalised by their numbers of such n-grams;
    landmarks are drawn from the sample, per_language different texts of each of up to
    `languages` languages. Ridge regression on Nyström features gives each language a score
    against the rest; the best wins, and its output in -1..1 is moved to 0..1.

    Learns from rows with text and language whose id is not held out; predicts
    from the text alone. Null text or text without a letter: undetermined, score
    0; also all rows if there is nothing to learn from. Ties: the first language
    in order. Very long texts: the whole text counts, alone in its batch. Repeated
    rows: each predicted alone, and learnt from once. An empty table: no rows. Other
    columns are ignored.

    Returns id_col, held_out, lang_pred, score.
    """
    model = fit(training_rows(docs, id_col=id_col, text_col=text_col, lang_col=lang_col, per_language=per_language, languages=languages), landmarks=landmarks, ridge=ridge)
    sent = share(docs.sparkSession, model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        known = sent()
        for b in batches:
            for ids, texts in pieces(b, 400_000):
                told, sure = [undetermined] * len(texts), [0.0] * len(texts)
                at = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if known else []
                for start in range(0, len(at), 128):
                    some = at[start : start + 128]
                    for i, k, s in zip(some, *known.predict([texts[i] for i in some])):
                        told[i], sure[i] = k, s
                yield pa.record_batch([ids, pa.array(told, pa.string()), pa.array(sure, pa.float64())], names=["id", "lang_pred", "score"])

    out = id_text(docs, id_col, text_col).mapInArrow(run, f"id {kind}, lang_pred string, score double")
    return out.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "lang_pred", "score")
