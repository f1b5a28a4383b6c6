"""Toxicity scores from a linear-chain conditional random field over tokens."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.common import held_out, pieces, share, unit, with_kept

TOKEN = re.compile(r"\w+")
BLOCK = 32


class Chains:
    """Texts as chains of tokens, in blocks of equal length so that whole arrays move at once."""

    def __init__(self, lengths: np.ndarray):
        self.per = -(-lengths // BLOCK)
        self.first = np.concatenate([[0], np.cumsum(self.per)])
        text = np.repeat(np.arange(len(lengths)), self.per)
        left = lengths[text] - (np.arange(self.first[-1]) - self.first[text]) * BLOCK
        self.real = np.arange(BLOCK)[:, None] < left  # place x block
        self.cut = [np.flatnonzero(~row) for row in self.real]
        self.begins = self.first[:-1][lengths > 0]
        place = (np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths), np.repeat(self.first[:-1], lengths))
        self.at = (place[0] % BLOCK, place[1] + place[0] // BLOCK)  # of each token

    def marginals(self, energy: np.ndarray, move: np.ndarray, start: np.ndarray, pairs: bool = False):
        """Of each token, the probability of state 1 by forward-backward; with pairs also expected moves.

        energy: log-odds of state 1 by token, between -20 and 20 (beyond, a token is as
        good as certain); move: 2 x 2 weights; start: weights of
        the state before the first token. Messages are ratios of the two states. They
        pass over products of the tokens' 2 x 2 matrices, block by block, and then
        inside all blocks at once, from end to end of each text.
        """
        (a, b), (c, d) = move.tolist()
        n = self.real.shape[1]
        x = np.ones((BLOCK, n))
        x[self.at] = np.exp(np.clip(energy, -20, 20))
        p, q, r, s = np.ones(n), np.zeros(n), np.zeros(n), np.ones(n)
        for t in range(BLOCK):
            cut = self.cut[t]
            old = p[cut], q[cut], r[cut], s[cut]
            p, q, r, s = p * a + q * c, (p * b + q * d) * x[t], r * a + s * c, (r * b + s * d) * x[t]
            if t % 8 == 7:
                size = p + q + r + s
                p, q, r, s = p / size, q / size, r / size, s / size
                old = tuple(v / size[cut] for v in old)
            p[cut], q[cut], r[cut], s[cut] = old
        into, out = np.full(n, start[1] / start[0]), np.ones(n)
        for k in range(1, int(self.per.max(initial=0))):
            at = self.first[:-1][self.per > k] + k
            into[at] = (q[at - 1] + into[at - 1] * s[at - 1]) / (p[at - 1] + into[at - 1] * r[at - 1])
            at = self.first[1:][self.per > k] - 1 - k
            out[at] = (r[at + 1] + s[at + 1] * out[at + 1]) / (p[at + 1] + q[at + 1] * out[at + 1])
        odds = np.empty((BLOCK, n))
        before = np.empty((BLOCK, n)) if pairs else None
        f = into
        for t in range(BLOCK):
            if pairs:
                before[t] = f
            f = odds[t] = (b + f * d) * x[t] / (a + f * c)
        g, after = out, np.empty((BLOCK, n)) if pairs else None
        for t in range(BLOCK - 1, -1, -1):
            odds[t] *= g
            if pairs:
                after[t] = g
            g = (c + d * x[t] * g) / (a + b * x[t] * g)
            g[self.cut[t]] = 1.0
        chance = (odds / (1 + odds))[self.at]
        if not pairs:
            return chance
        f, g = before[self.at], (after * x)[self.at]
        joint = np.stack([np.full(len(f), a), b * g, c * f, d * f * g])
        return chance, (joint / joint.sum(0)).sum(1).reshape(2, 2)


def features(word: str) -> list[str]:
    """A whole word, marked by its end, and its proper beginnings of three to eight letters."""
    return [word + "$", *(word[:k] for k in range(3, min(9, len(word))))]


@dataclass
class Model:
    weight: dict[str, float]  # log-odds of state 1 by feature
    bias: float
    move: np.ndarray
    start: np.ndarray
    score: np.ndarray  # by the columns of summary()

    def energies(self, words: list[str], known: dict[str, float], most: int = 300_000) -> list[float]:
        """Log-odds of state 1 of each word; known keeps those of words seen before, up to `most`."""
        if len(known) > most:
            known.clear()
        out = list(map(known.get, words))
        if None in out:
            for i, e in enumerate(out):
                if e is None:
                    w = words[i]
                    out[i] = known[w] = self.bias + sum([self.weight.get(f, 0.0) for f in features(w.lower())])
        return out

    def tag(self, texts: list[str | None], known: dict[str, float]) -> tuple[list[int], np.ndarray]:
        """(numbers of tokens, marginals of all tokens) of whole texts."""
        found = [self.energies(TOKEN.findall(t), known) if t else [] for t in texts]
        lengths = [len(x) for x in found]
        flat = np.fromiter(chain.from_iterable(found), float, sum(lengths))
        return lengths, Chains(np.array(lengths)).marginals(flat, self.move, self.start)

    def scores(self, lengths: list[int], chance: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-summary(lengths, chance) @ self.score))


def summary(lengths: list[int], chance: np.ndarray) -> np.ndarray:
    """By text: 1, its largest marginal, the expected number of toxic tokens and their share, as logs."""
    n = np.array(lengths)
    text = np.repeat(np.arange(len(n)), n)
    most = np.zeros(len(n))
    np.maximum.at(most, text, chance)
    total = np.bincount(text, chance, len(n))
    return np.stack([np.ones(len(n)), most, np.log1p(total), np.log1p(100 * total / (n + 10))], 1)


def label_tokens(tokens: list[list[str]], toxic: np.ndarray, most: int = 40_000, least: int = 5, ratio: float = 8.0) -> tuple[dict[str, int], set[str]]:
    """(numbers of features, features that mark a word as toxic) from labels of whole texts.

    A word is toxic in a toxic text if it has a feature that toxic texts hold
    `ratio` times as often as others, with shares smoothed by a half and taken
    from the lower end of their interval, and that occurs between `least`
    different pairs of neighbours there: copies of one text repeat its neighbours.
    """
    inside = [Counter(), Counter()]
    near: dict[str, set] = {}
    for words, y in zip(tokens, toxic):
        inside[y].update({f for w in set(words) for f in features(w)})
        if y:
            for a, w, b in zip(["", *words], words, [*words[1:], ""]):
                for f in features(w):
                    held = near.setdefault(f, set())
                    if len(held) < least:  # more are not asked for
                        held.add((a, b))
    n = np.maximum(1, [np.sum(toxic == 0), np.sum(toxic == 1)])
    bad = set()
    for f, a in inside[1].items():
        if a >= least and len(near[f]) >= least and len(f) > 3:
            if max(0.0, a - 1.64 * a**0.5) / n[1] > ratio * (inside[0][f] + 0.5) / n[0]:
                bad.add(f)
    common = [f for f, c in sorted((inside[0] + inside[1]).items(), key=lambda x: (-x[1], x[0])) if c >= 3 and f not in bad]
    return {f: i for i, f in enumerate([*sorted(bad), *common][:most])}, bad


def fit(rows: list[tuple[str | None, int]], prior: float, *, most_features: int = 40_000, rounds: int = 40, ridge: float = 1e-3) -> Model | None:
    """Fit on (text, toxic); prior: the share of toxic rows among all labelled ones."""
    toxic = np.array([y for _, y in rows], int)
    if len(set(toxic.tolist())) < 2:
        return None
    tokens = [[w.lower() for w in TOKEN.findall(t or "")] for t, _ in rows]
    number, bad = label_tokens(tokens, toxic, most_features)
    words = {w: i for i, w in enumerate(dict.fromkeys(w for t in tokens for w in t))}
    own = [[number[f] for f in features(w) if f in number] for w in words]
    of_word, feature = np.repeat(np.arange(len(words)), [len(x) for x in own]), np.array([f for x in own for f in x], np.int64)
    marked = np.array([any(f in bad for f in features(w)) for w in words], bool)
    lengths = np.array([len(t) for t in tokens])
    flat = np.array([words[w] for t in tokens for w in t], np.int64)
    gold = marked[flat] & (np.repeat(toxic, lengths) == 1) if len(flat) else np.zeros(0, bool)
    chains = Chains(lengths)
    begins = np.zeros(len(flat), bool)
    begins[np.concatenate([[0], np.cumsum(lengths)])[:-1][lengths > 0]] = True
    before = np.concatenate([[False], gold[:-1]]) & ~begins
    moved = np.array([[np.sum(~before & ~gold), np.sum(~before & gold)], [np.sum(before & ~gold), np.sum(before & gold)]], float)
    by_feature = lambda x: np.bincount(feature, x[of_word], len(number))
    observed, seen = np.bincount(flat, gold, len(words)), np.bincount(flat, minlength=len(words)).astype(float)
    often = 1 + by_feature(seen)
    # Log-likelihood of gold tags: emissions by feature, moves between tags; gradients are expected counts.
    weight, bias, log_move = np.zeros(len(number)), np.full(1, -3.0), np.zeros((2, 2))
    scale = np.zeros(len(number)), np.zeros(1), np.zeros((2, 2))
    start = np.array([1.0, 1e-6])
    energy = lambda: (np.bincount(of_word, weight[feature], len(words)) + bias)[flat]
    for r in range(rounds if len(flat) else 0):
        chance, joint = chains.marginals(energy(), np.exp(log_move), start, pairs=True)
        missed = observed - np.bincount(flat, chance, len(words))
        steps = (by_feature(missed) / often - ridge * weight, missed.sum() / len(flat), (moved - joint) / len(flat))
        for value, step, s in zip((weight, bias, log_move), steps, scale):
            s *= 0.9
            s += 0.1 * step**2
            value += 0.3 * 0.96**r * step / (np.sqrt(s) + 1e-4)
    move = np.exp(log_move - log_move.max())
    x = summary(lengths.tolist(), chains.marginals(energy(), move, start))
    shift = np.log(prior / (1 - prior)) - np.log(toxic.mean() / (1 - toxic.mean()))
    beta = np.zeros(x.shape[1])
    for _ in range(30):  # Newton's method for the logistic regression of labels on marginals
        p = 1 / (1 + np.exp(-x @ beta))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(beta))
        beta += np.linalg.solve(h, x.T @ (toxic - p) - 0.1 * beta)
    beta[0] += shift
    return Model({f: float(weight[i]) for f, i in number.items() if abs(weight[i]) > 1e-3}, float(bias[0]), move, start, beta)


def training_rows(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, per_class: int, sample_bytes: int) -> tuple[list[tuple[str | None, int]], float]:
    """The per_class ids of each label of least hash, with one text each, and the share of toxic labels.

    Texts are taken in that order as long as all of them make up sample_bytes at most.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).where(F.col("toxic").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
    once = known.groupBy("id").agg(F.max("toxic").alias("toxic")).withColumn("draw", unit(F.xxhash64("id")))
    counts = {r["toxic"]: r["count"] for r in once.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return [], 0.0
    # Some four times as many as are taken have so small a hash: few rows are ranked, however many there are.
    near = F.col("draw") < F.when(F.col("toxic") == 1, 4 * per_class / counts[1]).otherwise(4 * per_class / counts[0])
    place = F.row_number().over(W.partitionBy("toxic").orderBy("draw", "id"))
    drawn = once.where(near).withColumn("place", place).where(F.col("place") <= per_class).select(F.col("id").alias("drawn"), "toxic", "place")
    # Twice per_class rows by construction: small enough to send to every executor.
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(drawn), F.col("id") == F.col("drawn"))
    rows = rows.where(F.coalesce(F.octet_length("text"), F.lit(0)) <= sample_bytes)
    one = rows.groupBy("drawn", "toxic", "place").agg(F.min("text").alias("text"))
    size = F.sum(64 + F.coalesce(F.octet_length("text"), F.lit(0))).over(W.orderBy("place", "toxic"))
    found = one.withColumn("size", size).where(F.col("size") <= sample_bytes).select("text", "toxic").collect()
    return sorted(((r["text"], r["toxic"]) for r in found), key=lambda r: (r[1], r[0] or "")), counts[1] / (counts[0] + counts[1])


def score_toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_class: int = 800, sample_bytes: int = 16 << 20, most_features: int = 40_000, threshold: float = 0.3, keep: tuple[str, ...] = ()) -> DataFrame:
    """Toxicity of each whole text, with the offending passages.

    Labels of texts label tokens: words and beginnings of words that toxic texts
    hold far more often than clean ones. A linear-chain CRF of up to most_features
    features is fitted to them by gradient ascent on per_class texts of each label, all
    of them sample_bytes at most; forward-backward gives every token of every
    text its marginal, and a logistic regression on the largest marginal, their
    sum and their share, fitted on the same rows, gives the score.

    Learns from labelled rows whose id is not held out; scores come from the text
    alone. Null and empty texts: no tokens, the score of a text without offence.
    Labels of one kind only or none: score 0. Several labels of an id: toxic if
    one is, and of several texts of an id one is learnt from. Ties in the order of the
    sample go to the smaller id. Very long texts: all tokens count; blocks of them are
    worked on at once. Repeated rows: each scored alone. No documents: no rows. Other
    columns are ignored.

    Returns id_col, the columns of docs named in keep, held_out, score, predicted, spans (start and end of each
    passage of tokens more likely toxic than not, in turn, in code points).
    """
    spark = docs.sparkSession
    rows, prior = training_rows(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, per_class=per_class, sample_bytes=sample_bytes)
    get = share(spark, fit(rows, prior, most_features=most_features))
    texts = with_kept(docs, id_col, text_col, keep)
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches):
        model, known = get(), {}
        for b in batches:
            for ids, texts in pieces(b, 400_000):
                scores, spans = np.zeros(len(texts)), [[]] * len(texts)
                if model is not None:
                    lengths, chance = model.tag(texts, known)
                    scores = model.scores(lengths, chance)
                    ends = np.cumsum(lengths)
                    for i in np.unique(np.repeat(np.arange(len(texts)), lengths)[chance > 0.5]).tolist():
                        own = chance[ends[i] - lengths[i] : ends[i]] > 0.5
                        spans[i] = passages(texts[i], own)
                yield pa.record_batch([ids, pa.array(scores, pa.float64()), pa.array(spans, pa.list_(pa.int32()))], names=["id", "score", "spans"])

    out = texts.mapInArrow(run, f"id {kind}, score double, spans array<int>")
    kept = [F.col(f"id.kept.{c}") for c in keep if c != id_col]
    return out.select(F.col("id.own").alias(id_col), *kept, held_out(F.col("id.own")).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"), "spans")


def passages(text: str, own: np.ndarray) -> list[int]:
    out, last = [], -2
    for i, m in enumerate(TOKEN.finditer(text)):
        if own[i]:
            if last == i - 1:
                out[-1] = m.end()
            else:
                out += [m.start(), m.end()]
            last = i
    return out
