"""Bounds from grams never leave out a pair that difflib finds alike, and leave out most others."""

import difflib
import random

import numpy as np
import pytest

from ledgerloom.operators import text

RNG = random.Random(5)
PIECES = ["abra", "kad", "a", "bb ", "cad", " ", "the ", "xyz", "0 ", "\n", "é"]


def pair():
    a = "".join(RNG.choice(PIECES) for _ in range(RNG.randint(0, 120)))
    b = list(a)
    for _ in range(RNG.randint(0, 30)):
        b.insert(RNG.randint(0, len(b)), RNG.choice("ab ~"))
    return a, "".join(RNG.choice([b, list(reversed(b)), b[len(b) // 2 :] + b]))


def test_bounds():
    for _ in range(600):
        a, b = pair()
        shared = sum(m.size for m in difflib.SequenceMatcher(None, a, b).get_matching_blocks())
        assert list(text.Grams([a, b, ""]).passing(0, np.array([1]), np.array([shared - 0.5]))) == [1]
        assert text.Grams([a, b, ""]).following(max(0, shared - 0.5) / max(1, min(len(a), len(b))))[0] or not shared


def kept_by(monkeypatch, rule, *args):
    out = []
    monkeypatch.setattr(text, "of_groups", lambda rows, group, keep, *columns: out.append(keep))
    rule(None, *args)
    return out[0]


@pytest.mark.parametrize("rule, args, most", [(text.near_duplicates, ("d", "t", "i", "k"), 30), (text.overlapping, (["d"], "t", "i"), 30)])
def test_few_pairs_are_compared_sign_by_sign(monkeypatch, rule, args, most):
    words = ["".join(RNG.choice("etaoinshrdlucmfwypvbgk") for _ in range(RNG.randint(2, 9))) for _ in range(3000)]
    texts = [" ".join(RNG.choice(words) for _ in range(60))[:300] for _ in range(150)]
    texts += [texts[149][:250] + texts[3][:50], texts[149][:250] + texts[3][:50]]
    calls, real = [], difflib.SequenceMatcher
    monkeypatch.setattr(text.difflib, "SequenceMatcher", lambda *a: calls.append(a) or real(*a))
    keep = kept_by(monkeypatch, rule, *args)
    kept = keep([152], texts, list(range(152)), *[["x"] * 152] * (rule is text.near_duplicates))
    assert sorted(kept) == list(range(150)) and 0 < len(calls) <= most


def test_scores_of_a_block_are_not_held_at_once(monkeypatch):
    import tracemalloc

    import pyarrow as pa

    from ledgerloom.operators import vector_index

    table = lambda n, seed: pa.table({"v": pa.array(list(np.random.default_rng(seed).random((n, 4))), pa.list_(pa.float64()))})
    left, right = table(2000, 1), table(4000, 2)
    tracemalloc.start()
    q, r, s = vector_index.scored(left, right, 3)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 2000 * 4000 * 8
    score = (vector_index.matrix(left.column("v").combine_chunks()) @ vector_index.matrix(right.column("v").combine_chunks()).T).round(12)
    assert len(q) >= 6000 and np.allclose(score[q, r], s) and np.array_equal(np.bincount(q, minlength=2000) >= 3, np.ones(2000, bool))
