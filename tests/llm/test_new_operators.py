"""Tokens, resampling and point-in-time joins against brute force, with all the odd rows."""

import collections
import hashlib
import math
import random
import re
import time
import zlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_operators import DOCS, rows

from ledgerloom.llm import byte_bpe, point_in_time, resampling

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = byte_bpe.read_ranks(None, PATH)
BPE = byte_bpe.Bpe(RANKS, public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3).cache()


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text("abetnorisx'", max_size=120), st.lists(st.sampled_from(list(RANKS)[:50_000:7]), max_size=9).map(lambda x: b"".join(x).decode("utf-8", "ignore"))))
def test_tokens_equal_the_library(text):
    ids = BPE.encode(text).tolist()
    assert ids == LIBRARY.encode_ordinary(text)
    assert b"".join(BPE.bytes[i] for i in ids) == text.encode()


def test_neighbours_by_steps_equal_merging():
    """Two tokens may be neighbours if the library leaves them so."""
    rng, tokens = random.Random(5), [i for b, i in RANKS.items() if len(b) < 9]
    for _ in range(4000):
        a, b = rng.choice(tokens), rng.choice(tokens)
        both = BPE.bytes[a] + BPE.bytes[b]
        merged = [both[i : i + 1] for i in range(len(both))]
        while True:
            rank, at = min(((RANKS[x + y], i) for i, (x, y) in enumerate(zip(merged, merged[1:])) if x + y in RANKS), default=(-1, -1))
            if rank < 0:
                break
            merged[at : at + 2] = [merged[at] + merged[at + 1]]
        expected = merged == [BPE.bytes[a], BPE.bytes[b]]
        assert expected == (BPE.fits(-1, a) and BPE.fits(a, b))


def test_other_ranks_with_tokens_that_merging_never_makes():
    """Ranks where a token is only reached as a whole match, and where the longest match is wrong at every place."""
    ranks = {bytes([b]): i for i, b in enumerate(b"abcd")} | {b"bc": 4, b"ab": 5, b"abcd": 6, b"cd": 7, b"da": 8}
    own, library = byte_bpe.Bpe(ranks, "[a-d]+", known=3), tiktoken.Encoding("t", pat_str="[a-d]+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    for text in ["abcd", "abc", "abcdabcd", *("".join(rng.choice("abcd") for _ in range(rng.randint(1, 14))) for _ in range(800))]:
        assert own.encode(text).tolist() == library.encode_ordinary(text), text


def test_long_matches_take_linear_time():
    rng = random.Random(3)
    took = []
    for n in (100_000, 400_000):
        text = "".join(rng.choice("abcdefghij") for _ in range(n))
        began = time.time()
        ids = BPE.encode(text)
        took.append(time.time() - began)
        assert b"".join(BPE.bytes[i] for i in ids.tolist()) == text.encode()
    assert took[1] < 10 * took[0] + 1
    many = "one two  three\n" * 100_000  # beyond the size from which matches are taken one by one
    assert BPE.encode(many).tolist() == LIBRARY.encode_ordinary(many)


def test_token_table(spark, docs):
    out = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in byte_bpe.op11(docs, PATH, public_tokenizers.PATTERN).collect()}
    expected = set()
    for r in docs.collect():
        ids = LIBRARY.encode_ordinary(r["text"] or "")
        expected.add((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert out == expected
    assert byte_bpe.op11(docs, PATH, public_tokenizers.PATTERN).count() == docs.count()
    assert byte_bpe.op11(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
    with_null = spark.createDataFrame([(1, None), (2, []), (3, [BPE.ranks[b"a"]])], "doc_id long, ids array<int>")
    assert [(r["doc_id"], r["bytes"]) for r in byte_bpe.decoded(with_null, RANKS).orderBy("doc_id").collect()] == [(1, None), (2, b""), (3, b"a")]


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def resampled(docs, target, least, most, buckets, percent, min_words, seed):
    def grams(text):
        w = words_of(text)
        return [" ".join(w[i : i + n]) for n in range(least, most + 1) for i in range(len(w) - n + 1)]

    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = (collections.Counter(bucket(g) for text in side for g in grams(text)) for side in ([x for _, x in docs], target))
    gain = lambda b: math.floor(1000 * math.log(float(t[b] + 1) * float(s.total() + buckets) / (float(s[b] + 1) * float(t.total() + buckets))))
    out = []
    for key, text in docs:
        g = [gain(bucket(x)) for x in grams(text)]
        weight = sum(g) // len(g) if g else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words_of(text)) >= min_words])
    may = sorted((x for x in out if x[4]), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1]))
    place = {id(x): i + 1 for i, x in enumerate(may[: percent * len(may) // 100])}
    return sorted(((*x[:4], place.get(id(x))) for x in out), key=str)


@pytest.mark.parametrize("least, most, piece", [(1, 1, 4 << 20), (1, 3, 300), (2, 2, 1), (4, 5, 2000)])
def test_resampling(spark, docs, least, most, piece):
    plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
    target = [text for _, text in plain[5:9]] + [None, "", "one"]
    side = spark.createDataFrame([(t,) for t in target], "text string")
    out = resampling.importance_resample(docs, side, least=least, most=most, buckets=97, percent=30, seed=7, piece=piece)
    assert sorted(map(tuple, out.collect()), key=str) == resampled(plain, target, least, most, 97, 30, 20, 7)


def test_resampling_of_odd_tables(spark, docs):
    none = spark.createDataFrame([], "text string")
    plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, resampling.importance_resample(docs, none).collect()), key=str) == resampled(plain, [], 1, 1, 10_000, 10, 20, 2024)
    assert resampling.op12(docs.limit(0), none).count() == 0
    long = " ".join(f"w{i % 5000}" for i in range(300_000))
    out = resampling.op12(spark.createDataFrame([(1, long), (2, None)], "doc_id long, text string"), spark.createDataFrame([("w1 w2",)], "text string"))
    assert sorted((r["doc_id"], r["n_features"]) for r in out.collect()) == [(1, 300_000), (2, 0)]


def test_each_tuple_is_hashed_once(monkeypatch):
    known, hashed = resampling.Dictionary(["a b a b a b", "b a b", None, "", "a"]), []
    monkeypatch.setattr(resampling.zlib, "crc32", lambda b: hashed.append(b) or 0)
    for n, tuples in ((1, [b"a", b"b"]), (2, [b"a b", b"b a"]), (3, [b"a b a", b"b a b"])):
        hashed.clear()
        t, which, owner = known.grams(n)
        known.buckets(t, 10)
        assert sorted(hashed) == tuples and len(which) == len(owner) == {1: 10, 2: 7, 3: 5}[n]


def seen(versions, questions, lifetime):
    out = []
    for q, e, t in questions:
        usable = [(ev, -ar, v) for v, ve, ev, ar, ex in versions if None not in (e, t, ve, ev, ar, ex) and ve == e and ev <= t and ar <= t < min(ex, ev + lifetime)]
        best = max(usable, default=None)
        out.append((q, best and best[2], best and best[0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("lifetime, span, hot", [(30, 200, 0.4), (7, 40, 0.9), (1, 10, 0.5), (400, 300, 0.4)])
def test_point_in_time(spark, lifetime, span, hot):
    rng = random.Random(lifetime)
    entity = lambda: None if rng.random() < 0.05 else "hot" if rng.random() < hot else f"e{rng.randint(0, 4)}"
    versions = []
    for i in range(500):
        e = rng.randint(-span // 2, span)
        versions.append((i, entity(), e, e + rng.randint(-5, 12), e + rng.randint(0, lifetime + 3)))
    versions += versions[:20] + [(900, "hot", None, 1, 2), (901, "hot", 1, None, 9), (902, "hot", 1, 1, None)]
    questions = [(i, entity(), rng.randint(-span // 2, span + lifetime)) for i in range(300)] + [(500, "hot", None), (501, "hot", 5), (502, "hot", 5), (503, "unknown", 5)]
    v = spark.createDataFrame(versions, "v long, e string, event long, arrival long, expiry long").withColumn("question", F.lit("clash")).withColumn("found", F.lit(1)).repartition(3)
    q = spark.createDataFrame(questions, "q long, e string, t long").withColumn("found", F.lit("clash")).withColumn("span", F.lit(1)).repartition(3)
    out = point_in_time.point_in_time(v, q, entity="e", event="event", arrival="arrival", expiry="expiry", version="v", time="t", lifetime=lifetime, carry=("question", "found"))
    got = sorted(((r["question"]["q"], r["found"] and r["found"]["version"], r["found"] and r["found"]["event"]) for r in out.collect()), key=str)
    assert got == seen(versions, questions, lifetime)


def test_versions_that_cannot_win_are_left_out(spark):
    """Of one event as many versions stay as can win; that does not grow with their number."""
    rng = random.Random(1)
    many = [(i, "a", 10, 10 + rng.randint(-3, 5), 10 + rng.randint(0, 20)) for i in range(3000)]
    df = spark.createDataFrame(many, "version long, entity string, event long, arrival long, expiry long").withColumn("carry", F.lit(None).cast("int"))
    left = point_in_time.winners(df).collect()
    assert 0 < len(left) <= 20
    t = point_in_time.point_in_time(df, spark.range(5, 40).select(F.col("id").alias("t"), F.lit("a").alias("entity")), entity="entity", event="event", arrival="arrival", expiry="expiry", version="version", time="t", lifetime=20)
    assert sorted(((r["question"]["t"], r["found"] and r["found"]["version"], r["found"] and r["found"]["event"]) for r in t.collect()), key=str) == seen([(*m,) for m in many], [(t, "a", t) for t in range(5, 40)], 20)


def test_labels_and_sources(spark):
    none = "doc_id long, source string, n_chars long, lang string"
    labels = spark.createDataFrame([(1,), (1,), (None,), (77,)], "doc_id long")
    out = point_in_time.op13(spark.createDataFrame([], none), labels).collect()
    assert len(out) == 4 and {r["status"] for r in out} == {"none"} and [r["t"] for r in out if r["doc_id"] is None] == [None]
    docs = spark.createDataFrame([(1, None, 5, "en"), (2, "s", 6, None), (3, "s", None, "de"), (3, "s", None, "de"), (None, "s", 1, "x")], none)
    assert point_in_time.op13(docs, labels.limit(0)).count() == 0
    assert point_in_time.op13(docs, labels).count() == 4
