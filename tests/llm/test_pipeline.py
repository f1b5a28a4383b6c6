"""The pipeline against brute force over what each stage was given."""

import collections

import pytest
from test_operators import DOCS, ITEMS, WORDS, low, reach, rows, toxic_rows, word  # noqa: F401

import corpus_pipeline
from ledgerloom.llm import toxicity


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables of documents (toxic, copied, contaminated and odd ones), labels and benchmark."""
    path = str(tmp_path_factory.mktemp("sf"))
    toxic = toxic_rows(400)
    docs = [r[:5] for r in rows()] + [(2000 + i, t, "en", f"s{i % 3}", len(t)) for i, t, _ in toxic]
    docs += [(5000, " ".join(f"w{i}" for i in range(20)), "en", "s0", 10), (5001, "x " * 400 + " ".join(f"w{i}" for i in range(13)), "en", "s0", 10)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(2000 + i, 1, y) for i, _, y in toxic], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [sorted(map(tuple, docs.collect()), key=str)]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, folder)
        if k < 4:
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen.append(sorted(map(tuple, docs.collect()), key=str))
    start, clean, alone, pure, mixed, stored = seen

    bad = collections.Counter(map(tuple, toxicity.score_toxicity(spark.createDataFrame(start, DOCS.split(", id ")[0]), spark.read.parquet(f"{folder}/labels.parquet"), keep=corpus_pipeline.COLUMNS).where("predicted = 1").select(*corpus_pipeline.COLUMNS).collect()))
    assert bad and collections.Counter(clean) == collections.Counter(start) - bad

    groups = reach([(r[0], r[1]) for r in clean])
    assert sorted(r[0] for r in alone if r[0] is not None) == sorted({g for _, _, g in groups if g is not None})
    assert set(alone) <= set(clean) and len(set(alone)) == len(alone)

    def contaminated(text):
        w, hit = WORDS.findall(low(text)), set()
        for _, t in ITEMS:
            item = WORDS.findall(low(t))
            n = min(13, len(item))
            for s in range(len(item) - n + 1 if item else 0):
                hit |= {x + y for x in range(len(w) - n + 1) if w[x : x + n] == item[s : s + n] for y in range(n)}
        return bool(hit) and 20 * len(hit) >= len(w)

    assert pure == [r for r in alone if not contaminated(r[1])] and len(pure) < len(alone)

    times = collections.Counter(mixed)
    assert set(times) <= set(pure) and max(times.values()) <= 2
    size = lambda r: len((r[1] or "").split(" ")) if r[1] else 0
    assert abs(sum(map(size, mixed)) - 1.5 * sum(map(size, pure))) <= 0.05 * sum(map(size, mixed))

    assert sorted((r[0], r[1], r[2]) for r in stored if r[0] is not None) == sorted((r[0], r[3], r[4]) for r in mixed if r[0] is not None)
    assert len(stored) == len(mixed)


def test_run_equals_its_stages(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns[:3] == ["doc_id", "source", "n_chars"] and out.count() > 0
    again = corpus_pipeline.run(spark, folder)
    pick = lambda df: sorted(map(tuple, df.select("doc_id", "source", "n_chars").collect()), key=str)
    assert pick(out) == pick(again)


ODD = [(1, "a b c d e f g", "en", "s", 5), (1, "a b c d e f g", "en", "s", 5), (1, "a b c d e f g", "en", "t", 5), (None, "a b c d e f g", None, None, None), (None, "other words that nobody else has here", None, None, None), (None, "other words that nobody else has here", None, None, None), (None, "other words that nobody else has here", "en", None, None), (2, None, None, None, None), (2, None, None, None, None), (3, "", "en", "s", 0), (4, "long " * 400_000, "en", None, 9)]


def test_near_copies_without_an_id_go_too(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long")
    out = [tuple(r) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert len(out) == 5 and collections.Counter(r[0] for r in out) == {1: 1, None: 1, 2: 1, 3: 1, 4: 1}
    assert all(r in ODD for r in out)


@pytest.mark.parametrize("rows", [[], ODD])
def test_run_on_odd_tables(spark, tmp_path, rows):
    """Empty tables, nulls in any column, repeated rows, a very long text, and further columns named as those that stages add."""
    path = str(tmp_path)
    more = "score double, predicted int, n_hit long, size long, key string, shard_id long, component_id long, row string, name string"
    wide = [(*r, 1.0, 1, 1, 1, "k", 7, 7, "r", "n") for r in rows]
    spark.createDataFrame(wide, f"doc_id long, text string, lang string, source string, n_chars long, {more}").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, path)
    assert out.columns == ["doc_id", "source", "n_chars", "shard_version", "shard_id", "shard_bytes", "shard_rows"]
    assert len({r["doc_id"] for r in out.collect()}) <= (5 if rows else 0)
    assert (out.count() > 0) == bool(rows)
