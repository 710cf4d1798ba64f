from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plumbline.session import written
from tests.conftest import MIDDLE
from tests.llm.rows import awkward, nothing, prose
from tests.llm.test_leaks import plain, smith_waterman
from tests.llm.test_mixing import water_level
from tests.llm.test_sharding import laws
from tests.llm.test_similar import brute_force


@pytest.fixture(scope="module")
def steps(spark):
    """The documents before and after every stage."""
    docs = [spark.read.parquet(f"{MIDDLE}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(written(stage(spark, docs[-1], MIDDLE), f"test-{name}"))
    return docs


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()), key=str)


def test_stages_and_columns(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "mixing", "sharding"]
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns
    assert steps[-1].columns == [*steps[0].columns, "shard", "slot"]


def test_language_keeps_texts_with_a_clear_language(steps):
    gone = steps[0].join(steps[1], "doc_id", "left_anti").collect()
    assert len(gone) <= 0.01 * steps[0].count() and all(len(r.text.split()) < 20 for r in gone)


def test_one_of_each_class_stays(steps):
    before = [(r.doc_id, r.text) for r in steps[1].collect()]
    firsts = sorted({c for _, c, _ in brute_force(before)})
    assert sorted(r.doc_id for r in steps[2].collect()) == firsts


def test_only_leaks_go(spark, steps):
    items = [[w for w in plain(r.text) if w] for r in spark.read.parquet(f"{MIDDLE}/benchmark.parquet").collect()]
    stay = {r.doc_id for r in steps[3].collect()}
    for r in steps[2].collect():
        words = [w for w in plain(r.text) if w]
        triples = {tuple(words[k:k + 3]) for k in range(len(words) - 2)}
        leak = any(sum(tuple(i[k:k + 3]) in triples for k in range(len(i) - 2)) >= 3 and smith_waterman(i, words) >= 0.5 * len(i) for i in items)
        assert (r.doc_id not in stay) == leak


def test_mix_meets_its_targets(steps):
    size = {}
    for r in steps[3].collect():
        size[r.source] = size.get(r.source, 0) + len(r.text.split())
    target = water_level(size, (1, 2, 3), 3)
    taken = dict.fromkeys(size, 0)
    for r in steps[4].collect():
        taken[r.source] += len(r.text.split())
    assert all(abs(taken[s] - target[s]) < 0.02 * target[s] for s in target)
    assert steps[4].groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3


def test_shards(steps):
    assert rows(steps[5]) == rows(steps[4])
    loads = laws(steps[5].withColumn("size", F.octet_length("text") + 8).collect())
    assert max(loads.values()) - min(loads.values()) < 0.02 * max(loads.values())


def test_run_is_the_stages(spark, steps):
    assert rows(corpus_pipeline.run(spark, MIDDLE)) == rows(steps[5])


def test_one_of_each_class_stays_without_ids(spark):
    texts = [prose(k, 120) for k in range(3)]
    rows = [(i, v) for i, t in ((None, texts[0]), (7, texts[1])) for v in (t, t.upper(), t + " end")] + [(None, texts[1] + " more"), (None, texts[2]), (None, None)]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), MIDDLE).collect()
    assert sorted(str((r.doc_id, (r.text or "").lower()[:40])) for r in kept) == sorted(
        str(x) for x in ((None, texts[0][:40]), (7, texts[1][:40]), (None, texts[2][:40]), (None, "")))


def test_awkward(spark):
    for docs in (awkward(spark), nothing(spark)):
        docs, before = written(docs, "awkward"), docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, MIDDLE), f"awkward-{name}")
            assert docs.columns == before or name == "sharding"
        assert docs.filter("text is null or text = ''").count() == 0


def test_near_duplicates_tells_null_ids_from_null_texts(spark):
    rows = [("x", None), (None, "x"), (None, None), ("x", "x"), ("y", None), (None, "y"), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id string, text string, lang string, source string, n_chars int")
    kept = corpus_pipeline.near_duplicates(spark, docs, MIDDLE)
    # ("x", "x") and (None, "x") are one class; a repeated row stays once.
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [("x", "x"), ("x", None), (None, None), ("y", None), (None, "y")], key=str)
