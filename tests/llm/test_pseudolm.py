from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import pseudolm, registry
from tests.conftest import MIDDLE, SMALL
from tests.llm.rows import awkward, nothing, others_kept

ADDED = ("n_tokens", "log_likelihood", "mean_log_likelihood")


def random_table(seed):
    return np.random.default_rng(seed).normal(0, 0.5, (pseudolm.ROWS, pseudolm.WIDTH))


def by_hand(table, tokens):
    """One token at a time, straight from the definition."""
    w, out = pseudolm._views(table), []
    blank = pseudolm.TOKENS
    for i, t in enumerate(tokens):
        hidden = w["hidden_bias"][0].copy()
        for k, place in enumerate((-2, -1, 1, 2)):
            other = tokens[i + place] if 0 <= i + place < len(tokens) else blank
            hidden += w["context"][other].reshape(4, -1)[k]
        hidden = np.tanh(hidden)
        classes = hidden @ w["class_out"] + w["class_bias"][0]
        kind, inner = divmod(int(t), pseudolm.WIDTH)
        words = np.tanh(hidden + w["class_in"][kind]) @ w["word_out"] + w["word_bias"][kind]
        out.append(classes[kind] - np.log(np.exp(classes).sum()) + words[inner] - np.log(np.exp(words).sum()))
    return np.array(out)


def test_scores_by_hand():
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, pseudolm.TOKENS, n) for n in (1, 2, 7, 30)]
    table = random_table(2)
    got = pseudolm.log_probabilities(pseudolm._views(table), np.concatenate(docs), np.repeat([0, 3, 4, 9], [1, 2, 7, 30]), batch=6)
    assert got == pytest.approx(np.concatenate([by_hand(table, d) for d in docs]))
    assert len(pseudolm.log_probabilities(pseudolm._views(table), np.zeros(0, int), np.zeros(0, int))) == 0


def test_probabilities_sum_to_one():
    table = random_table(3)
    total = sum(np.exp(by_hand(table, [5, 900, t, 17, 4])[2]) for t in range(pseudolm.TOKENS))
    assert total == pytest.approx(1)


def test_a_step_follows_the_gradient():
    """With a tiny rate and equal step sizes, one batch moves every weight against the numerical gradient."""
    rng = np.random.default_rng(4)
    tokens = rng.integers(0, pseudolm.TOKENS, 40)
    table = random_table(5)
    sequence, _ = pseudolm.padded(tokens, np.zeros(40, int))
    moved, squares = table.copy(), np.full_like(table, 1e12)
    pseudolm.train_pass(moved, sequence, squares, rate=1e6, batch=1000)
    slope = table - moved  # gradient of the mean loss
    used = np.flatnonzero(np.abs(slope).sum(1))
    for r in rng.choice(used, 25, replace=False).tolist() + [pseudolm.ROWS - 1, pseudolm.ROWS - 2]:
        c = int(rng.integers(pseudolm.WIDTH))
        losses = []
        for sign in (1, -1):
            near = table.copy()
            near[r, c] += sign * 1e-5
            losses.append(-pseudolm.log_probabilities(pseudolm._views(near), tokens, np.zeros(40, int)).mean())
        assert slope[r, c] == pytest.approx((losses[0] - losses[1]) / 2e-5, rel=1e-3, abs=1e-7)


def test_sums_of_groups():
    """Groups of any size, to the last digit as numpy sums them one by one."""
    rng = np.random.default_rng(6)
    counts = np.array([300, 40, 9, 9, 8, 7, 6, 5, 4, 3, 2, 1, 1])
    starts = rng.permutation(np.cumsum(counts) - counts)
    rows, at = rng.normal(size=(50, 4)).astype(np.float32), rng.integers(0, 50, (int(counts.sum()) + 300, 3))
    for few in (slice(None), slice(2, None), slice(4, None), slice(9, None), slice(13, None)):
        got = pseudolm._summed(rows, at, starts[few], counts[few])
        one_by_one = [np.add.reduceat(rows[at[s:s + n]].reshape(n, -1).view(np.complex64), [0], axis=0) for s, n in zip(starts[few], counts[few])]
        assert np.array_equal(got, np.array(one_by_one, np.complex64).reshape(-1, 6).view(np.float32))


def mean(df):
    return df.agg(F.sum("log_likelihood") / F.sum("n_tokens")).first()[0]


def test_held_out_text_gets_likelier(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").filter("doc_id < 3000").repartition(4)
    learn, held = docs.filter("doc_id % 5 != 0"), docs.filter("doc_id % 5 = 0")
    frequencies = mean(pseudolm.scored(held, pseudolm.trained(learn, rounds=0)))
    model = pseudolm.trained(learn)
    after = mean(pseudolm.scored(held, model))
    shuffled = held.withColumn("text", F.expr(
        "array_join(transform(array_sort(transform(split(text, ' '), (w, i) -> struct(md5(concat(w, i)) as h, w as w))), s -> s.w), ' ')"))
    assert after > frequencies + 0.02 > np.log(1 / pseudolm.TOKENS)
    assert mean(pseudolm.scored(shuffled, model)) < after - 0.05


def test_query(spark):
    rows = {r.doc_id: r for r in registry.op6_pseudolm(spark, SMALL).collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert rows.keys() == docs.keys()
    for i, r in rows.items():
        assert r.n_tokens == len((docs[i] or "").split()) and r.log_likelihood < 0 and r.mean_log_likelihood == pytest.approx(r.log_likelihood / r.n_tokens)


def test_words_are_counted_over_all_documents(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    a, b = pseudolm.trained(docs, rounds=0), pseudolm.trained(docs, rounds=0, share=0.01)
    assert np.array_equal(a.token_of, b.token_of) and np.array_equal(a.table, b.table)


def test_awkward(spark):
    docs = awkward(spark)
    out = pseudolm.scored(docs, pseudolm.trained(docs))
    assert others_kept(docs, out, *ADDED)
    for r in out.collect():
        assert (r.n_tokens == 0) == (r.mean_log_likelihood is None) == (r.log_likelihood == 0)
    model = pseudolm.trained(nothing(spark))
    assert pseudolm.scored(nothing(spark), model).collect() == []
    flat = pseudolm.scored(spark.createDataFrame([("some words",)], "text string"), model).first()
    assert flat.mean_log_likelihood == pytest.approx(np.log(1 / pseudolm.TOKENS), abs=0.2)
