from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from plumbline.llm import leaks, registry
from tests.conftest import MIDDLE
from tests.llm.rows import awkward, nothing, others_kept, prose


def plain(text):
    return ["".join(c for c in w if c.isalnum() or ord(c) > 126) for w in (text or "").lower().split()]


def smith_waterman(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (1 if x == y else -1), row[j + 1] - 1, new[j] - 1))
        best, row = max(best, max(new)), new
    return best


def test_scores_are_smith_waterman():
    rng = np.random.default_rng(1)
    a, b = rng.integers(2, 6, (60, 12)).astype(np.uint64), rng.integers(2, 6, (60, 25)).astype(np.uint64)
    a[3, 8:], b[4, 20:] = 0, 1
    score, _ = leaks.local_scores(a, b)
    assert score.tolist() == [smith_waterman([x for x in p if x], [y if y > 1 else -1 for y in q]) for p, q in zip(a.tolist(), b.tolist())]


def test_query_against_all_alignments(spark):
    """Every document that shares a word triple with an item is aligned as a whole."""
    docs = {r.doc_id: [w for w in plain(r.text) if w] for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    items = {r.item_id: [w for w in plain(r.text) if w] for r in spark.read.parquet(f"{MIDDLE}/benchmark.parquet").collect()}
    triples = defaultdict(set)
    for i, w in items.items():
        for k in range(len(w) - 2):
            triples[tuple(w[k:k + 3])].add(i)
    want = {}
    for d, w in docs.items():
        shared = defaultdict(int)
        for k in range(len(w) - 2):
            for i in triples.get(tuple(w[k:k + 3]), ()):
                shared[i] += 1
        for i, n in shared.items():
            if n >= 3 and (score := smith_waterman(items[i], w) / len(items[i])) >= 0.5:
                want[d, i] = score
    got = {(r.doc_id, r.item_id): r.score for r in registry.op9_leaks(spark, MIDDLE).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want) and len(got) > 10


def edited(words, rng, share):
    out = []
    for w in words:
        x = rng.random()
        if x < share / 3:
            continue
        out.append(f"other{rng.randrange(99)}" if x < 2 * share / 3 else w)
        if x > 1 - share / 3:
            out.append(f"more{rng.randrange(99)}")
    return out


@pytest.mark.parametrize("block_words", [1 << 20, 50])
def test_edited_copies_are_found_and_clean_texts_are_not(spark, block_words):
    rng = random.Random(6)
    items = [(f"i{k}", prose(500 + k, 40)) for k in range(8)] + [("none", None), ("short", "the of")]
    docs = []
    for k in range(8):
        for e, share in enumerate((0, 0.1, 0.2)):
            docs.append((10 * k + e, f"{prose(k, 90)} {' '.join(edited(items[k][1].split(), rng, share))}, {prose(50 + k, 90)}"))
        docs.append((10 * k + 5, prose(100 + k, 200) + " the of"))
    docs += [(900, None), (901, "")]
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")
    got = {(r.doc_id, r.item_id) for r in leaks.leaks(docs, items, block_words=block_words).collect()}
    assert got == {(10 * k + e, f"i{k}") for k in range(8) for e in range(3)}
    assert {r.doc_id for r in leaks.clean(docs, items, block_words=block_words).collect()} == {10 * k + 5 for k in range(8)} | {900, 901}


def test_one_shared_triple_is_enough(spark):
    """Copies that reach the threshold with few triples intact, against all pairs that share at least one."""
    rng, items, docs = random.Random(3), [], []
    for k in range(300):
        words, keep = [f"i{k}w{j}" for j in range(rng.choice((12, 16, 20)))], rng.randrange(4)
        items.append((k, " ".join(words)))
        copy = [w if j % 4 != keep or rng.random() < 0.2 else f"other{k}x{j}" for j, w in enumerate(words)]
        docs.append((k, f"{prose(k, 30)} {' '.join(copy)} {prose(1000 + k, 30)}"))
    want = set()
    for (i, item), (d, text) in zip(items, docs):
        a, b = plain(item), plain(text)
        shared = {tuple(a[j:j + 3]) for j in range(len(a) - 2)} & {tuple(b[j:j + 3]) for j in range(len(b) - 2)}
        if shared and (score := smith_waterman(a, b)) >= 6 and score >= 0.5 * len(a):
            want.add((d, i))
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in leaks.leaks(docs, items).collect()} == want and len(want) > 100
    assert {r.doc_id for r in leaks.clean(docs, items).collect()} == set(range(300)) - {d for d, _ in want}


def test_awkward(spark):
    docs = awkward(spark)
    items = docs.filter("doc_id in (8, 9, 14)").selectExpr("doc_id as item_id", "text")
    out = leaks.leaks(docs, items)
    assert {(r._c0, r.text[:20], r.item_id) for r in out.collect()} == {("c", prose(1, 20)[:20], 8), ("c", prose(1, 20)[:20], 9), ("c", prose(4, 20)[:20], 14)}
    assert leaks.clean(docs, items).count() == docs.count() - 3 - 2
    assert others_kept(docs, leaks.clean(docs, items.limit(0)))
    assert leaks.leaks(docs, items.limit(0)).collect() == [] and leaks.leaks(nothing(spark), items).collect() == []
    assert leaks.leaks(docs, items.limit(0)).columns == leaks.leaks(docs, items).columns
