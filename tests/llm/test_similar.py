from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from plumbline.llm import components, registry, similar
from tests.conftest import MIDDLE
from tests.llm.rows import awkward, nothing, prose


def brute_force(rows, n=5, threshold=0.8):
    sets, inverse = [], defaultdict(set)
    for k, (_, text) in enumerate(rows):
        w = (text or "").lower().split()
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
        for g in sets[-1]:
            inverse[g].add(k)
    links, parent = [0] * len(rows), list(range(len(rows)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k, s in enumerate(sets):
        for j, both in Counter(j for g in s for j in inverse[g] if j != k).items():
            if both >= threshold * (len(s) + len(sets[j]) - both) - 1e-9:
                links[k] += 1
                a, b = top(k), top(j)
                parent[max(a, b)] = min(a, b)
    members = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        members[top(k)].append(i)
    return sorted((i, min(members[top(k)]), links[k]) for k, (i, _) in enumerate(rows))


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in registry.op2_similar(spark, MIDDLE).collect()) == brute_force(rows)


@pytest.mark.parametrize("limits", [{}, {"block_sets": 7}, {"block_ngrams": 900}])
def test_large_group_of_variants(spark, limits):
    rng, base, rows = random.Random(4), prose(9, 150).split(), []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(9)}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, rows[i][1].upper()) for i in range(10)] + [(200, "Of."), (201, "of."), (202, None), (203, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in similar.linked(docs, **limits).collect())
    assert got == brute_force(rows)


@pytest.mark.parametrize("common", [12, 24, 28, 32, 36, 400, 1596])
def test_links_at_exactly_the_threshold(common):
    """common of 5 / 4 common n-grams is 0.8; one more in the union is less."""
    apart = common // 4
    for more, links in ((0, 1), (1, 0)):
        a, b = np.arange(common + apart // 2), np.concatenate([np.arange(common), 10 ** 6 + np.arange(apart - apart // 2 + more)])
        got, label = similar.linked_sets(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), np.ones(2, np.int64), None, 0.8)
        assert got.tolist() == [links, links] and label.tolist() == [0, 1 - links]


def test_texts_at_exactly_the_threshold(spark):
    rows = []
    for k, common in enumerate((12, 24, 28, 32, 36)):
        base = [f"w{k}x{j}" for j in range(common + 4)]
        apart = common // 4
        rows += [(10 * k, " ".join(base + [f"a{k}x{j}" for j in range(apart // 2)])),
                 (10 * k + 1, " ".join(base + [f"b{k}x{j}" for j in range(apart - apart // 2)]))]
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in similar.linked(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute_force(rows) == [(10 * k + i, 10 * k, 1) for k in range(5) for i in range(2)]


def test_prefix_is_shortened_until_the_recall_is_reached():
    assert similar.prefix_length(0.8, 24, 8, 0.9999) == 5
    assert similar.prefix_length(0.8, 24, 8, 0.5) == 8
    assert similar.prefix_length(0.8, 2, 8, 0.9999) == 1


def test_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 40) if i % 11] + [(50, 60 + k) for k in range(30)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(50)]
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    alone = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for x in parent if x not in alone}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_awkward(spark):
    docs = awkward(spark)
    out = similar.linked(docs)
    rows = out.collect()
    assert len(rows) == docs.count()
    assert {(r.class_id, r.n_links) for r in rows if r.doc_id in (8, 9)} == {(8, 2)}
    assert {(r.class_id, r.n_links) for r in rows if r.doc_id in (0, 1, 2)} == {(0, 0), (1, 0), (2, 0)}
    assert similar.linked(nothing(spark)).collect() == []
