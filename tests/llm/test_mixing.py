from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import mixing, registry
from tests.conftest import MIDDLE, SMALL
from tests.llm.rows import awkward, nothing, others_kept

ADDED = ("size", "source_size", "target", "copies", "taken")


def water_level(sizes: dict, weights, most):
    """Shares by weight, excess over the limit shared again, until none is above."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = dict.fromkeys(order, 0.0), set(order), float(sum(sizes.values()))
    while open_ and left > 1e-9:
        level, full = left / sum(weight[s] for s in open_), set()
        for s in open_:
            if level * weight[s] >= most * sizes[s] - 1e-9:
                target[s] = most * sizes[s]
                full.add(s)
        if not full:
            target.update({s: level * weight[s] for s in open_})
            break
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 10, None: 3}, {"a": 1, "b": 1, "c": 10**6}, {"é": 5, "Z": 5, "a": 5}, {None: 7}, {"a": 0, "b": 0}, {"x": 0, "y": 9}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df, (1, 2, 3), 3).collect()}
    want = water_level(sizes, (1, 2, 3), 3)
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s], abs=1e-6) for s in want)


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 50, 2000):
        p, size = rng.random(n), rng.integers(0, 500, n)
        size[: n // 3] = 7
        out = mixing.flight(p, size, rng)
        assert out.sum() == pytest.approx(p.sum(), abs=1e-5 * n) and out @ size == pytest.approx(p @ size, abs=1e-3 * n)
        assert ((out > 1e-9) & (out < 1 - 1e-9)).sum() <= 2 and out.min() >= 0 and out.max() <= 1
        end = mixing.landing(p, out, size, rng)
        assert set(end) <= {0.0, 1.0} and abs(end @ size - p @ size) <= size.max()


def test_flight_keeps_probabilities():
    p, size = np.array([0.3, 0.5, 0.2, 0.7, 0.3, 0.4]), np.array([5, 9, 4, 12, 7, 3])
    rng = np.random.default_rng(1)
    mean = np.mean([mixing.flight(p, size, rng) for _ in range(4000)], axis=0)
    assert np.abs(mean - p).max() < 0.03


def test_query(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text", "source").collect()
    want = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs}
    by_source = {}
    for r in docs:
        by_source[r.source] = by_source.get(r.source, 0) + want[r.doc_id]
    target = water_level(by_source, (1, 2, 3), 3)
    rows = registry.op1_mixing(spark, MIDDLE).collect()
    assert sorted(r.doc_id for r in rows) == sorted(want)
    taken = dict.fromkeys(by_source, 0)
    for r in rows:
        assert r.size == want[r.doc_id] and r.source_size == by_source[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.size * r.copies
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] for s in target)
    again = registry.op1_mixing(spark, MIDDLE)
    assert {(r.doc_id, r.taken) for r in again.repartition(3).collect()} == {(r.doc_id, r.taken) for r in rows}


def test_many_blocks(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("source", F.lit("one"))
    rows = mixing.mixed(docs, block_rows=16, weights=(1,), most=0.37).select("taken", "target").collect()
    assert abs(sum(r.taken for r in rows) - rows[0].target) < 100


def test_awkward(spark):
    docs = awkward(spark)
    out = mixing.mixed(docs)
    assert others_kept(docs, out, *ADDED)
    assert {r.size for r in out.filter("text is null or trim(text) = ''").collect()} <= {0, 1}
    assert out.filter("size = 0 and taken > 0").count() == 0
    assert mixing.mixed(nothing(spark)).collect() == []


def test_no_row_is_multiplied_where_columns_are_null(spark):
    """Rows that differ only in which column is null are different units."""
    values = (None, "a", "b")
    rows = [(i, t, s) for i in values for t in values for s in values] * 2 + [("a", "a b c", None), ("a", None, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string")
    for seed in range(20):
        found = mixing.mixed(docs, seed=seed).collect()
        assert sorted(((r.doc_id, r.text, r.source) for r in found), key=str) == sorted(rows, key=str)
