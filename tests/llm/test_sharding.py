from __future__ import annotations

import random
import zlib

import pytest
from pyspark.sql import functions as F

from plumbline.llm import registry, sharding
from tests.conftest import MIDDLE
from tests.llm.rows import awkward, nothing, others_kept


def plain_best_fit(sizes, capacity):
    rest, out = [], []
    for s in sizes:
        fits = [(r, i) for i, r in enumerate(rest) if r >= s]
        if fits:
            _, i = min(fits)
        else:
            rest.append(capacity)
            i = len(rest) - 1
        rest[i] -= s
        out.append(i)
    return out


def test_tree_packs_like_a_list():
    for seed in range(20):
        rng = random.Random(seed)
        sizes = sorted((rng.randrange(1, 100) for _ in range(rng.randrange(200))), reverse=True)
        assert sharding.best_fit_decreasing(sizes, 100) == plain_best_fit(sizes, 100)
    assert sharding.best_fit_decreasing([11], 10) is None and sharding.best_fit_decreasing([6, 6], 10, 1) is None


def test_even_shards():
    rng = random.Random(5)
    sizes = sorted((rng.randrange(1, 1000) for _ in range(3000)), reverse=True)
    load = [0] * 24
    for size, shard in zip(sizes, sharding.even_shards(sizes, 24)):
        load[shard] += size
    assert max(load) - min(load) <= 0.01 * max(load)
    large = sharding.even_shards([900, 50, 50, 10, 10], 3)
    assert large.count(large[0]) == 1 and set(large) == {0, 1, 2}
    assert sharding.even_shards([], 24) == [] and sharding.even_shards([8], 24) == [0]


def laws(rows):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    assert set(by) <= set(range(24))
    for group in by.values():
        assert sorted(r.slot for r in group) == list(range(len(group)))
    return {s: sum(r.size for r in group) for s, group in by.items()}


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    rows = registry.op3_sharding(spark, MIDDLE).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    home = {}
    for r in rows:
        raw = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        assert home.setdefault(docs[r.doc_id], r.shard) == r.shard
    load = laws(rows)
    assert len(load) == 24 and max(load.values()) - min(load.values()) < 0.01 * max(load.values())


@pytest.mark.parametrize("slot_rows", [1, 20_000])
def test_awkward(spark, slot_rows):
    docs = awkward(spark)
    out = sharding.sharded(docs, slot_rows=slot_rows)
    assert others_kept(docs, out, "size", "shard")
    laws(out.collect())
    assert out.groupBy(F.coalesce("text", F.lit("?"))).agg(F.countDistinct("shard").alias("n")).filter("n > 1").count() == 0
    assert {r.size for r in out.filter("text is null").collect()} == {8}
    assert sharding.sharded(nothing(spark)).collect() == []
