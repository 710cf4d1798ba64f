"""The cooldown against a plain loop."""

from __future__ import annotations

from collections import defaultdict
from datetime import datetime, timedelta
from random import Random

import pytest

from plumbline.operators import crowded
from plumbline.operators.cooldown import alerts_with_cooldown

START = datetime(1969, 12, 1)       # moments before 1970 are negative numbers
SCHEMA = "a string, b int, ts timestamp_ntz"


def brute_force(rows, cooldown, last=None):
    sent, newest = set(), dict(last or {})
    for a, b, ts in sorted((r for r in rows if r[2]), key=lambda r: r[2]):
        if (a, b) not in newest or ts >= newest[a, b] + cooldown:
            newest[a, b] = ts
            sent.add((a, b, ts))
    return sent


def run(spark, rows, cooldown, last=None, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    earlier = spark.createDataFrame([(*k, t) for k, t in last.items()], SCHEMA) if last is not None else None
    got = [tuple(r) for r in alerts_with_cooldown(df, ["a", "b"], "ts", cooldown, earlier, **options).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("fan_in", [2, 5])
def test_random(spark, seed, fan_in):
    random = Random(seed)
    keys = [("x", 1), ("x", 2), (None, 1), ("y", None), (None, None)]
    density = random.choice([3, 60, 900])
    rows = []
    for a, b in keys[:-1] + keys[:1] * 3:                   # one key holds a third of all rows or more
        rows += [(a, b, START + timedelta(seconds=random.randrange(60 * 86400) // density * density))
                 for _ in range(400)]
    rows += [("x", 1, None), (None, None, START)]
    cooldown = timedelta(seconds=random.choice([1800, 3600, 50000]))
    assert run(spark, rows, cooldown, fan_in=fan_in) == brute_force(rows, cooldown)


def test_dense_key_in_small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        rows = [("hot", 0, START + timedelta(microseconds=i * 7_300_001)) for i in range(4000)]
        rows += [("cold", i, START + timedelta(hours=i)) for i in range(40)]
        cooldown = timedelta(minutes=10)
        assert run(spark, rows, cooldown, fan_in=3) == brute_force(rows, cooldown)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_counts_from_the_last_alert_sent(spark):
    """Not from the last violation: 0, 40 and 70 minutes send 0 and 70."""
    rows = [("x", 1, START + timedelta(minutes=t)) for t in (0, 40, 60 - 1e-6 / 60, 70, 130)]
    sent = run(spark, rows, timedelta(hours=1))
    assert {(t - START) // timedelta(minutes=1) for *_, t in sent} == {0, 70, 130}


@pytest.mark.parametrize("seed", range(3))
def test_continues_from_earlier_alerts(spark, seed):
    random = Random(seed)
    rows = [(a, 1, START + timedelta(seconds=random.randrange(20 * 86400))) for a in "xyz" for _ in range(500)]
    cut, cooldown = START + timedelta(days=9), timedelta(hours=5)
    first = run(spark, [r for r in rows if r[2] < cut], cooldown)
    newest = defaultdict(lambda: START)
    for a, b, ts in first:
        newest[a, b] = max(newest[a, b], ts)
    second = run(spark, [r for r in rows if r[2] >= cut], cooldown, last=dict(newest))
    assert first | second == brute_force(rows, cooldown)


def test_nothing_to_send(spark):
    assert run(spark, [], timedelta(hours=1)) == set()


@pytest.mark.parametrize("seed, crowd", [(0, 0), (1, 30), (2, 0)])
def test_crowded_keys(spark, seed, crowd):
    """All keys by pointers, or only those with many moments in a segment."""
    random = Random(seed)
    rows = [("x", i % 2, START + timedelta(seconds=random.randrange(40_000))) for i in range(600)]
    rows += [(None, i % 7, START + timedelta(seconds=random.randrange(4_000_000))) for i in range(300)] + [("x", 1, None)]
    cooldown = timedelta(seconds=random.choice([1, 700, 9000, 10**7]))
    assert run(spark, rows, cooldown, crowd=crowd) == brute_force(rows, cooldown)
    last = {("x", 0): START + timedelta(seconds=100), (None, 3): START + timedelta(days=400)}
    assert run(spark, rows, cooldown, last=last, crowd=crowd) == brute_force(rows, cooldown, last)


def test_five_million_moments_of_one_key_within_an_hour(spark, monkeypatch):
    passes = []
    stored = crowded.written

    def seen(df, purpose):
        out = stored(df, purpose)
        if purpose == "crowded-pass":
            passes.append(out)
        return out

    monkeypatch.setattr(crowded, "written", seen)
    n, step = 5_000_000, 720
    df = spark.range(n).selectExpr("'hot' as a", "1 as b", f"timestampadd(MICROSECOND, id * {step}, timestamp_ntz'2025-01-01 00:00:00') as ts")
    pause = timedelta(minutes=7, microseconds=11)
    got = sorted(r.ts for r in alerts_with_cooldown(df, ["a", "b"], "ts", pause).collect())
    expected, at = [], 0
    while at < n:
        expected.append(datetime(2025, 1, 1) + timedelta(microseconds=at * step))
        at += -(-int(pause / timedelta(microseconds=1)) // step)
    assert got == expected
    tasks = [r["count"] for r in passes[0].groupBy("block").count().collect()]
    assert len(tasks) >= 4 and max(tasks) <= 0.5 * n
