from __future__ import annotations

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from plumbline.functions import metrics as m
from plumbline.operators.changes import captured, first_per_key_after
from plumbline.operators.dedup import first_per_key
from plumbline.plans import shop_monitors
from plumbline.plans.monitor import Monitor
from plumbline.plans.validate import validated_orders
from plumbline.sources import schemas, shop
from plumbline.streaming.measured_table import MeasuredTable
from plumbline.streaming.validated_stream import ValidatedTable
from tests.conftest import SMALL

AS_OF = datetime(2026, 1, 1)
SCHEMA = "k string, at int, a string, b string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_rows(rng, n):
    pick = lambda *x: rng.choice(x)
    return [(pick("p", "q", "r", "s", "t", None), pick(1, 2, 3, None), pick("x", None), pick("x", None)) for _ in range(n)]


def test_captured_counts_copies_and_tells_nulls_apart(spark):
    before = spark.createDataFrame([("k", 1, "a", None)] * 3 + [("k", 1, None, "a"), (None, None, None, None)], SCHEMA)
    after = spark.createDataFrame([("k", 1, "a", None)] + [("k", 1, None, "a")] * 2 + [(None, None, None, None), ("new", 2, "", "")], SCHEMA)
    assert rows_of(captured(before, after)) == sorted(
        [("k", 1, "a", None, -2), ("k", 1, None, "a", 1), ("new", 2, "", "", 1)], key=repr)
    assert captured(before, before).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_minimum_with_retraction(spark, seed):
    rng = random.Random(seed)
    first = random_rows(rng, 40)
    second = [r for r in first if rng.random() < 0.7] + random_rows(rng, rng.choice([0, 3, 10]))
    if seed == 0:
        second = []  # truncated
    before, after = spark.createDataFrame(first, SCHEMA), spark.createDataFrame(second, SCHEMA)
    net = captured(before, after)
    found = first_per_key_after(first_per_key(before, "k", "at"), net, after, "k", "at")
    assert rows_of(found) == rows_of(first_per_key(after, "k", "at"))


def test_unchanged_keys_are_not_read_again(spark):
    before = spark.createDataFrame([("lost", 1, "w", ""), ("lost", 2, "v", ""), ("kept", 1, "w", ""), ("came", 5, "w", "")], SCHEMA)
    net = spark.createDataFrame([("lost", 1, "w", "", -1), ("came", 4, "n", "", 1)], SCHEMA + ", change long")
    # The table given afterwards lies about all keys but the one that lost its winner.
    after = spark.createDataFrame([("lost", 2, "v", ""), ("kept", 0, "lie", ""), ("came", 0, "lie", "")], SCHEMA)
    found = first_per_key_after(first_per_key(before, "k", "at"), net, after, "k", "at")
    assert rows_of(found) == [("came", 4, "n", ""), ("kept", 1, "w", ""), ("lost", 2, "v", "")]


def order(k, day, total=1.0, customer="C"):
    return (k, customer, "P", 1, 1.0, total, date(2025, 1, day), "NEW", "1 A St", "WEST", None)


def table_of(spark, *orders):
    return spark.createDataFrame(list(orders), schemas.ORDERS)


def test_validated_table_follows_updates_and_streamed_rows(spark, folder):
    table = ValidatedTable(spark, folder)
    v1 = table_of(spark, order("a", 1), order("a", 2), order("b", 1), order("c", 3), order("c", 3), order(None, 5))
    table.initialize(v1)
    v2 = table_of(spark, order("a", 2), order("b", 1, total=-5.0), order("c", 3), order("d", 4), order(None, 6))
    table.change(captured(v1, v2), v2, 0)
    assert rows_of(table.read()) == rows_of(validated_orders(v2))
    # A streamed copy that is earlier, then its deletion.
    new = order("a", 1, customer=None)
    table.refresh(table_of(spark, new), 1)
    v3 = v2.union(table_of(spark, new))
    assert rows_of(table.read()) == rows_of(validated_orders(v3))
    table.change(captured(v3, v2), v2, 2)
    assert rows_of(table.read()) == rows_of(validated_orders(v2))
    # The same batch once more, then a compaction, then everything goes.
    table.change(captured(v3, v2), v2, 2)
    table.compact(2)
    assert rows_of(table.read()) == rows_of(validated_orders(v2))
    table.change(captured(v2, v2.limit(0)), v2.limit(0), 3)
    assert table.read().count() == 0
    assert [r.state for r in table.refresh_history(10).collect()] == ["SUCCEEDED"] * 6


def test_refresh_mode_turns_with_the_number_of_changes(spark, folder):
    first = table_of(spark, *[order(f"k{i}", 1 + i % 20) for i in range(20)])
    results = []
    for moved, expected in ((10, "INCREMENTAL"), (11, "FULL")):
        changed = table_of(spark, *[order(f"k{i}", 1 + i % 20) for i in range(moved, 20)])
        for mode in ("AUTO", "FULL", "INCREMENTAL"):
            table = ValidatedTable(spark, f"{folder}/{moved}-{mode}")
            table.initialize(first)
            table.change(captured(first, changed), changed, 0, mode)
            assert table.refresh_modes().first()["refresh_mode"] == (expected if mode == "AUTO" else mode)
            results.append((moved, rows_of(table.read())))
            table.change(captured(changed, first), first, 1, "INCREMENTAL")
            assert rows_of(table.read()) == rows_of(validated_orders(first))
        assert all(r == rows_of(validated_orders(changed)) for m_, r in results if m_ == moved)


def test_shop_versions(spark, folder):
    before = shop.raw(spark, SMALL, "orders")
    after = shop.updated_orders(before)
    table = ValidatedTable(spark, folder)
    table.initialize(before)
    table.change(captured(before, after), after, 0)
    assert rows_of(table.read()) == rows_of(validated_orders(after))
    assert rows_of(first_per_key_after(first_per_key(before, "order_id", "order_date"), captured(before, after), after,
                                       "order_id", "order_date")) == rows_of(first_per_key(after, "order_id", "order_date"))


def compared(spark, monitor, folder, versions, keep):
    table = MeasuredTable(spark, monitor, folder, keep)
    got = [rows_of(table.initialize(versions[0], AS_OF))]
    for i, (v, w) in enumerate(zip(versions, versions[1:]), 1):
        got.append(rows_of(table.change(captured(v, w), w, AS_OF, i)))
        if i == 3:
            table.compact(i)
    for found, version in zip(got, versions):
        assert found == rows_of(monitor.measure(version, AS_OF))
    return table


def test_metrics_with_retraction(spark, folder):
    monitor = (Monitor("a.b.c").attach(m.NULL_COUNT, ["customer_id"]).attach(m.DUPLICATE_COUNT, ["order_id"])
               .attach(m.DUPLICATE_COUNT, ["order_id", "customer_id"]).attach(m.FRESHNESS, ["order_date"])
               .attach(m.FILL_RATE, ["customer_notes"]))
    rng = random.Random(3)
    pool = [order(rng.choice(["a", "b", "c", None]), rng.randrange(1, 29), customer=rng.choice(["C", "D", None])) for _ in range(60)]
    versions = [table_of(spark, *rng.sample(pool, n), *rng.choices(pool, k=n // 4)) for n in (30, 25, 50)]
    versions += [versions[-1].filter("order_date < date'2025-01-06'"), versions[0].limit(0), versions[1]]
    table = compared(spark, monitor, folder, versions, keep=3)
    assert table.full_reads >= 1
    assert compared(spark, monitor, folder + "/wide", versions[:3], keep=64).full_reads == 0


def test_all_order_metrics_after_shop_updates(spark, folder):
    before = shop.raw(spark, SMALL, "orders")
    compared(spark, shop_monitors.orders_monitor(), folder, [before, shop.updated_orders(before), before.filter("region = 'WEST'")], 64)


def test_a_maximum_without_values_is_refused(spark, folder):
    blind = m.Metric("NEWEST", ("any",), lambda c: [m.Part("max", F.max(c))])
    with pytest.raises(ValueError):
        MeasuredTable(spark, Monitor("a.b.c").attach(blind, ["order_date"]), folder)
