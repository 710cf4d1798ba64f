"""Stored cells of the semantic model."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import date

import pytest

from plumbline.operators.changes import captured
from plumbline.plans.semantic import ALL_METRICS, ORDER_QUALITY
from plumbline.plans.validate import validated_orders
from plumbline.sources import schemas, shop
from plumbline.streaming.semantic_cells import SemanticCells
from plumbline.streaming.validated_stream import ValidatedTable
from tests.conftest import SMALL

CUSTOMERS = "customer_id string, tier string, signup_date date"
#: The eight requests of the registered queries over sums.
REQUESTS = [
    *[(ALL_METRICS, dims, None, None) for dims in ([], ["region"], ["status"], ["quality_status"], ["tier"])],
    (["total_orders", "rejected_count", "rejection_rate"], ["region", "tier"], None, [["region", "tier"], ["region"], ["tier"], []]),
    (["total_orders", "clean_order_rate", "avg_quality_score"], ["region"],
     {"tier": "tier in ('GOLD', 'PLATINUM')", "status": "status <> 'PENDING'"}, None),
    (ALL_METRICS, ["region", "quality_status", "status", "tier"], None, None),
]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def agree(cells, model, requests=REQUESTS[-1:]):
    for request in requests:
        assert rows_of(cells.query(*request)) == rows_of(model.query(*request))


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def model(spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("tables"))
    validated_orders(shop.raw(spark, SMALL, "orders")).write.parquet(f"{where}/orders")
    shop.raw(spark, SMALL, "customers").write.parquet(f"{where}/customers")
    return ORDER_QUALITY.bind(**{t: spark.read.parquet(f"{where}/{t}") for t in ("orders", "customers")})


def test_requests_are_answered_without_the_orders(spark, folder, model):
    cells = SemanticCells(spark, model, folder)
    cells.initialize()
    agree(cells, model, REQUESTS)
    for request in REQUESTS:
        text = plan(cells.query(*request))
        assert "order_id" not in text and "customer_id" not in text and "Join" not in text
    some = SemanticCells(spark, model, folder + "/some", ["region", "status"])
    some.initialize()
    assert some.covers(["region"], {"status": ""}) and not some.covers(["tier"]) and not some.covers([], {"tier": ""})
    agree(some, model, [REQUESTS[1], REQUESTS[4]])


def order(rng):
    pick = rng.choice
    return (pick([*"abcdefgh", None]), pick(["C", "D", "E", None]), "P", pick([1, 2, None]), 1.0, pick([-1.0, 0.0, 1.0, 2.0, None]),
            date(2025, 1, rng.randrange(1, 29)), pick(["NEW", "PENDING", None]), pick(["1 A St", None]), pick(["WEST", "EAST", None]), None)


def customers_of(spark, rng, n):
    return spark.createDataFrame([(rng.choice(["C", "D", "E", "F", None]), rng.choice(["GOLD", "SILVER", None]),
                                   rng.choice([date(2020, 1, 1), date(2021, 1, 1), None])) for _ in range(n)], CUSTOMERS)


def test_cells_follow_every_kind_of_change(spark, folder):
    rng = random.Random(0)
    orders = spark.createDataFrame([order(rng) for _ in range(40)], schemas.ORDERS)
    customers = customers_of(spark, rng, 6)
    table = ValidatedTable(spark, f"{folder}/table")
    table.initialize(orders)
    cells = SemanticCells(spark, ORDER_QUALITY.bind(orders=table.read(), customers=customers), f"{folder}/cells")
    cells.initialize()
    # Updates and deletes, twice over as after a failure.
    kept = [tuple(r) for r in orders.collect() if rng.random() < 0.8]
    after = spark.createDataFrame([*kept, *[order(rng) for _ in range(6)]], schemas.ORDERS)
    for _ in range(2):
        table.change(captured(orders, after), after, 0, "INCREMENTAL")
        cells.follow(table, 0)
        agree(cells, cells.model)
    # Streamed rows.
    more = spark.createDataFrame([order(rng) for _ in range(8)], schemas.ORDERS)
    table.refresh(more, 1)
    cells.follow(table, 1)
    agree(cells, ORDER_QUALITY.bind(orders=validated_orders(after.union(more)), customers=customers))
    # Customers change, go, and come; also twice over.
    others = customers_of(spark, rng, 5)
    for _ in range(2):
        cells.change(2, orders=table.read(), customers=others)
        agree(cells, ORDER_QUALITY.bind(orders=table.read(), customers=others))
    cells.compact(2)
    agree(cells, ORDER_QUALITY.bind(orders=table.read(), customers=others))
    # The table is built anew, then everything goes.
    whole = after.union(more)
    table.change(captured(whole, orders), orders, 3, "FULL")
    cells.follow(table, 3)
    agree(cells, ORDER_QUALITY.bind(orders=validated_orders(orders), customers=others))
    table.change(captured(orders, orders.limit(0)), orders.limit(0), 4, "INCREMENTAL")
    cells.follow(table, 4)
    agree(cells, ORDER_QUALITY.bind(orders=validated_orders(orders.limit(0)), customers=others))
    assert cells.read().count() == 0


def test_only_moved_rows_are_read(spark, folder):
    rng = random.Random(5)
    orders = validated_orders(spark.createDataFrame([(f"k{i}", *order(rng)[1:]) for i in range(30)], schemas.ORDERS))
    first = spark.createDataFrame([("C", "GOLD", date(2020, 1, 1)), ("D", "SILVER", date(2020, 1, 1))], CUSTOMERS)
    second = spark.createDataFrame([("C", "GOLD", date(2020, 1, 1)), ("D", "BRONZE", date(2020, 1, 1))], CUSTOMERS)
    cells = SemanticCells(spark, ORDER_QUALITY.bind(orders=orders, customers=first), folder)
    cells.initialize()
    # The table given afterwards lies about the orders of all customers but the one who moved.
    cells.change(0, orders=orders.filter("customer_id = 'D'"), customers=second)
    agree(cells, ORDER_QUALITY.bind(orders=orders, customers=second))
    with pytest.raises(ValueError):
        cells.change(1, customers=first)


def test_streamed_in_several_batches(spark, folder):
    rng = random.Random(9)
    orders = spark.createDataFrame([order(rng) for _ in range(45)], schemas.ORDERS)
    for part in orders.randomSplit([1.0] * 5, 3):
        part.coalesce(1).write.mode("append").parquet(f"{folder}/orders")
    customers = customers_of(spark, rng, 6)
    table = ValidatedTable(spark, f"{folder}/table", compact_every=2)
    cells = SemanticCells(spark, ORDER_QUALITY.bind(orders=table.read(), customers=customers), f"{folder}/cells")
    cells.initialize()
    arriving = spark.readStream.schema(schemas.ORDERS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/orders")
    cells.stream(table, arriving).trigger(availableNow=True).start().awaitTermination()
    # Batches were folded on the way.
    assert cells.log.read().agg({"batch_id": "max"}).first()[0] >= 3
    agree(cells, ORDER_QUALITY.bind(orders=validated_orders(orders), customers=customers))


def test_inexact_measures_are_refused(spark, folder, model):
    with pytest.raises(ValueError):
        SemanticCells(spark, replace(model, measures={"n": "1L", "total": "cast(order_total as double)"}), folder)
