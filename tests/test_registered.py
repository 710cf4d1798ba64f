"""Every registered query beside its SQL, and the numbers known beforehand."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from plumbline import catalog
from tests.compare import connect, differences
from tests.conftest import MIDDLE, SMALL

SQL = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) <= set(SQL) and set(SQL) <= set(entry_point.queries())


def test_entry(spark):
    shares = {r.quality_status: (r.order_count, r.pct) for r in entry_point.entry(spark).collect()}
    assert shares == {"CLEAN": (1242, 82.8), "REJECTED": (160, 10.7), "REVIEW_NEEDED": (98, 6.5)}


@pytest.mark.parametrize("key", list(catalog.QUERIES))
def test_equals_sql(spark, con, key):
    assert differences(catalog.QUERIES[key](spark, SMALL), con, SQL[key]) == []


def rows(spark, key, *columns):
    return {tuple(r) for r in catalog.QUERIES[key](spark, MIDDLE).select(*columns).collect()}


def test_known_numbers(spark):
    assert rows(spark, "row_counts", "table_name", "row_count") == {
        ("raw.orders", 15469), ("raw.customers", 1525), ("raw.products", 2000),
        ("raw.inventory", 2000), ("raw.shipments", 15000)}
    assert rows(spark, "dq_orders_all", "metric_name", "value") == {
        ("NULL_COUNT", 1395), ("DUPLICATE_COUNT", 469), ("NEGATIVE_TOTAL_COUNT", 329),
        ("SUSPICIOUS_ADDRESS_COUNT", 279), ("FRESHNESS", 86400)}
    assert rows(spark, "dq_duplicate_variants", "*") == {(469, 463, 932)}
    # The limit itself is not below the limit: exactly one day is not fresh.
    assert rows(spark, "dq_expectations", "expectation_name", "value", "violated") == {
        ("low_nulls", 1395, True), ("no_duplicates", 469, True),
        ("few_negatives", 329, True), ("fresh_data", 86400, True)}
    assert rows(spark, "score_histogram", "*") == {
        (0, 1643), (55, 21), (70, 413), (75, 33), (85, 460), (90, 773), (100, 11657)}
    assert rows(spark, "semantic_tier", "tier", "total_orders", "clean_order_count", "rejected_count") == {
        ("BRONZE", 4304, 3901, 101), ("GOLD", 4020, 3647, 83), ("PLATINUM", 2677, 2470, 52),
        ("SILVER", 2645, 2412, 53), (None, 1354, 0, 1354)}
    for key, value in {"customers_duplicates": 25, "customers_bad_email": 80, "products_bad_category": 91,
                       "products_price_outlier": 55, "inventory_negative": 123, "shipments_no_tracking": 757,
                       "shipments_future": 686}.items():
        assert rows(spark, key, key) == {(value,)}
    assert rows(spark, "inventory_orphans", "orphan_rows") == {(65,)}
    assert rows(spark, "redact_counts", "*") == {
        ("ADDRESS", 0, 0), ("EMAIL", 11, 12), ("IP", 25, 32), ("CARD", 24, 30), ("PHONE", 18, 19)}
    sent = catalog.QUERIES["alerts_cooldown"](spark, MIDDLE).groupBy("event_type").count().collect()
    assert {tuple(r) for r in sent} == {("click", 471), ("error", 467), ("purchase", 466),
                                        ("signup", 487), ("view", 463)}
    flagged = catalog.QUERIES["root_cause_flags"](spark, MIDDLE).filter("flagged and metric_name = 'rejection_rate'")
    assert [r.region for r in flagged.collect()] == ["WEST"]


def test_late_copies_lose(spark):
    survivors = catalog.QUERIES["validated_orders"](spark, MIDDLE)
    assert survivors.filter("status = 'LATE_COPY'").count() == 0
    assert survivors.filter("order_total is null and quality_status = 'CLEAN'").count() == 69


def test_last_month_of_history_is_the_whole_table(spark):
    history = catalog.QUERIES["metric_history"](spark, MIDDLE)
    assert history.select("measurement_time").distinct().count() == 80
    newest = history.groupBy("metric_name").agg({"measurement_time": "max"}).count()
    assert newest == 5
    last = history.orderBy("measurement_time", ascending=False).limit(5).collect()
    assert {r.metric_name: r.value for r in last if r.metric_name != "FRESHNESS"} == {
        "NULL_COUNT": 1395, "NEGATIVE_TOTAL_COUNT": 329, "DUPLICATE_COUNT": 469, "SUSPICIOUS_ADDRESS_COUNT": 279}
