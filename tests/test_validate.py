"""Row by row: deduplication, rules, scores."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from plumbline.operators.dedup import first_per_key, first_per_key_by_rank, merge_first
from plumbline.plans import validate
from plumbline.sources import schemas
from plumbline.sources.shop import raw
from tests.conftest import SMALL


def order(order_id="A", customer_id="C", quantity=2, unit_price=10.0, order_total=20.0,
          order_date=date(2001, 1, 1), status="PENDING", address="1 Oak St, Austin TX 78701"):
    return (order_id, customer_id, "P", quantity, unit_price, order_total, order_date, status, address, "WEST", None)


def orders(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.ORDERS)


@pytest.mark.parametrize("change, score, status", [
    ({}, 100, "CLEAN"),
    ({"order_total": None}, 100, "CLEAN"),                      # unknown breaks no rule
    ({"order_total": 21.0}, 100, "CLEAN"),                      # off by exactly 1.00
    ({"order_total": 21.01}, 90, "CLEAN"),                      # a mismatch alone is still clean
    ({"address": None}, 85, "REVIEW_NEEDED"),
    ({"address": None, "order_total": 30.0}, 75, "REVIEW_NEEDED"),
    ({"order_total": 0.0}, 70, "REVIEW_NEEDED"),                # zero also mismatches
    ({"order_total": 0.0, "address": None}, 55, "REVIEW_NEEDED"),
    ({"order_total": 0.0, "quantity": 0}, 80, "REVIEW_NEEDED"),
    ({"customer_id": None}, 0, "REJECTED"),
    ({"order_total": -1.0}, 0, "REJECTED"),
    ({"customer_id": None, "order_total": -1.0, "address": None}, 0, "REJECTED"),
])
def test_scores(spark, change, score, status):
    row = validate.validated_orders(orders(spark, order(**change))).first()
    assert (row.quality_score, row.quality_status) == (score, status)


def test_keeps_every_column(spark):
    columns = validate.validated_orders(orders(spark, order())).columns
    assert columns == [*schemas.ORDERS.fieldNames(), "quality_score", "quality_status"]


def test_empty_table(spark):
    assert validate.validated_orders(orders(spark)).count() == 0


@pytest.mark.parametrize("dedup", [first_per_key, first_per_key_by_rank])
def test_earliest_copy_wins(spark, dedup):
    df = orders(spark,
                order("A", order_date=date(2001, 1, 2), status="LATE"), order("A", status="FIRST"),
                order("B", order_date=None, status="UNDATED"), order("B", status="DATED"),
                order("C", customer_id="2"), order("C", customer_id="1"),        # same day: smallest columns
                order("D", order_date=None, quantity=9), order("D", order_date=None, quantity=3),
                order(None, status="X"), order(None, status="Y"))
    got = {r.order_id: r for r in dedup(df, "order_id", "order_date").collect()}
    assert len(got) == 5
    assert got["A"].status == "FIRST" and got["B"].status == "DATED"
    assert got["C"].customer_id == "1" and got["D"].quantity == 3 and got[None].status == "X"


def test_both_dedup_forms_agree(spark):
    df = raw(spark, SMALL, "orders").withColumn("order_date", F.expr("if(quantity = 7, null, order_date)"))
    one, other = first_per_key(df, "order_id", "order_date"), first_per_key_by_rank(df, "order_id", "order_date")
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_merging_changes_equals_doing_it_all_again(spark):
    base = orders(spark, order("A"), order("B", order_date=None), order(None, status="OLD"), order("D"))
    changes = orders(spark, order("A", order_date=date(2000, 1, 1)), order("A", order_date=date(2002, 1, 1)),
                     order("B", status="DATED"), order(None, order_date=date(2000, 1, 1), status="NEW"), order("E"))
    merged = merge_first(base, changes, "order_id", "order_date")
    whole = first_per_key(base.unionByName(changes), "order_id", "order_date")
    assert merged.count() == 5
    assert merged.exceptAll(whole).isEmpty() and whole.exceptAll(merged).isEmpty()


def test_custom_rules(spark):
    bulk = validate.Rule("bulk", "quantity > 1", 40)
    row = validate.score(orders(spark, order()), hard=[validate.Rule("no_region", "region is null")],
                         soft=[bulk], clean_at=50).first()
    assert (row.quality_score, row.quality_status) == (60, "CLEAN")


def test_one_shuffle(spark, folder):
    raw(spark, SMALL, "orders").write.parquet(f"{folder}/orders")
    plan = validate.validated_orders(schemas.read_table(spark, f"{folder}/orders", schemas.ORDERS))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and text.count("FileScan") == 1
    assert "partial_min" in text            # copies are reduced ahead of the shuffle


def test_flags_stay_unknown(spark):
    row = validate.flag_hard_failures(orders(spark, order(order_total=None))).first()
    assert row.is_negative_total is None and row.is_null_customer is False
