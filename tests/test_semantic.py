"""The semantic model and root causes."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from plumbline.plans import root_cause
from plumbline.plans.semantic import ALL_METRICS, ORDER_QUALITY
from plumbline.plans.validate import validated_orders
from plumbline.sources.shop import raw
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def model(spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("model"))
    validated_orders(raw(spark, SMALL, "orders")).write.parquet(f"{where}/orders")
    raw(spark, SMALL, "customers").write.parquet(f"{where}/customers")
    return ORDER_QUALITY.bind(orders=spark.read.parquet(f"{where}/orders"),
                              customers=spark.read.parquet(f"{where}/customers"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_inventory():
    assert len(ORDER_QUALITY.facts) == 2 and len(ORDER_QUALITY.dimensions) == 4
    assert len(ALL_METRICS) == 8 + 2


def test_join_only_when_needed(model):
    assert "Join" not in plan(model.query(["total_orders"], ["region", "status"]))
    assert "Join" in plan(model.query(["total_orders"], ["tier"]))
    assert "customers" not in plan(model.query(["total_orders"], ["region"]))


def test_scan_reads_needed_columns(model):
    text = plan(model.query(["total_orders"], ["region"]))
    assert "order_total" not in text and "shipping_address" not in text


@contextmanager
def settings(spark, conf):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
SMALL_SKEW = {**NO_BROADCAST, "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}


def hot(spark, model, folder, key):
    """Orders of which most refer to one customer, or to none."""
    orders = model.tables["orders"].withColumn("customer_id", F.when(F.col("quantity") > 3, F.lit(key)).otherwise(F.col("customer_id")))
    orders.unionByName(orders).unionByName(orders).repartition(6).write.parquet(f"{folder}/hot")
    return model.bind(orders=spark.read.parquet(f"{folder}/hot"), customers=model.tables["customers"])


def test_a_hot_customer_is_split(spark, model, folder):
    some = model.tables["customers"].filter("tier = 'GOLD'").first()["customer_id"]
    with settings(spark, SMALL_SKEW):
        facts = hot(spark, model, folder, some).query_rows(["quality_score"], ["tier"], ["order_id"])
        rows = facts.collect()
        assert "SortMergeJoin(skew=true)" in plan(facts)
    assert len(rows) == 4500


def test_rows_without_a_customer_are_spread(spark, model, folder):
    asked = hot(spark, model, folder, None)
    with settings(spark, {**NO_BROADCAST, "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        facts = asked.query_rows(["quality_score"], ["tier"], ["order_id", "customer_id"])
        per_task = facts.withColumn("task", F.spark_partition_id()).filter("customer_id is null").groupBy("task").count()
        counts = [r["count"] for r in per_task.collect()]
    assert len(counts) == 8 and max(counts) < 0.3 * sum(counts)
    totals = {r.tier: r.total_orders for r in asked.query(["total_orders"], ["tier"]).collect()}
    assert sum(totals.values()) == asked.tables["orders"].count()


@pytest.mark.parametrize("ask", [{"dims": ["tier"]}, {"dims": ["region", "tier"], "grouping_sets": [["region", "tier"], ["region"], []]},
                                 {"dims": ["region"], "where": {"tier": "tier = 'GOLD'"}}])
def test_one_exchange_of_the_rows(spark, model, ask):
    """One for the join; the aggregates after it exchange partial sums."""
    with settings(spark, NO_BROADCAST):
        text = plan(model.query(["total_orders", "rejection_rate"], **ask))
    fact_side = text.split("Join", 1)[1].split("lookup-customers")[0]
    assert fact_side.count("Exchange hashpartitioning") == 2 and "partial_" not in fact_side  # one of each side of the join


def test_copies_of_a_customer_do_not_multiply_orders(spark, model):
    orders, customers = model.tables["orders"], model.tables["customers"]
    fanned_out = orders.join(customers.select("customer_id", "tier"), "customer_id", "left").count()
    assert (fanned_out, orders.count()) == (1520, 1500)
    totals = model.query(["total_orders"], ["tier"]).agg(F.sum("total_orders")).first()[0]
    assert totals == 1500
    assert model.query_rows(["quality_score"], ["tier"], ["order_id"]).count() == 1500


def test_rates_are_null_without_rows(model):
    row = model.bind(orders=model.tables["orders"].limit(0), customers=model.tables["customers"]).query(ALL_METRICS).first()
    assert row.total_orders == 0 and row.clean_order_rate is None and row.avg_quality_score is None


def test_where_on_unselected_dimensions(model):
    asked = model.query(["total_orders"], ["region"], where={"tier": "tier = 'GOLD'", "status": "status = 'SHIPPED'"})
    rows = model.query_rows(["order_total"], ["region", "tier", "status"], ["order_id"])
    expected = rows.filter("tier = 'GOLD' and status = 'SHIPPED'").groupBy("region").count()
    assert {tuple(r) for r in asked.collect()} == {tuple(r) for r in expected.collect()}


def test_unknown_names(model):
    with pytest.raises(KeyError):
        model.query(["total_orders"], ["colour"])
    with pytest.raises(KeyError):
        model.query(["colour"])


def test_grouping_sets_tell_missing_tier_from_total(model):
    rows = model.query(["total_orders"], ["tier"], grouping_sets=[["tier"], []]).collect()
    assert {r.grouping_tier: r.total_orders for r in rows if r.tier is None} == {0: 133, 1: 1500}


def test_no_cross_join_for_the_overall_rate(model):
    flags = root_cause.flags(model, "region", {"rejection_rate": ("n_rejected", "n_orders", True)}, {"null_customer": "n_null_customer"})
    assert "Cartesian" not in plan(flags) and "NestedLoop" not in plan(flags)


def test_quote_in_a_group(spark, model):
    odd = model.bind(orders=model.tables["orders"].withColumn("region", F.when(F.col("region") == "WEST", "O'West").otherwise(F.col("region"))),
                     customers=model.tables["customers"])
    row = root_cause.one_against_rest(odd, "region", "O'West", ["total_orders"]).first()
    assert row.group_value + row.rest_value == 1500 and row.group_value > 0


def test_causes(spark):
    rows = [("W", "REJECTED", None, 1.0)] * 3 + [("W", "CLEAN", "c", 1.0)] + [("E", "REJECTED", "c", -1.0)] \
        + [("E", "CLEAN", "c", 1.0)] * 3 + [("N", "CLEAN", "c", 1.0)]
    df = spark.createDataFrame(rows, "region string, quality_status string, customer_id string, order_total double")
    got = {r.region: (r.rank, r.rejection_rate, r.main_cause) for r in root_cause.rejection_causes(df, "region").collect()}
    assert got == {"W": (1, 75.0, "null_customer"), "E": (2, 25.0, "negative_total"), "N": (3, 0.0, None)}
