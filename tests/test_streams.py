"""Streams end where the batch plans end, whatever the batches were."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.functions import metrics as m
from plumbline.operators.cooldown import alerts_with_cooldown
from plumbline.plans.shop_monitors import orders_monitor
from plumbline.plans.validate import validated_orders
from plumbline.sources import schemas
from plumbline.sources.shop import AS_OF, given, raw
from plumbline.streaming.monitor_stream import AlertStream, MonitorStream
from plumbline.streaming.validated_stream import ValidatedTable
from tests.conftest import SMALL


def same(one, other):
    return one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def batches(df, column, n, folder):
    """``n`` files in the order of ``column``, read one per micro-batch."""
    sliced = df.withColumn("slice", F.ntile(n).over(Window.orderBy(column)))
    for i in range(1, n + 1):
        sliced.filter(F.col("slice") == i).drop("slice").coalesce(1).write.mode("append").parquet(folder)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def drain(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


@pytest.fixture(scope="module")
def orders(spark):
    """With missing dates, and with the order of arrival against the dates."""
    return raw(spark, SMALL, "orders").withColumn(
        "order_date", F.when(F.col("quantity") != 7, F.col("order_date")))


def test_validated_table(spark, orders, folder):
    stream = batches(orders, F.col("order_date").desc(), 4, f"{folder}/in")
    table = ValidatedTable(spark, f"{folder}/table")
    drain(table.follow(stream))
    expected = validated_orders(orders)
    assert same(table.read(), expected)
    history = table.refresh_history().collect()
    assert len(history) == 4 and {r.state for r in history} == {"SUCCEEDED"}
    assert [r.refresh_start_time for r in history] == sorted((r.refresh_start_time for r in history), reverse=True)

    # A batch that runs again changes nothing; compaction changes nothing.
    table.refresh(spark.read.parquet(f"{folder}/in").limit(0), 4)
    table.compact(through_batch=2)
    assert table.base.current()[1] == 2 and same(table.read(), expected)
    table.compact(through_batch=4)
    assert same(table.read(), expected) and same(table.base.read(), expected)


def test_earlier_copy_that_arrives_late_wins(spark, folder):
    table = ValidatedTable(spark, folder)
    first = raw(spark, SMALL, "orders").limit(1)
    table.initialize(first.withColumn("status", F.lit("LATER")))
    table.refresh(first.withColumn("order_date", F.date_sub("order_date", 30)).withColumn("status", F.lit("EARLIER")), 0)
    assert [r.status for r in table.read().collect()] == ["EARLIER"]


def test_failed_refresh_is_noted(spark, folder):
    table = ValidatedTable(spark, folder)
    orders = raw(spark, SMALL, "orders")
    table.initialize(orders.limit(3))
    with pytest.raises(Exception) as failure:
        table.refresh(spark.range(1), 0)
    table.refresh(orders, 0)
    history = table.refresh_history().collect()
    assert [(r.state, r.attempt) for r in history] == [("SUCCEEDED", 2), ("FAILED", 1), ("SUCCEEDED", 1)]
    assert history[1].state_message == str(failure.value) and len(history[1].state_message) > 100


def test_compaction_by_rule(spark, orders, folder):
    table = ValidatedTable(spark, f"{folder}/table", compact_every=2)
    drain(table.follow(batches(orders, "order_id", 7, f"{folder}/in")))
    assert same(table.read(), validated_orders(orders))
    assert table.base.current() == (3, 5)
    # The newest compaction's changes stay for readers of the base before; older ones are gone, as are older bases.
    assert [r.batch_id for r in table.changes.read().select("batch_id").distinct().orderBy("batch_id").collect()] == [4, 5, 6]
    assert sorted(p for p in os.listdir(f"{folder}/table/base/data") if p.startswith("version")) == ["version=2", "version=3"]


def test_monitor(spark, orders, folder):
    stream = batches(orders, "order_id", 4, f"{folder}/in")
    monitor = orders_monitor().attach(m.DUPLICATE_COUNT, ["customer_id", "product_id"]).attach(m.FILL_RATE, ["customer_notes"])
    clock = [AS_OF + timedelta(minutes=25 * i) for i in range(4)]
    recorder = MonitorStream(spark, monitor, f"{folder}/log", lambda batch: clock[batch])
    drain(recorder.follow(stream))
    # After every batch, the log holds what measuring the table so far gives.
    sliced = orders.withColumn("slice", F.ntile(4).over(Window.orderBy("order_id")))
    whole = monitor.measure(orders, clock[3])
    assert same(recorder.results.batch(3), whole)
    assert recorder.results.read().count() == 4 * 7
    assert recorder.statuses.read().count() == 4 * 4
    # Violations every 25 minutes with one hour between alerts: batches 0 and 3.
    alerts = recorder.alerts.read().filter("expectation_name = 'no_duplicates'").collect()
    assert sorted(r.measurement_time for r in alerts) == [clock[0], clock[3]]
    assert '"expectation":"no_duplicates"' in alerts[0].payload
    assert sliced.count() == orders.count()


def test_attach_and_detach_between_runs(spark, orders, folder):
    """Values follow their metric, whatever else is attached."""
    sliced = orders.withColumn("slice", F.ntile(4).over(Window.orderBy("order_id"))).cache()

    def feed(i):
        sliced.filter(F.col("slice") == i).drop("slice").coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def so_far():
        return spark.read.schema(orders.schema).parquet(f"{folder}/in")

    def run(monitor):
        recorder = MonitorStream(spark, monitor, f"{folder}/log", lambda batch: AS_OF, table=so_far)
        drain(recorder.follow(spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")))
        newest = recorder.results.read().agg(F.max("batch_id")).first()[0]
        assert same(recorder.results.batch(newest), monitor.measure(so_far(), AS_OF))
        return newest

    feed(1)
    run(orders_monitor())
    feed(2)
    detached = orders_monitor().detach(m.NULL_COUNT, ["customer_id"])
    run(detached)
    feed(3)
    grown = (orders_monitor().attach(m.FILL_RATE, ["customer_notes"]).attach(m.not_matching("x"), ["region"])
             .attach(m.not_matching("S"), ["region"]).attach(m.DUPLICATE_COUNT, ["customer_id", "product_id"]))
    run(grown)
    feed(4)
    assert run(grown.detach(m.DUPLICATE_COUNT, ["order_id"])) == 3
    kept = sorted(p for p in os.listdir(f"{folder}/log/parts") if p.startswith("batch"))
    assert kept == ["batch_id=2", "batch_id=3"] == sorted(p for p in os.listdir(f"{folder}/log/last_sent") if p.startswith("batch"))


def test_a_new_metric_needs_the_table(spark, orders, folder):
    orders.limit(5).write.parquet(f"{folder}/in")
    stream = lambda: spark.readStream.schema(orders.schema).parquet(f"{folder}/in")
    drain(MonitorStream(spark, orders_monitor(), f"{folder}/log", lambda batch: AS_OF).follow(stream()))
    orders.limit(3).write.mode("append").parquet(f"{folder}/in")
    late = MonitorStream(spark, orders_monitor().attach(m.FILL_RATE, ["region"]), f"{folder}/log", lambda batch: AS_OF)
    with pytest.raises(Exception, match="needs the table"):
        drain(late.follow(stream()))


def test_alerts(spark, folder):
    violations = given(spark, SMALL, "events").filter("value > 5").select("event_type", "ts")
    stream = batches(violations, "ts", 4, f"{folder}/in")
    recorder = AlertStream(spark, f"{folder}/log", {"event_type": violations.schema["event_type"].dataType}, "ts")
    drain(recorder.follow(stream))
    assert same(recorder.alerts.read().drop("batch_id"),
                alerts_with_cooldown(violations, ["event_type"], "ts", timedelta(hours=1)))


def test_logs_have_their_schema(spark, folder):
    recorder = MonitorStream(spark, orders_monitor(), folder, lambda batch: datetime(2001, 1, 1))
    assert recorder.results.read().columns == [*schemas.RESULTS.fieldNames(), "batch_id"]
    assert recorder.alerts.read().count() == 0
