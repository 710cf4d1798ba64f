"""Metrics, monitors, expectations, history."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from plumbline.functions import metrics as m
from plumbline.plans.alerts import with_payload
from plumbline.plans.monitor import Monitor
from plumbline.plans.shop_monitors import orders_monitor
from plumbline.sources import schemas
from plumbline.sources.shop import AS_OF, raw
from tests.conftest import SMALL

ROWS = [("a", 1.0, date(2001, 1, 1)), ("a", -1.0, date(2001, 1, 3)), ("b", None, None),
        (None, -2.0, date(2001, 1, 2)), (None, 0.0, date(2001, 1, 2)), ("c", 5.0, date(2001, 1, 2)), ("a", 5.0, None)]
SCHEMA = "k string, x double, d date"
NOON = datetime(2001, 1, 4, 12)


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def value(metric, df, *columns, as_of=NOON):
    return metric.on(df, *columns, as_of=as_of).first()["value"]


def test_built_in_metrics(table):
    assert value(m.NULL_COUNT, table, "k") == 2
    assert value(m.DUPLICATE_COUNT, table, "k") == 2            # "a" three times: two too many
    assert value(m.DUPLICATE_COUNT, table, "k", "x") == 0       # rows with a NULL part are no keys
    assert value(m.NEGATIVE_TOTAL_COUNT, table, "x") == 2       # unknown is not counted
    assert value(m.FRESHNESS, table, "d") == 36 * 3600
    assert value(m.FILL_RATE, table, "k") == 5 * 100 / 7
    assert value(m.ROW_COUNT, table, "k") == 7
    assert value(m.outlier(0.0, 5.0), table, "x") == 5
    assert value(m.not_accepted(["a", "b"]), table, "k") == 1
    assert value(m.null_where("a"), table, "k", "d") == 1
    assert value(m.later_than(date(2001, 1, 2)), table, "d") == 1
    assert value(m.not_matching("^[ab]$"), table, "k") == 1


def test_empty_table(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert value(m.NULL_COUNT, nothing, "k") == 0 and value(m.DUPLICATE_COUNT, nothing, "k") == 0
    assert value(m.FRESHNESS, nothing, "d") is None and value(m.FILL_RATE, nothing, "k") is None
    monitor = (Monitor("db.s.t").attach(m.FRESHNESS, ["d"]).expect(m.FRESHNESS, ["d"], "fresh", "value < 1")
               .attach(m.NULL_COUNT, ["k"]).expect(m.NULL_COUNT, ["k"], "none", "value = 0"))
    verdicts = {r.expectation_name: (r.evaluated, r.violated) for r in monitor.evaluate(nothing, NOON).collect()}
    assert verdicts == {"fresh": (False, False), "none": (True, False)}


def test_on_a_query(table):
    assert value(m.NEGATIVE_TOTAL_COUNT, table.filter("k is null").select("x"), "x") == 1


def test_signatures(table):
    with pytest.raises(TypeError):
        m.NEGATIVE_TOTAL_COUNT.on(table, "k")
    with pytest.raises(ValueError):
        m.NULL_COUNT.on(table, "k", "x")
    registry = m.Registry(m.NULL_COUNT)
    wide = registry.create(m.counting("WIDE", ["double"], lambda x: x > 4))
    text = registry.create(m.counting("WIDE", ["string"], lambda x: F.length(x) > 4))
    assert registry.get("WIDE", "double") is wide and registry.get("WIDE", "string") is text
    registry.remove("WIDE", "double")
    with pytest.raises(KeyError):
        registry.get("WIDE", "double")
    assert {x.name for x in registry} == {"NULL_COUNT", "WIDE"}


def test_model_backed_metric(spark, table):
    from plumbline.functions.text import batch_model

    model = batch_model(lambda texts: texts.eq("a"), "boolean")
    counted = m.counting("LIKED", ["string"], lambda c: c.isNotNull() & model(c))
    assert value(counted, table, "k") == 3


def test_attach_expect_detach():
    monitor = Monitor("db.s.t").attach(m.NULL_COUNT, ["k"])
    with pytest.raises(ValueError):
        monitor.attach(m.NULL_COUNT, ["k"])
    with pytest.raises(ValueError):
        monitor.expect(m.NULL_COUNT, ["x"], "n", "value = 0")
    monitor.detach(m.NULL_COUNT, ["k"])
    assert monitor.associations == []
    with pytest.raises(ValueError):
        monitor.detach(m.NULL_COUNT, ["k"])


def test_several_expectations_on_one_metric(table):
    monitor = Monitor("db.s.t").attach(m.NULL_COUNT, ["k"])
    for name, predicate in (("low", "value < 3"), ("none", "value = 0")):
        monitor.expect(m.NULL_COUNT, ["k"], name, predicate)
    rows = monitor.evaluate(table, NOON).collect()
    assert {(r.expectation_name, r.expression, r.value, r.violated) for r in rows} == {
        ("low", "value < 3", 2.0, False), ("none", "value = 0", 2.0, True)}
    assert rows[0].table_schema == "s" and rows[0].measurement_time == NOON


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_metrics_share_scans(spark, folder):
    """Four metrics from one scan without keyed shuffle; the keys on their own."""
    raw(spark, SMALL, "orders").write.parquet(f"{folder}/orders")
    stored = schemas.read_table(spark, f"{folder}/orders", schemas.ORDERS)
    text = plan(orders_monitor().evaluate(stored, AS_OF))
    read = sorted(line.split("ReadSchema: ")[1].strip() for line in text.splitlines() if "ReadSchema" in line)
    assert read == ["struct<customer_id:string,order_total:double,order_date:date,shipping_address:string>",
                    "struct<order_id:string>"]
    keyed = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(keyed) == 1 and "order_id" in keyed[0]
    assert "Expand" not in text and "Python" not in text and "Join" not in text


def test_two_key_sets_do_not_multiply_rows(table):
    monitor = (Monitor("db.s.t").attach(m.DUPLICATE_COUNT, ["k"]).attach(m.NULL_COUNT, ["x"])
               .attach(m.DUPLICATE_COUNT, ["x"]).attach(m.DUPLICATE_COUNT, ["k", "x"]))
    measured = monitor.measure(table, NOON)
    assert "Expand" not in plan(measured)
    assert {(r.metric_name, r.columns): r.value for r in measured.collect()} == {
        ("DUPLICATE_COUNT", "k"): 2, ("NULL_COUNT", "x"): 1, ("DUPLICATE_COUNT", "x"): 1, ("DUPLICATE_COUNT", "k,x"): 0}


def test_history_equals_measuring_every_prefix(spark):
    rows = [(i % 7 if i % 5 else None, float(i % 11 - 3), date(2001, 1, 1 + i % 9) if i % 13 else None, i // 12)
            for i in range(90)]
    batches = [None if b == 0 else b for *_, b in rows]        # an unknown batch comes first
    df = spark.createDataFrame([(str(k) if k is not None else None, x, d, b)
                                for (k, x, d, _), b in zip(rows, batches)], SCHEMA + ", b int")
    monitor = (Monitor("db.s.t").attach(m.NULL_COUNT, ["k"]).attach(m.DUPLICATE_COUNT, ["k"])
               .attach(m.DUPLICATE_COUNT, ["k", "x"]).attach(m.FRESHNESS, ["d"]).attach(m.FILL_RATE, ["d"]))
    at = "timestampadd(DAY, coalesce({b}, 0), timestamp_ntz'2001-02-01 00:00:00')"
    history = monitor.history(df, F.col("b"), lambda batch: F.expr(at.format(b="batch")))
    got = {(r.metric_name, r.columns, r.measurement_time): r.value for r in history.collect()}
    expected = {}
    for last in sorted({b or 0 for b in batches}):
        prefix = df.filter(F.coalesce("b", F.lit(0)) <= last)
        for r in monitor.measure(prefix, datetime(2001, 2, 1 + last)).collect():
            expected[r.metric_name, r.columns, r.measurement_time] = r.value
    assert got == expected and len(got) == 5 * 8


def test_references_report_unmeasured(spark):
    monitor = orders_monitor()
    rows = monitor.references(spark, spark.createDataFrame([], schemas.STATUSES),
                              spark.createDataFrame([], schemas.RESULTS)).collect()
    assert len(rows) == 5 and all(r.value is None and r.violated is None for r in rows)


def test_latest_only_of_this_table(spark):
    at = datetime(2001, 1, 1)
    log = spark.createDataFrame([("shop", "raw", t, "NULL_COUNT", str(i), float(i), at.replace(day=1 + i))
                                 for t in ("orders", "customers") for i in range(25)], schemas.RESULTS)
    newest = orders_monitor().latest(log).collect()
    assert len(newest) == 20 and {r.table_name for r in newest} == {"orders"}
    assert [r.value for r in newest] == [float(i) for i in range(24, 4, -1)]


def test_parameters_tell_metrics_apart(table):
    registry = m.Registry()
    registry.create(m.not_matching("a"))
    registry.create(m.not_matching("b"))
    with pytest.raises(ValueError):
        registry.create(m.not_matching("b"))
    registry.create(m.not_matching("b"), replace=True)
    assert registry.get("NOT_MATCHING_COUNT", "string", parameters=("b",)).label == "NOT_MATCHING_COUNT(b)"
    monitor = Monitor("shop.raw.t").attach(m.not_matching("a"), ["k"]).attach(m.not_matching("b"), ["k"])
    with pytest.raises(ValueError):
        monitor.attach(m.not_matching("a"), ["k"])
    monitor.expect(m.not_matching("b"), ["k"], "all_b", "value = 0")
    assert {r.metric_name: r.value for r in monitor.measure(table, NOON).collect()} == {
        "NOT_MATCHING_COUNT(a)": 2, "NOT_MATCHING_COUNT(b)": 4}
    assert [(r.metric_name, r.value, r.violated) for r in monitor.evaluate(table, NOON).collect()] == [("NOT_MATCHING_COUNT(b)", 4, True)]


def test_only_results_of_this_table_are_judged(spark):
    monitor, at = orders_monitor(), datetime(2001, 1, 1)
    log = spark.createDataFrame([("shop", "raw", t, "DUPLICATE_COUNT", "order_id", v, at) for t, v in
                                 (("orders", 0.0), ("shipments", 7.0))] + [("other", "raw", "orders", "DUPLICATE_COUNT", "order_id", 9.0, at)],
                                schemas.RESULTS)
    assert [(r.table_name, r.value, r.violated) for r in monitor.statuses(log).collect()] == [("orders", 0.0, False)]


def test_payload_keeps_the_fraction(spark):
    monitor = Monitor("shop.raw.t").attach(m.FILL_RATE, ["k"]).expect(m.FILL_RATE, ["k"], "filled", "value > 99")
    log = spark.createDataFrame([("shop", "raw", "t", "FILL_RATE", "k", 97.6, datetime(2001, 1, 1))], schemas.RESULTS)
    payload = json.loads(with_payload(monitor.statuses(log)).first()["payload"])
    assert payload["value"] == 97.6 and payload["expectation"] == "filled"
