"""Every registered query: a function of a session and a scale-factor folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.functions import metrics as m
from plumbline.functions import address_paths, text
from plumbline.operators import changes, cooldown, nearest, references, sketches, updates
from plumbline.plans import alerts, enrich, facts, root_cause, semantic, validate
from plumbline.plans import shop_monitors as monitors
from plumbline.session import shared_folder, written
from plumbline.sources import shop
from plumbline.sources.shop import AS_OF, given, raw
from plumbline.streaming.measured_table import MeasuredTable
from plumbline.streaming.monitor_stream import AlertStream, MonitorStream
from plumbline.streaming.semantic_cells import SemanticCells
from plumbline.streaming.validated_stream import ValidatedTable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# ---- fixed values -----------------------------------------------------------
SAMPLED_ORDERS = 150
COPIED_CUSTOMERS = 40
VIOLATION = "value > 20"
# -----------------------------------------------------------------------------


def query(run: Query, key: str | None = None) -> Query:
    QUERIES[key or run.__name__] = run
    return run


def named(key: str):
    return lambda run: query(run, key)


def orders(spark, d):
    return raw(spark, d, "orders")


def validated(spark, d):
    return validate.validated_orders(orders(spark, d))


# -- tables ---------------------------------------------------------------------

def _scan(name: str) -> None:
    QUERIES[f"scan_{name}"] = lambda spark, d: raw(spark, d, name)


for _name in ("orders", "customers", "products", "inventory", "shipments"):
    _scan(_name)


@query
def row_counts(spark, d):
    counts = None
    for name in ("orders", "customers", "products", "inventory", "shipments"):
        one = raw(spark, d, name).agg(F.count("*").alias("row_count")).select(
            F.lit(f"raw.{name}").alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return counts.orderBy("table_name")


@query
def update_null_tracking(spark, d):
    loaded = shop.loaded_shipments_from(given(spark, d, "orders"))
    return updates.lose_tracking_numbers(loaded).select("shipment_id", "status", "tracking_number")


@query
def sample_rows(spark, d):
    return updates.sample_rows(given(spark, d, "orders").select("o_orderkey", "o_totalprice"),
                               "o_orderkey", SAMPLED_ORDERS, salt=63)


@query
def inject_duplicates(spark, d):
    return updates.inject_duplicates(given(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"),
                                     "c_custkey", COPIED_CUSTOMERS, salt=64)


# -- filters ----------------------------------------------------------------------

@query
def negative_totals(spark, d):
    return orders(spark, d).filter(F.col("order_total") < 0).select("order_id", "order_total")


# -- single metrics -----------------------------------------------------------------

def _metric(key: str, table: str, metric: Callable[[], m.Metric], columns: list[str]) -> None:
    QUERIES[key] = lambda spark, d: metric().on(raw(spark, d, table), *columns, as_of=AS_OF, alias=key)


_metric("dq_null_count", "orders", lambda: m.NULL_COUNT, ["customer_id"])
_metric("dq_duplicate_count", "orders", lambda: m.DUPLICATE_COUNT, ["order_id"])
_metric("dq_negative_total", "orders", lambda: m.NEGATIVE_TOTAL_COUNT, ["order_total"])
_metric("dq_suspicious_address", "orders", lambda: m.SUSPICIOUS_ADDRESS_COUNT, ["shipping_address"])
_metric("price_mismatch", "orders", lambda: m.product_mismatch(monitors.MISMATCH_TOLERANCE),
        ["order_total", "quantity", "unit_price"])
_metric("notes_fill_rate", "orders", lambda: m.FILL_RATE, ["customer_notes"])
_metric("customers_bad_email", "customers", lambda: m.not_matching(monitors.EMAIL), ["email"])
_metric("customers_duplicates", "customers", lambda: m.DUPLICATE_COUNT, ["customer_id"])
_metric("products_bad_category", "products", lambda: m.not_accepted(shop.CATEGORIES), ["category"])
_metric("products_price_outlier", "products",
        lambda: m.outlier(monitors.PRICE_FLOOR, monitors.PRICE_CEILING), ["unit_price"])
_metric("inventory_negative", "inventory", lambda: m.below(0), ["quantity_on_hand"])
_metric("shipments_no_tracking", "shipments", lambda: m.null_where("DELIVERED"), ["status", "tracking_number"])
_metric("shipments_future", "shipments", lambda: m.later_than(AS_OF.date()), ["ship_date"])


@query
def dq_freshness(spark, d):
    seconds = m.FRESHNESS.on(orders(spark, d), "order_date", as_of=AS_OF, alias="freshness_seconds")
    return seconds.select("freshness_seconds",
                          F.round(F.col("freshness_seconds") / 3600, 1).alias("freshness_hours"))


@query
def dq_custom_metric(spark, d):
    """A user-defined metric over two columns, registered, bound and called."""
    registry = m.Registry()
    registry.create(m.rate("UNPLACED_RATE", ["string", "string"],
                           lambda customer, address: customer.isNull() | address.isNull()))
    return registry.get("UNPLACED_RATE", "string", "string").on(
        orders(spark, d), "customer_id", "shipping_address", alias="unplaced_rate")


@query
def dq_duplicate_variants(spark, d):
    return references.duplicate_variants(orders(spark, d), "order_id")


@query
def inventory_orphans(spark, d):
    return references.orphan_count(raw(spark, d, "inventory"), raw(spark, d, "products"), "product_id")


@query
def shipment_order_semi(spark, d):
    return references.referenced(raw(spark, d, "shipments"), orders(spark, d), "order_id", "status")


@query
def category_repair(spark, d):
    nearest = references.nearest_value(F.col("category"), shop.CATEGORIES)
    return (raw(spark, d, "products").groupBy("category").agg(F.count("*").alias("products"))
            .select("category", nearest.alias("repaired"), "products"))


@query
def product_label_repair(spark, d):
    """Misspelt labels of products and the nearest label in the whole table, NULL if none is within two edits."""
    parts = shop.labelled_parts(given(spark, d, "part"))
    index = written(nearest.remainder_index(parts, "label"), "label-index")
    wrong = parts.filter("given_label != label")
    found = nearest.nearest_listed(wrong, "given_label", index)
    return wrong.join(found, "given_label", "left").select(
        "p_partkey", "given_label", F.col("nearest").alias("repaired"), "distance")


@query
def history_estimates(spark, d):
    """Distinct orders up to each month, and whether the estimate from the months' sketches keeps its stated bound."""
    month = F.trunc("order_date", "month")
    estimates = sketches.running_estimates(sketches.batch_sketches(orders(spark, d), ["order_id"], month))
    first = orders(spark, d).dropna(subset=["order_id"]).groupBy("order_id").agg(F.min(month).alias("batch"))
    fresh = first.groupBy("batch").agg(F.count("*").alias("n"))
    so_far = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)
    exact = estimates.join(fresh, "batch", "left").withColumn("exact", F.sum("n").over(so_far))
    return exact.select("batch", "exact", (F.abs(F.col("estimate") - F.col("exact"))
                                           <= sketches.bound() * F.col("exact")).alias("within_bound"))


# -- monitors ------------------------------------------------------------------------

@query
def dq_orders_all(spark, d):
    return monitors.orders_monitor().measure(orders(spark, d), AS_OF)


@query
def dq_lineitem_all(spark, d):
    return monitors.lineitem_monitor().measure(given(spark, d, "lineitem"), AS_OF)


@query
def dq_expectations(spark, d):
    return monitors.orders_monitor().evaluate(orders(spark, d), AS_OF)


@query
def dq_all_tables(spark, d):
    """The verdicts on all five raw tables in one report."""
    report = None
    for name, monitor in monitors.all_monitors().items():
        one = monitor.evaluate(raw(spark, d, name), AS_OF)
        report = one if report is None else report.unionByName(one)
    return report


@query
def dq_model_metric(spark, d):
    """A metric whose predicate is a batch model; this one doubts every address without a house number."""
    doubtful = text.batch_model(lambda address: ~address.str.match(r"[0-9]+ ", na=True), "boolean")
    return m.counting("DOUBTFUL_ADDRESS_COUNT", ["string"], doubtful).on(
        orders(spark, d), "shipping_address", alias="dq_model_metric")


def _month(column: str):
    return F.trunc(column, "month")


def _after_month(batch):
    return F.add_months(batch, 1).cast("timestamp_ntz")


def orders_history(spark, d):
    return monitors.orders_monitor().history(orders(spark, d), _month("order_date"), _after_month)


def results_log(spark, d):
    """The result log of two tables, each measured after every month."""
    customers = monitors.customers_monitor().history(
        raw(spark, d, "customers"), _month("signup_date"), _after_month)
    return orders_history(spark, d).unionByName(customers)


@query
def metric_history(spark, d):
    return orders_history(spark, d)


@query
def metric_results_latest(spark, d):
    return monitors.orders_monitor().latest(results_log(spark, d)).select(
        "metric_name", "columns", "value", "measurement_time")


@query
def expectation_history(spark, d):
    monitor = monitors.orders_monitor()
    return monitor.latest(monitor.statuses(results_log(spark, d)))


@query
def metric_references(spark, d):
    monitor = monitors.orders_monitor()
    results = orders_history(spark, d)
    return monitor.references(spark, monitor.statuses(results), results)


@query
def alert_payload(spark, d):
    """Alerts are raised from the status log, so the log is written first."""
    log = written(monitors.orders_monitor().statuses(orders_history(spark, d)), "statuses")
    return alerts.alerts(log)


@query
def alerts_cooldown(spark, d):
    violations = given(spark, d, "events").filter(VIOLATION)
    return cooldown.alerts_with_cooldown(violations, ["event_type"], "ts", timedelta(hours=1))


# -- enrichment -----------------------------------------------------------------------

@named("extract_address")
def extract_addresses(spark, d):
    return enrich.extracted_addresses(orders(spark, d))


@named("redact_address")
def redact_addresses(spark, d):
    return enrich.redacted_addresses(orders(spark, d))


@query
def address_spellings(spark, d):
    """Addresses written in other ways, taken apart by their best path."""
    spelled = shop.spelled_addresses(orders(spark, d))
    return spelled.select("order_id", address_paths.parse_address(F.col("address")).alias("found")).select("order_id", "found.*")


@query
def address_preview(spark, d):
    return enrich.address_preview(orders(spark, d))


@query
def enriched_orders(spark, d):
    return enrich.flat(enrich.enriched_orders(orders(spark, d)))


@query
def redact_documents(spark, d):
    return enrich.redacted_documents(given(spark, d, "documents"))


@query
def redact_counts(spark, d):
    return enrich.redaction_counts(given(spark, d, "documents"))


@query
def extract_pages(spark, d):
    return enrich.page_fields(given(spark, d, "pages"))


@query
def redact_conversations(spark, d):
    return enrich.conversation_hits(given(spark, d, "conversations"))


# -- validated orders --------------------------------------------------------------------

@query
def dedup_earliest(spark, d):
    return validate.dedup_orders(orders(spark, d))


@query
def hard_failures(spark, d):
    return validate.flag_hard_failures(validate.dedup_orders(orders(spark, d))).select(
        "order_id", *[f"is_{r.name}" for r in validate.HARD_RULES])


@query
def score_histogram(spark, d):
    return validate.score_histogram(validated(spark, d))


@query
def validated_orders(spark, d):
    return validated(spark, d)


@query
def status_pct(spark, d):
    return validate.status_pct(validated(spark, d))


@query
def region_status(spark, d):
    return validate.region_status(validated(spark, d))


# -- semantic model ------------------------------------------------------------------------

def model(spark, d):
    return semantic.ORDER_QUALITY.bind(orders=validated(spark, d), customers=raw(spark, d, "customers"))


def _by(key: str, *dims: str) -> None:
    QUERIES[key] = lambda spark, d: model(spark, d).query(semantic.ALL_METRICS, dims)


_by("semantic_overall")
_by("semantic_region", "region")
_by("semantic_status", "status")
_by("semantic_quality", "quality_status")
_by("semantic_tier", "tier")


@query
def semantic_grouping_sets(spark, d):
    return model(spark, d).query(
        ["total_orders", "rejected_count", "rejection_rate"], ["region", "tier"],
        grouping_sets=[["region", "tier"], ["region"], ["tier"], []])


@query
def semantic_filtered(spark, d):
    return model(spark, d).query(["total_orders", "clean_order_rate", "avg_quality_score"], ["region"],
                                 where={"tier": "tier in ('GOLD', 'PLATINUM')", "status": "status <> 'PENDING'"})


@query
def semantic_facts(spark, d):
    return model(spark, d).query_rows(["order_total", "quality_score"], ["region", "tier"], keep=["order_id"])


def shop_facts(spark, d):
    return facts.SHOP.bind(orders=validated(spark, d), customers=raw(spark, d, "customers"), shipments=raw(spark, d, "shipments"))


@query
def facts_by_tier(spark, d):
    """Three fact tables; shipments reach the tier over orders and customers."""
    return shop_facts(spark, d).query(["late_shipments", "late_rate", "total_shipments", "rejected_count", "total_orders",
                                       "shipments_per_order", "customer_rows"], ["tier"])


@query
def facts_filtered(spark, d):
    return shop_facts(spark, d).query(["late_shipments", "untracked_count", "total_orders"], ["region", "tier"],
                                      where={"quality_status": "quality_status <> 'REJECTED'"})


@query
def root_cause_slices(spark, d):
    return root_cause.slices(model(spark, d), "n_rejected", "n_orders", ["region", "tier", "status"])


@query
def root_cause_address_slices(spark, d):
    return root_cause.slices(model(spark, d), "n_missing_address", "n_rows", ["region", "status", "quality_status", "tier"],
                             least_rows=50, least_share=0.02, above_parents=1.0)


@query
def root_cause_region(spark, d):
    return root_cause.rejection_causes(validated(spark, d), "region")


@query
def root_cause_flags(spark, d):
    return root_cause.flags(model(spark, d), "region", {
        "rejection_rate": ("n_rejected", "n_orders", True),
        "null_customer_rate": ("n_null_customer", "n_orders", True),
        "negative_total_rate": ("n_negative", "n_orders", True),
        "clean_order_rate": ("n_clean", "n_orders", False),
        "avg_quality_score": ("sum_score", "n_scored", False)},
        causes={"null_customer": "n_null_customer", "negative_total": "n_negative",
                **{r.name: f"n_{r.name}" for r in validate.SOFT_RULES}})


@query
def issues_by_region(spark, d):
    return root_cause.issues_by(validated(spark, d), "region")


@query
def west_vs_rest(spark, d):
    return root_cause.one_against_rest(
        model(spark, d), "region", "WEST",
        ["clean_order_rate", "rejection_rate", "avg_quality_score", "null_customer_rate"])


@query
def tier_vs_rest(spark, d):
    return root_cause.one_against_rest(
        model(spark, d), "tier", "GOLD",
        ["total_orders", "clean_order_rate", "rejection_rate", "avg_quality_score"])


# -- streams: the table or log after everything that is there has been read --------------------

def _stream(spark, d, name, per_trigger=1):
    """The table as a stream.  The pattern stands for the one file or the folder
    of files; a stream does not take the plain path of a single file."""
    return (spark.readStream.schema(given(spark, d, name).schema)
            .option("maxFilesPerTrigger", per_trigger).parquet(f"{d}/{name}.parque[t]"))


def _drain(writer) -> None:
    writer.trigger(availableNow=True).start().awaitTermination()


@query
def stream_validated(spark, d):
    table = ValidatedTable(spark, shared_folder(spark, "validated"))
    _drain(table.follow(shop.orders_from(_stream(spark, d, "orders"))))
    return table.read()


@query
def stream_semantic(spark, d):
    """Cells kept by the stream that keeps the validated table."""
    table = ValidatedTable(spark, shared_folder(spark, "validated"))
    cells = SemanticCells(spark, semantic.ORDER_QUALITY.bind(orders=table.read(), customers=raw(spark, d, "customers")),
                          shared_folder(spark, "cells"))
    cells.initialize()
    _drain(cells.stream(table, shop.orders_from(_stream(spark, d, "orders"))))
    return cells.query(semantic.ALL_METRICS, ["tier", "quality_status"])


# -- updates and deletes: two versions of the raw orders, the second after a script of statements ---

def versions(spark, d):
    before = orders(spark, d)
    return before, shop.updated_orders(before)


@query
def captured_changes(spark, d):
    """How many rows, copies counted, came and went."""
    net = changes.captured(*versions(spark, d))
    kind = F.when(F.col("change") > 0, "came").otherwise("went")
    return net.groupBy(kind.alias("kind")).agg(F.sum(F.abs("change")).alias("copies"), F.count("*").alias("different_rows"))


@query
def validated_after_updates(spark, d):
    before, after = versions(spark, d)
    table = ValidatedTable(spark, shared_folder(spark, "validated"))
    table.initialize(before)
    table.change(changes.captured(before, after), after, 0)
    return table.read()


@query
def semantic_after_updates(spark, d):
    """Stored cells follow updates of orders through the validated table, then those of customers; the answer reads the cells alone."""
    before, after = versions(spark, d)
    customers = raw(spark, d, "customers")
    table = ValidatedTable(spark, shared_folder(spark, "validated"))
    table.initialize(before)
    cells = SemanticCells(spark, semantic.ORDER_QUALITY.bind(orders=table.read(), customers=customers), shared_folder(spark, "cells"))
    cells.initialize()
    table.change(changes.captured(before, after), after, 0)
    cells.follow(table, 0)
    cells.change(1, orders=table.read(), customers=shop.updated_customers(customers))
    return cells.query(semantic.ALL_METRICS, ["region", "tier"], where={"status": "status <> 'PENDING'"},
                       grouping_sets=[["region", "tier"], ["region"], ["tier"], []])


@query
def refresh_modes(spark, d):
    """Some rows change and the refresh is incremental; then all of them, and the table is built anew."""
    first, second = versions(spark, d)
    third = second.withColumn("quantity", F.col("quantity") + 1)
    table = ValidatedTable(spark, shared_folder(spark, "validated"))
    table.initialize(first)
    table.change(changes.captured(first, second), second, 0)
    table.change(changes.captured(second, third), third, 1)
    return table.refresh_modes()


@query
def metrics_after_updates(spark, d):
    before, after = versions(spark, d)
    table = MeasuredTable(spark, monitors.orders_monitor(), shared_folder(spark, "measured"))
    table.initialize(before, AS_OF)
    return table.change(changes.captured(before, after), after, AS_OF, 1)


@query
def refresh_history(spark, d):
    """The attempts at building the table from one region and then refreshing it with everything."""
    table = ValidatedTable(spark, shared_folder(spark, "validated"))
    table.initialize(orders(spark, d).filter("region = 'WEST'"))
    everything = _stream(spark, d, "orders", per_trigger=1_000_000)
    _drain(table.follow(shop.orders_from(everything)))
    order = F.row_number().over(Window.orderBy("refresh_start_time")).cast("bigint")
    return table.refresh_history().select(order.alias("position"), "name", "state", "attempt")


@query
def stream_metrics(spark, d):
    """The values recorded after the last file."""
    stream = MonitorStream(spark, monitors.orders_monitor(), shared_folder(spark, "monitor"), lambda batch: AS_OF)
    _drain(stream.follow(shop.orders_from(_stream(spark, d, "orders"))))
    newest = stream.results.read().agg(F.max("batch_id")).first()[0]
    return stream.results.batch(newest or 0)


@query
def stream_alerts(spark, d):
    events = given(spark, d, "events")
    stream = AlertStream(spark, shared_folder(spark, "alerts"),
                         {"event_type": events.schema["event_type"].dataType}, "ts")
    _drain(stream.follow(_stream(spark, d, "events").filter(VIOLATION)))
    return stream.alerts.read().drop("batch_id")
