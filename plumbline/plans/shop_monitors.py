"""What is measured and expected on the shop tables."""

from __future__ import annotations

from plumbline.functions import metrics as m
from plumbline.plans.monitor import Monitor
from plumbline.sources.shop import CATEGORIES, LAST_DAY

# ---- fixed values -----------------------------------------------------------
ORDERS, CUSTOMERS, PRODUCTS = "shop.raw.orders", "shop.raw.customers", "shop.raw.products"
INVENTORY, SHIPMENTS = "shop.raw.inventory", "shop.raw.shipments"
EMAIL = r"^[^@ ]+@[^@ ]+[.][A-Za-z]+$"
PRICE_FLOOR, PRICE_CEILING = 0.0, 99999.0
MISMATCH_TOLERANCE = 1.00
# -----------------------------------------------------------------------------


def orders_monitor() -> Monitor:
    return (Monitor(ORDERS)
            .attach(m.NULL_COUNT, ["customer_id"])
            .attach(m.DUPLICATE_COUNT, ["order_id"])
            .attach(m.NEGATIVE_TOTAL_COUNT, ["order_total"])
            .attach(m.SUSPICIOUS_ADDRESS_COUNT, ["shipping_address"])
            .attach(m.FRESHNESS, ["order_date"])
            .expect(m.NEGATIVE_TOTAL_COUNT, ["order_total"], "few_negatives", "value < 50")
            .expect(m.DUPLICATE_COUNT, ["order_id"], "no_duplicates", "value = 0")
            .expect(m.NULL_COUNT, ["customer_id"], "low_nulls", "value < 200")
            .expect(m.FRESHNESS, ["order_date"], "fresh_data", "value < 86400"))


def customers_monitor() -> Monitor:
    return (Monitor(CUSTOMERS)
            .attach(m.not_matching(EMAIL), ["email"])
            .attach(m.DUPLICATE_COUNT, ["customer_id"])
            .expect(m.not_matching(EMAIL), ["email"], "emails_well_formed", "value = 0")
            .expect(m.DUPLICATE_COUNT, ["customer_id"], "no_duplicates", "value = 0"))


def products_monitor() -> Monitor:
    return (Monitor(PRODUCTS)
            .attach(m.not_accepted(CATEGORIES), ["category"])
            .attach(m.outlier(PRICE_FLOOR, PRICE_CEILING), ["unit_price"])
            .expect(m.not_accepted(CATEGORIES), ["category"], "known_categories", "value = 0")
            .expect(m.outlier(PRICE_FLOOR, PRICE_CEILING), ["unit_price"], "plausible_prices", "value = 0"))


def inventory_monitor() -> Monitor:
    return (Monitor(INVENTORY)
            .attach(m.below(0), ["quantity_on_hand"])
            .expect(m.below(0), ["quantity_on_hand"], "no_negative_stock", "value = 0"))


def shipments_monitor() -> Monitor:
    return (Monitor(SHIPMENTS)
            .attach(m.null_where("DELIVERED"), ["status", "tracking_number"])
            .attach(m.later_than(LAST_DAY), ["ship_date"])
            .expect(m.null_where("DELIVERED"), ["status", "tracking_number"], "delivered_are_tracked", "value = 0")
            .expect(m.later_than(LAST_DAY), ["ship_date"], "nothing_from_the_future", "value = 0"))


def all_monitors() -> dict[str, Monitor]:
    """The monitor of each raw table."""
    return {"orders": orders_monitor(), "customers": customers_monitor(), "products": products_monitor(),
            "inventory": inventory_monitor(), "shipments": shipments_monitor()}


def lineitem_monitor() -> Monitor:
    return (Monitor("shop.raw.lineitem")
            .attach(m.NULL_COUNT, ["l_partkey"])
            .attach(m.DUPLICATE_COUNT, ["l_orderkey", "l_linenumber"])
            .attach(m.NEGATIVE_TOTAL_COUNT, ["l_extendedprice"])
            .attach(m.FRESHNESS, ["l_shipdate"]))
