"""The five raw shop tables, derived row by row from the given star schema.

The given tables are clean.  These projections plant known defects in them: one
scan per table, no shuffle, the same rows on every run.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.address import address_parts
from plumbline.functions.draws import draw, identifier, pick, uniform
from plumbline.sources import schemas

# ---- fixed values -----------------------------------------------------------
AS_OF = datetime(2001, 8, 2)
LAST_DAY = date(2001, 8, 1)
REGIONS = ("NORTH", "SOUTH", "EAST", "WEST")
ORDER_STATUSES = ("PENDING", "PROCESSING", "SHIPPED", "DELIVERED")
SHIPMENT_STATUSES = ("PENDING", "IN_TRANSIT", "DELIVERED", "RETURNED")
CARRIERS = ("FedEx", "UPS", "USPS", "DHL")
WAREHOUSES = ("WH-EAST", "WH-WEST", "WH-CENTRAL")
CATEGORIES = ("ELECTRONICS", "ACCESSORIES", "PERIPHERALS", "OFFICE")
MISSPELT_CATEGORIES = ("ELECTRNICS", "ACCESORIES", "PRIPHERALS")
FIRST_NAMES = ("James", "Sarah", "Emily", "David")
LAST_NAMES = ("Smith", "Brown", "Garcia", "Taylor")
STREETS = (" Oak St, Austin TX 78701", " Pine Ave, Seattle WA 98101",
           " Main Blvd, Chicago IL 60601", " Elm Dr, Miami FL 33101")
NOTES = ("Great quality and fast shipping.",
         "Item arrived damaged, requesting replacement.",
         "Average experience overall.")
TIERS = ("PLATINUM", "PLATINUM", "GOLD", "GOLD", "GOLD", "SILVER", "SILVER",
         "BRONZE", "BRONZE", "BRONZE")
LATE_COPY = "LATE_COPY"
# -----------------------------------------------------------------------------


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def one_in_hundred(key: str, salt: int, below: int) -> Column:
    """True for ``below`` percent of the keys."""
    return draw(key, salt, 100) < below


def _with_copies(df: DataFrame, **copies: Column) -> DataFrame:
    """Every row once, plus once more for each condition that holds, all from
    one scan; ``copy`` names the kind of row."""
    none = F.array().cast("array<string>")
    kinds = [F.when(hit, F.array(F.lit(kind))).otherwise(none) for kind, hit in copies.items()]
    return df.withColumn("copy", F.explode(F.concat(F.array(F.lit("original")), *kinds)))


def orders_from(source: DataFrame) -> DataFrame:
    k = "o_orderkey"
    quantity = uniform(k, 11, 1, 25).cast("int")
    price = uniform(k, 12, 500, 29899).cast("double") / F.lit(100.0)
    null_customers = F.when(draw(k, 15, 4) == 3, 12).otherwise(8)
    number = uniform(k, 14, 100, 9999).cast("string")
    rows = _with_copies(
        source.select("o_orderkey", "o_custkey", "o_orderdate"),
        exact=one_in_hundred(k, 17, 2), late=one_in_hundred(k, 18, 1))
    late = F.col("copy") == "late"
    day = F.col("o_orderdate").cast("date")
    return schemas.conform(rows.select(
        identifier("ORD", F.col(k)).alias("order_id"),
        F.when(draw(k, 1, 100) >= null_customers, identifier("CUST", F.col("o_custkey"))).alias("customer_id"),
        identifier("PROD", draw(k, 13, 200)).alias("product_id"),
        quantity.alias("quantity"),
        price.alias("unit_price"),
        F.when(draw(k, 7, 200) < 1, F.lit(None).cast("double"))
        .when(one_in_hundred(k, 3, 2), (-10 - draw(k, 4, 491)).cast("double"))
        .when(one_in_hundred(k, 5, 3), F.lit(0.0))
        .when(one_in_hundred(k, 6, 6), quantity * price + F.lit(7.5))
        .otherwise(quantity * price).alias("order_total"),
        F.when(late, F.date_add(day, 1)).otherwise(day).alias("order_date"),
        F.when(late, F.lit(LATE_COPY)).otherwise(pick(k, 8, ORDER_STATUSES)).alias("status"),
        F.when(one_in_hundred(k, 9, 4), F.lit(None).cast("string"))
        .when(one_in_hundred(k, 9, 6), F.concat(F.lit("n/a "), number))
        .otherwise(F.concat(number, pick(k, 10, STREETS))).alias("shipping_address"),
        pick(k, 15, REGIONS).alias("region"),
        F.get(F.array(*[F.lit(n) for n in NOTES]),
              F.floor(draw(k, 16, 100) / 10).cast("int")).alias("customer_notes"),
    ), schemas.ORDERS)


def customers_from(source: DataFrame) -> DataFrame:
    k = "c_custkey"
    user = F.concat(F.lit("user"), F.col(k).cast("string"))
    rows = _with_copies(source.select("c_custkey"), exact=one_in_hundred(k, 27, 2))
    return schemas.conform(rows.select(
        identifier("CUST", F.col(k)).alias("customer_id"),
        F.when(one_in_hundred(k, 21, 2), F.concat(user, F.lit("nodomain.com")))
        .when(one_in_hundred(k, 21, 4), F.lit("@example.com"))
        .when(one_in_hundred(k, 21, 5), F.concat(user, F.lit("@@example.com")))
        .otherwise(F.concat(user, F.lit("@example.com"))).alias("email"),
        pick(k, 28, FIRST_NAMES).alias("first_name"),
        pick(k, 29, LAST_NAMES).alias("last_name"),
        F.concat(F.lit("555-"), uniform(k, 22, 100, 999).cast("string"),
                 F.lit("-"), uniform(k, 23, 1000, 9999).cast("string")).alias("phone"),
        F.date_sub(F.lit(LAST_DAY), draw(k, 24, 1096).cast("int")).alias("signup_date"),
        pick(k, 25, REGIONS).alias("region"),
        pick(k, 26, TIERS).alias("tier"),
    ), schemas.CUSTOMERS)


def products_from(source: DataFrame) -> DataFrame:
    k = "p_partkey"
    return schemas.conform(source.select(
        identifier("PROD", F.col(k)).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(one_in_hundred(k, 31, 5), pick(k, 35, MISSPELT_CATEGORIES))
        .otherwise(pick(k, 32, CATEGORIES)).alias("category"),
        F.when(one_in_hundred(k, 33, 1), F.lit(0.0))
        .when(one_in_hundred(k, 33, 3), F.lit(99999.99))
        .otherwise(F.col("p_retailprice")).alias("unit_price"),
        (draw(k, 34, 10) > 0).alias("is_active"),
    ), schemas.PRODUCTS)


def labelled_parts(source: DataFrame) -> DataFrame:
    """Parts with their label and the label as given, in which some lost or
    changed a character or got a prefix."""
    k = "p_partkey"
    kind, label = draw(k, 91, 100), F.col("label")
    at = draw(k, 92, "length(label)").cast("int")
    before, after = label.substr(F.lit(1), at), label.substr(at + 2, F.length(label))
    parts = source.select(k, F.concat_ws(" ", "p_brand", "p_name", "p_type").alias("label"))
    return parts.withColumn("given_label", F.when(kind < 4, F.concat(before, after))
                            .when(kind < 7, F.concat(before, F.lit("_"), after))
                            .when(kind < 8, F.concat(F.lit("zzz"), label)).otherwise(label))


def inventory_from(source: DataFrame) -> DataFrame:
    k = "p_partkey"
    return schemas.conform(source.select(
        identifier("INV", F.col(k)).alias("inventory_id"),
        identifier("PROD", F.when(one_in_hundred(k, 41, 3), F.col(k) + 90000000).otherwise(F.col(k))).alias("product_id"),
        pick(k, 42, WAREHOUSES).alias("warehouse_location"),
        F.when(one_in_hundred(k, 43, 5), -1 - draw(k, 44, 200))
        .otherwise(draw(k, 44, 5001)).alias("quantity_on_hand"),
        F.date_sub(F.lit(LAST_DAY), draw(k, 46, 30).cast("int")).cast("timestamp_ntz").alias("last_updated"),
        uniform(k, 45, 10, 200).alias("reorder_point"),
    ), schemas.INVENTORY)


def shipments_from(source: DataFrame) -> DataFrame:
    """Shipments after the tracking numbers of some delivered ones were lost."""
    from plumbline.operators.updates import lose_tracking_numbers

    return schemas.conform(lose_tracking_numbers(loaded_shipments_from(source)), schemas.SHIPMENTS)


def loaded_shipments_from(source: DataFrame) -> DataFrame:
    """Shipments as first loaded; ``o_orderkey`` is kept for later draws."""
    k = "o_orderkey"
    day = F.col("o_orderdate").cast("date")
    return source.select(
        "o_orderkey",
        identifier("SHIP", F.col(k)).alias("shipment_id"),
        identifier("ORD", F.col(k)).alias("order_id"),
        pick(k, 51, CARRIERS).alias("carrier"),
        F.upper(F.concat(F.lit("1z"), F.lpad(draw(k, 54, 1000000000).cast("string"), 12, "0"))).alias("tracking_number"),
        F.when(one_in_hundred(k, 55, 4), F.date_add(day, 3650))
        .otherwise(F.date_add(day, draw(k, 56, 30).cast("int"))).alias("ship_date"),
        F.date_add(day, uniform(k, 57, 31, 40).cast("int")).alias("estimated_delivery"),
        F.when(draw(k, 58, 4) != 0, F.date_add(day, uniform(k, 59, 31, 60).cast("int"))).alias("actual_delivery"),
        pick(k, 52, SHIPMENT_STATUSES).alias("status"))


# ---- fixed values -----------------------------------------------------------
KEY_OF_ORDER = "cast(substring(order_id, 5) as bigint)"
CLOSED_AFTER = "2001-07-25"
RESTATED = "RESTATED"
SALT_OF_SPELLING = 87
# Last digits of the customers that an update deletes or promotes.
CLOSED_CUSTOMERS, PROMOTED_CUSTOMERS = "3", "7"
# -----------------------------------------------------------------------------


def updated_orders(orders: DataFrame) -> DataFrame:
    """The raw orders after a script of DELETE, UPDATE and INSERT statements:
    originals whose late copies stay, whole orders and the last days go; totals,
    customers and dates change; some orders are stated again with an earlier date."""
    def drawn(salt: int, below: int) -> Column:
        return draw(KEY_OF_ORDER, salt, 100) < below

    original = F.col("status") != LATE_COPY
    left = orders.filter(~(drawn(81, 3) & original) & ~drawn(82, 2) & (F.col("order_date") <= F.lit(CLOSED_AFTER).cast("date")))
    changed = left.withColumns({
        "order_total": F.when(drawn(83, 2), -F.col("order_total")).otherwise(F.col("order_total")),
        "customer_id": F.when(~drawn(84, 1), F.col("customer_id")),
        "order_date": F.when(drawn(85, 2) & original, F.date_add("order_date", 3)).otherwise(F.col("order_date"))})
    again = changed.filter(drawn(86, 1)).withColumns({"order_date": F.date_sub("order_date", 2), "status": F.lit(RESTATED)})
    return schemas.conform(changed.unionByName(again), schemas.ORDERS)


def updated_customers(customers: DataFrame) -> DataFrame:
    """The raw customers after an UPDATE that promotes some and a DELETE of others."""
    left = customers.filter(~F.col("customer_id").endswith(CLOSED_CUSTOMERS))
    promoted = F.col("customer_id").endswith(PROMOTED_CUSTOMERS) & (F.col("tier") == "SILVER")
    return left.withColumn("tier", F.when(promoted, "GOLD").otherwise(F.col("tier")))


def spelled_addresses(orders: DataFrame) -> DataFrame:
    """(order_id, address): the well-formed addresses of orders, each in one of eight other spellings."""
    parts = address_parts(F.col("shipping_address"))
    known = orders.select("order_id", "shipping_address", parts.alias("p")).filter("p is not null")
    street, city, state, code = (F.get("p", F.lit(i)) for i in range(4))
    whole, plain = F.col("shipping_address"), F.replace("shipping_address", F.lit(","), F.lit(""))
    spellings = F.array(
        whole, F.upper(whole), F.lower(plain), plain, F.format_string("%s %s %s, %s", city, state, code, street),
        F.format_string("%s Apt 4b, %s, %s, %s", street, city, state, code), F.format_string("%s #12 %s %s %s", street, city, state, code),
        F.format_string("%s, %s, %s %s", street, city, code, state))
    return known.select("order_id", F.get(spellings, draw(KEY_OF_ORDER, SALT_OF_SPELLING, 8).cast("int")).alias("address"))


_DERIVED = {
    "orders": ("orders", orders_from),
    "customers": ("customer", customers_from),
    "products": ("part", products_from),
    "inventory": ("part", inventory_from),
    "shipments": ("orders", shipments_from),
}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the five raw tables over the given scale-factor folder."""
    source, derive = _DERIVED[name]
    return derive(given(spark, sf_dir, source))
