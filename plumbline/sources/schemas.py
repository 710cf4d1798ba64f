"""Declared schemas of the five shop tables and of the logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(),
    "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(), "boolean": T.BooleanType(),
}


def _schema(columns: str) -> T.StructType:
    """``name type, name type, …``; every column may be NULL."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


ORDERS = _schema(
    "order_id string, customer_id string, product_id string, quantity int, "
    "unit_price double, order_total double, order_date date, status string, "
    "shipping_address string, region string, customer_notes string")
CUSTOMERS = _schema(
    "customer_id string, email string, first_name string, last_name string, "
    "phone string, signup_date date, region string, tier string")
PRODUCTS = _schema(
    "product_id string, product_name string, category string, unit_price double, is_active boolean")
INVENTORY = _schema(
    "inventory_id string, product_id string, warehouse_location string, "
    "quantity_on_hand int, last_updated timestamp_ntz, reorder_point int")
SHIPMENTS = _schema(
    "shipment_id string, order_id string, carrier string, tracking_number string, "
    "ship_date date, estimated_delivery date, actual_delivery date, status string")

TABLES = {
    "orders": ORDERS, "customers": CUSTOMERS, "products": PRODUCTS,
    "inventory": INVENTORY, "shipments": SHIPMENTS,
}

RESULTS = _schema(
    "table_database string, table_schema string, table_name string, metric_name string, "
    "columns string, value double, measurement_time timestamp_ntz")
STATUSES = _schema(
    "table_database string, table_schema string, table_name string, metric_name string, "
    "columns string, expectation_name string, expression string, value double, "
    "evaluated boolean, violated boolean, measurement_time timestamp_ntz")
REFRESHES = _schema(
    "name string, attempt int, state string, state_message string, "
    "refresh_start_time timestamp_ntz, refresh_end_time timestamp_ntz")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, in order and with the declared types."""
    return df.selectExpr(*[f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in schema])


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A typed scan: nothing is inferred from the files."""
    return spark.read.schema(schema).parquet(path)
