"""Synthetic orders of any size, generated in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.draws import draw, uniform
from plumbline.sources.shop import LAST_DAY, orders_from


def generate_orders(spark: SparkSession, n: int, customers: int) -> DataFrame:
    """``n`` orders of the last year plus their planted copies.  The sequence
    comes from ``range``, whose partitions number their rows independently; a
    global ``row_number`` would pass every row through one task."""
    k = "o_orderkey"
    source = spark.range(1, n + 1).select(F.col("id").alias("o_orderkey")).select(
        "o_orderkey", uniform(k, 61, 1, customers).alias("o_custkey"),
        F.date_sub(F.lit(LAST_DAY), draw(k, 62, 366).cast("int")).cast("timestamp_ntz").alias("o_orderdate"))
    return orders_from(source)
