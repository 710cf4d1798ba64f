"""Conditional updates and injected duplicates, as rewrites of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.draws import draw


def update_where(df: DataFrame, column: str, value: Column, condition: Column) -> DataFrame:
    """``UPDATE … SET column = value WHERE condition``: rows whose condition is
    false or unknown keep their value."""
    return df.withColumn(column, F.when(condition, value).otherwise(F.col(column)))


def lose_tracking_numbers(shipments: DataFrame, one_in: int = 5) -> DataFrame:
    """Blank the tracking number of one delivered shipment in ``one_in``."""
    drawn = draw("o_orderkey", 53, one_in) == 0
    return update_where(shipments, "tracking_number", F.lit(None).cast("string"),
                        (F.col("status") == "DELIVERED") & drawn)


def sample_rows(df: DataFrame, key: str, k: int, salt: int) -> DataFrame:
    """``k`` rows in the order of a draw on the key: a distributed top-k."""
    return df.orderBy(draw(key, salt, 1_000_000_007), F.col(key)).limit(k)


def inject_duplicates(df: DataFrame, key: str, k: int, salt: int) -> DataFrame:
    """The table with ``k`` of its own rows appended a second time."""
    return df.unionByName(sample_rows(df, key, k, salt))


def preview(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The first ``n`` rows by key, for looking at a result."""
    return df.orderBy(F.col(key).asc_nulls_last()).limit(n)
