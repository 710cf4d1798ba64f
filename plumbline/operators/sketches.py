"""Distinct keys after each batch, estimated from mergeable sketches.

Every batch is reduced to one sketch of its keys (HyperLogLog, ``2 ** size``
registers), in one aggregate by batch whose shuffle carries sketches and no keys.
The sketch of the table after a batch is the union of those so far: a window over
one row per batch.  Stored sketches of old batches can be unioned with new ones at
any time, so earlier rows are never read again.

The standard error of an estimate is ``1.04 / sqrt(2 ** size)``; ``bound`` gives
the relative error that three of them make.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def bound(size: int = 12) -> float:
    return 3 * 1.04 / sqrt(2 ** size)


def batch_sketches(df: DataFrame, keys: Sequence[str], batch: Column, size: int = 12) -> DataFrame:
    """(batch, sketch) of the keys in each batch; a key with a NULL is none."""
    rows = df.dropna(subset=list(keys)).select(batch.alias("batch"), F.xxhash64(*keys).alias("key"))
    return rows.groupBy("batch").agg(F.hll_sketch_agg("key", F.lit(size)).alias("sketch"))


def running_estimates(sketches: DataFrame) -> DataFrame:
    """(batch, estimate): distinct keys in all batches up to this one; an unknown batch is the earliest."""
    so_far = Window.orderBy(F.col("batch").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    return sketches.select("batch", F.hll_sketch_estimate(F.hll_union_agg("sketch").over(so_far)).alias("estimate"))
