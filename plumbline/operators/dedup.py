"""One row per key, chosen by a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_per_key(df: DataFrame, key: str, order_by: str, keep: Sequence[str] | None = None) -> DataFrame:
    """For every key the row with the smallest ``order_by``.

    NULLs come last in ``order_by``; ties are broken by the remaining columns in
    table order, NULLs first, so the result does not depend on arrival order.
    The minimum of a struct is an ordinary aggregate: tasks reduce each key to
    one row before the shuffle, so a key with very many rows stays cheap, and
    the minimum of minima is the minimum, which incremental refresh relies on.
    ``keep`` restricts the columns read and returned.
    """
    columns = list(keep) if keep is not None else df.columns
    rest = [c for c in columns if c not in (key, order_by)]
    row = F.struct(F.col(order_by).isNull().alias("is_last"), F.col(order_by), *[F.col(c) for c in rest])
    best = df.groupBy(key).agg(F.min(row).alias("best"))
    return best.select(*[F.col(key) if c == key else F.col(f"best.{c}").alias(c) for c in columns])


def merge_first(base: DataFrame, changes: DataFrame, key: str, order_by: str) -> DataFrame:
    """``first_per_key`` over both, where ``base`` already has one row per key.

    Only keys that changed are compared again; all other rows of ``base`` pass
    through unshuffled when Spark finds the changed keys small enough to
    broadcast, and through an ordinary join otherwise.
    """
    changed = changes.select(F.col(key).alias("changed_key")).distinct()
    same_key = base[key].eqNullSafe(changed["changed_key"])
    touched = base.join(changed, same_key, "left_semi")
    untouched = base.join(changed, same_key, "left_anti")
    return untouched.unionByName(first_per_key(touched.unionByName(changes), key, order_by))


def first_per_key_by_rank(df: DataFrame, key: str, order_by: str) -> DataFrame:
    """The same rows by ``row_number() = 1``.  Spark also prunes this form to
    one row per key and task ahead of the shuffle, but it is batch only."""
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in (key, order_by)]
    order: list[Column] = [F.col(order_by).asc_nulls_last(), *rest]
    ranked = df.withColumn("rn", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.filter("rn = 1").drop("rn")
