"""What changed between two versions of a table, and results that take rows back.

Changes are net: a row of the table with ``change``, the number of copies that
came (positive) or went (negative).  An updated row went as it was and came as
it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.dedup import first_per_key

CHANGE = "change"


def digest(columns: list[str]) -> list[Column]:
    """128 bits of a row.  NULLs are marked, since the hash function skips them:
    otherwise (1, 'a', NULL) and (1, NULL, 'a') would be one row."""
    marked = [x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return [F.xxhash64(F.lit(1), *marked).alias("_digest_a"), F.xxhash64(*marked, F.lit(2)).alias("_digest_b")]


DIGEST = ["_digest_a", "_digest_b"]


def captured(before: DataFrame, after: DataFrame) -> DataFrame:
    """The net changes from ``before`` to ``after`` (same columns).

    Versions are compared by digests alone: 16 bytes a row cross the network,
    counted within the tasks first, so that a row with very many copies is one
    record of each task.  Only rows whose number changed are fetched as they are.
    """
    columns = before.columns
    count = before.select(*digest(columns), F.lit(-1).alias(CHANGE)).unionByName(
        after.select(*columns).select(*digest(columns), F.lit(1).alias(CHANGE)))
    changed = count.groupBy(*DIGEST).agg(F.sum(CHANGE).alias(CHANGE)).filter(F.col(CHANGE) != 0)

    def fetched(version: DataFrame, side: DataFrame) -> DataFrame:
        rows = version.select(*columns, *digest(columns)).join(side, DIGEST, "left_semi")
        return rows.groupBy(*DIGEST).agg(F.any_value(F.struct(*[F.col(f"`{c}`") for c in columns])).alias("row")) \
            .join(side, DIGEST).select("row.*", CHANGE)

    return fetched(before, changed.filter(F.col(CHANGE) < 0)).unionByName(fetched(after.select(*columns), changed.filter(F.col(CHANGE) > 0)))


def same(left: str, right: str, names: list[str]) -> Column:
    """Equality of some columns of two aliased tables, NULLs equal."""
    out = F.lit(True)
    for c in names:
        out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def lost_keys(winners: DataFrame, changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys whose winner is among the rows that went.  (Another copy of it may
    have stayed; reading the key again settles that.)"""
    gone = changes.filter(F.col(CHANGE) < 0).select(F.col(key), *digest(columns)).distinct()
    return winners.select(F.col(key), *digest(columns)).join(gone, DIGEST, "left_semi").select(key)


def of_keys(rows: DataFrame, keys: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    return rows.alias("l").join(keys.select(F.col(key).alias(key)).distinct().alias("r"), same("l", "r", [key]), how)


def first_per_key_after(winners: DataFrame, changes: DataFrame, after: DataFrame, key: str, order_by: str) -> DataFrame:
    """``first_per_key(after)`` from the winners before and the changes.

    A minimum follows rows that come, but not rows that go.  So only keys whose
    winner went are read again from the table; all other keys compare their
    winner with what came, and keys without changes pass through.
    """
    columns = winners.columns
    lost = lost_keys(winners, changes, key, columns)
    came = of_keys(changes.filter(F.col(CHANGE) > 0).select(*columns), lost, key, "left_anti")
    stayed = of_keys(winners, lost, key, "left_anti")
    touched = of_keys(stayed, came, key)
    return (of_keys(stayed, came, key, "left_anti")
            .unionByName(first_per_key(touched.unionByName(came), key, order_by))
            .unionByName(first_per_key(of_keys(after.select(*columns), lost, key), key, order_by)))
