"""Referential checks between tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _counted(df: DataFrame, key: str, *by: str) -> DataFrame:
    """Rows per key.  Joining counts instead of rows keeps a very frequent key
    from piling up in one task."""
    return df.dropna(subset=[key]).groupBy(key, *by).agg(F.count("*").alias("n"))


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Key values of ``child`` that ``parent`` lacks, with their row counts.  A
    NULL refers to nothing and is not an orphan."""
    return _counted(child, key).join(parent.select(key).distinct(), key, "left_anti")


def orphan_count(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return orphans(child, parent, key).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"), F.count("*").alias("orphan_keys"))


def referenced(child: DataFrame, parent: DataFrame, key: str, by: str) -> DataFrame:
    """Rows of ``child`` with a parent, counted per value of ``by``.  One exchange
    per side: a semi join needs no distinct keys, and as both sides are plain
    exchanges, AQE splits a very frequent key."""
    kept = child.dropna(subset=[key]).select(key, by).join(parent.select(key), key, "left_semi")
    return kept.groupBy(by).agg(F.count("*").alias("rows"))


def duplicate_variants(df: DataFrame, key: str) -> DataFrame:
    """Three readings of "duplicates": rows too many, keys that repeat, and all
    rows of repeating keys."""
    repeated = F.col("n") > 1
    return _counted(df, key).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("excess_rows"),
        F.count_if(repeated).alias("duplicated_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias("rows_in_duplicate_groups"))


def nearest_value(column, accepted):
    """The accepted value with the smallest edit distance; ties go to the first
    by name.  The list is short configuration, so this is a plain expression."""
    candidates = [F.struct(F.levenshtein(column, F.lit(v)).alias("distance"), F.lit(v).alias("value"))
                  for v in accepted]
    return F.when(column.isNotNull(), F.least(*candidates)["value"])
