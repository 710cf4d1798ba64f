"""Columns of a table set aside under names of our own, so that none can clash with the operators'."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def aside(docs: DataFrame, *replaced: str) -> tuple[list[Column], list[Column]]:
    """(all columns but the replaced ones as _c0, _c1 …, and those back under their own names)."""
    kept = [c for c in docs.columns if c not in replaced]
    return ([F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(kept)],
            [F.col(f"_c{i}").alias(c) for i, c in enumerate(kept)])


def renamed(docs: DataFrame) -> tuple[DataFrame, dict[str, str], list[Column]]:
    """(the table with columns _c0, _c1 …, name to new name, and the columns back under their own names)."""
    away, back = aside(docs)
    return docs.select(*away), {c: f"_c{i}" for i, c in enumerate(docs.columns)}, back


def row_hashes(*columns: str) -> list[Column]:
    """128 bits of some columns as two numbers.  The hash function skips NULLs; the second number marks them,
    otherwise (1, 'a', NULL) and (1, NULL, 'a') would be equal."""
    marked = [x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return [F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.xxhash64(*marked)]
