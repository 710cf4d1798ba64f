"""Reproducible pseudo-random draws.

A draw is a pure function of a row key and a salt, so a lost task that is run
again yields the same rows, and a second engine can compute the same values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# A Mersenne prime, a multiplicative constant, a second prime and
# the stride between salts.
MERSENNE = 2147483647
MULTIPLIER = 2654435761
PRIME = 4294967291
STRIDE = 1000003


def draw_sql(key: str, salt: int, n: int | str) -> str:
    """An integer in ``[0, n)`` as SQL text.  Reducing the key first keeps every
    step inside a bigint for any bigint key."""
    start = f"(({key} + {salt * STRIDE}) % {MERSENNE})"
    return f"(({start} * {start}) % {MERSENNE} * {MULTIPLIER} % {PRIME} % {n})"


def draw(key: str, salt: int, n: int | str) -> Column:
    """An integer in ``[0, n)`` from a bigint column."""
    return F.expr(draw_sql(key, salt, n))


def uniform(key: str, salt: int, low: int, high: int) -> Column:
    """An integer in ``[low, high]``."""
    return F.lit(low) + draw(key, salt, high - low + 1)


def pick(key: str, salt: int, values: Sequence[str]) -> Column:
    """One of ``values``, all equally likely."""
    choice = F.array(*[F.lit(v) for v in values])
    return F.element_at(choice, (draw(key, salt, len(values)) + 1).cast("int"))


def identifier(prefix: str, key: Column) -> Column:
    """``PREFIX-00000042``; wider keys keep all their digits (a plain ``lpad``
    would cut them and make different keys equal)."""
    digits = key.cast("string")
    return F.concat(
        F.lit(f"{prefix}-"),
        F.when(F.length(digits) < 8, F.lpad(digits, 8, "0")).otherwise(digits),
    )


def identifier_sql(prefix: str, key: str) -> str:
    digits = f"cast({key} as varchar)"
    return (f"concat('{prefix}-', case when length({digits}) < 8 "
            f"then lpad({digits}, 8, '0') else {digits} end)")
