"""Data metrics: named, mergeable aggregates over bound columns.

A metric is a few *parts* and a formula over them.  Each part says how the
values of two disjoint row sets combine (``sum``, ``max`` or, for distinct keys,
``keys``).  So one definition serves a single call, the fused measurement of a
table, the running history over its batches, and a stream.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.address import is_us_address


@dataclass(frozen=True)
class Part:
    merge: str                      # "sum", "max" or "keys"
    column: Column | None = None    # the aggregate, for "sum" and "max"
    keys: tuple[str, ...] = ()      # the key columns, for "keys"
    value: Column | None = None     # each row's value, for "max"; without it rows can't be taken back

    def aggregate(self) -> Column:
        return F.count_distinct(*[F.col(k) for k in self.keys]) if self.merge == "keys" else self.column


@dataclass(frozen=True)
class Metric:
    """``types`` is the declared signature, one SQL type (or ``any``) per bound
    column; a metric that takes any number of columns ends it with ``...``.
    ``parameters`` tell apart metrics of one name, such as two patterns."""

    name: str
    types: tuple[str, ...]
    parts: Callable[..., Sequence[Part]]
    finish: Callable[[Sequence[Column], Column], Column] = lambda parts, as_of: parts[0]
    parameters: tuple = ()

    @property
    def label(self) -> str:
        """The name in logs, with the parameters if there are any."""
        return f"{self.name}({', '.join(map(str, self.parameters))})" if self.parameters else self.name

    def bind(self, columns: Sequence[str]) -> Sequence[Part]:
        variadic = self.types[-1:] == ("...",)
        if (len(columns) < len(self.types) - 1) if variadic else (len(columns) != len(self.types)):
            raise ValueError(f"{self.name}{self.types} cannot be bound to {list(columns)}")
        return self.parts(*columns)

    def on(self, df: DataFrame, *columns: str, as_of: datetime | None = None, alias: str = "value") -> DataFrame:
        """Call the metric on a query; the answer is one row with one value."""
        parts = self.bind(columns)
        for column, declared in zip(columns, self.types):
            found = df.schema[column].dataType.simpleString()
            if declared not in ("any", "...", found):
                raise TypeError(f"{self.name} takes {declared}, but {column} is {found}")
        names = [f"part{i}" for i in range(len(parts))]
        raw = df.agg(*[p.aggregate().alias(n) for p, n in zip(parts, names)])
        return raw.select(self.finish([F.col(n) for n in names], moment(as_of)).alias(alias))


def moment(at: datetime | None) -> Column:
    """A timestamp without zone; text keeps the driver's own zone out of it."""
    return F.lit(None if at is None else at.isoformat(" ")).cast("timestamp_ntz")


def counting(name: str, types: Sequence[str], predicate: Callable[..., Column], *parameters) -> Metric:
    """A user-defined metric that counts the rows where a predicate is true.
    Rows for which it is unknown are not counted."""
    return Metric(name, tuple(types),
                  lambda *cols: [Part("sum", F.count_if(predicate(*[F.col(c) for c in cols])))], parameters=parameters)


def rate(name: str, types: Sequence[str], predicate: Callable[..., Column], *parameters) -> Metric:
    """Percentage of all rows where the predicate is true; NULL without rows."""
    return Metric(
        name, tuple(types),
        lambda *cols: [Part("sum", F.count_if(predicate(*[F.col(c) for c in cols]))), Part("sum", F.count("*"))],
        lambda p, as_of: p[0].cast("double") * 100 / F.nullif(p[1].cast("double"), F.lit(0.0)), parameters)


def _all_present(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


NULL_COUNT = counting("NULL_COUNT", ["any"], lambda c: c.isNull())

# Excess rows: how many rows would have to go for the key to become unique.
DUPLICATE_COUNT = Metric(
    "DUPLICATE_COUNT", ("any", "..."),
    lambda *cols: [Part("sum", F.count_if(_all_present(cols))), Part("keys", keys=tuple(cols))],
    lambda p, as_of: p[0] - p[1])

# Seconds from the newest value to the moment of measurement.
FRESHNESS = Metric(
    "FRESHNESS", ("any",),
    lambda c: [Part("max", F.max(F.col(c).cast("timestamp_ntz")), value=F.col(c).cast("timestamp_ntz"))],
    lambda p, as_of: F.timestamp_diff("SECOND", p[0], as_of))

NEGATIVE_TOTAL_COUNT = counting("NEGATIVE_TOTAL_COUNT", ["double"], lambda c: c < 0)

SUSPICIOUS_ADDRESS_COUNT = counting(
    "SUSPICIOUS_ADDRESS_COUNT", ["string"], lambda c: c.isNotNull() & ~is_us_address(c))

ROW_COUNT = Metric("ROW_COUNT", ("any",), lambda c: [Part("sum", F.count("*"))])

FILL_RATE = rate("FILL_RATE", ["any"], lambda c: c.isNotNull())


def not_matching(pattern: str) -> Metric:
    return counting("NOT_MATCHING_COUNT", ["string"], lambda c: ~c.rlike(pattern), pattern)


def not_accepted(values: Sequence[str]) -> Metric:
    return counting("NOT_ACCEPTED_COUNT", ["string"], lambda c: ~c.isin(*values), *values)


def outlier(floor: float, ceiling: float) -> Metric:
    """At or below ``floor``, or at or above ``ceiling``."""
    return counting("OUTLIER_COUNT", ["double"], lambda c: (c <= floor) | (c >= ceiling), floor, ceiling)


def below(bound: float) -> Metric:
    return counting("BELOW_COUNT", ["any"], lambda c: c < bound, bound)


def null_where(value: str) -> Metric:
    """Rows whose first column equals ``value`` and whose second is NULL."""
    return counting("NULL_WHERE_COUNT", ["string", "any"], lambda s, c: (s == value) & c.isNull(), value)


def later_than(day: date) -> Metric:
    return counting("LATER_THAN_COUNT", ["date"], lambda c: c > F.lit(day), day)


def product_mismatch(tolerance: float) -> Metric:
    """Totals that differ from quantity × price by more than ``tolerance``."""
    return counting("PRODUCT_MISMATCH_COUNT", ["double", "int", "double"],
                    lambda total, q, p: F.abs(total - q * p) > tolerance, tolerance)


class Registry:
    """Known metrics by name, parameters and signature."""

    def __init__(self, *metrics: Metric):
        self._metrics = {self._key(m): m for m in metrics}

    @staticmethod
    def _key(metric: Metric) -> tuple:
        return metric.name, metric.types, metric.parameters

    def create(self, metric: Metric, replace: bool = False) -> Metric:
        if not replace and self._key(metric) in self._metrics:
            raise ValueError(f"{metric.label}{metric.types} exists")
        self._metrics[self._key(metric)] = metric
        return metric

    def get(self, name: str, *types: str, parameters: tuple = ()) -> Metric:
        return self._metrics[name, types, parameters]

    def remove(self, name: str, *types: str, parameters: tuple = ()) -> None:
        del self._metrics[name, types, parameters]

    def __iter__(self):
        return iter(self._metrics.values())


REGISTRY = Registry(NULL_COUNT, DUPLICATE_COUNT, FRESHNESS, NEGATIVE_TOTAL_COUNT,
                    SUSPICIOUS_ADDRESS_COUNT, ROW_COUNT, FILL_RATE)
