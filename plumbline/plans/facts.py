"""Requests over several fact tables that refer to shared tables, over any number of hops.

Tables are nodes, many-to-one references are edges.  A dimension is found along
the shortest path from a fact to its table; two shortest paths are ambiguous and
refused.  Every fact is summed by the requested dimensions on its own and only
the sums meet, so joining shipments and orders can't count either of them twice.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.dedup import first_per_key
from plumbline.plans.semantic import Dimension, flag, per_hundred
from plumbline.session import written


@dataclass(frozen=True)
class Reference:
    """Many rows of ``table`` refer by ``key`` to one row of ``to_table``; of
    several rows with one key the one with the smallest ``order_by`` counts."""

    table: str
    to_table: str
    key: str
    order_by: str


@dataclass(frozen=True)
class Measure:
    table: str
    expression: str     # a number per row; its sum is the measure


@dataclass(frozen=True)
class FactModel:
    references: Sequence[Reference]
    dimensions: Mapping[str, Dimension]
    measures: Mapping[str, Measure]
    metrics: Mapping[str, str]          # SQL over measures, also over those of several facts
    tables: Mapping[str, DataFrame] = field(default_factory=dict)

    def bind(self, **tables: DataFrame) -> FactModel:
        return FactModel(self.references, self.dimensions, self.measures, self.metrics, tables)

    # -- paths -------------------------------------------------------------------

    def path(self, table: str, to_table: str) -> tuple[Reference, ...]:
        """The references from one table to the other, the fewest there are."""
        paths: list[tuple[Reference, ...]] = [()]
        for _ in range(len(self.references) + 1):
            ends = [p for p in paths if (p[-1].to_table if p else table) == to_table]
            if len(ends) > 1:
                raise ValueError(f"{len(ends)} paths lead from {table} to {to_table}: {ends}")
            if ends:
                return ends[0]
            paths = [(*p, r) for p in paths for r in self.references
                     if r.table == (p[-1].to_table if p else table) and r not in p]
        raise KeyError(f"no path leads from {table} to {to_table}")

    def _steps(self, table: str, dims: Sequence[str]) -> dict[Reference, list[str]]:
        """The first reference to follow for each dimension that is not the table's own."""
        steps: dict[Reference, list[str]] = {}
        for d in dims:
            path = self.path(table, self.dimensions[d].table)
            if path:
                steps.setdefault(path[0], []).append(d)
        return steps

    # -- tables with dimensions ----------------------------------------------------

    def _with_dimensions(self, rows: DataFrame, table: str, dims: Sequence[str], keep: Sequence[str]) -> DataFrame:
        """``keep`` and the dimensions, for rows of ``table`` that still have all their columns.

        A lookup is stored before it is joined: Spark knows its size, broadcasts
        it if it is small, and else can split a very frequent key.  Rows without
        a key match nothing and are spread by a number of their own.
        """
        steps = self._steps(table, dims)
        own = [d for d in dims if self.dimensions[d].table == table]
        out = rows.select(*keep, *[F.col(self.dimensions[d].column).alias(f"_dim_{d}") for d in own],
                          *[F.col(r.key).alias(f"_ref{i}") for i, r in enumerate(steps)])
        for i, (r, wanted) in enumerate(steps.items()):
            lookup = written(self._lookup(r, wanted).withColumnRenamed(r.key, f"_key{i}").withColumn(f"_none{i}", F.lit(0)), f"lookup-{r.to_table}")
            spread = F.when(F.col(f"_ref{i}").isNull(), F.pmod(F.xxhash64(*[F.col(c) for c in out.columns]), F.lit(1 << 16))).otherwise(0).cast("int")
            out = out.withColumn(f"_spread{i}", spread)
            out = out.join(lookup, (F.col(f"_ref{i}") == F.col(f"_key{i}")) & (F.col(f"_spread{i}") == F.col(f"_none{i}")), "left")
        return out.select(*keep, *[f"_dim_{d}" for d in dims])

    def _lookup(self, r: Reference, dims: Sequence[str]) -> DataFrame:
        """One row for each key of the referenced table, with dimensions from there and beyond."""
        columns = [self.dimensions[d].column for d in dims if self.dimensions[d].table == r.to_table]
        columns += [x.key for x in self._steps(r.to_table, dims)]
        keep = list(dict.fromkeys([r.key, r.order_by, *columns]))
        one = first_per_key(self.tables[r.to_table].dropna(subset=[r.key]), r.key, r.order_by, keep)
        return self._with_dimensions(one, r.to_table, dims, [r.key])

    # -- requests ---------------------------------------------------------------------

    def sums(self, measures: Sequence[str], dims: Sequence[str], where: Mapping[str, str] | None = None) -> DataFrame:
        """The measures by dimensions: each fact summed first, then the sums of all facts brought together."""
        where = dict(where or {})
        asked = list(dict.fromkeys([*dims, *where]))
        of_facts = None
        for table in dict.fromkeys(self.measures[m].table for m in measures):
            mine = [m for m in measures if self.measures[m].table == table]
            rows = self.tables[table].select("*", *[F.expr(self.measures[m].expression).alias(f"_sum_{m}") for m in mine])
            rows = self._with_dimensions(rows, table, asked, [f"_sum_{m}" for m in mine])
            rows = rows.select(*[F.col(f"_dim_{d}").alias(d) for d in asked], *[F.col(f"_sum_{m}").alias(m) for m in mine])
            for predicate in where.values():
                rows = rows.filter(predicate)
            one = rows.groupBy(*dims).agg(*[F.sum(m).alias(m) for m in mine])
            of_facts = one if of_facts is None else of_facts.unionByName(one, allowMissingColumns=True)
        return of_facts.groupBy(*dims).agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])

    def query(self, metrics: Sequence[str], dims: Sequence[str] = (), where: Mapping[str, str] | None = None) -> DataFrame:
        words = set(re.findall(r"\w+", " ".join(self.metrics[m] for m in metrics)))
        totals = self.sums([m for m in self.measures if m in words], dims, where)
        return totals.select(*dims, *[F.expr(self.metrics[m]).alias(m) for m in metrics])


SHOP = FactModel(
    references=[Reference("shipments", "orders", "order_id", "order_date"),
                Reference("orders", "customers", "customer_id", "signup_date")],
    dimensions={
        "carrier": Dimension("shipments", "carrier"),
        "region": Dimension("orders", "region"),
        "quality_status": Dimension("orders", "quality_status"),
        "tier": Dimension("customers", "tier"),
    },
    measures={
        "n_orders": Measure("orders", "1L"),
        "n_rejected": Measure("orders", flag("quality_status = 'REJECTED'")),
        "n_shipments": Measure("shipments", "1L"),
        "n_late": Measure("shipments", flag("actual_delivery > estimated_delivery")),
        "n_untracked": Measure("shipments", flag("tracking_number is null")),
        "n_customers": Measure("customers", "1L"),
    },
    metrics={
        "total_orders": "n_orders",
        "rejected_count": "n_rejected",
        "total_shipments": "n_shipments",
        "late_shipments": "n_late",
        "late_rate": per_hundred("n_late", "n_shipments"),
        "untracked_count": "n_untracked",
        "customer_rows": "n_customers",
        "shipments_per_order": "round(cast(n_shipments as double) / nullif(cast(n_orders as double), 0D), 3)",
    })
