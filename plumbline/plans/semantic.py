"""A semantic model: metrics by any dimensions, without writing the query."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.dedup import first_per_key
from plumbline.plans.validate import SOFT_RULES
from plumbline.session import written


OWN = "_own_key"        # the base table's key on its way through the joins


@dataclass(frozen=True)
class Relationship:
    """Many rows of the base table refer to one row of ``to_table`` by ``key``."""

    to_table: str
    key: str
    # Copies of a key are reduced to the row with the smallest value here.
    order_by: str


@dataclass(frozen=True)
class Dimension:
    table: str
    column: str


@dataclass
class SemanticModel:
    """``measures`` are sums over rows of the base table (SQL expressions that
    yield a number per row); ``metrics`` are SQL expressions over measures.

    Neither a very frequent key nor the rows without a key pile up in one task;
    see ``_joined``.
    """

    base: str
    relationships: Sequence[Relationship]
    facts: Mapping[str, str]
    dimensions: Mapping[str, Dimension]
    measures: Mapping[str, str]
    metrics: Mapping[str, str]
    base_key: str = "order_id"
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def bind(self, **tables: DataFrame) -> SemanticModel:
        return SemanticModel(self.base, self.relationships, self.facts, self.dimensions,
                             self.measures, self.metrics, self.base_key, tables)

    # -- resolution --------------------------------------------------------------

    def _foreign(self, dims: Sequence[str]) -> list[Relationship]:
        """Only the relationships that a requested dimension needs."""
        unknown = [d for d in dims if d not in self.dimensions]
        if unknown:
            raise KeyError(f"unknown dimensions {unknown}")
        needed = {self.dimensions[d].table for d in dims}
        return [r for r in self.relationships if r.to_table in needed]

    def _local(self, dims: Sequence[str]) -> list[str]:
        return [d for d in dims if self.dimensions[d].table == self.base]

    def _lookup(self, relationship: Relationship, dims: Sequence[str]) -> DataFrame:
        """The referenced table with one row per key, so that joining it cannot
        multiply rows, cut down to the requested dimensions."""
        wanted = {d: self.dimensions[d].column for d in dims
                  if self.dimensions[d].table == relationship.to_table}
        keep = [relationship.key, relationship.order_by, *dict.fromkeys(wanted.values())]
        one = first_per_key(self.tables[relationship.to_table].dropna(subset=[relationship.key]),
                            relationship.key, relationship.order_by, list(dict.fromkeys(keep)))
        return one.select(relationship.key, *[F.col(c).alias(d) for d, c in wanted.items()])

    def measures_of(self, metrics: Sequence[str]) -> list[str]:
        words = set(re.findall(r"\w+", " ".join(self.metrics[m] for m in metrics)))
        return [m for m in self.measures if m in words]

    def _joined(self, rows: DataFrame, foreign: Sequence[Relationship], dims: Sequence[str]) -> DataFrame:
        """``rows`` with the dimensions of other tables.

        Each lookup is stored first.  So Spark knows its size and broadcasts it
        if it is small; otherwise both sides of the join are plain exchanges and
        AQE splits a very frequent key.  Rows without a key match nothing; a
        number drawn from the row's own key spreads them over all tasks.  (The other
        side's number comes from its file: as a constant it would be optimised
        out of the join keys.)
        """
        for i, r in enumerate(foreign):
            lookup = self._lookup(r, dims).withColumnRenamed(r.key, f"_key{i}").withColumn(f"_spread{i}", F.lit(0))
            lookup = written(lookup, f"lookup-{r.to_table}")
            spread = F.when(F.col(r.key).isNull(), F.pmod(F.xxhash64(OWN), F.lit(1 << 16))).otherwise(0).cast("int")
            rows = rows.withColumn(f"_row{i}", spread)
            on = (F.col(r.key) == F.col(f"_key{i}")) & (F.col(f"_row{i}") == F.col(f"_spread{i}"))
            rows = rows.join(lookup, on, "left").drop(f"_key{i}", f"_spread{i}", f"_row{i}")
        return rows

    # -- requests ----------------------------------------------------------------

    def sums(self, measures: Sequence[str], dims: Sequence[str] = (), where: Mapping[str, str] | None = None,
             grouping_sets: Sequence[Sequence[str]] | None = None) -> DataFrame:
        """The measures by dimensions.  The rows cross the network once for each
        join that a dimension needs, cut down to the columns asked for; what
        comes after is reduced within the tasks before it is exchanged."""
        where = dict(where or {})
        asked = list(dict.fromkeys([*dims, *where]))
        foreign, local = self._foreign(asked), self._local(asked)
        own = [F.col(self.base_key).alias(OWN)] if foreign else []
        rows = self.tables[self.base].select(
            *own, *[F.col(r.key) for r in foreign], *[F.col(self.dimensions[d].column).alias(d) for d in local],
            *[F.expr(self.measures[m]).alias(m) for m in measures])
        for d in local:
            if d in where:
                rows = rows.filter(where[d])
        rows = self._joined(rows, foreign, asked)
        for d in asked:
            if d in where and d not in local:
                rows = rows.filter(where[d])
        return self.grouped(rows, measures, dims, grouping_sets)

    def grouped(self, rows: DataFrame, measures: Sequence[str], dims: Sequence[str] = (),
                grouping_sets: Sequence[Sequence[str]] | None = None) -> DataFrame:
        """Sums of rows that hold the dimensions and the measures by name."""
        marks: list[Column] = []
        if grouping_sets:
            # Sums of the finest groups first: the sets expand these, not the rows.
            rows = rows.groupBy(*dims).agg(*[F.sum(m).alias(m) for m in measures])
            sets = [[F.col(d) for d in one] for one in grouping_sets]
            marks = [F.grouping(d).cast("int").alias(f"grouping_{d}") for d in dims]
            grouped = rows.groupingSets(sets, *[F.col(d) for d in dims])
        else:
            grouped = rows.groupBy(*dims)
        totals = grouped.agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures], *marks)
        return totals.select(*dims, *[f"grouping_{d}" for d in dims if marks], *measures)

    def query(self, metrics: Sequence[str], dims: Sequence[str] = (),
              where: Mapping[str, str] | None = None,
              grouping_sets: Sequence[Sequence[str]] | None = None) -> DataFrame:
        """``where`` maps a dimension to a SQL predicate on it.  With
        ``grouping_sets`` the answer holds one block of rows per set, told apart
        by ``grouping_<dimension>`` (1 where the dimension is summed over)."""
        return self.computed(self.sums(self.measures_of(metrics), dims, where, grouping_sets), metrics)

    def computed(self, totals: DataFrame, metrics: Sequence[str]) -> DataFrame:
        """The metrics from sums of the measures."""
        groups = [c for c in totals.columns if c not in self.measures]
        return totals.select(*groups, *[F.expr(self.metrics[m]).alias(m) for m in metrics])

    def query_rows(self, facts: Sequence[str], dims: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
        """Row-level facts with dimensions."""
        foreign = self._foreign(dims)
        columns = [F.col(self.base_key).alias(OWN), *[F.col(c) for c in dict.fromkeys([*keep, *[r.key for r in foreign]])]]
        rows = self.tables[self.base].select(
            *columns, *[F.col(self.dimensions[d].column).alias(d) for d in self._local(dims)],
            *[F.expr(self.facts[f]).alias(f) for f in facts])
        return self._joined(rows, foreign, dims).select(*keep, *dims, *facts)


def flag(predicate: str) -> str:
    """A measure that counts the rows where ``predicate`` is true."""
    return f"cast(coalesce({predicate}, false) as bigint)"


def per_hundred(part: str, whole: str) -> str:
    return f"round(cast({part} as double) * 100 / nullif(cast({whole} as double), 0D), 2)"


ORDER_QUALITY = SemanticModel(
    base="orders",
    relationships=[Relationship("customers", "customer_id", "signup_date")],
    facts={"order_total": "order_total", "quality_score": "quality_score"},
    dimensions={
        "region": Dimension("orders", "region"),
        "quality_status": Dimension("orders", "quality_status"),
        "status": Dimension("orders", "status"),
        "tier": Dimension("customers", "tier"),
    },
    measures={
        "n_rows": "1L",
        "n_orders": flag("order_id is not null"),
        "n_clean": flag("quality_status = 'CLEAN'"),
        "n_rejected": flag("quality_status = 'REJECTED'"),
        "n_review": flag("quality_status = 'REVIEW_NEEDED'"),
        "n_scored": flag("quality_score is not null"),
        "sum_score": "cast(coalesce(quality_score, 0) as bigint)",
        "n_null_customer": flag("customer_id is null"),
        "n_negative": flag("order_total < 0"),
        **{f"n_{r.name}": flag(r.predicate) for r in SOFT_RULES},
    },
    metrics={
        "total_orders": "n_orders",
        "clean_order_count": "n_clean",
        "rejected_count": "n_rejected",
        "review_needed_count": "n_review",
        "clean_order_rate": per_hundred("n_clean", "n_orders"),
        "avg_quality_score": "round(cast(sum_score as double) / nullif(cast(n_scored as double), 0D), 1)",
        "null_customer_count": "n_null_customer",
        "negative_total_count": "n_negative",
        "null_customer_rate": per_hundred("n_null_customer", "n_orders"),
        "rejection_rate": per_hundred("n_rejected", "n_orders"),
    })
ALL_METRICS = tuple(ORDER_QUALITY.metrics)
