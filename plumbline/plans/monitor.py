"""Monitors: metrics attached to a table, measured together, judged, recorded."""

from __future__ import annotations

import hashlib

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.functions.metrics import Metric, Part, moment
from plumbline.sources import schemas

TABLE_COLUMNS = ("table_database", "table_schema", "table_name")


@dataclass(frozen=True)
class Expectation:
    """A named SQL predicate over ``value``."""

    name: str
    predicate: str


@dataclass
class Association:
    metric: Metric
    columns: tuple[str, ...]
    parts: tuple[Part, ...]
    expectations: list[Expectation] = field(default_factory=list)

    @property
    def column_list(self) -> str:
        return ",".join(self.columns)

    @property
    def part_names(self) -> list[str]:
        """Names that stay with metric and columns, whatever else is attached."""
        own = hashlib.md5(f"{self.metric.label}|{self.metric.types}|{self.column_list}".encode()).hexdigest()[:16]
        return [f"p{own}_{j}" for j in range(len(self.parts))]


class Monitor:
    """What is measured on one table (``database.schema.table``).

    A monitor is configuration: every method that takes a DataFrame returns a
    lazy DataFrame, and the attached metrics are measured together.
    """

    def __init__(self, table: str):
        self.table = table
        self.database, self.schema, self.name = table.split(".")
        self.associations: list[Association] = []

    # -- configuration ---------------------------------------------------------

    def _find(self, metric: Metric, on: Sequence[str]) -> Association | None:
        return next((a for a in self.associations
                     if a.metric.label == metric.label and a.columns == tuple(on)), None)

    def attach(self, metric: Metric, on: Sequence[str]) -> Monitor:
        if self._find(metric, on):
            raise ValueError(f"{metric.label} is already attached to {list(on)}")
        self.associations.append(Association(metric, tuple(on), tuple(metric.bind(on))))
        return self

    def detach(self, metric: Metric, on: Sequence[str]) -> Monitor:
        self.associations.remove(self._require(metric, on))
        return self

    def expect(self, metric: Metric, on: Sequence[str], name: str, predicate: str) -> Monitor:
        self._require(metric, on).expectations.append(Expectation(name, predicate))
        return self

    def _require(self, metric: Metric, on: Sequence[str]) -> Association:
        found = self._find(metric, on)
        if found is None:
            raise ValueError(f"{metric.label} is not attached to {list(on)}")
        return found

    # -- parts -----------------------------------------------------------------

    def parts(self) -> dict[str, Part]:
        """Every part of every attached metric under a column name."""
        return {name: part for a in self.associations for name, part in zip(a.part_names, a.parts)}

    def _value(self, i: int, as_of: Column) -> Column:
        a = self.associations[i]
        return a.metric.finish([F.col(name) for name in a.part_names], as_of).cast("double")

    def long_form(self, wide: DataFrame, measured_at: Column, only: Sequence[int] | None = None) -> DataFrame:
        """From one row with all parts to one row per association."""
        chosen = range(len(self.associations)) if only is None else only
        rows = [F.struct(F.lit(self.associations[i].metric.label).alias("metric_name"),
                         F.lit(self.associations[i].column_list).alias("columns"),
                         self._value(i, measured_at).alias("value"),
                         measured_at.alias("measurement_time")) for i in chosen]
        long = wide.select(F.inline(F.array(*rows)))
        place = [F.lit(v).alias(c) for c, v in zip(TABLE_COLUMNS, (self.database, self.schema, self.name))]
        return schemas.conform(long.select(*place, "*"), schemas.RESULTS)

    # -- measuring -------------------------------------------------------------

    def measure(self, df: DataFrame, as_of: datetime) -> DataFrame:
        """The current value of every attached metric, as rows of the result log.

        All metrics without keys share one scan and one aggregate, which sends a
        single row per task.  Distinct keys have to be shuffled, so the metrics
        of a key set share an aggregate of their own: its shuffle carries the
        keys and nothing else, and its scan reads only the key columns.
        """
        together: dict[tuple[str, ...], list[int]] = {}
        for i, a in enumerate(self.associations):
            together.setdefault(next((p.keys for p in a.parts if p.keys), ()), []).append(i)
        measured = None
        for chosen in together.values():
            aggregates = [p.aggregate().alias(name) for i in chosen
                          for name, p in zip(self.associations[i].part_names, self.associations[i].parts)]
            long = self.long_form(df.agg(*aggregates), moment(as_of), chosen)
            measured = long if measured is None else measured.unionByName(long)
        if measured is None:
            raise ValueError(f"nothing is attached to {self.table}")
        return measured

    def statuses(self, results: DataFrame) -> DataFrame:
        """Judge this table's result rows: one row per expectation, with the verdict.

        The pairing of metrics and expectations is known beforehand, so it is a
        projection and not a join.  A value that is unknown violates nothing,
        but the row says that it was not ``evaluated``.
        """
        judged, verdicts = [], []
        for a in self.associations:
            if not a.expectations:
                continue
            mine = (F.col("metric_name") == a.metric.label) & (F.col("columns") == a.column_list)
            tests = []
            for e in a.expectations:
                tests.append(F.struct(F.lit(len(verdicts)).alias("slot"),
                                      F.lit(e.name).alias("expectation_name"),
                                      F.lit(e.predicate).alias("expression")))
                verdicts.append(F.when(F.col("slot") == len(verdicts), F.expr(e.predicate)))
            judged.append(F.when(mine, F.array(*tests)))
        if not judged:
            raise ValueError(f"nothing is expected of {self.table}")
        paired = self.of_this_table(results).select("*", F.inline(F.coalesce(*judged)))
        met = F.coalesce(*verdicts)
        return schemas.conform(paired.select(
            "*", met.isNotNull().alias("evaluated"), F.coalesce(~met, F.lit(False)).alias("violated"),
        ), schemas.STATUSES)

    def evaluate(self, df: DataFrame, as_of: datetime) -> DataFrame:
        """Measure and judge at once, in the same plan."""
        return self.statuses(self.measure(df, as_of))

    # -- history ---------------------------------------------------------------

    def batch_parts(self, df: DataFrame, batch: Column) -> DataFrame:
        """For every batch, the parts of its own rows.

        A distinct key counts in the batch where it appears first.  That is an
        aggregate per key and then per batch; no rows are ranked, so a key with
        very many rows is reduced before it is shuffled.
        """
        rows = df.withColumn("batch", batch)
        parts = self.parts()
        plain = {n: p for n, p in parts.items() if not p.keys}
        measures = rows.groupBy("batch").agg(*[p.column.alias(n) for n, p in plain.items()])
        for keys in dict.fromkeys(p.keys for p in parts.values() if p.keys):
            names = [n for n, p in parts.items() if p.keys == keys]
            # An unknown batch counts as the earliest one, as in the sort below.
            first = (rows.dropna(subset=list(keys)).groupBy(*keys)
                     .agg(F.when(F.count_if(F.col("batch").isNull()) == 0, F.min("batch")).alias("batch")))
            fresh = first.groupBy("batch").agg(F.count("*").alias(names[0]))
            measures = measures.unionByName(
                fresh.select("batch", *[F.col(names[0]).alias(n) for n in names]), allowMissingColumns=True)
        merge = {"max": F.max, "sum": F.sum, "keys": F.sum}
        return measures.groupBy("batch").agg(*[merge[p.merge](n).alias(n) for n, p in parts.items()])

    def running(self, batches: DataFrame, order: str) -> DataFrame:
        """From the parts of each batch to the parts of the table after it.  The
        window sees one row per batch, never the table's rows."""
        so_far = Window.orderBy(F.col(order).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
        merge = {"max": F.max, "sum": F.sum, "keys": F.sum}
        cumulative = []
        for name, part in self.parts().items():
            value = merge[part.merge](name).over(so_far)
            cumulative.append((value if part.merge == "max" else F.coalesce(value, F.lit(0))).alias(name))
        others = [c for c in batches.columns if c not in self.parts()]
        return batches.select(*others, *cumulative)

    def history(self, df: DataFrame, batch: Column, measured_at: Callable[[Column], Column]) -> DataFrame:
        """The whole-table value of every metric after each batch, without
        reading any earlier version of the table again."""
        wide = self.running(self.batch_parts(df, batch), "batch")
        return self.long_form(wide, measured_at(F.col("batch")))

    # -- reports ---------------------------------------------------------------

    def of_this_table(self, log: DataFrame) -> DataFrame:
        return log.filter((F.col("table_database") == self.database)
                          & (F.col("table_schema") == self.schema)
                          & (F.col("table_name") == self.name))

    def latest(self, log: DataFrame, n: int = 20) -> DataFrame:
        """The newest ``n`` rows of a result or status log for this table."""
        tie = [c for c in ("metric_name", "columns", "expectation_name") if c in log.columns]
        return self.of_this_table(log).orderBy(F.col("measurement_time").desc(), *tie).limit(n)

    def references(self, spark: SparkSession, statuses: DataFrame, results: DataFrame) -> DataFrame:
        """Coverage: every association with its latest value, time and verdict
        (NULL where it was never measured or nothing is expected of it)."""
        newest = (self.of_this_table(results).groupBy("metric_name", "columns")
                  .agg(F.max_by("value", "measurement_time").alias("value"),
                       F.max("measurement_time").alias("measured")))
        verdict = (self.of_this_table(statuses).groupBy("metric_name", "columns", "measurement_time")
                   .agg(F.bool_or("violated").alias("violated"))
                   .groupBy("metric_name", "columns")
                   .agg(F.max_by("violated", "measurement_time").alias("violated")))
        attached = spark.createDataFrame(
            [(self.name, a.metric.label, a.column_list, len(a.expectations)) for a in self.associations],
            "table_name string, metric_name string, columns string, expectations int")
        return (attached.join(newest, ["metric_name", "columns"], "left")
                .join(verdict, ["metric_name", "columns"], "left")
                .select("table_name", "metric_name", "columns", "expectations", "value",
                        F.col("measured").alias("measurement_time"), "violated"))
