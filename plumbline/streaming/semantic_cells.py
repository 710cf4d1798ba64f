"""Stored sums of a semantic model, kept up to date by signed changes.

A cell is one combination of all dimensions that are kept, with the sum of every
measure over its rows.  Sums add up and take rows back, so

* a request whose dimensions and conditions are among those kept is answered from
  the cells, and the rows of the base table are not read; any other request goes
  to the model;
* changes of the base table become signed cells of their own: the number of
  copies that came or went, times the measures;
* changes of a table that is referred to move rows between cells: only base rows
  whose key leads to another row than before are read, taken out under the old
  dimensions and put back under the new ones.

The signed cells of a batch are one small partition of a log; running a batch
again overwrites them.  Readers add up base and log, and ``compact`` folds
finished batches into a new base.  A cell without rows vanishes, as it does where
rows are grouped.  Measures must be exact numbers (integers or decimals): sums of
floating-point numbers do not subtract without a rest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from plumbline.operators.changes import CHANGE, captured, of_keys
from plumbline.plans.semantic import Relationship, SemanticModel
from plumbline.session import written
from plumbline.sources.storage import BatchLog, VersionedTable
from plumbline.streaming.validated_stream import ValidatedTable

ROWS = "_rows"          # how many base rows a cell stands for


class SemanticCells:
    """``model`` is bound to its tables; ``dims`` are the dimensions kept."""

    def __init__(self, spark: SparkSession, model: SemanticModel, folder: str, dims: Sequence[str] | None = None):
        self.spark, self.model, self.dims = spark, model, list(model.dimensions if dims is None else dims)
        self.measures = {**model.measures, ROWS: "1L"}
        kinds = model.tables[model.base].select(*[F.expr(e).alias(m) for m, e in self.measures.items()]).schema
        inexact = [f.name for f in kinds if isinstance(f.dataType, T.FractionalType) and not isinstance(f.dataType, T.DecimalType)]
        if inexact:
            raise ValueError(f"{inexact} are not exact numbers")
        where = [model.dimensions[d] for d in self.dims]
        self.schema = T.StructType(
            [T.StructField(d, model.tables[w.table].schema[w.column].dataType) for d, w in zip(self.dims, where)]
            + [T.StructField(f.name, T.LongType() if isinstance(f.dataType, T.IntegralType) else T.DecimalType(38, f.dataType.scale))
               for f in kinds])
        self.base = VersionedTable(spark, f"{folder.rstrip('/')}/base", self.schema)
        self.log = BatchLog(spark, f"{folder.rstrip('/')}/log", self.schema)
        self._last: tuple[int, dict[str, DataFrame]] | None = None     # the last batch and the tables before it

        self._retired = -1      # up to which batch the log was dropped

    # -- writing -----------------------------------------------------------------

    def _cells(self, tables: Mapping[str, DataFrame], signed: bool = False) -> DataFrame:
        """The cells of a base table; with ``signed``, of rows that carry ``change``."""
        weighted = {m: f"({e}) * {CHANGE}" if signed else e for m, e in self.measures.items()}
        sums = replace(self.model, measures=weighted, tables=dict(tables)).sums(list(weighted), self.dims)
        return self._typed(sums)

    def _typed(self, sums: DataFrame) -> DataFrame:
        return sums.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])

    def _summed(self, cells: DataFrame) -> DataFrame:
        sums = cells.groupBy(*self.dims).agg(*[F.sum(m).alias(m) for m in self.measures])
        return self._typed(sums.filter(F.col(ROWS) != 0))

    def initialize(self, through_batch: int = -1) -> None:
        """Add up the whole base table of the model, which holds all batches up to the given one."""
        self.base.publish(self._cells(self.model.tables), through_batch)

    def change(self, batch_id: int, changes: DataFrame | None = None, **tables: DataFrame) -> None:
        """Follow net changes of the base table and new versions of the tables it refers to.

        ``tables`` are those versions by name.  If one of them is given, so must
        be the base table after the changes: the rows to move are looked up there.
        """
        old = dict(self.model.tables)
        if self._last and self._last[0] == batch_id:
            old = self._last[1]     # the batch runs again
        self._last = batch_id, old
        signed = [] if changes is None else [self._cells({**old, self.model.base: changes}, signed=True)]
        moved_to = [r for r in self.model.relationships if r.to_table in tables]
        if moved_to and self.model.base not in tables:
            raise ValueError(f"{self.model.base} after the changes is needed to move its rows")
        for r in moved_to:
            new = {**old, r.to_table: tables[r.to_table]}
            rows = written(self._moved(r, old, new, tables[self.model.base]), "moved-rows")
            for versions, sign in ((old, -1), (new, 1)):
                signed.append(self._cells({**versions, self.model.base: rows.withColumn(CHANGE, F.lit(sign))}, signed=True))
            old = new
        self.model = replace(self.model, tables={**old, **tables})
        cells = self.spark.createDataFrame([], self.schema)
        for part in signed:
            cells = cells.unionByName(part)
        # Measures may move while the number of rows stays, so only a cell that is zero throughout is left out.
        sums = self._typed(cells.groupBy(*self.dims).agg(*[F.sum(m).alias(m) for m in self.measures]))
        self.log.write(sums.filter(" or ".join(f"`{m}` != 0" for m in self.measures)), batch_id)

    def _moved(self, r: Relationship, old: Mapping[str, DataFrame], new: Mapping[str, DataFrame], base: DataFrame) -> DataFrame:
        """The base rows whose key leads to other dimensions than before."""
        def lookup(tables: Mapping[str, DataFrame]) -> DataFrame:
            return replace(self.model, tables=dict(tables))._lookup(r, self.dims)

        return of_keys(base, written(captured(lookup(old), lookup(new)).select(r.key), "moved-keys"), r.key)

    def follow(self, table: ValidatedTable, batch_id: int) -> None:
        """Follow what a batch did to the validated table; to be called after it, in the same micro-batch."""
        changes = table.net_changes(batch_id)
        if changes is None:
            self.model = replace(self.model, tables={**self.model.tables, self.model.base: table.read()})
            self.initialize(batch_id)
        else:
            self.change(batch_id, changes, **{self.model.base: table.read()})

    def stream(self, table: ValidatedTable, orders: DataFrame) -> DataStreamWriter:
        """The stream that keeps both the validated table and these cells."""
        def refresh(batch: DataFrame, batch_id: int) -> None:
            table.refresh(batch, batch_id)
            self.follow(table, batch_id)
            if batch_id and batch_id % table.compact_every == 0:
                self.compact(batch_id - 1)

        return table.follow(orders).foreachBatch(refresh)

    def compact(self, through_batch: int) -> None:
        """Fold finished batches into a new base; the log entries that the base before covered go."""
        covered = self.base.current()[1]
        self.base.publish(self._merged(through_batch), through_batch)
        self.log.retire(covered + 1, self._retired + 1)
        self._retired = covered
        self.base.retire()

    # -- reading -----------------------------------------------------------------

    def _merged(self, through_batch: int | None = None) -> DataFrame:
        log = self.log.read().filter(F.col("batch_id") > self.base.current()[1])
        if through_batch is not None:
            log = log.filter(F.col("batch_id") <= through_batch)
        return self._summed(self.base.read().unionByName(log.drop("batch_id")))

    def read(self) -> DataFrame:
        return self._merged()

    def covers(self, dims: Sequence[str] = (), where: Mapping[str, str] | None = None) -> bool:
        return {*dims, *(where or {})} <= set(self.dims)

    def query(self, metrics: Sequence[str], dims: Sequence[str] = (), where: Mapping[str, str] | None = None,
              grouping_sets: Sequence[Sequence[str]] | None = None) -> DataFrame:
        """``SemanticModel.query``, from the cells where they cover the request."""
        if not self.covers(dims, where):
            return self.model.query(metrics, dims, where, grouping_sets)
        cells = self.read()
        for predicate in (where or {}).values():
            cells = cells.filter(predicate)
        measures = self.model.measures_of(metrics)
        totals = self.model.grouped(cells.select(*dims, *measures), measures, dims, grouping_sets)
        return self.model.computed(totals, metrics)
