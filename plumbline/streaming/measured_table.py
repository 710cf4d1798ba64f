"""Metrics of a table that loses rows as well as it gains them.

The state says how every kind of part takes rows back:

* **sum** subtracts.  Changes are aggregated for each number of copies, then
  weighted with it.
* **max** keeps the ``keep`` largest different values with their counts.  All
  values down to the least one kept (``floor``) are known, so the maximum stays
  exact until all of them are gone; only then the table is read again.
* **keys** count the rows of every key in a log of signed counts.  A change looks
  up the keys it touches; a key is gone when its count falls to zero.

The state of batch ``n`` is read to make that of batch ``n + 1``; running a batch
again overwrites what it wrote.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.metrics import Part, moment
from plumbline.operators.changes import CHANGE, same
from plumbline.plans.monitor import Monitor
from plumbline.session import written
from plumbline.sources.storage import remove


class MeasuredTable:
    def __init__(self, spark: SparkSession, monitor: Monitor, folder: str, keep: int = 64):
        self.spark, self.monitor, self.folder, self.keep = spark, monitor, folder.rstrip("/"), keep
        missing = [n for n, p in monitor.parts().items() if p.merge == "max" and p.value is None]
        if missing:
            raise ValueError(f"{missing} can't take rows back: the part has no value")
        self.full_reads = 0     # how often a maximum had to be looked for in the whole table

    def _of(self, merge: str) -> dict[str, Part]:
        return {n: p for n, p in self.monitor.parts().items() if p.merge == merge}

    def _key_sets(self) -> dict[tuple[str, ...], list[str]]:
        sets: dict[tuple[str, ...], list[str]] = {}
        for n, p in self._of("keys").items():
            sets.setdefault(p.keys, []).append(n)
        return sets

    def _path(self, what: str, batch_id: int) -> str:
        return f"{self.folder}/{what}/batch_id={batch_id}"

    def _write(self, df: DataFrame, what: str, batch_id: int) -> DataFrame:
        df.write.mode("overwrite").parquet(self._path(what, batch_id))
        return self._read(what, batch_id)

    def _read(self, what: str, batch_id: int) -> DataFrame:
        return self.spark.read.parquet(self._path(what, batch_id))

    # -- parts of signed rows --------------------------------------------------------

    def _sums(self, rows: DataFrame) -> DataFrame:
        """One row with the signed sums of rows that carry ``change``."""
        sums = self._of("sum")
        if not sums:
            return rows.agg(F.count("*")).drop("count(1)")
        by_weight = rows.groupBy(CHANGE).agg(*[p.column.alias(n) for n, p in sums.items()])
        return by_weight.agg(*[F.coalesce(F.sum(F.col(n) * F.col(CHANGE)), F.lit(0)).alias(n) for n in sums])

    def _largest(self, values: DataFrame) -> list[T.Row]:
        """The ``keep`` largest values that are left, at most so many rows."""
        left = values.groupBy("value").agg(F.sum("n").alias("n")).filter("value is not null and n > 0")
        return left.orderBy(F.desc("value")).limit(self.keep).collect()

    def _top(self, name: str, part: Part, changes: DataFrame, table: DataFrame, batch_id: int) -> None:
        """The largest values after the changes; ``floor`` is NULL where they are all values."""
        kind = changes.select(part.value.alias("value")).schema["value"].dataType
        schema = T.StructType([T.StructField("value", kind), T.StructField("n", T.LongType()), T.StructField("floor", kind)])
        floor, left = None, []
        if batch_id:
            known = self._read(f"top-{name}", batch_id - 1)
            floor = known.agg(F.max("floor")).first()[0]
            came = changes.select(part.value.alias("value"), F.col(CHANGE).alias("n"))
            if floor is not None:
                came = came.filter(F.col("value") >= F.lit(floor).cast(kind))
            left = self._largest(known.select("value", "n").unionByName(came))
        if not batch_id or not left and floor is not None:
            self.full_reads += 1 if batch_id else 0
            left, floor = self._largest(table.select(part.value.alias("value"), F.lit(1).alias("n"))), None
        if len(left) == self.keep:
            floor = left[-1]["value"]
        # A marker without a value carries the floor when nothing is left.
        rows = [(r["value"], r["n"], floor) for r in left] or [(None, 0, floor)]
        self._write(self.spark.createDataFrame(rows, schema), f"top-{name}", batch_id)

    def _keys(self, keys: tuple[str, ...], names: list[str], changes: DataFrame, batch_id: int) -> DataFrame:
        """One row: by how much the number of different keys grew."""
        what = "keys-" + ",".join(keys)
        signed = changes.dropna(subset=list(keys)).groupBy(*keys).agg(F.sum(CHANGE).alias("n")).filter("n <> 0")
        signed = self._write(signed, what, batch_id)
        if batch_id:
            log = self.spark.read.parquet(f"{self.folder}/{what}").filter(F.col("batch_id") < batch_id)
            # Only touched keys of the log take part; the rest are dropped where they are read if the touched ones are few.
            before = log.alias("l").join(signed.alias("r"), same("l", "r", list(keys)), "left_semi") \
                .groupBy(*keys).agg(F.sum("n").alias("before"))
            signed = signed.alias("l").join(before.alias("r"), same("l", "r", list(keys)), "left") \
                .select("n", F.coalesce("before", F.lit(0)).alias("before"))
        else:
            signed = signed.select("n", F.lit(0).alias("before"))
        grown = F.count_if((F.col("before") <= 0) & (F.col("before") + F.col("n") > 0)) - F.count_if((F.col("before") > 0) & (F.col("before") + F.col("n") <= 0))
        return signed.agg(grown.alias(names[0])).select(*[F.col(names[0]).alias(n) for n in names])

    # -- batches -----------------------------------------------------------------------

    def initialize(self, table: DataFrame, as_of: datetime) -> DataFrame:
        """Measure the whole table, as batch 0."""
        return self._apply(table.withColumn(CHANGE, F.lit(1)), table, as_of, 0)

    def change(self, changes: DataFrame, table: DataFrame, as_of: datetime, batch_id: int) -> DataFrame:
        """The metrics after net changes (``operators.changes``).  ``table`` is the
        table after them; it is read only where no largest value is left."""
        return self._apply(written(changes, "changes"), table, as_of, batch_id)

    def _apply(self, changes: DataFrame, table: DataFrame, as_of: datetime, batch_id: int) -> DataFrame:
        parts = self.monitor.parts()
        rows = self._sums(changes)
        for keys, names in self._key_sets().items():
            rows = rows.unionByName(self._keys(keys, names, changes, batch_id), allowMissingColumns=True)
        counted = [n for n, p in parts.items() if p.merge != "max"]
        if batch_id:
            rows = rows.unionByName(self._read("counted", batch_id - 1), allowMissingColumns=True)
        rows = self._write(rows.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counted]), "counted", batch_id)
        for name, part in self._of("max").items():
            self._top(name, part, changes, table, batch_id)
            rows = rows.unionByName(self._read(f"top-{name}", batch_id).agg(F.max("value").alias(name)), allowMissingColumns=True)
        wide = rows.agg(*[F.max(n).alias(n) for n in parts])  # every column has one value, the others are NULL
        return self.monitor.long_form(wide, moment(as_of))

    def compact(self, batch_id: int) -> None:
        """Fold the logs of keys up to a finished batch into one, and drop the states before it."""
        for keys in self._key_sets():
            what = "keys-" + ",".join(keys)
            log = self.spark.read.parquet(f"{self.folder}/{what}").filter(F.col("batch_id") <= batch_id)
            whole = written(log.groupBy(*keys).agg(F.sum("n").alias("n")).filter("n <> 0"), "keys")
            # Later batches are added in any case; the ones folded go before the whole is written in their place.
            for old in range(batch_id + 1):
                remove(self.spark, self._path(what, old))
            self._write(whole, what, batch_id)
        for what in ["counted", *[f"top-{n}" for n in self._of("max")]]:
            for old in range(batch_id):
                remove(self.spark, self._path(what, old))
