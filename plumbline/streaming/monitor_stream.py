"""Metrics, verdicts and alerts, recorded after every change of a table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from plumbline.functions.metrics import Part, moment
from plumbline.operators.cooldown import alerts_with_cooldown
from plumbline.plans.alerts import COOLDOWN, SUBJECT, alerts
from plumbline.plans.monitor import Monitor
from plumbline.session import ROCKSDB, STATE_STORE
from plumbline.sources import schemas
from plumbline.sources.storage import BatchLog

ALERTS = T.StructType([*[T.StructField(c, T.StringType()) for c in SUBJECT],
                       T.StructField("measurement_time", T.TimestampNTZType()),
                       T.StructField("payload", T.StringType())])
KEY_SETS = T.StructType([T.StructField("number", T.IntegerType()), T.StructField("keys", T.ArrayType(T.StringType()))])


def newest(sent: DataFrame, keys, ts: str) -> DataFrame:
    """The last alert of each key: all that later batches need to know."""
    return sent.groupBy(*keys).agg(F.max(ts).alias(ts))


class MonitorStream:
    """Measures a growing table without reading it again.

    The stream carries every new row, and once more each key that was never seen
    before; ``dropDuplicates`` keeps the keys in the state store.  One aggregate
    over the micro-batch gives its parts, and the table's parts are those of the
    batch before plus these.

    Parts are stored under the identity of metric and columns, so metrics may be
    attached and detached between runs of the stream.  ``table`` reads the table
    as it stands; a newly attached metric starts from a measurement of it.  The
    key sets that the stream carries are fixed when it is first started (its
    state cannot change later); a metric on other keys, attached afterwards, is
    measured on the whole table with every batch.
    """

    def __init__(self, spark: SparkSession, monitor: Monitor, folder: str,
                 clock: Callable[[int], datetime], cooldown: timedelta = COOLDOWN,
                 table: Callable[[], DataFrame] | None = None):
        self.spark, self.monitor, self.folder = spark, monitor, folder.rstrip("/")
        self.clock, self.cooldown, self.table = clock, cooldown, table
        self.carried = BatchLog(spark, f"{self.folder}/key_sets", KEY_SETS)
        self.results = BatchLog(spark, f"{self.folder}/results", schemas.RESULTS)
        self.statuses = BatchLog(spark, f"{self.folder}/statuses", schemas.STATUSES)
        self.alerts = BatchLog(spark, f"{self.folder}/alerts", ALERTS)
        self.last_sent = BatchLog(spark, f"{self.folder}/last_sent", T.StructType(ALERTS.fields[:-1]))

    def _key_sets(self) -> list[tuple[str, ...]]:
        """Those the stream was first started with."""
        known = self.carried.batch(0).orderBy("number").collect()       # one row per key set
        if not known:
            sets = list(dict.fromkeys(p.keys for p in self.monitor.parts().values() if p.keys))
            self.carried.write(self.spark.createDataFrame([(i, list(k)) for i, k in enumerate(sets)], KEY_SETS), 0)
            return sets
        return [tuple(r["keys"]) for r in known]

    def _tagged(self, rows: DataFrame) -> DataFrame:
        """All new rows, and the first row of every new key, told apart by ``kind``."""
        self.key_sets = self._key_sets()
        used = list(dict.fromkeys([*(c for a in self.monitor.associations for c in a.columns),
                                   *(c for keys in self.key_sets for c in keys)]))
        tagged = rows.select(*used, F.lit("row").alias("kind"))
        for i, keys in enumerate(self.key_sets):
            fresh = rows.select(*keys).dropna().dropDuplicates(list(keys))
            tagged = tagged.unionByName(fresh.withColumn("kind", F.lit(f"key{i}")), allowMissingColumns=True)
        return tagged

    def batch_parts(self, tagged: DataFrame, parts: dict[str, Part]) -> DataFrame:
        """One row with the given parts of a micro-batch, from one pass over it."""
        plain = {n: p for n, p in parts.items() if not p.keys}
        kinds = tagged.groupBy("kind").agg(F.count("*").alias("n"), *[p.column.alias(n) for n, p in plain.items()])
        of_rows = [F.max(F.when(F.col("kind") == "row", F.col(n))).alias(n) for n in plain]
        of_keys = [F.coalesce(F.max(F.when(F.col("kind") == f"key{self.key_sets.index(p.keys)}", F.col("n"))),
                              F.lit(0)).alias(n) for n, p in parts.items() if p.keys]
        return kinds.agg(*of_rows, *of_keys).select(*parts)

    def table_parts(self, batch_id: int, tagged: DataFrame) -> DataFrame:
        """One row with all parts of the table after this batch."""
        parts, merge = self.monitor.parts(), {"max": F.max, "sum": F.sum, "keys": F.sum}
        before = self.spark.read.parquet(f"{self.folder}/parts/batch_id={batch_id - 1}") if batch_id else None
        carried = {n: p for n, p in parts.items()
                   if (not p.keys or p.keys in self.key_sets) and (before is None or n in before.columns)}
        row = None
        if carried:
            delta = self.batch_parts(tagged, carried)
            row = delta if before is None else before.select(*carried).unionByName(delta).agg(
                *[merge[p.merge](n).alias(n) for n, p in carried.items()])
        anew = {n: p for n, p in parts.items() if n not in carried}
        if anew:
            if self.table is None:
                raise ValueError("a metric attached to a running stream needs the table to start from")
            whole = self.table().agg(*[p.aggregate().alias(n) for n, p in anew.items()])
            # One row each; every part is in one of them.
            row = whole if row is None else row.unionByName(whole, allowMissingColumns=True).agg(
                *[F.max(n).alias(n) for n in parts])
        return row.select(*parts)

    def record(self, tagged: DataFrame, batch_id: int) -> None:
        row = self.table_parts(batch_id, tagged)
        state = BatchLog(self.spark, f"{self.folder}/parts", row.schema)
        state.write(row, batch_id)
        self.results.write(self.monitor.long_form(state.batch(batch_id), moment(self.clock(batch_id))), batch_id)
        self.statuses.write(self.monitor.statuses(self.results.batch(batch_id)), batch_id)
        last = self.last_sent.previous(batch_id)
        self.alerts.write(alerts(self.statuses.batch(batch_id), self.cooldown, last), batch_id)
        sent = self.alerts.batch(batch_id).select(*SUBJECT, "measurement_time")
        self.last_sent.write(newest(last.unionByName(sent), SUBJECT, "measurement_time"), batch_id)
        # This batch may run again and then needs the one before, but nothing older.
        for log in (state, self.last_sent):
            log.retire(batch_id - 1, batch_id - 2)

    def follow(self, rows: DataFrame) -> DataStreamWriter:
        self.spark.conf.set(STATE_STORE, ROCKSDB)       # all keys ever seen do not fit on a heap
        return (self._tagged(rows).writeStream.queryName(self.monitor.table).outputMode("append")
                .foreachBatch(self.record).option("checkpointLocation", f"{self.folder}/checkpoint"))


class AlertStream:
    """Alerts with a cooldown from any stream of violations whose moments do not
    run backwards from batch to batch."""

    def __init__(self, spark: SparkSession, folder: str, keys: dict[str, T.DataType], ts: str,
                 cooldown: timedelta = COOLDOWN):
        self.keys, self.ts, self.cooldown, self.folder = list(keys), ts, cooldown, folder.rstrip("/")
        schema = T.StructType([*[T.StructField(k, t) for k, t in keys.items()],
                               T.StructField(ts, T.TimestampNTZType())])
        self.alerts = BatchLog(spark, f"{self.folder}/alerts", schema)
        self.last_sent = BatchLog(spark, f"{self.folder}/last_sent", schema)

    def record(self, violations: DataFrame, batch_id: int) -> None:
        last = self.last_sent.previous(batch_id)
        self.alerts.write(alerts_with_cooldown(violations, self.keys, self.ts, self.cooldown, last), batch_id)
        sent = last.unionByName(self.alerts.batch(batch_id))
        self.last_sent.write(newest(sent, self.keys, self.ts), batch_id)
        self.last_sent.retire(batch_id - 1, batch_id - 2)

    def follow(self, violations: DataFrame) -> DataStreamWriter:
        return (violations.writeStream.foreachBatch(self.record)
                .option("checkpointLocation", f"{self.folder}/checkpoint"))
