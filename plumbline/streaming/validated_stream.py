"""The validated table, kept up to date as raw orders arrive.

The earliest copy of an order is a minimum, and the minimum of minima is the
minimum.  So every micro-batch is deduplicated and scored on its own and added
to a change log, without looking at the table; a copy that arrives late with an
earlier date still wins.  Reading merges base and changes by the same minimum,
and ``compact`` folds the changes into a new base.  The cost of a refresh grows
with what changed, not with the table.

Rows that go can take the earliest copy with them.  ``change`` then voids what
the table knows of the key (``resets``) and reads that key, and no other, again.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from plumbline.functions.metrics import moment
from plumbline.operators.changes import CHANGE, captured, lost_keys, of_keys, same
from plumbline.operators.dedup import merge_first
from plumbline.plans.validate import validated_orders
from plumbline.session import written
from plumbline.sources import schemas
from plumbline.sources.storage import BatchLog, VersionedTable

VALIDATED = T.StructType([*schemas.ORDERS.fields,
                          T.StructField("quality_score", T.IntegerType()),
                          T.StructField("quality_status", T.StringType())])
KEY, EARLIEST = "order_id", "order_date"
TARGET_LAG = "1 minute"
# Batches between two compactions: a day at the usual lag.
COMPACT_EVERY = 1440
INITIAL = -1            # the batch number of the initial build
AUTO, FULL, INCREMENTAL = "AUTO", "FULL", "INCREMENTAL"
# From so many changed rows for each row of the base on, building the table anew
# is cheaper: a changed row is looked up, compared and merged by every reader.
FULL_ABOVE = 0.5
MODES = T.StructType([T.StructField("refresh_mode", T.StringType()), T.StructField("changed_rows", T.LongType()),
                      T.StructField("base_rows", T.LongType())])


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class ValidatedTable:
    """``compact_every``: after so many batches, the finished ones are folded
    into a new base and their changes dropped, so that neither the change log
    nor what a reader has to list grows with the age of the table."""

    def __init__(self, spark: SparkSession, folder: str, name: str = "shop.clean.validated_orders",
                 compact_every: int = COMPACT_EVERY):
        self.spark, self.folder, self.name, self.compact_every = spark, folder.rstrip("/"), name, compact_every
        self.base = VersionedTable(spark, f"{self.folder}/base", VALIDATED)
        self.changes = BatchLog(spark, f"{self.folder}/changes", VALIDATED)
        self.resets = BatchLog(spark, f"{self.folder}/resets", T.StructType([T.StructField(KEY, T.StringType())]))
        self.modes = BatchLog(spark, f"{self.folder}/modes", MODES)
        self.refreshes = BatchLog(spark, f"{self.folder}/refreshes", schemas.REFRESHES)

    # -- writing -----------------------------------------------------------------

    def initialize(self, orders: DataFrame) -> None:
        """Build the whole table from what is there."""
        self._noted(INITIAL, lambda: self.base.publish(validated_orders(orders)))

    def refresh(self, batch: DataFrame, batch_id: int) -> None:
        """Add one batch of raw orders and note how it went."""
        self._noted(batch_id, lambda: self.changes.write(validated_orders(batch), batch_id))
        # The batch before is finished: it is not run again once this one has begun.
        if batch_id and batch_id % self.compact_every == 0:
            self.compact(batch_id - 1)

    def change(self, changes: DataFrame, orders: DataFrame, batch_id: int, mode: str = AUTO) -> None:
        """Follow net changes of the raw orders (``operators.changes``), among them
        rows that were updated, deleted or truncated.  ``orders`` is the raw
        table after them.

        An incremental refresh reads from it only keys whose row in this table
        went, a full one builds a new base.  AUTO chooses by the numbers of
        changed rows and of rows in the base, which cost a look at file footers.
        The choice is noted (``refresh_modes``)."""
        def work() -> None:
            changed = written(changes, "changes")
            n, rows = changed.count(), self.base.read().count()
            chosen = mode if mode != AUTO else FULL if n > FULL_ABOVE * rows else INCREMENTAL
            if chosen == FULL:
                self.base.publish(validated_orders(orders), batch_id)
            else:
                follow(changed)
            self.modes.write(self.spark.createDataFrame([(chosen, n, rows)], MODES), batch_id)

        def follow(changed: DataFrame) -> None:
            raw = schemas.ORDERS.fieldNames()
            known = of_keys(self._merged(batch_id - 1), changed.filter(F.col(CHANGE) < 0), KEY)
            lost = written(lost_keys(known.select(*raw), changed, KEY, raw).distinct(), "lost-keys")
            came = of_keys(changed.filter(F.col(CHANGE) > 0).select(*raw), lost, KEY, "left_anti")
            again = of_keys(orders.select(*raw), lost, KEY)
            # Voided first would be missing from the table until the rows are there.
            self.changes.write(validated_orders(came.unionByName(again)), batch_id)
            self.resets.write(lost, batch_id)
        self._noted(batch_id, work)

    def _noted(self, batch_id: int, work: Callable[[], object]) -> None:
        """Run ``work``; every attempt at a batch leaves a row of its own."""
        attempt, started = self.refreshes.batch(batch_id).count() + 1, now()
        try:
            work()
        except Exception as error:
            self._note(batch_id, attempt, "FAILED", str(error), started)
            raise
        self._note(batch_id, attempt, "SUCCEEDED", None, started)

    def _note(self, batch_id: int, attempt: int, state: str, message: str | None, started: datetime) -> None:
        row = self.spark.range(1).select(
            F.lit(self.name).alias("name"), F.lit(attempt).alias("attempt"), F.lit(state).alias("state"),
            F.lit(message).cast("string").alias("state_message"),
            moment(started).alias("refresh_start_time"), moment(now()).alias("refresh_end_time"))
        self.refreshes.add(row, batch_id)

    def follow(self, orders: DataFrame, lag: str = TARGET_LAG) -> DataStreamWriter:
        """The stream that keeps the table within ``lag`` of its source; call
        ``start()`` on it, or set another trigger first."""
        return (orders.writeStream.queryName(self.name).foreachBatch(self.refresh)
                .option("checkpointLocation", f"{self.folder}/checkpoint").trigger(processingTime=lag))

    def compact(self, through_batch: int) -> int:
        """Fold all changes up to a finished batch into a new base, and drop
        them.  The stream may go on meanwhile: later batches stay in the change
        log.  The base before stays for readers that have begun with it; the
        changes it lacks are those of the compaction before, kept as well."""
        covered = self.base.current()[1]
        version = self.base.publish(self._merged(through_batch), through_batch)
        self.changes.retire(covered + 1, covered + 1 - self.compact_every)
        self.resets.retire(covered + 1, covered + 1 - self.compact_every)
        self.base.retire()
        return version

    # -- reading -----------------------------------------------------------------

    def _merged(self, through_batch: int | None = None) -> DataFrame:
        _, covered = self.base.current()
        changes, resets = (log.read().filter(F.col("batch_id") > covered) for log in (self.changes, self.resets))
        if through_batch is not None:
            changes, resets = (log.filter(F.col("batch_id") <= through_batch) for log in (changes, resets))
        # What was known of a key before its last reset counts no more.
        since = resets.groupBy(KEY).agg(F.max("batch_id").alias("since"))
        base = of_keys(self.base.read(), since, KEY, "left_anti")
        changes = changes.alias("l").join(since.alias("r"), same("l", "r", [KEY]) & (F.col("batch_id") < F.col("since")), "left_anti")
        return merge_first(base, changes.drop("batch_id"), KEY, EARLIEST)

    def read(self) -> DataFrame:
        return self._merged()

    def net_changes(self, batch_id: int) -> DataFrame | None:
        """What a batch changed in this table (``operators.changes``), for tables
        that are derived from it.  Only keys that the batch touched are compared.
        None if the batch built the table anew."""
        if self.base.current()[1] >= batch_id:
            return None
        keys = self.changes.batch(batch_id).select(KEY).unionByName(self.resets.batch(batch_id))
        keys = written(keys.distinct(), "touched-keys")
        return captured(of_keys(self._merged(batch_id - 1), keys, KEY), of_keys(self._merged(batch_id), keys, KEY))

    def refresh_modes(self) -> DataFrame:
        """How each batch of net changes was followed."""
        return self.modes.read().select("batch_id", *MODES.fieldNames())

    def refresh_history(self, n: int = 5) -> DataFrame:
        return (self.refreshes.read().filter(F.col("name") == self.name)
                .orderBy(F.col("refresh_start_time").desc(), F.col("batch_id").desc(), F.col("attempt").desc())
                .limit(n).drop("batch_id"))
