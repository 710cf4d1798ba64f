"""Cooldown alerts of keys with very many moments, by pointers instead of segments.

``operators.cooldown`` gathers the moments of a key within some cooldowns in one
task.  A key may have any number of them there; such keys come here.

1. Every moment asks for the first moment at or after itself plus the cooldown.
   Moments and questions are sorted by one range exchange over (key, moment), so
   a key spreads over as many tasks as its rows need.  An ordered pass answers
   the questions whose answer lies in the same task; for the others it is the
   first moment of a later task, and these firsts, one a task, are all that is
   carried from task to task.
2. The alerts are what the pointers reach from each key's first moment.  Pointers
   are doubled: each round joins them with themselves and adds what they reach
   from the alerts known so far, so n alerts of a key take log2(n) rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import written

#: Moments and questions in a task.
TASK_ROWS = 1 << 21


POINTERS = "label string, upto long, next long, block int, open boolean"


def _ordered_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Moments and questions of a task in order, to answered questions.  Those
    of the task's last key that no moment here answers stay open.  One more row
    without ``upto`` names the task's first moment as ``next``."""
    held = [b for b in batches if len(b)]
    if not held:
        return
    rows = pa.Table.from_batches(held).combine_chunks()
    labels, at, origin = rows["label"].combine_chunks(), rows["at"].to_numpy(), rows["origin"].combine_chunks()
    group = np.append(0, np.cumsum(pc.not_equal(labels[1:], labels[:-1]).to_numpy(zero_copy_only=False)))
    asks = origin.is_valid().to_numpy(zero_copy_only=False)
    # The next moment from each row on, seen from the end.
    following = np.minimum.accumulate(np.where(asks, len(at), np.arange(len(at)))[::-1])[::-1]
    found = np.minimum(following, len(at) - 1)
    inside = (following < len(at)) & (group[found] == group)
    ours = np.flatnonzero(asks)
    moments = np.flatnonzero(~asks)[:1]
    chosen = pa.array(np.append(ours, moments))
    answer = pa.array(np.append(at[found[ours]], at[moments]), mask=np.append(~inside[ours], moments < 0))
    block = np.full(len(chosen), TaskContext.get().partitionId(), np.int32)
    open_ = np.append(~inside[ours] & (group[ours] == group[-1]), moments < 0)
    yield pa.RecordBatch.from_arrays([labels.take(chosen), origin.take(chosen), answer, pa.array(block), pa.array(open_)],
                                     ["label", "upto", "next", "block", "open"])


def pointers(events: DataFrame, pause: int) -> DataFrame:
    """(label, upto, next): for each moment the first one of its key at least ``pause`` later, if there is one."""
    spark = events.sparkSession
    asked = events.select("label", F.col("upto").alias("at"), F.lit(None).cast("long").alias("origin")).unionByName(
        events.select("label", (F.col("upto") + pause).alias("at"), F.col("upto").alias("origin")))
    # A question sorts before a moment at the same time, so that the moment follows it.
    asked = asked.withColumn("kind", F.col("origin").isNull().cast("int"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-2 * events.count() // TASK_ROWS))
    ordered = asked.repartitionByRange(parts, "label", "at", "kind").sortWithinPartitions("label", "at", "kind").drop("kind")
    passed = written(ordered.mapInArrow(_ordered_pass, POINTERS), "crowded-pass")
    firsts = [(r.block, r.label, r.next) for r in passed.filter("upto is null").orderBy("block").collect()]  # one a task
    later = []
    for block in range(parts):
        while firsts and firsts[0][0] <= block:
            firsts.pop(0)
        later += [(block, *firsts[0][1:])] if firsts else []
    carried = spark.createDataFrame(later, "block int, label string, carried long")
    answered = passed.filter("upto is not null").join(carried, ["block", "label"], "left")
    return answered.select("label", "upto", F.when(F.col("open"), F.col("carried")).otherwise(F.col("next")).alias("next"))


def alerts(events: DataFrame, pause: int) -> DataFrame:
    """(label, upto) of the alerts: each key's first moment, and each next moment that is ``pause`` after the last one."""
    events = written(events.select("label", "upto"), "crowded")
    jumps = written(pointers(events, pause).filter("next is not null"), "crowded-pointers")
    reached = written(events.groupBy("label").agg(F.min("upto").alias("upto")), "crowded-alerts")
    while True:
        fresh = written(reached.join(jumps, ["label", "upto"]).select("label", F.col("next").alias("upto")), "crowded-alerts")
        if fresh.isEmpty():
            return reached
        # Jumps of length 2 ** k lead from all alerts among the first 2 ** k to the next 2 ** k of them.
        reached = written(reached.unionByName(fresh), "crowded-alerts")
        further = jumps.select("label", F.col("upto").alias("next"), F.col("next").alias("further"))
        jumps = written(jumps.join(further, ["label", "next"]).select("label", "upto", F.col("further").alias("next")), "crowded-pointers")
