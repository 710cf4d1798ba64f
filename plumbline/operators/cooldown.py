"""At most one alert per key and cooldown, counted from the last alert sent.

The rule is sequential: whether a violation is sent depends on the alert before
it.  A fold over all violations of a key would put that key into one task.  Here
the timeline of every key is cut into segments that are worked on in parallel.
Segments are spans of time: the distinct moments of one key within ``fan_in``
cooldowns meet in one task.  Keys with more than ``crowd`` rows in one of them go
by pointers instead (``operators.crowded``), which divides them by rows.

What happens inside a segment depends on the past only through one number, the
first moment at which an alert may be sent again.  So a segment is summarised by
rows ``(upto, sent)``: if alerts are allowed from a moment not later than
``upto`` (and later than the row before), the last alert of the segment is
``sent``.  A single violation is such a row with ``upto = sent``, and summaries of
neighbouring segments combine by the same rule.  Two rounds upwards summarise
long segments, the few rows that are left per key are walked in order, and two
rounds downwards find the alerts inside the segments.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import timedelta

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators import crowded
from plumbline.session import written

EVER = -(2**60)         # alerts are allowed from the start
EPOCH = "1970-01-01 00:00:00"
EXACT = {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}


def _micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def _moment(micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", micros, F.lit(EPOCH).cast("timestamp_ntz"))


def _changes(values: np.ndarray) -> np.ndarray:
    """True for the first row of every run of equal values."""
    return np.append(True, values[1:] != values[:-1])


def whole_runs(batches: Iterator[pa.RecordBatch], run_of: Callable[[pa.Table], np.ndarray],
               enough: int = 1 << 18) -> Iterator[pa.Table]:
    """The rows of a sorted partition in portions that divide no run."""
    waiting, rows, wanted = [], 0, enough
    for batch in batches:
        waiting.append(batch)
        rows += batch.num_rows
        if rows >= wanted:
            portion = pa.Table.from_batches(waiting).combine_chunks()
            last = int(np.flatnonzero(_changes(run_of(portion)))[-1])
            if last:
                yield portion.slice(0, last)
            rest = portion.slice(last)
            waiting, rows = rest.to_batches(), rest.num_rows
            wanted = max(enough, 2 * rows)
    if rows:
        yield pa.Table.from_batches(waiting).combine_chunks()


def label_codes(rows: pa.Table) -> np.ndarray:
    return rows["label"].combine_chunks().dictionary_encode().indices.to_numpy()


def label_runs(rows: pa.Table) -> np.ndarray:
    """Numbers that change where the label does."""
    labels = rows["label"].combine_chunks()
    return np.append(0, np.cumsum(pc.not_equal(labels[1:], labels[:-1]).to_numpy(zero_copy_only=False)))


class Lanes:
    """The rows of many groups on one axis, so that a single sorted search serves
    them all: every group gets a lane that no moment of interest leaves."""

    def __init__(self, group: np.ndarray, upto: np.ndarray, sent: np.ndarray, pause: int):
        self.group = np.cumsum(_changes(group)) - 1
        self.upto, self.sent = upto, sent
        self.origin = int(upto.min())
        self.lane = int(upto.max()) - self.origin + pause + 1
        self.position = self.group * self.lane + (upto - self.origin)

    def first_from(self, group: np.ndarray, moment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first row of each group at or after a moment, and whether there is one."""
        offset = np.clip(moment - self.origin, 0, self.lane - 1)
        row = np.searchsorted(self.position, group * self.lane + offset)
        return row, np.append(self.group, -1)[row] == group


def grouped(rows: pa.Table, width: int | None, pause: int) -> Iterator[tuple[pa.Table, Lanes]]:
    """Rows ordered by moment, brought together by label and segment; as many
    groups at a time as have room for their lanes in 64 bits."""
    upto, codes = rows["upto"].to_numpy(), label_codes(rows)
    segment = np.zeros_like(upto) if width is None else upto // width
    group = (segment - segment.min()) * (int(codes.max()) + 1) + codes
    order = np.argsort(group, kind="stable")
    rows, group = rows.take(pa.array(order)), group[order]
    upto = upto[order]
    sent = rows["sent"].to_numpy() if "sent" in rows.column_names else upto
    room = max(1, 2**62 // (int(upto.max()) - int(upto.min()) + pause + 1))
    cuts = [*np.flatnonzero(_changes(group))[::room], len(group)]
    for begin, end in zip(cuts[:-1], cuts[1:]):
        part = slice(begin, end)
        yield rows.slice(begin, end - begin), Lanes(group[part], upto[part], sent[part], pause)


def _batch(rows: pa.Table, chosen: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    label = rows["label"].combine_chunks().take(pa.array(chosen))
    return pa.RecordBatch.from_arrays([label, *[pa.array(v) for v in columns.values()]], ["label", *columns])


def summarise(rows: pa.Table, lanes: Lanes, pause: int, width: int) -> pa.RecordBatch:
    """Rows of whole segments to the rows of their summaries."""
    follower, follows = lanes.first_from(lanes.group, lanes.sent + pause)
    last = np.where(follows, follower, np.arange(len(follower)))
    while True:                         # jump to the last alert of each chain
        further = last[last]
        if np.array_equal(further, last):
            break
        last = further
    final = lanes.sent[last]
    same_group = np.append(lanes.group[1:] == lanes.group[:-1], False)
    # An alert before the segment forbids less than its first ``pause``, so only
    # rows up to the first one beyond that can be where alerts resume.
    beyond = lanes.upto % width >= pause - 1
    reachable = np.append(True, ~(same_group & beyond)[:-1])
    merged = same_group & np.append(reachable[1:], False) & np.append(final[1:] == final[:-1], False)
    keep = np.flatnonzero(reachable & ~merged)
    return _batch(rows, keep, upto=lanes.upto[keep], sent=final[keep])


def walk(rows: pa.Table, lanes: Lanes, pause: int) -> pa.RecordBatch:
    """The rows passed on the way through each group, starting from its
    ``allowed``, each with the moment from which alerts were allowed there."""
    group, first = np.unique(lanes.group, return_index=True)
    allowed = rows["allowed"].to_numpy()[first]
    passed, arrivals = [], []
    while len(group):
        row, found = lanes.first_from(group, allowed)
        row, group = row[found], group[found]
        passed.append(row)
        arrivals.append(allowed[found])
        allowed = lanes.sent[row] + pause
    chosen = np.concatenate(passed)
    return _batch(rows, chosen, upto=lanes.upto[chosen], allowed=np.concatenate(arrivals))


def alerts_with_cooldown(violations: DataFrame, keys: Sequence[str], ts: str, cooldown: timedelta,
                         last_sent: DataFrame | None = None, fan_in: int = 32, crowd: int = 1 << 20) -> DataFrame:
    """``keys`` and ``ts`` of the alerts sent.  ``last_sent`` holds, for some of
    the keys, the newest alert of earlier runs in a column ``ts``."""
    keys = list(keys)
    pause = int(cooldown / timedelta(microseconds=1))
    short, long = pause * fan_in, pause * fan_in * fan_in
    # One text per key; unlike the key columns it is never NULL.
    label = F.to_json(F.struct(*keys), EXACT).alias("label")
    row_schema, entry_schema = "label string, upto long, sent long", "label string, upto long, allowed long"

    def segment(width: int) -> Column:
        # Whole numbers throughout: a rounded quotient could miss the boundary.
        return F.expr(f"(upto - pmod(upto, {width}L)) div {width}L").alias("segment")

    def by_segment(df: DataFrame, width: int) -> DataFrame:
        return df.select("*", segment(width)).repartition("label", "segment")

    def upwards(width: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in whole_runs(batches, lambda t: t["upto"].to_numpy() // width):
                for some, lanes in grouped(rows, width, pause):
                    yield summarise(some, lanes, pause, width)
        return run

    def downwards(width: int | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            runs = label_runs if width is None else lambda t: t["upto"].to_numpy() // width
            for rows in whole_runs(batches, runs):
                for some, lanes in grouped(rows, width, pause):
                    yield walk(some, lanes, pause)
        return run

    def summaries(segments: DataFrame, width: int) -> DataFrame:
        """Ordered by moment alone, which Spark does by radix sort; segments are
        spans of time, so they come one after the other."""
        return segments.drop("segment").sortWithinPartitions("upto").mapInArrow(upwards(width), row_schema)

    def resolve(segments: DataFrame, entries: DataFrame, width: int) -> DataFrame:
        """Segments that alerts come through; the others send nothing."""
        entered = segments.join(entries.select("label", segment(width), "allowed"), ["label", "segment"])
        return entered.drop("segment").sortWithinPartitions("upto").mapInArrow(downwards(width), entry_schema)

    rows = violations.select(label, _micros(F.col(ts)).alias("upto")).dropna(subset=["upto"])
    full = rows.groupBy("label", segment(short)).agg(F.count("*").alias("n")).filter(F.col("n") > crowd)
    crowds = full.select("label").distinct().collect()  # at most one for ``crowd`` rows
    # Equal moments of a key are one violation; tasks drop them before the
    # shuffle, so a segment holds at most its number of distinct moments.
    events = rows.distinct()
    if last_sent is not None:
        # What is too close to an earlier alert is not sent; the rest starts anew.
        earlier = last_sent.groupBy(label).agg((F.max(_micros(F.col(ts))) + pause).alias("allowed"))
        events = (events.join(earlier, "label", "left")
                  .filter("allowed is null or upto >= allowed").drop("allowed"))
    pointed = None
    if crowds:
        names = written(violations.sparkSession.createDataFrame(crowds, "label string"), "crowds")
        pointed = crowded.alerts(events.join(names, "label", "left_semi"), pause)
        events = events.join(names, "label", "left_anti")
    in_short = by_segment(events, short)
    in_long = by_segment(summaries(in_short, short), long)
    overview = summaries(in_long, long).repartition("label").withColumn("allowed", F.lit(EVER))
    entries = overview.sortWithinPartitions("label", "upto").mapInArrow(downwards(None), entry_schema)
    sent = resolve(in_short, resolve(in_long, entries, long), short)
    if pointed is not None:
        sent = sent.select("label", "upto").unionByName(pointed)

    key_type = T.StructType([T.StructField(k, violations.schema[k].dataType) for k in keys])
    return sent.select(F.from_json("label", key_type, EXACT).alias("key"), _moment(F.col("upto")).alias(ts)).select("key.*", ts)
