"""Suffix-order removal of repeated passages, built column by column.

A byte goes when it lies in a ``width``-byte string that starts at a second place
anywhere, the same text included.

The collection is ordered as a column-wise construction does it: one symbol of
every member is inserted per round, from the last column to the first; the order
of all suffixes (the members' symbols in that order are the transform) and the
common prefixes of neighbours are carried from round to round, so a round costs
one stable sort by symbol and one pass over the prefixes.  A window repeats
exactly if the common prefix with a neighbour reaches ``width``.

Inserting whole texts this way would take as many rounds as the longest text has
bytes, over one ever growing collection.  Two steps make it local and exact:

* Every window is known by its minimiser, the position of the least hash of its
  32-byte strings (the first one if there are several).  Equal windows have their
  minimiser at the same place, so only members with the same minimiser hash have
  to be compared, and only *aligned on it*: suffixes of one column.  A member is
  the run of windows of a text that share one minimiser: at most
  ``2 * width - 32`` bytes, hence as many rounds.
* Equal members are counted, not compared.  A member that occurs twice repeats as
  a whole; only different members with the same minimiser hash enter the rounds.

Members reach their task through Spark's external sort, in the order of their
minimiser hash, and are worked off in batches of whole groups; a batch holds at
most twice ``group_rows`` members.  Larger groups (a hot passage with thousands of
variants) are not compared in one task: their windows are counted by a 128-bit
hash in an ordinary aggregate, which gives the same windows.

Equal texts are one text that occurs several times, so all of it repeats.  A text
shorter than ``width`` keeps everything; null counts as empty.  Repeated rows
count as copies.  An empty table gives no rows.  Member hashes are 64 bits beside
the 64 bits of the minimiser's string; texts are told apart by MD5.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.columns import aside
from plumbline.llm.words import mix
from plumbline.session import shared_folder, written

SEED = 32  # bytes of a minimiser's string
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_BITS = 21  # positions within a portion
PORTION = (1 << _BITS) - 1024


def seed_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from every position, doubling the length five times."""
    h = data.astype(np.uint64) + np.uint64(1)
    for k, m in enumerate(_MULTIPLIERS):
        s = 1 << k
        h = h[:-s] * np.uint64(m) + h[s:]
    return mix(h)


def members(data: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one minimiser: first window, number of windows, minimiser's position and hash."""
    h = seed_hashes(data)
    key = (h >> np.uint64(_BITS) << np.uint64(_BITS)) | np.arange(len(h), dtype=np.uint64)
    seen, span = 1, width - SEED + 1
    while 2 * seen <= span:
        key = np.minimum(key[:-seen], key[seen:])
        seen *= 2
    if span > seen:
        key = np.minimum(key[:seen - span], key[span - seen:])
    at = (key & np.uint64((1 << _BITS) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return first, np.diff(np.append(first, len(at))), at[first], h[at[first]]


MEMBERS = "seed long, body long, text_key binary, lo long, windows int, lead int, copies long"


def _members(width: int):
    def packed(batch: pa.RecordBatch, found: list[tuple]) -> pa.RecordBatch:
        row, seed, body, lo, windows, lead = (np.concatenate(x) for x in zip(*found))
        row = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [pa.array(seed.view(np.int64)), pa.array(body.view(np.int64)), batch.column(0).take(row), pa.array(lo),
             pa.array(windows.astype(np.int32)), pa.array(lead.astype(np.int32)), batch.column(2).take(row)],
            ["seed", "body", "text_key", "lo", "windows", "lead", "copies"])

    def run(batches):
        for batch in batches:
            found, size = [], 0
            for r, text in enumerate(batch.column(1)):
                data = text.as_buffer()
                whole, view = np.frombuffer(data, np.uint8), memoryview(data)
                for cut in range(0, len(whole) - width + 1, PORTION - width):  # windows from cut on
                    first, n, at, seed = members(whole[cut:cut + PORTION - 1], width)
                    lo = first + cut
                    body = [xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(lo.tolist(), (lo + n + width - 1).tolist())]
                    found.append((np.full(len(lo), r), seed, np.array(body, np.uint64), lo, n, at - first))
                    size += len(lo)
                if size > 50_000:
                    yield packed(batch, found)
                    found, size = [], 0
            if found:
                yield packed(batch, found)
    return run


def repeated_windows(columns: np.ndarray, begin: np.ndarray, end: np.ndarray, group: np.ndarray, width: int) -> np.ndarray:
    """Which windows (member x first column) equal the window at the same columns of another member of the group.

    Column-wise construction: ``order`` are the members sorted by their suffix
    from the column last inserted, ``common`` the prefix each shares with the one
    before it (up to ``width``).
    """
    rows, last = columns.shape
    found = np.zeros((rows, last), bool)
    order = np.argsort(group, kind="stable")
    common = np.zeros(rows + 1, np.int32)
    base = group.astype(np.int64) * 257
    for c in range(int(end.max(initial=0)) - 1, -1, -1):
        present = (begin <= c) & (c < end)
        symbol = base + np.where(present, columns[:, c].astype(np.int64), 256)
        inserted = symbol[order]
        moved = np.argsort(inserted, kind="stable")  # new place to old place
        order, inserted = order[moved], inserted[moved]
        follow = np.flatnonzero((inserted[1:] == inserted[:-1]) & present[order[1:]]) + 1
        grown = np.zeros(rows + 1, np.int32)
        if len(follow):
            # The least common prefix between the two old places, and the new symbol.
            between = np.minimum.reduceat(common, np.stack([moved[follow - 1] + 1, moved[follow] + 1], 1).ravel())[::2]
            grown[follow] = np.minimum(between + 1, width)
            hit = follow[grown[follow] == width]
            found[order[hit], c] = found[order[hit - 1], c] = True
        common = grown
    return found


SPANS = "text_key binary, start long, stop long"


def _runs(found: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, stop) of the bytes covered by found windows; first: the byte at column 0 of each row."""
    padded = np.zeros((len(found), found.shape[1] + 2), np.int8)
    padded[:, 1:-1] = found
    step = np.diff(padded, axis=1)
    row, begin = np.nonzero(step == 1)
    _, stop = np.nonzero(step == -1)
    return row, first[row] + begin, first[row] + stop - 1 + width


def _compare(width: int, group_rows: int):
    most = width - SEED  # columns before the minimiser

    def settle(table: pa.Table) -> pa.RecordBatch:
        seeds = table.column("seed").to_numpy()
        group = np.cumsum(np.concatenate([[0], seeds[1:] != seeds[:-1]])) if len(seeds) else seeds
        pieces = table.column("piece").combine_chunks().cast(pa.large_binary())
        offsets = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset:pieces.offset + len(pieces) + 1]
        data = np.frombuffer(pieces.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        size = np.diff(offsets)
        begin = most - table.column("lead").to_numpy().astype(np.int64)
        columns = np.zeros((len(size), 2 * width - SEED), np.uint8)
        row = np.repeat(np.arange(len(size)), size)
        columns[row, np.arange(len(data)) - (offsets[:-1] - offsets[0])[row] + begin[row]] = data
        found = repeated_windows(columns, begin, begin + size, group, width)
        at, start, stop = _runs(found, table.column("lo").to_numpy() - begin, width)
        return pa.RecordBatch.from_arrays([table.column("text_key").combine_chunks().take(pa.array(at)),
                                           pa.array(start), pa.array(stop)], ["text_key", "start", "stop"])

    def run(batches):
        held, last, rows = [], None, 0
        for batch in batches:
            seeds = batch.column(batch.schema.get_field_index("seed")).to_numpy()
            at = 0
            while at < len(seeds):
                # Up to the end of a group once there are enough rows.
                edges = np.flatnonzero(seeds[at + 1:] != seeds[at:-1]) + at + 1
                if rows >= group_rows and seeds[at] != last:
                    yield settle(pa.Table.from_batches(held))
                    held, rows = [], 0
                room = edges[edges - at + rows >= group_rows]
                stop = int(room[0]) if len(room) else len(seeds)
                held.append(batch.slice(at, stop - at))
                rows, last, at = rows + stop - at, seeds[stop - 1], stop
        if held:
            yield settle(pa.Table.from_batches(held))
    return run


def _pieces(batches):
    """(text, its members to compare) to one row for each member, with its bytes."""
    for batch in batches:
        for key, body, wanted in zip(batch.column(0), batch.column(1), batch.column(2)):
            view, key = memoryview(body.as_buffer()), key.as_py()
            items = wanted.values
            lo, stop = items.field("lo"), items.field("stop")
            cut = [bytes(view[a:b]) for a, b in zip(lo.to_pylist(), stop.to_pylist())]
            yield pa.RecordBatch.from_arrays([items.field("seed"), pa.array([key] * len(cut), pa.binary()), lo, items.field("lead"),
                                              items.field("copies"), items.field("hot"), pa.array(cut, pa.binary())],
                                             ["seed", "text_key", "lo", "lead", "copies", "hot", "piece"])


PIECES = "seed long, text_key binary, lo long, lead int, copies long, hot boolean, piece binary"


def _windows(width: int):
    def run(batches):
        for batch in batches:
            for seed, key, lo, copies, piece in zip(*(batch.column(c) for c in ("seed", "text_key", "lo", "copies", "piece"))):
                view, first = memoryview(piece.as_buffer()), lo.as_py()
                count = len(view) - width + 1
                ids = [xxhash.xxh3_128_digest(view[k:k + width]) for k in range(count)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.binary()), pa.array([key.as_py()] * count, pa.binary()),
                    pa.array(np.arange(first, first + count)), pa.array(np.full(count, copies.as_py(), np.int64))],
                    ["id", "text_key", "start", "copies"])
    return run


def _cut(batches):
    """Removed spans (maximal runs) and remaining bytes of each text."""
    for batch in batches:
        spans, kept, sizes = [], [], []
        for body, copies, width, found in zip(*(batch.column(k) for k in (1, 2, 3, 4))):
            data = np.frombuffer(body.as_buffer(), np.uint8)
            edge = np.zeros(len(data) + 1, np.int64)
            if copies.as_py() > 1 and len(data) >= width.as_py():
                edge[0], edge[-1] = 1, -1
            elif found.is_valid:
                np.add.at(edge, found.values.field("start").to_numpy(), 1)
                np.add.at(edge, found.values.field("stop").to_numpy(), -1)
            gone = np.cumsum(edge[:-1]) > 0
            step = np.diff(np.concatenate([[0], gone, [0]]).astype(np.int8))
            spans.append([{"start": a, "stop": b} for a, b in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist())])
            kept.append(data[~gone].tobytes())
            sizes.append(len(data))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
                                         ["text_key", "n_bytes", "spans", "kept"])


def text_key(text: str = "text"):
    return F.unhex(F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))))


def stored_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Each different text once, as (text_key, body, copies), bucketed by key so that later joins leave the bytes where they are."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name, path = f"texts_{uuid.uuid4().hex}", shared_folder(spark, "repeat-texts")
    (docs.select(text_key(text).alias("text_key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("body"))
     .groupBy("text_key").agg(F.any_value("body").alias("body"), F.count("*").alias("copies"))
     .repartition(buckets, "text_key").write.bucketBy(buckets, "text_key").option("path", path).option("compression", "zstd")
     .saveAsTable(name))
    return spark.table(name)


def cut_texts(docs: DataFrame, width: int = 400, group_rows: int = 4096, text: str = "text") -> DataFrame:
    """One row for each different text: text_key, n_bytes, spans (removed runs of bytes) and kept (the other bytes)."""
    if width <= SEED:
        raise ValueError(f"width must be over {SEED}")
    texts = stored_texts(docs, text)
    found = written(texts.filter(F.octet_length("body") >= width).select("text_key", "body", "copies")
                    .mapInArrow(_members(width), MEMBERS), "repeat-members")
    # Stored, so that both sides of the join are plain exchanges and a seed with very many members is split.
    shared = written(found.groupBy("seed").agg(F.sum("copies").alias("n")).filter("n > 1").select("seed"), "repeat-seeds")
    found = written(found.join(shared, "seed"), "repeat-shared")
    # Equal members: counted, with one of them to stand for all.
    kinds = found.groupBy("seed", "body").agg(
        F.sum("copies").alias("copies"), F.min(F.struct("text_key", "lo", "windows", "lead")).alias("one"))
    kinds = written(kinds, "repeat-kinds")
    whole = found.join(kinds.filter("copies > 1").select("seed", "body"), ["seed", "body"]) \
        .select("text_key", F.col("lo").alias("start"), (F.col("lo") + F.col("windows") + (width - 1)).alias("stop"))
    # Different members with one seed: their bytes, side by side.
    groups = written(kinds.groupBy("seed").agg(F.count("*").alias("n")).filter("n > 1"), "repeat-groups")
    wanted = kinds.join(groups, "seed").select(
        F.col("one.text_key").alias("text_key"),
        F.struct("seed", F.col("one.lo").alias("lo"), (F.col("one.lo") + F.col("one.windows") + (width - 1)).alias("stop"),
                 F.col("one.lead").alias("lead"), "copies", (F.col("n") > group_rows).alias("hot")).alias("item"))
    wanted = wanted.groupBy("text_key").agg(F.collect_list("item").alias("wanted"))  # at most one per byte of a text
    pieces = written(texts.select("text_key", "body").join(wanted, "text_key").select("text_key", "body", "wanted")
                     .mapInArrow(_pieces, PIECES), "repeat-pieces")
    usual = pieces.filter("not hot").repartition("seed").sortWithinPartitions("seed").mapInArrow(_compare(width, group_rows), SPANS)
    windows = pieces.filter("hot").mapInArrow(_windows(width), "id binary, text_key binary, start long, copies long")
    twice = windows.groupBy("id").agg(F.sum("copies").alias("n")).filter("n > 1").select("id")
    hot = windows.join(twice, "id").select("text_key", "start", (F.col("start") + width).alias("stop"))
    spans = whole.unionByName(usual).unionByName(hot).groupBy("text_key").agg(F.collect_list(F.struct("start", "stop")).alias("found"))
    return (texts.select("text_key", "body", "copies").join(written(spans, "repeat-spans"), "text_key", "left")
            .select("text_key", "body", "copies", F.lit(width).alias("width"), "found")
            .mapInArrow(_cut, "text_key binary, n_bytes long, spans array<struct<start: long, stop: long>>, kept binary"))


def of_rows(docs: DataFrame, per_text: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with what ``per_text`` has for their text (its columns replace those of the same name)."""
    new = [c for c in per_text.columns if c != "text_key"]
    away, back = aside(docs, *new)
    stored = written(per_text.withColumnRenamed("text_key", "_of"), "repeat-results")
    return docs.select(*away, text_key(text).alias("_key")).join(stored, F.col("_key") == F.col("_of")).select(*back, *new)
