"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

* Words are lower case without ASCII punctuation.
* Seeds are the n-grams of an item, all of them by default, so a copy needs no
  more than n neighbouring words intact.  With a ``stretch`` above 1 only the one
  whose words are rarest together, counted over all documents, in every stretch of
  as many neighbouring n-grams is a seed: fewer searches, but heavily edited short copies can be missed.
* A seed found in a document opens a window of about twice the item's length
  around the place where the item would lie.  Item and window are aligned word
  by word (match +1, mismatch and gap -1); the best local score over the item's
  number of words is the score of the pair, 1 for a whole copy.

Items are the query set and documents are scanned once for every block of at most
``block_words`` item words, which is what a task holds of them; a larger
benchmark takes more scans.  Documents are not shuffled, and a passage in a third
of all documents costs each of them one alignment.

A pair is reported if its score is at least ``threshold`` and at least ``least``
words match (all of them in a shorter item).  Each pair is reported once, with its
best window.  Items that are null or have fewer than ``n`` words match nothing, as
do null and empty documents; equal items are reported each, repeated rows each.
An empty table gives no rows.  Extra columns of the documents are kept;
``item_id``, ``score`` and ``last_word`` (where the alignment ends, in words from
0) replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.columns import aside
from plumbline.llm.words import ngram_hashes, portions, text_bytes, word_hashes, word_spans

_KEPT = np.ones(256, bool)
_KEPT[[c for c in range(33, 127) if not chr(c).isalnum()]] = False


def plain_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word, ASCII punctuation left out."""
    use = _KEPT[data]
    before = np.concatenate([[0], np.cumsum(use)])
    data, offsets = data[use], before[offsets]
    start, end, row = word_spans(data, offsets)
    return word_hashes(data, start, end), row


@dataclass(frozen=True)
class Items:
    ids: list
    words: np.ndarray      # of all items, one after another
    offsets: np.ndarray    # where each item begins in words


def blocks(items: DataFrame, item_id: str, text: str, block_words: int) -> Iterator[Items]:
    """The items, in blocks of about ``block_words`` words; one block at a time is on the driver."""
    ids, texts, size = [], [], 0

    def block() -> Items:
        data, offsets = text_bytes(pa.array(texts, pa.string()))
        words, row = plain_words(data, offsets)
        return Items(ids, words, np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(ids)))]))

    rows = items.filter(F.col(f"`{text}`").isNotNull()).select(F.col(f"`{item_id}`"), F.lower(F.col(f"`{text}`")))
    for row in rows.toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        size += 1 + len(row[1]) // 4
        if size >= block_words:
            yield block()
            ids, texts, size = [], [], 0
    if ids:
        yield block()


def _counts(vocabulary: np.ndarray):
    """How often each word of the vocabulary occurs in the batches, as rows (index, n)."""
    def run(batches):
        total = np.zeros(len(vocabulary) + 1, np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for lo, hi in portions(offsets):
                words, _ = plain_words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
                total += np.bincount(np.where(vocabulary[at] == words, at, len(vocabulary)), minlength=len(total))
        used = np.flatnonzero(total[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["word", "n"])
    return run


def rare_seeds(items: Items, weight: np.ndarray, n: int, stretch: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, item, first word within the item) of the seeds, sorted by hash. weight: log frequency of every item word."""
    owner = np.repeat(np.arange(len(items.ids)), np.diff(items.offsets))
    grams, at = ngram_hashes(items.words, owner, n)
    if not len(grams):
        return grams, at, at
    sums = np.concatenate([[0.0], np.cumsum(weight)])
    common, of = sums[at + n] - sums[at], owner[at]
    part = of * (1 << 32) + (at - items.offsets[of]) // stretch
    order = np.lexsort((at, common, part))
    first = np.concatenate([[True], part[order][1:] != part[order][:-1]])
    chosen = order[first]
    chosen = chosen[np.argsort(grams[chosen], kind="stable")]
    return grams[chosen], of[chosen], at[chosen] - items.offsets[of[chosen]]


def local_scores(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman of many pairs at once: rows of a (padded with 0) with rows of b (padded with 1): score and its column."""
    score = np.zeros(b.shape, np.float32)
    best, where = np.zeros(len(a), np.float32), np.zeros(len(a), np.int64)
    gap = np.arange(b.shape[1], dtype=np.float32)
    for i in range(a.shape[1]):
        step = np.where(a[:, i:i + 1] == b, np.float32(1), np.float32(-1))
        step[:, 1:] += score[:, :-1]
        row = np.maximum(np.maximum(step, score - 1), 0)
        score = np.maximum.accumulate(row + gap, axis=1) - gap  # gaps along the window: the best start so far
        at = score.argmax(axis=1)
        top = score[np.arange(len(a)), at]
        better = top > best
        best[better], where[better] = top[better], at[better]
    return best, where


def _padded(source: np.ndarray, first: np.ndarray, size: np.ndarray, blank: int) -> np.ndarray:
    out = np.full((len(first), int(size.max(initial=1))), blank, np.uint64)
    row = np.repeat(np.arange(len(first)), size)
    column = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    out[row, column] = source[first[row] + column]
    return out


def aligned(words: np.ndarray, row: np.ndarray, rows: int, items: Items, seeds: tuple, n: int,
            cells: int = 1 << 20) -> tuple[np.ndarray, ...]:
    """(row, item, score, last word) of all windows that a seed opens."""
    hashes, of, place = seeds
    first_word = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))])
    grams, at = ngram_hashes(words, row, n)
    low, high = np.searchsorted(hashes, grams, side="left"), np.searchsorted(hashes, grams, side="right")
    hits = high - low
    at, low, hits = at[hits > 0], low[hits > 0], hits[hits > 0]
    seed = np.repeat(low, hits) + np.arange(hits.sum()) - np.repeat(np.cumsum(hits) - hits, hits)
    at = np.repeat(at, hits)
    item, size = of[seed], np.diff(items.offsets)[of[seed]]
    # Windows start at multiples of half the item's length, so the seeds of one copy share one or two of them.
    half = (size + 1) // 2
    begin = (at - first_word[row[at]] - place[seed] + half // 2) // half * half - half
    window = np.unique(np.stack([row[at], item, begin], 1), axis=0) if len(at) else np.zeros((0, 3), np.int64)
    r, item, begin = window.T
    size = np.diff(items.offsets)[item]
    lo = np.maximum(first_word[r] + begin, first_word[r])
    hi = np.minimum(first_word[r] + begin + 2 * size + 2, first_word[r + 1])
    score, last = np.zeros(len(r)), np.zeros(len(r), np.int64)
    order, k = np.argsort(size, kind="stable"), 0
    while k < len(order):
        widest = 2 * int(size[order[min(len(order) - 1, k + 255)]]) + 2
        some = order[k:k + max(1, min(256, cells // widest))]
        a = _padded(items.words, items.offsets[item[some]], size[some], 0)
        b = _padded(words, lo[some], hi[some] - lo[some], 1)
        best, where = local_scores(a, b)
        score[some], last[some] = best, lo[some] + where - first_word[r[some]]
        k += len(some)
    return r, item, score, last


def _matches(items: Items, seeds: tuple, n: int, threshold: float, least: int):
    kind = pa.list_(pa.struct([("item", pa.int32()), ("score", pa.float64()), ("last_word", pa.int64())]))
    size = np.diff(items.offsets)

    def run(text: pa.Array) -> pa.Array:
        data, offsets = text_bytes(text)
        out = []
        for lo, hi in portions(offsets):
            words, row = plain_words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            found: list[dict] = [{} for _ in range(hi - lo)]
            for r, item, score, last in zip(*aligned(words, row, hi - lo, items, seeds, n)):
                share = score / size[item]
                if share >= threshold and score >= min(least, size[item]) and share > found[r].get(item, (0,))[0]:
                    found[r][item] = (float(share), int(last))
            out += [[{"item": int(i), "score": s, "last_word": w} for i, (s, w) in sorted(f.items())] for f in found]
        return pa.array(out, kind)

    return F.arrow_udf(run, "array<struct<item: int, score: double, last_word: long>>")


def _block_seeds(docs: DataFrame, block: Items, n: int, stretch: int, text: str) -> tuple:
    """The block's seeds, by the frequency of its words in all documents."""
    vocabulary, at = np.unique(block.words, return_inverse=True)
    often = np.zeros(len(vocabulary))
    if len(vocabulary) and stretch > 1:  # of one n-gram there is no choice
        counts = docs.select(F.lower(F.col(f"`{text}`")).alias("text")).mapInArrow(_counts(vocabulary), "word long, n long") \
            .groupBy("word").agg(F.sum("n").alias("n")).toPandas()  # a row for each word of the block at most
        often[counts["word"].to_numpy(int)] = counts["n"].to_numpy()
    return rare_seeds(block, np.log1p(often)[at], n, stretch)


def clean(docs: DataFrame, items: DataFrame, n: int = 3, stretch: int = 1, threshold: float = 0.5, least: int = 6,
          block_words: int = 1 << 20, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item is found."""
    out = docs
    for block in blocks(items, item_id, item_text, block_words):
        found = _matches(block, _block_seeds(docs, block, n, stretch, text), n, threshold, least)
        out = out.filter(F.size(found(F.lower(F.col(f"`{text}`")))) == 0)
    return out


def leaks(docs: DataFrame, items: DataFrame, n: int = 3, stretch: int = 1, threshold: float = 0.5, least: int = 6,
          block_words: int = 1 << 20, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` once for every item found in them, with item_id, score and last_word."""
    spark = docs.sparkSession
    id_type = items.schema[item_id].dataType
    added = ("item_id", "score", "last_word")
    away, back = aside(docs, *added)
    body = F.lower(F.col(f"`{text}`"))
    out = None
    for block in blocks(items, item_id, item_text, block_words):
        seeds = _block_seeds(docs, block, n, stretch, text)
        names = spark.createDataFrame(list(enumerate(block.ids)), f"_item int, item_id {id_type.simpleString()}")
        found = docs.select(*away, F.explode(_matches(block, seeds, n, threshold, least)(body)).alias("_m"))
        found = found.join(F.broadcast(names), F.col("_m.item") == F.col("_item")).select(  # a block's items, bounded by block_words
            *back, "item_id", "_m.score", "_m.last_word")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = docs.select(*away).select(*back, F.lit(None).cast(id_type).alias("item_id"),
                          F.lit(None).cast("double").alias("score"), F.lit(None).cast("long").alias("last_word")).filter(F.lit(False))
    return out
