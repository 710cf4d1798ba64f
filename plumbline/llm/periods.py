"""Periodic runs of words: stretches that repeat one phrase at least ``exponent`` times, end to end.

Online square catching over dyadic blocks.  At level k the text is cut into blocks
of 2 ** k words.  Once the two blocks from s on are complete they are a catcher for
the periods 2 ** k … 2 ** (k + 1) - 1: while the words of the next block come in,
the window of 2 ** (k + 1) words that begins at each of them is compared with the
catcher.  Being equal at distance d means a square of period d (the window is
longer than d).  So each word advances one comparison a level, and a text of n
words takes n comparisons at each of log n levels, here for all texts of a batch
at once; windows are compared by 64-bit hashes that double in length from level to
level.

* A run of exponent 4 holds a complete catcher: its equal stretch is three periods
  long, the catcher needs 3 * 2 ** k - 1.  Lower exponents are refused.
* If a catcher sees two distances, both are multiples of a shorter period of the
  catcher (theorem of Fine and Wilf), so no run has either as its least period.
* Squares of one distance from neighbouring catchers overlap by a period and merge
  into one run, whose ends lie less than a block beyond; they are found word by word.
* A run that also shows at a multiple of its period has the same ends there; the
  least period stays.

A word is a run of characters other than space, tab, line feed, vertical tab, form
feed and carriage return; words are told apart by 64-bit hashes.

No shuffle: a row's result depends on its text alone, and a task holds about a
megabyte of text besides the batch (one longer text is held as a whole, with some
ten numbers a word).  Null, empty and blank texts have no words and no runs, and
collapse to the empty text.  Repeated rows get equal results, an empty table gives
no rows.  Extra columns are kept; ``n_words``, ``runs`` and ``collapsed`` replace
columns of the same name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.columns import aside
from plumbline.llm.words import mix, portions, text_bytes, word_hashes, word_spans

_MULTIPLIER = np.uint64(0x9FB21C651E98DF25)


def _reach(words: np.ndarray, at: np.ndarray, step: int, apart: np.ndarray, room: np.ndarray, most: int) -> np.ndarray:
    """For each place, how many words from it on (in steps of +1 or -1) equal those ``apart`` away, up to ``most``."""
    out = np.zeros(len(at), np.int64)
    alive = np.arange(len(at))
    for t in range(most):
        alive = alive[room[alive] > t]
        here = at[alive] + step * t
        alive = alive[words[here] == words[here + apart[alive]]]
        if not len(alive):
            break
        out[alive] += 1
    return out


def word_runs(words: np.ndarray, offsets: np.ndarray, exponent: int = 4, least: int = 6) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of every run, by text, start and period.  offsets: where each text's words begin, and the end."""
    if exponent < 4:
        raise ValueError("the catchers are complete from exponent 4 on")
    text = np.arange(len(offsets) - 1)
    window, found, k = words, [], 0
    while True:
        q = 1 << k
        size = np.diff(offsets)
        long = size >= max(least, exponent * q)
        if not long.any():
            break
        if not long.all():  # texts too short for this level's periods go
            stay = np.repeat(long, size)
            words, window, text = words[stay], window[stay], text[long]
            offsets = np.concatenate([[0], np.cumsum(size[long])])
            size = size[long]
        begin, end = np.repeat(offsets[:-1], size), np.repeat(offsets[1:], size)
        here = np.arange(len(words))
        grown = np.zeros(len(words), np.uint64)  # windows of 2 q words; those that cross texts are never asked
        grown[:len(words) - q] = mix(window[:len(words) - q] * _MULTIPLIER + window[q:])
        window = grown
        place = here - begin
        catcher = begin + ((np.maximum(place >> k, 1) - 1) << k)
        hit = here[(place >= q) & (here + 2 * q <= end) & (window == window[catcher])]
        if len(hit):
            source = catcher[hit]
            lone = np.diff(np.flatnonzero(np.concatenate([[True], source[1:] != source[:-1], [True]])))
            hit = hit[np.repeat(lone == 1, lone)]
        if len(hit):
            source = catcher[hit]
            apart = hit - source
            chain = np.concatenate([[True], (source[1:] != source[:-1] + q) | (apart[1:] != apart[:-1]) | (begin[hit[1:]] != begin[hit[:-1]])])
            first, last = np.flatnonzero(chain), np.append(np.flatnonzero(chain)[1:], len(hit)) - 1
            d, s, e = apart[first], source[first], source[last] + 2 * q + apart[first]
            low, high = begin[source[first]], end[source[first]]
            enough = e - s + 2 * q >= exponent * d + 2
            d, s, e, low, high = d[enough], s[enough], e[enough], low[enough], high[enough]
            before = _reach(words, s - 1, -1, d, s - low, q)
            after = _reach(words, e, 1, -d, high - e, q)
            length = e - s + before + after
            # A run of this least period ends within the block; one that goes on is caught at a shorter period.
            good = (before < q) & (after < q) & (length >= np.maximum(least, exponent * d))
            owner = np.searchsorted(offsets, s, side="right") - 1
            found.append(np.stack([text[owner], s - before - low, length, d], 1)[good])
        k += 1
    table = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
    table = table[np.lexsort((table[:, 3], table[:, 2], table[:, 1], table[:, 0]))]
    if len(table):  # of equal ends the least period
        table = table[np.concatenate([[True], (table[1:, :3] != table[:-1, :3]).any(axis=1)])]
    table = table[np.lexsort((table[:, 3], table[:, 1], table[:, 0]))]
    return tuple(table.T)


def repeated_words(offsets: np.ndarray, row: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which words lie in a run after its first period."""
    edge = np.zeros(offsets[-1] + 1, np.int64)
    np.add.at(edge, offsets[row] + start + period, 1)
    np.add.at(edge, offsets[row] + start + length, -1)
    return np.cumsum(edge[:-1]) > 0


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"


def _finder(exponent: int, least: int):
    def find(text: pa.Array) -> pa.Array:
        data, offsets = text_bytes(text)
        counts, runs, collapsed = [], [], []
        for lo, hi in portions(offsets):
            own = offsets[lo:hi + 1] - offsets[lo]
            body = data[offsets[lo]:offsets[hi]]
            begin, end, row = word_spans(body, own)
            size = np.bincount(row, minlength=hi - lo)
            first = np.concatenate([[0], np.cumsum(size)])
            found = word_runs(word_hashes(body, begin, end), first, exponent, least)
            runs.append((found[0] + lo, *found[1:]))
            counts.append(size)
            gone = repeated_words(first, *found)
            cut = set(found[0].tolist())
            for r in range(hi - lo):
                words = body[own[r]:own[r + 1]].tobytes().split()  # bytes split at the same six characters
                if r in cut:
                    kept = np.flatnonzero(~gone[first[r]:first[r + 1]])
                    words = [words[i] for i in kept.tolist()]
                collapsed.append(b" ".join(words))
        rows = len(text)
        row, start, length, period = (np.concatenate(x) for x in zip(*runs)) if runs else (np.zeros(0, np.int64),) * 4
        lists = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))]).astype(np.int32)
        fields = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], fields=list(_RUN))
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate(counts) if counts else np.zeros(0), pa.int64()),
             pa.ListArray.from_arrays(pa.array(lists), fields), pa.array(collapsed, pa.binary())], ["n_words", "runs", "collapsed"])

    return F.arrow_udf(find, _SCHEMA)


def periodic(docs: DataFrame, text: str = "text", exponent: int = 4, least: int = 6) -> DataFrame:
    """Adds n_words, runs (by start, then period) and collapsed: the words outside all runs and each run's first period, joined by spaces.

    A run is a stretch of at least ``exponent`` periods and ``least`` words that no neighbouring word extends.
    """
    added = ("n_words", "runs", "collapsed")
    away, back = aside(docs, *added)
    found = _finder(exponent, least)(F.col(f"`{text}`")).alias("_found")
    return docs.select(*away, found).select(*back, "_found.n_words", "_found.runs", F.col("_found.collapsed").cast("string").alias("collapsed"))
