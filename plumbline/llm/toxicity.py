"""Toxicity of texts whose words may be disguised.

Noisy channel: a writer's letters are observed with look-alikes for letters
(1 for i or l), separators put between letters, letters repeated, or letters
masked by a star.  Every disguised unit is a lattice of the letters its characters
may stand for; the Viterbi path under a character model and the channel's
costs is the restored reading.  Restored texts are scored.

* **Units.** A word is stripped of quotes and other marks around it and cut at
  marks within.  It is a unit if it mixes letters with look-alikes or masks, or
  repeats a letter three times, or most of its letters twice.  Three or more single
  characters in a row, at least half of them letters and the rest look-alikes, apart
  by one blank or one mark each, are one unit, in which every gap may be a word's end.  All other words stand as they are:
  their lattice has one path.
* **Language model.** Four symbols in a row (a to z, any other letter, the word
  boundary), counted over all words of all texts and interpolated with fewer.
* **Score.** Logistic regression over hashed words of the restored text and their
  beginnings (present or not), fitted on at most about ``sample_rows`` labelled rows, chosen by a hash
  of the id, on the ``chosen`` features that tell the classes apart best.

Restoring and scoring are one pass without a shuffle.  Restored units are
remembered within a task (``REMEMBERED`` of them at a time).

Null and empty texts have no words, and score as the model's intercept says.
Repeated rows get equal scores.  Without labelled rows, or with one class only,
every text gets the (smoothed) share of that class.  Labels other than 0 and 1 are
ignored; an id labelled both ways counts as toxic.  An empty table gives no rows.
Extra columns are kept; ``restored`` and ``score`` replace columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.columns import aside
from plumbline.llm.words import mix, portions, text_bytes, word_hashes, word_spans
from plumbline.session import written

# What a character may stand for besides itself, with its cost (natural logarithm).
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c",
}
MASKS = "*#%"
VOWELS = "aeiou"
SEPARATORS = ".-_~/,'·"
SWAPPED, MASKED, MASKED_OTHER, DROPPED, LITERAL = -1.0, -1.5, -4.0, -0.5, -14.0
ENDED = -0.5      # a gap between single letters is the end of a word
ONCE, TWICE, KEPT = -0.4, -0.8, -2.0  # a run of equal letters stands for one, for two; a double letter that stands for one

SYMBOLS = 28      # a to z, any other letter, the boundary
OTHER, EDGE = 26, 27
ORDER = 4
CELLS = SYMBOLS**ORDER
CONTEXTS = SYMBOLS**(ORDER - 1)
START = CONTEXTS - 1  # three boundaries
FEATURES = 1 << 18
BEGINNINGS = (4, 5, 6, 7)
REMEMBERED = 200_000

# Classes of bytes.
_LETTER, _ALIKE, _MASK, _JOIN = 1, 2, 3, 4
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(ord("a"), ord("z") + 1), *range(128, 256)]] = _LETTER
_CLASS[[ord(c) for c in LOOKALIKES]] = _ALIKE
_CLASS[[ord(c) for c in MASKS]] = _MASK
_CLASS[[ord(c) for c in SEPARATORS if ord(c) < 128]] = _JOIN
_OUTSIDE = np.zeros(256, bool)  # taken off the ends of a word
_OUTSIDE[[ord(c) for c in "\"'`()[]{}<>.,;:!?#%*-_~/\\^&="]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


@dataclass(frozen=True)
class Letters:
    """log P(symbol | the three before it); the first axis numbers the three."""
    log_chance: np.ndarray

    def table(self) -> list[list[float]]:
        return self.log_chance.tolist()


def letters_from(counts: np.ndarray) -> Letters:
    """Interpolated: each order gives way to the shorter one by how rarely its context was seen."""
    chance = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(1, ORDER + 1):
        n = counts.reshape(-1, *[SYMBOLS] * order).sum(axis=0)
        chance = (n + 10 * chance) / (n.sum(axis=-1, keepdims=True) + 10)
    return Letters(np.log(chance).reshape(-1, SYMBOLS).astype(np.float32))


def cores(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(bytes in lower case, first byte, end byte, row) of every word without the marks around it; words of marks alone are left out."""
    body = _LOWER[data]
    start, end, row = word_spans(body, offsets)
    inner = ~_OUTSIDE[body]
    # The next inner byte from the start on, the last one before the end.
    place = np.arange(len(body))
    following = np.minimum.accumulate(np.where(inner, place, len(body))[::-1])[::-1] if len(body) else place
    before = np.maximum.accumulate(np.where(inner, place, -1))
    first, last = (following[start], before[end - 1] + 1) if len(start) else (start, end)
    good = first < last
    good &= first < end
    return body, first[good], last[good], row[good], start[good], end[good]


def plain_words(data: np.ndarray, offsets: np.ndarray):
    """Cores that consist of letters."""
    body, first, last, row, _, _ = cores(data, offsets)
    strange = np.concatenate([[0], np.cumsum(_CLASS[body] != _LETTER)])
    good = strange[first] == strange[last]
    return body, first[good], last[good]


def symbol_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How often each four symbols follow one another within a word, boundaries before and after it."""
    body, first, last = plain_words(data, offsets)
    code = np.full(len(body), OTHER, np.int64)
    ascii_letter = (body >= ord("a")) & (body <= ord("z"))
    code[ascii_letter] = body[ascii_letter] - ord("a")
    size = last - first
    # Every word as three boundaries, letters, one boundary; later bytes of a letter of several bytes are skipped.
    begin = np.cumsum(size + ORDER) - (size + ORDER)
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    flat = np.full(int((size + ORDER).sum()), EDGE, np.int64)
    skip, opening = np.zeros((2, len(flat)), bool)
    spot, source = np.repeat(begin + ORDER - 1, size) + inner, np.repeat(first, size) + inner
    flat[spot] = code[source]
    skip[spot] = (body[source] & 0xC0) == 0x80
    for k in range(ORDER - 1):
        opening[begin + k] = True
    flat, opening = flat[~skip], opening[~skip]
    if len(flat) < ORDER:
        return np.zeros(CELLS, np.int64)
    cell = flat[:1 - ORDER]
    for k in range(1, ORDER):
        cell = cell * SYMBOLS + flat[k:len(flat) - ORDER + 1 + k]
    return np.bincount(cell[~opening[ORDER - 1:]], minlength=CELLS)  # what a boundary before a word follows is no matter


def letters(docs: DataFrame, text: str = "text") -> Letters:
    """The language model of all texts."""
    def count(batches):
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for lo, hi in portions(offsets):
                total += symbol_counts(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(total[cell])], ["cell", "n"])

    found = docs.select(F.col(f"`{text}`")).mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(CELLS)  # as many cells at most reach the driver
    counts[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return letters_from(counts)


def lattice(unit: str, spaced: bool) -> list[list[tuple[str, float]]]:
    """For each character, or run of one letter, what it may stand for and at what cost.  "" is nothing, " " the end of a word."""
    arcs, i = [], 0
    while i < len(unit):
        c = unit[i]
        n = 1
        while i + n < len(unit) and unit[i + n] == c:
            n += 1
        if "a" <= c <= "z" or c > "\x7f" and c not in SEPARATORS:
            options = [(c, 0.0)] if n == 1 else [(c, KEPT), (c * 2, 0.0)] if n == 2 else [(c, ONCE), (c * 2, TWICE)]
        elif c in LOOKALIKES:
            options = [(x, SWAPPED) for x in LOOKALIKES[c]] + [(c, LITERAL)]
            if n > 1:
                options += [(x * 2, SWAPPED + TWICE) for x in LOOKALIKES[c]]
        elif c in MASKS:
            options = [(x, MASKED if x in VOWELS else MASKED_OTHER) for x in "abcdefghijklmnopqrstuvwxyz"] + [("", DROPPED * 2)]
        elif spaced:
            options = [("", DROPPED), (" ", ENDED)]
        else:
            options = [("", DROPPED), (" ", DROPPED)]
        arcs.append(options)
        i += n
    return arcs


def decoded(unit: str, spaced: bool, table: list[list[float]]) -> str:
    """The best path through the unit's lattice.  table: log P(symbol) for each three symbols before it."""
    best = {START: (0.0, "")}
    for options in lattice(unit, spaced):
        after = {}
        for context, (score, read) in best.items():
            for said, cost in options:
                total, x = score + cost, context
                for c in said:
                    s = EDGE if c == " " else ord(c) - 97 if "a" <= c <= "z" else OTHER
                    total += table[x][s]
                    x = START if s == EDGE else (x * SYMBOLS + s) % CONTEXTS
                known = after.get(x)
                if known is None or total > known[0]:
                    after[x] = (total, read + said)
        best = after
    return max((score + (table[x][EDGE] if x != START else 0.0), read) for x, (score, read) in best.items())[1].strip()


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int, bool]]]:
    """(bytes in lower case, units as (first byte, end byte, row, spaced)), in order, none overlapping."""
    body, first, last, row, start, end = cores(data, offsets)
    if not len(first):
        return body, []
    kind = _CLASS[body]
    sums = lambda mask: np.concatenate([[0], np.cumsum(mask)])
    within = lambda total: total[last] - total[first]
    ascii_letter = (kind == _LETTER) & (body < 128)
    n_letters, n_alike, n_masks = (within(sums(x)) for x in (ascii_letter, kind == _ALIKE, kind == _MASK))
    size = last - first
    # Doubled and tripled letters, seen at the last of them.
    double = np.zeros(len(body), bool)
    double[1:] = ascii_letter[1:] & (body[1:] == body[:-1])
    triple = np.zeros(len(body), bool)
    triple[2:] = double[2:] & double[1:-1]
    doubles, triples = sums(double), sums(triple)
    inside = lambda total, by: total[last] - total[np.minimum(first + by, last)]
    mixed = (n_letters > 0) & ((n_alike > 0) | (n_masks > 0) | (inside(triples, 2) > 0) | (inside(doubles, 1) > 2) & (5 * inside(doubles, 1) >= 2 * size))
    # Single letters or look-alikes, each a word of its own, with one blank between.
    single = (size == 1) & (end - start == 1) & ((kind[first] == _LETTER) | (kind[first] == _ALIKE))
    linked = np.zeros(len(first), bool)
    linked[1:] = single[1:] & single[:-1] & (start[1:] == end[:-1] + 1) & (row[1:] == row[:-1])
    # Joined by marks: every second byte a mark, the others single letters or look-alikes.
    joined = (size >= 5) & (size % 2 == 1) & (4 * n_letters >= size) & (within(sums(kind == _JOIN)) * 2 + 1 == size)
    found = []
    for i in np.flatnonzero(mixed | joined).tolist():
        a, b = int(first[i]), int(last[i])
        if joined[i] and not (kind[a:b:2] == _JOIN).any():
            found.append((a, b, int(row[i]), True))
        elif mixed[i]:
            found.append((a, b, int(row[i]), False))
    head = np.flatnonzero(linked & ~np.concatenate([[False], linked[:-1]])) if len(linked) else []
    stop = np.flatnonzero(linked & ~np.concatenate([linked[1:], [False]]))
    for h, t in zip(head.tolist(), stop.tolist()):
        if t - h >= 1 and 2 * ascii_letter[first[h - 1:t + 1]].sum() >= t - h + 2:
            found.append((int(first[h - 1]), int(last[t]), int(row[h]), True))
    return body, sorted(found)


class Restorer:
    def __init__(self, model: Letters):
        self.table, self.known = model.table(), {}

    def __call__(self, unit: bytes, spaced: bool) -> bytes:
        known = self.known.get((unit, spaced))
        if known is None:
            known = decoded(unit.decode("utf-8", "replace"), spaced, self.table).encode()
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[unit, spaced] = known
        return known

    def portion(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of the restored texts."""
        body, found = units(data, offsets)
        if not found:
            return body, offsets
        whole, parts, at = body.tobytes(), [], 0
        grown = np.zeros(len(offsets), np.int64)
        for a, b, r, spaced in found:
            said = self(whole[a:b], spaced)
            parts += (whole[at:a], said)
            grown[r + 1] += len(said) - (b - a)
            at = b
        parts.append(whole[at:])
        return np.frombuffer(b"".join(parts), np.uint8), offsets + np.cumsum(grown)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of all words and their beginnings of ``BEGINNINGS`` bytes, repeats included.  A word ends at whatever is no letter."""
    body = _LOWER[data]
    start, end, row = word_spans(np.where(_CLASS[body] == _LETTER, body, np.uint8(0x20)), offsets)
    rows, hashes = [row], [word_hashes(body, start, end)]
    for n in BEGINNINGS:
        long = end - start >= n
        rows.append(row[long])
        hashes.append(mix(word_hashes(body, start[long], start[long] + n) + np.uint64(n)))
    return np.concatenate(rows), (np.concatenate(hashes) >> np.uint64(46)).astype(np.int64)


def different(row: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.unique(row * FEATURES + feature)
    return pairs // FEATURES, pairs % FEATURES


@dataclass(frozen=True)
class Model:
    letters: Letters
    place: np.ndarray      # of each feature in the weights, or -1
    weights: np.ndarray
    intercept: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        row, feature = features(data, offsets)
        known = self.place[feature] >= 0
        row, feature = different(row[known], feature[known])
        total = self.intercept + np.bincount(row, weights=self.weights[self.place[feature]], minlength=len(offsets) - 1)
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def telling(seen: np.ndarray, toxic: np.ndarray, rows: int, ones: float, chosen: int) -> np.ndarray:
    """Place of each feature among the ``chosen`` ones that depend most on the class (chi-squared); -1 for the others."""
    prior = (ones + 0.5) / (rows + 1)
    expected = seen * prior
    apart = (toxic - expected) ** 2 / (expected * (1 - prior) + 1e-9)
    apart[(seen < 2) | (ones in (0, rows))] = 0
    best = np.sort(np.argsort(-apart, kind="stable")[:chosen])
    best = best[apart[best] > 0]
    place = np.full(len(seen), -1, np.int32)
    place[best] = np.arange(len(best))
    return place


def fitted(row: np.ndarray, column: np.ndarray, label: np.ndarray, width: int, rounds: int = 300, shrink: float = 0.3) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression on features that are there or not (Adam on the whole sample)."""
    prior = (label.sum() + 0.5) / (len(label) + 1)
    weights, bias = np.zeros(width), log(prior / (1 - prior))
    if not width:
        return weights, bias
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for t in range(1, rounds + 1):
        margin = bias + np.bincount(row, weights=weights[column], minlength=len(label))
        miss = 1 / (1 + np.exp(-np.clip(margin, -500, 500))) - label
        slope = np.append(np.bincount(column, weights=miss[row], minlength=width) + shrink * weights, miss.sum())
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope * slope
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8) * (1 - t / (rounds + 1))
        weights, bias = weights - step[:-1], bias - step[-1]
    return weights, float(bias)


def trained(docs: DataFrame, labels: DataFrame, model: Letters, label: str = "toxic", text: str = "text", doc_id: str = "doc_id",
            sample_rows: int = 20_000, chosen: int = 2048) -> Model:
    """Fits the classifier to at most about ``sample_rows`` of the rows of ``docs`` whose id ``labels`` marks 0 or 1."""
    marks = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("mark")).filter("mark in (0, 1)") \
        .groupBy("id").agg(F.max("mark").alias("mark"))
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.lower(F.col(f"`{text}`")).alias("text")).filter("id is not null and text is not null")
    share = sample_rows / max(1, marks.count())
    if share < 1:
        marks = marks.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20)))

    def extract(batches):
        restorer = Restorer(model)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for lo, hi in portions(offsets):
                row, feature = different(*features(*restorer.portion(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])))
                lists = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=hi - lo))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(lists), pa.array(feature.astype(np.int32)))],
                    ["mark", "features"])

    sample = written(rows.join(marks, "id").select("text", "mark").mapInArrow(extract, "mark int, features array<int>"), "toxicity-sample")

    def count(batches):
        seen, toxic = np.zeros((2, FEATURES), np.int64)
        for batch in batches:
            lists = batch.column(1)
            of = np.repeat(batch.column(0).to_numpy(), lists.value_lengths().to_numpy())
            feature = lists.flatten().to_numpy()
            seen += np.bincount(feature, minlength=FEATURES)
            toxic += np.bincount(feature[of == 1], minlength=FEATURES)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at]), pa.array(toxic[at])], ["feature", "seen", "toxic"])

    counts = sample.mapInArrow(count, "feature int, seen long, toxic long").groupBy("feature") \
        .agg(F.sum("seen").alias("seen"), F.sum("toxic").alias("toxic")).toArrow()  # FEATURES rows at most
    seen, toxic = np.zeros((2, FEATURES))
    at = counts.column("feature").to_numpy()
    seen[at], toxic[at] = counts.column("seen").to_numpy(), counts.column("toxic").to_numpy()
    rows, ones = sample.agg(F.count("*"), F.coalesce(F.sum("mark"), F.lit(0))).first()
    place = telling(seen, toxic, rows, ones, chosen)

    def choose(batches):
        for batch in batches:
            lists = batch.column(1)
            column = place[lists.flatten().to_numpy()]
            row = np.repeat(np.arange(len(batch)), lists.value_lengths().to_numpy())[column >= 0]
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(batch)))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(column[column >= 0]))],
                                             ["mark", "columns"])

    # At most ``sample_rows`` lists of at most ``chosen`` numbers.
    kept = sample.mapInArrow(choose, "mark int, columns array<int>").toArrow()
    lists = kept.column("columns").combine_chunks() if rows else pa.array([], pa.list_(pa.int32()))
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    column, row = lists.flatten().to_numpy(), np.repeat(np.arange(rows), lists.value_lengths().to_numpy())
    return Model(model, place, *fitted(row, column, kept.column("mark").to_numpy().astype(float), int((place >= 0).sum())))


def _mapper(model: Letters | Model):
    scoring = isinstance(model, Model)
    held = []

    def run(text: pa.Array) -> pa.Array:
        if not held:
            held.append(Restorer(model.letters if scoring else model))
        data, offsets = text_bytes(text)
        scores, restored = [], []
        for lo, hi in portions(offsets):
            body, own = held[0].portion(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            if scoring:
                scores.append(model.scores(body, own))
            else:
                whole = body.tobytes()
                restored += [whole[a:b] for a, b in zip(own[:-1].tolist(), own[1:].tolist())]
        return pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64()) if scoring else pa.array(restored, pa.binary())

    return F.arrow_udf(run, "double" if scoring else "binary")


def restored(docs: DataFrame, model: Letters, text: str = "text") -> DataFrame:
    """Adds restored: the text in lower case with disguised units as they were meant. Null: empty."""
    away, back = aside(docs, "restored")
    return docs.select(*away, _mapper(model)(F.lower(F.col(f"`{text}`"))).alias("_found")).select(*back, F.col("_found").cast("string").alias("restored"))


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds score: the chance, 0 to 1, that the restored text is toxic."""
    away, back = aside(docs, "score")
    return docs.select(*away, _mapper(model)(F.lower(F.col(f"`{text}`"))).alias("_found")).select(*back, F.col("_found").alias("score"))
