"""Language identification with error-correcting output codes.

Every language gets a codeword of bits.  For each bit one binary classifier tells
the languages with a 1 from those with a 0: a naive Bayes log-odds table over
hashed byte n-grams.  The margins of all bits are compared with all codewords;
each bit's loss is weighted by how far apart its classifier holds the two sides,
the language with the least loss wins, and a small lead marks the text ambiguous.

Training takes a bounded sample of labelled rows (``sample_rows``, chosen by a
hash of the id, so it is spread over the whole table and does not depend on
partitions); the model is a table of languages x ``features``.  Prediction is one
pass over the texts without a shuffle.

A text that is null or has no letter is ``und`` with score 0, as is every text if
nothing was learned.  Empty texts have no letter.  Repeated rows and ties of the
loss resolve to the same, alphabetically first language.  Rows without a label do
not train.  Extra columns are kept; ``lang_pred``, ``score`` and ``ambiguous``
replace columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.columns import aside
from plumbline.llm.words import portions, text_bytes

UNKNOWN = "und"
FEATURES = 1 << 14
GRAMS = (2, 4)
_LETTERS = np.arange(256, dtype=np.uint8)
_LETTERS[[c for c in range(128) if not chr(c).isalpha()]] = 0x20


def features(data: np.ndarray, offsets: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each n: buckets of the byte n-grams in order, and the row of each; none crosses rows.

    ASCII characters that are no letters count as a space; runs of spaces shrink to one.
    """
    plain = _LETTERS[data]
    blank = plain == 0x20
    use = np.ones(len(plain), bool)
    use[1:] = ~(blank[1:] & blank[:-1])
    use[offsets[:-1][offsets[:-1] < offsets[1:]]] = True  # a row does not depend on the one before it
    before = np.concatenate([[0], np.cumsum(use)])
    plain, offsets = plain[use].astype(np.uint32), before[offsets]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    out = []
    for n in GRAMS:
        count = max(len(plain) - n + 1, 0)
        h = np.full(count, n, np.uint32)
        for k in range(n):
            h = (h ^ plain[k:k + count]) * np.uint32(0x01000193)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        same = row[:count] == row[n - 1:] if count else np.zeros(0, bool)
        out.append(((h >> np.uint32(8)).astype(np.int64)[same] % size, row[:count][same]))
    return out


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n codewords of +1 and -1: all splits of the languages while these are few, else random splits far apart."""
    if n < 2:
        return np.ones((n, 1), np.int8)
    if n <= 5:
        columns = [[1 if (c >> k) & 1 else -1 for k in range(n)] for c in range(1, 1 << (n - 1))]
        return np.array(columns, np.int8).T
    rng, best, far = np.random.default_rng(seed), None, -1
    width = 6 * int(np.ceil(np.log2(n)))
    for _ in range(50):
        code = np.where(rng.random((n, width)) < 0.5, -1, 1).astype(np.int8)
        code = code[:, np.abs(code.sum(0)) < n]
        apart = (code.shape[1] - code.astype(int) @ code.T.astype(int)) // 2
        least = apart[~np.eye(n, dtype=bool)].min()
        if least > far:
            best, far = code, least
    return best


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    code: np.ndarray      # language x bit
    odds: np.ndarray      # feature x bit
    spread: np.ndarray    # mean margin per n-gram of each bit's own side


def fitted(counts: np.ndarray, languages: tuple[str, ...]) -> Model:
    """From n-gram counts, language x feature."""
    share = (counts + 0.1) / (counts + 0.1).sum(axis=1, keepdims=True)
    code = codewords(len(languages))
    one, zero = code == 1, code == -1
    if len(languages) < 2:
        odds = np.zeros((counts.shape[1], 1), np.float32)
    else:
        odds = np.stack([np.log(share[one[:, b]].mean(0) / share[zero[:, b]].mean(0)) for b in range(code.shape[1])], 1)
    spread = np.maximum((code * (share @ odds)).mean(0), 1e-6) if languages else np.ones(code.shape[1])
    return Model(languages, code, odds.astype(np.float32), spread.astype(np.float64))


def trained(docs: DataFrame, label: str = "lang", text: str = "text", doc_id: str = "doc_id",
            sample_rows: int = 20_000, size: int = FEATURES) -> Model:
    """Learns from at most about ``sample_rows`` labelled rows."""
    rows = docs.filter(F.col(f"`{label}`").isNotNull() & F.col(f"`{text}`").isNotNull())
    rows = rows.select(F.col(f"`{label}`").alias("label"), F.lower(F.col(f"`{text}`")).alias("text"), F.col(f"`{doc_id}`").alias("id"))
    share = sample_rows / max(1, docs.filter(F.col(f"`{label}`").isNotNull()).count())
    if share < 1:
        rows = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20)))

    def count(batches):
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            names, index = np.unique(np.array(batch.column(0).to_pylist(), dtype=object).astype(str), return_inverse=True)
            total = np.zeros((len(names), size), np.int64)
            for lo, hi in portions(offsets):
                part = offsets[lo:hi + 1] - offsets[lo]
                for bucket, row in features(data[offsets[lo]:offsets[hi]], part, size):
                    total += np.bincount(index[lo + row] * size + bucket, minlength=total.size).reshape(total.shape)
            at, bucket = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(names[at].tolist(), pa.string()), pa.array(bucket.astype(np.int32)),
                                              pa.array(total[at, bucket])], ["label", "bucket", "n"])

    found = rows.select("label", "text").mapInArrow(count, "label string, bucket int, n long") \
        .groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas()  # languages x features at most
    languages = tuple(sorted(found["label"].unique()))
    counts = np.zeros((len(languages), size))
    counts[[languages.index(x) for x in found["label"]] if len(found) else [], found["bucket"].to_numpy(int)] = found["n"]
    return fitted(counts, languages)


def decided(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the language, score and lead over the second one, for each row."""
    rows = len(offsets) - 1
    total, grams = np.zeros((rows, model.code.shape[1])), np.zeros(rows)
    for bucket, row in features(data, offsets, len(model.odds)):
        n = np.bincount(row, minlength=rows)
        first = np.concatenate([[0], np.cumsum(n)[:-1]])
        if len(bucket):
            total[n > 0] += np.add.reduceat(model.odds[bucket], first[n > 0], axis=0)
        grams += n
    # Per n-gram, in units of what the classifier usually sees; more n-grams give more confidence.
    margin = total / np.maximum(grams, 1)[:, None] / model.spread * np.sqrt(np.minimum(grams, 400) / 25)[:, None]
    weight = model.spread / model.spread.sum()
    loss = np.logaddexp(0, -margin[:, None, :] * model.code[None]) @ weight
    chance = np.exp(4 * (loss.min(axis=1, keepdims=True) - loss))
    chance /= chance.sum(axis=1, keepdims=True)
    best = chance.argmax(axis=1)
    second = np.partition(chance, -2, axis=1)[:, -2] if chance.shape[1] > 1 else np.zeros(rows)
    return best, chance[np.arange(rows), best], chance[np.arange(rows), best] - second


def _predictor(model: Model, least_lead: float):
    names = np.array([*model.languages, UNKNOWN], dtype=object)

    def predict(text: pa.Array, lettered: pa.Array) -> pa.Array:
        rows = len(text)
        data, offsets = text_bytes(text)
        best, score, lead = np.full(rows, len(names) - 1), np.zeros(rows), np.zeros(rows)
        if model.languages:
            for lo, hi in portions(offsets):
                part = offsets[lo:hi + 1] - offsets[lo]
                best[lo:hi], score[lo:hi], lead[lo:hi] = decided(model, data[offsets[lo]:offsets[hi]], part)
            none = ~np.array(lettered.fill_null(False))
            best[none], score[none], lead[none] = len(names) - 1, 0, 0
        return pa.StructArray.from_arrays(
            [pa.array(names[best].tolist(), pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(lead < least_lead)],
            ["lang_pred", "score", "ambiguous"])

    return F.arrow_udf(predict, "lang_pred string, score double, ambiguous boolean")


def predicted(docs: DataFrame, model: Model, text: str = "text", least_lead: float = 0.05) -> DataFrame:
    """Adds lang_pred, score (0 to 1) and ambiguous (the lead over the second language is small)."""
    added = ("lang_pred", "score", "ambiguous")
    body: Column = F.col(f"`{text}`")
    away, back = aside(docs, *added)
    found = _predictor(model, least_lead)(F.lower(body), F.coalesce(body.rlike(r"\p{L}"), F.lit(False))).alias("_found")
    return docs.select(*away, found).select(*back, *(F.col(f"_found.{c}").alias(c) for c in added))
