"""Masked pseudo-likelihood of documents under a bidirectional window network.

Every token is hidden in turn and predicted from ``REACH`` tokens on either side:
each neighbour adds the vector of its word and place, a tanh layer follows, and
the word comes out in two steps, its class and then its place within the class,
so that probabilities of all words sum to one at the cost of two small softmaxes.
The sum of the log probabilities of all tokens is the document's score.

* Texts are split once: the hashed bucket of every word is stored, two bytes a
  word.  Buckets are counted over all documents; the most frequent ones have
  tokens of their own, the rest share the others.
* The network starts as the word frequencies.  Each round, every task trains its
  own copy in numpy on its documents (all of them by default), and the copies are
  averaged by number of tokens in one aggregate.  What is gathered grows with the
  number of tasks, hence with the documents; a task holds one network, about
  half a megabyte.
* Scoring is one pass without a shuffle.

Null and empty texts have 0 tokens, likelihood 0 and no mean.  A model trained on
nothing takes all words as equally likely.  Repeated rows score alike.  An empty
table gives no rows.  Extra columns are kept; ``n_tokens``, ``log_likelihood`` and
``mean_log_likelihood`` replace columns of the same name.  Weights depend in the
last digits on how the table is cut into tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.columns import aside
from plumbline.llm.words import portions, text_bytes, word_hashes, word_spans
from plumbline.session import written

REACH = 2
WIDTH = 32                      # hidden units, classes, and words of a class
TOKENS = WIDTH * WIDTH
NAMED = 768                     # tokens of the most frequent buckets
BUCKETS = 1 << 16
_PLACES = (-2, -1, 1, 2)
# Rows of the weight table, all WIDTH long.
_CONTEXT = len(_PLACES) * (TOKENS + 1)
_LAYERS = ("class_out", "class_in", "word_out", "word_bias")
ROWS = _CONTEXT + len(_LAYERS) * WIDTH + 2


def _views(table: np.ndarray) -> dict[str, np.ndarray]:
    out = {"context": table[:_CONTEXT].reshape(TOKENS + 1, -1)}
    for k, name in enumerate(_LAYERS):
        out[name] = table[_CONTEXT + k * WIDTH:_CONTEXT + (k + 1) * WIDTH]
    out["hidden_bias"], out["class_bias"] = table[-2:-1], table[-1:]
    return out


@dataclass(frozen=True)
class Model:
    token_of: np.ndarray    # bucket to token
    table: np.ndarray       # ROWS x WIDTH


def _words(batch_text: pa.Array):
    """(first row, row after the last, bucket of each word, row of each word) of portions of the texts."""
    data, offsets = text_bytes(batch_text)
    for lo, hi in portions(offsets):
        part, at = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        start, end, row = word_spans(part, at)
        yield lo, hi, word_hashes(part, start, end).astype(np.uint16), row


def _bucketed(text: pa.Array) -> pa.Array:
    out = []
    for lo, hi, words, row in _words(text):
        ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=hi - lo))])
        out += [words[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
    return pa.array(out, pa.binary())


def _stored(column: pa.Array):
    """(bucket of each word, row of each word) of portions of a column of stored buckets."""
    data, offsets = text_bytes(column)
    words, ends = data.view(np.uint16), offsets // 2
    for lo, hi in portions(ends, 1 << 18):
        yield words[ends[lo]:ends[hi]], np.repeat(np.arange(hi - lo), np.diff(ends[lo:hi + 1]))


def _count(batches):
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for words, _ in _stored(batch.column(0)):
            total += np.bincount(words, minlength=BUCKETS)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["bucket", "n"])


def padded(tokens: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens with REACH blanks around every document, and where each token now stands.

    So neighbours are shifts of one sequence, and none reaches into another document.
    """
    new = np.concatenate([[0], np.cumsum(row[1:] != row[:-1])]) if len(row) else row
    at = np.arange(len(tokens)) + REACH * (new + 1)
    out = np.full(len(tokens) + REACH * (int(new[-1]) + 2 if len(row) else 1), TOKENS, np.int16)
    out[at] = tokens
    return out, at


def _tanh(x: np.ndarray) -> np.ndarray:
    """tanh by one exponential, which numpy computes faster; changes x."""
    with np.errstate(over="ignore"):  # to infinity, which gives 1
        np.exp(np.add(x, x, out=x), out=x)
    x += 1
    np.divide(-2, x, out=x)
    x += 1
    return x


def _softmax(x: np.ndarray, shares: bool) -> tuple[np.ndarray | None, np.ndarray]:
    """(probabilities if wanted, log of the sum of exponentials) of each row."""
    top = x.max()
    e = x - top
    np.exp(e, out=e)
    total = e @ np.ones(x.shape[1], x.dtype)
    if total.min() < 1e-30:  # a row far below the largest one
        top = x.max(axis=1, keepdims=True)
        e = np.exp(x - top)
        total = e @ np.ones(x.shape[1], x.dtype)
        return e / total[:, None], np.log(total) + top[:, 0]
    if shares:
        e /= total.repeat(x.shape[1]).reshape(x.shape)
    return e if shares else None, np.log(total) + top


def forward(w: dict[str, np.ndarray], sequence: np.ndarray, lo: int, hi: int, learns: bool = True):
    """(log probability of each token from lo to hi, and if it learns what the gradient needs)."""
    n = hi - lo
    by_place = w["context"].reshape(-1, WIDTH)  # a row for each token and place
    around = sequence[lo - REACH:hi + REACH].astype(np.int64) * len(_PLACES)
    same = np.zeros(n, np.int64)
    # Whole rows are taken and added: numpy broadcasts a short row far slower.
    hidden = w["hidden_bias"].take(same, axis=0)
    for k, place in enumerate(_PLACES):
        hidden += by_place.take(around[REACH + place:REACH + place + n] + k, axis=0)
    hidden = _tanh(hidden)
    tokens = sequence[lo:hi].astype(np.int64) % TOKENS  # a blank's own probability is never used
    kind, inner, at = tokens // WIDTH, tokens % WIDTH, np.arange(n)
    classes = hidden @ w["class_out"]
    classes += w["class_bias"].take(same, axis=0)
    second = w["class_in"].take(kind, axis=0)
    second += hidden
    second = _tanh(second)
    words = second @ w["word_out"]
    words += w["word_bias"].take(kind, axis=0)
    (p_class, s_class), (p_word, s_word) = _softmax(classes, learns), _softmax(words, learns)
    return classes[at, kind] - s_class + words[at, inner] - s_word, (hidden, second, p_class, p_word, kind, inner, at)


def log_probabilities(w: dict[str, np.ndarray], tokens: np.ndarray, row: np.ndarray, batch: int = 2048) -> np.ndarray:
    sequence, at = padded(tokens, row)
    out = np.zeros(len(sequence))
    for lo in range(REACH, len(sequence) - REACH, batch):
        hi = min(lo + batch, len(sequence) - REACH)
        out[lo:hi] = forward(w, sequence, lo, hi, learns=False)[0]
    return out[at]


def _summed(rows: np.ndarray, at: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums over groups, the largest groups first: group g sums what ``rows`` has at the indices ``at[starts[g]]``,
    ``at[starts[g] + 1]`` …, counts[g] of them, each several rows side by side.

    Small groups are summed side by side, entry by entry, in the order of ``np.add.reduceat``
    (the same digits), which takes as long for a group of two as for one of twenty.
    """
    def taken(entries: np.ndarray) -> np.ndarray:
        return rows.take(at[entries], axis=0).reshape(len(entries), at.shape[1] * rows.shape[1])

    over = [int(np.searchsorted(-counts, -j)) for j in range(9)]  # groups with more than j entries
    total = taken(starts)
    if over[1]:
        rest = taken(starts[:over[1]] + 1)
        rest[:over[2]] += taken(starts[:over[2]] + 2)
        third = taken(starts[:over[3]] + 3)
        third[:over[4]] += taken(starts[:over[4]] + 4)
        rest[:over[3]] += third
        for j in range(5, 8):
            rest[:over[j]] += taken(starts[:over[j]] + j)
        total[:over[1]] += rest
    if large := over[8]:
        n = counts[:large]
        first = np.cumsum(n) - n
        # Neighbouring floats as one complex number: the same sums with half the steps.
        wide = taken(np.arange(int(n.sum())) + np.repeat(starts[:large] - first, n)).view(np.result_type(rows.dtype, np.complex64))
        total[:large] = np.add.reduceat(wide, first, axis=0).view(rows.dtype)
    return total


def train_pass(table: np.ndarray, sequence: np.ndarray, squares: np.ndarray, rate: float = 0.1, batch: int = 2048) -> None:
    """One pass over a padded sequence in mini-batches, with a step size for each weight row (AdaGrad); changes table and squares."""
    w = _views(table)
    seen = _views(squares)
    ones = np.eye(WIDTH, dtype=table.dtype)

    def step(name: str, rows, gradient: np.ndarray) -> None:
        first = seen[name][:, 0]  # one step size a row: the first column holds it
        total = first[rows] + np.einsum("ij,ij->i", gradient, gradient) / gradient.shape[1]
        first[rows] = total
        gradient *= (rate / np.sqrt(total))[:, None]
        w[name][rows] -= gradient

    for lo in range(REACH, len(sequence) - REACH, batch):
        hi = min(lo + batch, len(sequence) - REACH)
        _, (hidden, second, d_class, d_word, kind, inner, at) = forward(w, sequence, lo, hi)
        blank = np.flatnonzero(sequence[lo:hi] == TOKENS)
        share = table.dtype.type(1 / max(1, hi - lo - len(blank)))
        of_kind = ones.take(kind, axis=0)
        d_class -= of_kind
        d_word[at, inner] -= 1
        d_class[blank] = d_word[blank] = 0
        second_loss = d_word @ w["word_out"].T
        of_word = second.T @ d_word
        np.multiply(second, second, out=second)
        second_loss -= second_loss * second
        d_hidden = d_class @ w["class_out"].T
        d_hidden += second_loss
        of_hidden = hidden.T @ d_class
        np.multiply(hidden, hidden, out=hidden)
        d_hidden -= d_hidden * hidden
        of_kind *= share
        # Each token's share in what its neighbours have lost, place by place; equal tokens are summed up.
        lost = np.zeros((hi - lo + 4 * REACH, WIDTH), table.dtype)
        lost[2 * REACH:-2 * REACH] = d_hidden
        near = sequence[lo - REACH:hi + REACH]
        order = np.argsort(near, kind="stable")
        step("class_out", slice(None), of_hidden * share)
        step("word_out", slice(None), of_word * share)
        step("class_in", slice(None), of_kind.T @ second_loss)
        step("word_bias", slice(None), of_kind.T @ d_word)
        step("hidden_bias", slice(None), d_hidden.sum(0)[None] * share)
        step("class_bias", slice(None), d_class.sum(0)[None] * share)
        ranked = near[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        counts = np.diff(np.append(first, len(ranked)))
        large = np.argsort(-counts, kind="stable")
        total = _summed(lost, order[:, None] + (REACH - np.array(_PLACES)), first[large], counts[large])
        total *= share
        step("context", ranked[first[large]], total)


def _start(counts: np.ndarray, seed: int) -> np.ndarray:
    """Weights whose predictions are the token frequencies whatever the context."""
    share = (counts + 1).reshape(WIDTH, WIDTH).astype(float)
    table = np.random.default_rng(seed).normal(0, 0.1, (ROWS, WIDTH))
    w = _views(table)
    w["word_bias"][:] = np.log(share / share.sum(1, keepdims=True))
    w["class_bias"][:] = np.log(share.sum(1) / share.sum())
    w["class_out"][:] = w["word_out"][:] = w["hidden_bias"][:] = 0
    return table


def trained(docs: DataFrame, text: str = "text", rounds: int = 2, share: float = 1.0, seed: int = 5) -> Model:
    """Learns from ``share`` of the documents, chosen by a hash of the text; words are counted over all of them."""
    body = docs.select(F.lower(F.col(f"`{text}`")).alias("text"))
    own = F.lit(True) if share >= 1 else F.coalesce(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20)), F.lit(False))
    body = written(body.select(F.arrow_udf(_bucketed, "binary")("text").alias("words"), own.alias("learn")), "pseudolm-words")
    counted = body.select("words").mapInArrow(_count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # BUCKETS rows at most
    often = np.zeros(BUCKETS, np.int64)
    often[counted["bucket"].to_numpy(int)] = counted["n"].to_numpy()
    token_of = NAMED + np.arange(BUCKETS) % (TOKENS - NAMED)
    order = np.lexsort((np.arange(BUCKETS), -often))[:NAMED]
    # Frequent words are dealt out over the classes.
    token_of[order] = np.arange(NAMED)
    token_of = (token_of % WIDTH) * WIDTH + token_of // WIDTH
    table = _start(np.bincount(token_of, weights=often, minlength=TOKENS), seed)
    learn = body.filter("learn").select("words")
    names = [f"w{k}" for k in range(WIDTH)]

    for _ in range(rounds if len(counted) else 0):
        def train(batches, start=table):
            own, squares, seen = start.astype(np.float32), np.full((ROWS, WIDTH), 1e-6, np.float32), 0
            for batch in batches:
                for words, row in _stored(batch.column(0)):
                    tokens = token_of[words]
                    train_pass(own, padded(tokens, row)[0], squares)
                    seen += len(tokens)
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(ROWS, dtype=np.int32)), pa.array(np.full(ROWS, float(seen))),
                     *(pa.array(own[:, k].astype(float) * seen) for k in range(WIDTH))], ["row", "n", *names])

        summed = learn.mapInArrow(train, "row int, n double, " + ", ".join(f"{c} double" for c in names)) \
            .groupBy("row").agg(*(F.sum(c).alias(c) for c in ("n", *names))).orderBy("row").toPandas()  # ROWS rows
        if len(summed):
            table = summed[names].to_numpy() / summed[["n"]].to_numpy()
    return Model(token_of, table)


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds n_tokens, log_likelihood (sum over the tokens) and mean_log_likelihood."""
    added = ("n_tokens", "log_likelihood", "mean_log_likelihood")
    table = model.table.astype(np.float32)
    token_of = model.token_of.astype(np.int32)

    def score(column: pa.Array) -> pa.Array:
        w = _views(table)
        n, total = np.zeros(len(column), np.int64), np.zeros(len(column))
        for lo, hi, words, row in _words(column):
            tokens = token_of[words]
            n[lo:hi] = np.bincount(row, minlength=hi - lo)
            total[lo:hi] = np.bincount(row, weights=log_probabilities(w, tokens, row), minlength=hi - lo)
        return pa.StructArray.from_arrays([pa.array(n), pa.array(total)], ["n_tokens", "log_likelihood"])

    scorer = F.arrow_udf(score, "n_tokens long, log_likelihood double")
    away, back = aside(docs, *added)
    return docs.select(*away, scorer(F.lower(F.col(f"`{text}`"))).alias("_found")).select(
        *back, "_found.n_tokens", "_found.log_likelihood",
        F.when(F.col("_found.n_tokens") > 0, F.col("_found.log_likelihood") / F.col("_found.n_tokens")).alias("mean_log_likelihood"))
