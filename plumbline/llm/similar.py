"""N-gram Jaccard join: bands of MinHash values, then exact verification.

A text is the set of its word n-grams (lower case; a text of fewer words is one
n-gram of all its words).  Two texts are linked if the Jaccard similarity of
their sets is at least ``threshold``.

* Texts with equal sets are one *set* that has copies; only sets are compared.
* Each of ``trees`` signatures of MinHash values is cut to one length and grouped by
  a hash of it (banding, not a forest: nothing is sorted, and all prefixes of all
  tables are equally long).  Two sets of similarity s share a prefix of k values in
  some tree with probability 1 - (1 - s ** k) ** trees.  k is computed from the
  parameters: the most, up to ``longest``, with which every link, even one at the
  threshold, is found with at least ``recall``.
* Sets under one prefix are candidates.  They are not paired up: each is tied to
  the least of them, and the components of these ties are verified as wholes.  So
  a set's n-grams travel once, however many tries it shares a prefix in.
* A component's sets are compared by exact intersection counts, block by block.
  Small components share a task; one that is larger than ``block_sets`` sets or
  ``block_ngrams`` n-grams is dealt into blocks, and each pair of blocks is a
  group of its own.  A task holds two blocks and writes for each set the number
  of its links and one tie, never the pairs.

Every row gets ``n_links``, the number of other rows whose text is linked to its
own (copies included), and ``class_id``, the least id in its class, where classes
are the components of all links.  A row with null text or without words has no
links and its own id as class.  Ties and repeated rows are copies of each other.
An empty table gives no rows.  Ids that are null take part; the class of rows
that have nothing but null ids is null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.columns import row_hashes
from plumbline.llm.components import components
from plumbline.llm.words import mix, ngram_hashes, portions, text_bytes, word_hashes, word_spans
from plumbline.session import written


def prefix_length(threshold: float, trees: int, longest: int, recall: float) -> int:
    """The longest prefix with which a link at the threshold is found with at least ``recall``."""
    length = longest
    while length > 1 and 1 - (1 - threshold ** length) ** trees < recall:
        length -= 1
    return length


def ngram_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The different n-gram hashes of all rows, sorted within each, and where each row's begin."""
    start, end, row = word_spans(data, offsets)
    words = word_hashes(data, start, end)
    rows = len(offsets) - 1
    grams, at = ngram_hashes(words, row, n)
    hashes, owner = [grams], [row[at]]
    count = np.bincount(row, minlength=rows)
    for k in range(1, n):  # texts of k words
        few = np.flatnonzero(count[row] == k) if len(row) else row
        if len(few):
            grams, at = ngram_hashes(words[few], row[few], k)
            hashes.append(mix(grams + np.uint64(k)))
            owner.append(row[few][at])
    h, r = np.concatenate(hashes), np.concatenate(owner)
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    h, r = h[new], r[new]
    return h, np.concatenate([[0], np.cumsum(np.bincount(r, minlength=rows))])


def prefixes(sets: np.ndarray, offsets: np.ndarray, trees: int, length: int, seed: int = 11) -> np.ndarray:
    """rows x trees: a hash of the tree and the first ``length`` MinHash values of its signature."""
    rng = np.random.default_rng(seed)
    flips = rng.integers(0, 1 << 32, (trees, length), np.uint32)
    factors = rng.integers(0, 1 << 32, (trees, length), np.uint32) | np.uint32(1)
    filled = np.flatnonzero(offsets[:-1] < offsets[1:])
    short, first = (sets >> np.uint64(32)).astype(np.uint32), offsets[:-1][filled]
    out = np.zeros((len(offsets) - 1, trees), np.uint64)
    for t in range(trees):
        key = np.full(len(filled), t + 1, np.uint64)
        for k in range(length):
            values = (short ^ flips[t, k]) * factors[t, k]
            values ^= values >> np.uint32(15)
            values *= np.uint32(0x2C1B3C6D)
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(values, first))
        out[filled, t] = key
    return out


def _sketch(n: int, trees: int, length: int) -> Column:
    def run(text: pa.Array) -> pa.Array:
        data, offsets = text_bytes(text)
        keys, sizes, tries = [], [], []
        for lo, hi in portions(offsets):
            sets, at = ngram_sets(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], n)
            view = memoryview(sets).cast("B")
            keys += [xxhash.xxh3_128_digest(view[8 * a:8 * b]) if b > a else None for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            sizes.append(np.diff(at))
            tries.append(prefixes(sets, at, trees, length).view(np.int64))
        size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        flat = np.concatenate(tries).ravel() if tries else np.zeros(0, np.int64)
        return pa.StructArray.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(size.astype(np.int32)),
             pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, trees, dtype=np.int32), pa.array(flat))], ["set_key", "ngrams", "tries"])

    return F.arrow_udf(run, "set_key binary, ngrams int, tries array<long>")


def _sets(n: int) -> Column:
    def run(text: pa.Array) -> pa.Array:
        data, offsets = text_bytes(text)
        found, ends = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
        for lo, hi in portions(offsets):
            sets, at = ngram_sets(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], n)
            found.append(sets)
            ends.append(at[1:] + ends[-1][-1])
        return pa.ListArray.from_arrays(np.concatenate(ends).astype(np.int32), pa.array(np.concatenate(found).view(np.int64)))

    return F.arrow_udf(run, "array<long>")


LINKED = "set_key binary, links long, hub binary"


def shared_counts(values: np.ndarray, offsets: np.ndarray, cells: int = 1 << 23) -> np.ndarray:
    """Sizes of all pairwise intersections of the given sets."""
    rows = len(offsets) - 1
    owner = np.repeat(np.arange(rows), np.diff(offsets))
    _, which, count = np.unique(values, return_inverse=True, return_counts=True)
    common = count > 1  # an n-gram of one set is in no intersection
    use = common[which]
    owner, which = owner[use], (np.cumsum(common) - 1)[which[use]]
    order = np.argsort(which, kind="stable")
    owner, which = owner[order], which[order]
    out = np.zeros((rows, rows))  # parts are exact in float32, their sums and the threshold need more
    width = max(1, cells // rows)
    for lo in range(0, int(which[-1]) + 1 if len(which) else 0, width):
        a, b = np.searchsorted(which, [lo, lo + width])
        part = np.zeros((rows, min(width, int(which[b - 1]) + 1 - lo)), np.float32)
        part[owner[a:b], which[a:b] - lo] = 1
        out += part @ part.T
    return out


def linked_sets(values: np.ndarray, offsets: np.ndarray, copies: np.ndarray, block: np.ndarray | None,
                threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of each set (copies counted) and the least set of its local class; with blocks, only between different ones."""
    size = np.diff(offsets)
    link = shared_counts(values, offsets) * (1 + threshold) >= threshold * (size[:, None] + size[None, :]) - 1e-6
    np.fill_diagonal(link, False)
    if block is not None:
        link &= block[:, None] != block[None, :]
    label = np.arange(len(size))
    while True:
        near = np.minimum(label, np.where(link, label[None, :], len(size)).min(axis=1, initial=len(size)))
        near = near[near]
        if (near == label).all():
            return link @ copies, label
        label = near


def _verify(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        names = np.array(table.column("set_key").to_pylist(), object)
        roots = np.array(table.column("root").to_pylist(), object)
        block, other = table.column("block").to_numpy(), table.column("other").to_numpy()
        copies = table.column("copies").to_numpy()
        lists = table.column("grams").chunk(0) if table.num_rows else pa.array([], pa.list_(pa.int64()))
        ends, values = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy()
        # One row for each set (repeated rows of the text's table come twice), component by component.
        order = sorted(range(len(names)), key=lambda i: (roots[i], names[i]))
        order = [i for k, i in enumerate(order) if not k or names[i] != names[order[k - 1]] or roots[i] != roots[order[k - 1]]]
        edge = [k for k in range(len(order)) if not k or roots[order[k]] != roots[order[k - 1]]] + [len(order)]
        found: list[tuple] = []
        for a, b in zip(edge[:-1], edge[1:]):
            of = np.array(order[a:b])
            if len(of) < 2:
                continue
            at = np.concatenate([[0], np.cumsum(ends[of + 1] - ends[of])])
            grams = np.concatenate([values[ends[i]:ends[i + 1]] for i in of])
            cross = other[of[0]] >= 0
            links, hub = linked_sets(grams, at, copies[of], block[of] if cross else None, threshold)
            found += [(names[of[k]], int(links[k]), names[of[hub[k]]]) for k in np.flatnonzero(links)]
        columns = list(zip(*found)) or [(), (), ()]
        return pa.table([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary())],
                        names=["set_key", "links", "hub"])
    return run


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128 bits of id and text, NULLs marked."""
    return F.struct(*[h.alias(c) for h, c in zip(row_hashes(doc_id, text), "ab")])


def linked(docs: DataFrame, n: int = 5, threshold: float = 0.8, trees: int = 24, longest: int = 8, recall: float = 0.9999,
           block_sets: int = 1024, block_ngrams: int = 1 << 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row_key, doc_id, set_key, class_key, class_id, n_links) for every row of ``docs``.

    row_key is a hash of id and text; class_key names the class and is null for texts without words only.
    """
    length = prefix_length(threshold, trees, longest, recall)
    body = docs.select(row_key(doc_id, text).alias("row_key"), F.col(f"`{doc_id}`").alias("doc_id"), F.lower(F.col(f"`{text}`")).alias("text"))
    rows = written(body.select("row_key", "doc_id", _sketch(n, trees, length)("text").alias("s"))
                   .select("row_key", "doc_id", "s.*"), "similar-rows")
    sets = written(rows.filter("set_key is not null").groupBy("set_key").agg(
        F.count("*").alias("copies"), F.min("row_key").alias("row_key"), F.min("doc_id").alias("doc_id"),
        F.first("ngrams").alias("ngrams"), F.first("tries").alias("tries")), "similar-sets")
    # Candidates: every set is tied to the least set under the same prefix.
    under = sets.select("set_key", F.explode("tries").alias("prefix"))
    shared = written(under.groupBy("prefix").agg(F.min("set_key").alias("hub"), F.count("*").alias("n")).filter("n > 1").drop("n"),
                     "similar-prefixes")
    ties = under.join(shared, "prefix").filter("set_key != hub").select(F.col("set_key").alias("a"), F.col("hub").alias("b"))
    found = written(components(ties), "similar-candidates")
    known = sets.select("set_key", "copies", "row_key", "ngrams").join(found, F.col("set_key") == F.col("node")).drop("node")
    known = written(known, "similar-known")
    sizes = known.groupBy("root").agg(F.sum("ngrams").alias("total"), F.count("*").alias("many")).select(
        F.col("root").alias("of"), F.ceil(F.greatest(F.col("total") / block_ngrams, F.col("many") / block_sets)).cast("int").alias("blocks"))
    bundles = max(1, int((known.agg(F.sum("ngrams")).first()[0] or 0) // block_ngrams) + 1)
    dealt = (known.join(written(sizes, "similar-sizes"), F.col("root") == F.col("of"))
             .withColumn("block", F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int"))
             .withColumn("task", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("root"), F.lit(bundles)))))
    texts = body.join(dealt, "row_key").select("set_key", "root", "copies", "blocks", "block", "task", _sets(n)("text").alias("grams"))
    pairs = F.when(F.col("blocks") == 1, F.array(F.lit(-1))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    # (low, high) is a pair of blocks; other is -1 where the sets of one block are compared with each other.
    spread = texts.withColumn("with", F.explode(pairs)).select(
        "set_key", "root", "copies", "grams", "block",
        F.when(F.col("with") == F.col("block"), -1).otherwise(F.col("with")).alias("other"),
        F.coalesce("task", F.xxhash64("root", F.least("block", "with"), F.greatest("block", "with"))).alias("task"),
        F.col("task").isNull().alias("alone"))
    checked = written(spread.groupBy("alone", "task").applyInArrow(_verify(threshold), LINKED), "similar-links")
    links = checked.groupBy(F.col("set_key").alias("of")).agg(F.sum("links").alias("links"))
    roots = components(checked.filter("set_key != hub").select(F.col("set_key").alias("a"), F.col("hub").alias("b")))
    classed = (sets.select("set_key", "copies", "doc_id").join(links, F.col("set_key") == F.col("of"), "left")
               .join(roots, F.col("set_key") == F.col("node"), "left")
               .select("set_key", "doc_id", F.coalesce("root", "set_key").alias("root"),
                       (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    classed = written(classed, "similar-classes")
    least = written(classed.groupBy(F.col("root").alias("r")).agg(F.min("doc_id").alias("class_id")), "similar-least")
    of_set = written(classed.join(least, F.col("root") == F.col("r")).select(F.col("set_key").alias("k"), F.col("root").alias("class_key"), "class_id", "n_links"),
                     "similar-of-set")
    return rows.join(of_set, F.col("set_key") == F.col("k"), "left").select(
        "row_key", "doc_id", "set_key", "class_key", F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
