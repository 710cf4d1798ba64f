"""Phrases that occur together more often than their parts suggest, for each language.

Texts are lower-cased (A to Z), split into pieces at ``. , ; : ! ?`` and line
breaks, and those into words at spaces and tabs.  A phrase of two words or more
scores by its worst cut: 1000 * a * n / (l * r), where a, l and r count the phrase
and its two parts and n all words of the language.

Multikey three-way quicksort of suffix pointers: a suffix is the words from one
place of a piece on, at most ``max_words`` of them.

1. Words are counted, and pairs of neighbouring words.  A pair that occurs less
   than ``min_count`` times can't lie in a phrase, so suffixes end before the
   first such pair.  Tasks know the frequent pairs by a bitmap of 16 bits a pair, at most ``FILTER_BITS``;
   where it is too small for its pairs, it cuts fewer suffixes and changes no result.
2. Equal suffixes of a batch become one row with their number, and rows are routed
   by their leading words: a range exchange over all words, sampled, so that a
   leading word with very many suffixes spreads over several tasks.
3. Every task sorts its suffixes by three-way partition around a pivot word, going
   on to the next word in the middle part.  The weight of a middle part is the
   count of its phrase; parts below ``min_count`` are abandoned at once.  Only
   phrases of a task's first and last suffix can go on in other tasks: they are
   never abandoned, and their counts are summed.
4. Parts and longer phrases are looked up by joins.  Products are decimals of 38 digits.

Words are told apart by 64-bit hashes of language and word; if two frequent words
shared one, counting starts again with other hashes (rarer words can't be seen to
collide: a chance of 5e-20 a pair).  Every task holds a part of the range exchange,
about ``TASK_ROWS`` rows.

Null texts have no words.  A null language counts as ``und``.  Repeated rows count
each.  Of equal scores the more frequent phrase ranks first, then the lesser one in
UTF-8 byte order.  Without candidates (an empty table, or short ones) there are no
rows.  Other columns play no part, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.words import mix, portions, text_bytes, word_hashes, word_spans
from plumbline.session import written

UNKNOWN = "und"
#: Most bits of the bitmap of frequent pairs (8 MB).
FILTER_BITS = 1 << 26
TASK_ROWS = 2_000_000
#: Pairs or suffixes that a task counts at a time.
GATHERED = 1 << 19
SALTS = 64

_BREAKS = np.zeros(256, bool)
_BREAKS[np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_PAIR = np.uint64(0x9E6C63D0876A9A35)


def tokens(batch: pa.RecordBatch, seed: int):
    """(data, first byte, end byte, hash of language and word, piece, languages, language of each word) of every portion of a batch."""
    data, offsets = text_bytes(batch.column(0))
    languages, of_row = np.unique(np.array(batch.column(1).to_pylist(), dtype=object).astype(str), return_inverse=True)
    salts = mix(np.array([hash_of(x, seed) for x in languages], np.uint64))
    for lo, hi in portions(offsets):
        body = _LOWER[data[offsets[lo]:offsets[hi]]]
        broken = _BREAKS[body]
        body[broken] = 0x20
        start, end, row = word_spans(body, offsets[lo:hi + 1] - offsets[lo])
        language = of_row[lo + row]
        words = mix(word_hashes(body, start, end) ^ salts[language]).view(np.int64)
        words[words == 0] = 1  # 0 stands for no word
        piece = np.cumsum(broken)[start] + row * (len(body) + 1)
        yield body, start, end, words, piece, languages, language


def hash_of(text: str, seed: int) -> int:
    out = 0xCBF29CE484222325 ^ seed
    for byte in text.encode():
        out = (out ^ byte) * 0x100000001B3 % (1 << 64)
    return out


def pair_hashes(words: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word with the next one, and whether both are in one piece."""
    return mix(words[:-1].view(np.uint64) * _PAIR + words[1:].view(np.uint64)).view(np.int64), piece[1:] == piece[:-1]


def _unique(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different keys, where each stands first, and how often."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    edge = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return ranked[edge], order[edge], np.diff(np.append(edge, len(keys)))


def _count_words(seed: int):
    def run(batches):
        for batch in batches:
            for body, start, end, words, _, languages, language in tokens(batch, seed):
                key, first, n = _unique(words)
                view = body.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(languages[language[first]].tolist(), pa.string()),
                     pa.array([view[a:b] for a, b in zip(start[first].tolist(), end[first].tolist())], pa.binary()), pa.array(n)],
                    ["key", "lang", "word", "n"])
    return run


def _count_pairs(seed: int):
    def run(batches):
        for batch in batches:
            held = []
            for _, _, _, words, piece, _, _ in tokens(batch, seed):
                pair, same = pair_hashes(words, piece)
                held.append(pair[same])
                if sum(map(len, held)) >= GATHERED:
                    yield counts(held)
                    held = []
            if held:
                yield counts(held)

    def counts(held):
        key, _, n = _unique(np.concatenate(held))
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["pair", "n"])
    return run


def merged(rows: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows as one, weights added.  Rows are brought together by a hash and compared as they are."""
    h = np.zeros(len(rows), np.uint64)
    for c in range(rows.shape[1]):
        h = mix(h * _PAIR + rows[:, c].view(np.uint64))
    order = np.argsort(h)
    rows, weight = rows[order], weight[order]
    new = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])) if len(rows) else np.zeros(0, np.int64)
    return rows[new], np.add.reduceat(weight, new) if len(new) else weight


def _suffixes(seed: int, depth: int, bits: np.ndarray):
    shift = np.uint64(64 - int(np.log2(len(bits) * 64)))

    def frequent(pair: np.ndarray) -> np.ndarray:
        at = pair.view(np.uint64) >> shift
        return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1

    def run(batches):
        for batch in batches:
            held = []
            for _, _, _, words, piece, _, _ in tokens(batch, seed):
                if len(words) < 2:
                    continue
                pair, same = pair_hashes(words, piece)
                good = same & frequent(pair)
                at = np.flatnonzero(good)
                rows = np.zeros((len(at), depth), np.int64)
                rows[:, 0] = words[at]
                going = np.ones(len(at), bool)
                for k in range(1, depth):
                    place = np.minimum(at + k, len(words) - 1)
                    going = going & (at + k < len(words)) & good[np.minimum(at + k - 1, len(good) - 1)]
                    rows[:, k] = np.where(going, words[place], 0)
                held.append(merged(rows, np.ones(len(rows), np.int64)))
                if sum(len(r) for r, _ in held) >= GATHERED:
                    yield counts(held)
                    held = []
            if held:
                yield counts(held)

    def counts(held):
        rows, weight = merged(np.concatenate([r for r, _ in held]), np.concatenate([w for _, w in held]))
        return pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(rows[:, k])) for k in range(depth)), pa.array(weight)],
                                          [*(f"w{k}" for k in range(depth)), "weight"])
    return run


def sorted_counts(rows: np.ndarray, weight: np.ndarray, least: int) -> tuple[list[tuple], list[int]]:
    """Counts of the phrases (prefixes of two words or more) of weighted suffixes, by multikey three-way quicksort.

    Phrases that weigh less than ``least`` are left out unless they begin the first or the last suffix.
    """
    depth = rows.shape[1]
    if not len(rows):
        return [], []
    phrases, counts = [], []
    edges = set()
    for pick in (np.min, np.max):  # the first and the last suffix, and all that share a prefix with them
        among = np.arange(len(rows))
        prefix = ()
        for k in range(depth):
            word = int(pick(rows[among, k]))
            # Along the whole prefix: the edge's own words, smallest or largest at every depth.
            among = among[rows[among, k] == word]
            prefix += (word,)
            if word == 0:
                break
            if k and prefix not in edges:
                edges.add(prefix)
                phrases.append(prefix)
                counts.append(int(weight[among].sum()))
    stack = [(np.arange(len(rows)), 0, ())]
    while stack:
        part, k, prefix = stack.pop()
        if weight[part].sum() < least:
            continue  # nothing in it can be frequent
        key = rows[part, k]
        pivot = int(key[0] if len(key) < 3 else np.partition(key[[0, len(key) // 2, -1]], 1)[1])
        equal = key == pivot
        if not equal.all():
            stack.append((part[key < pivot], k, prefix))
            stack.append((part[key > pivot], k, prefix))
            part = part[equal]
        if pivot == 0:
            continue  # these suffixes end here
        longer = (*prefix, pivot)
        total = int(weight[part].sum())
        if total < least:
            continue
        if k and longer not in edges:
            phrases.append(longer)
            counts.append(total)
        if k + 1 < depth:
            stack.append((part, k + 1, longer))
    return phrases, counts


def _sorter(depth: int, least: int):
    def run(batches):
        held = [(np.stack([b.column(k).to_numpy() for k in range(depth)], 1), b.column(depth).to_numpy()) for b in batches if len(b)]
        if held:
            phrases, counts = sorted_counts(*merged(np.concatenate([r for r, _ in held]), np.concatenate([w for _, w in held])), least)
            yield pa.RecordBatch.from_arrays([pa.array(phrases, pa.list_(pa.int64())), pa.array(counts, pa.int64())], ["words", "a"])
    return run


def bitmap(pairs: DataFrame, count: int) -> np.ndarray:
    """Bits of the pairs' hashes, put together by Spark; at most ``FILTER_BITS`` of them reach the driver."""
    width = 16
    while width < 1 << 14 or width < 16 * count and width < FILTER_BITS:
        width *= 2
    log = width.bit_length() - 1
    at = F.shiftrightunsigned("pair", 64 - log)
    cells = pairs.select((at / 64).cast("int").alias("cell"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(pair, {64 - log}) % 64 as int))").alias("bit")) \
        .groupBy("cell").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(width // 64, np.uint64)
    out[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy().view(np.uint64)
    return out


def counted(docs: DataFrame, lang: str = "lang", text: str = "text", max_words: int = 5, min_count: int = 100) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(languages: lang, n; words: key, lang, word, n; phrases: words as an array of keys, a).

    Words and phrases that occur ``min_count`` times or more.
    """
    spark = docs.sparkSession
    table = docs.select(F.col(f"`{text}`").alias("text"), F.coalesce(F.col(f"`{lang}`"), F.lit(UNKNOWN)).alias("lang"))
    seed = 0
    while True:
        found = table.mapInArrow(_count_words(seed), "key long, lang string, word binary, n long") \
            .groupBy("key", "lang", "word").agg(F.sum("n").alias("n"))
        found = written(found, "phrase-words")
        words = written(found.filter(F.col("n") >= min_count), "phrase-frequent")
        if words.groupBy("key").count().filter("count > 1").isEmpty():
            break
        seed += 1
    languages = written(found.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-languages")
    pairs = table.mapInArrow(_count_pairs(seed), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = written(pairs.filter(F.col("n") >= min_count).select("pair"), "phrase-pairs")
    bits = bitmap(pairs, pairs.count())
    names = [f"w{k}" for k in range(max_words)]
    suffixes = written(table.mapInArrow(_suffixes(seed, max_words, bits), ", ".join(f"{c} long" for c in names) + ", weight long"), "phrase-suffixes")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-suffixes.count() // TASK_ROWS))
    phrases = suffixes.repartitionByRange(parts, *names).mapInArrow(_sorter(max_words, min_count), "words array<long>, a long") \
        .groupBy("words").agg(F.sum("a").alias("a")).filter(F.col("a") >= min_count)
    words = words.withColumn("word", F.col("word").cast("string"))
    return languages, words, written(phrases, "phrase-counts")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", max_words: int = 5, min_count: int = 100,
                 nested_percent: int = 100, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases.

    A phrase inside a longer one that has ``nested_percent`` of its occurrences is left out.
    """
    languages, words, phrases = counted(docs, lang, text, max_words, min_count)
    inner = F.expr("flatten(transform(sequence(2, size(words) - 1), k -> transform(sequence(1, size(words) - k + 1), i -> slice(words, i, k))))")
    covered = phrases.filter(F.size("words") > 2).select(F.explode(inner).alias("part"), "a").groupBy("part").agg(F.max("a").alias("most"))
    alone = phrases.join(covered, (F.col("words") == F.col("part")) & (100 * F.col("most") >= nested_percent * F.col("a")), "left_anti")
    alone = written(alone, "phrase-alone")
    counts = written(phrases.unionByName(words.select(F.array("key").alias("words"), F.col("n").alias("a"))), "phrase-parts")

    cuts = alone.select("words", "a", F.explode(F.expr("sequence(1, size(words) - 1)")).alias("k"))
    cuts = cuts.withColumns({"left": F.expr("slice(words, 1, k)"), "right": F.expr("slice(words, k + 1, size(words) - k)")})
    cuts = cuts.join(counts.select(F.col("words").alias("left"), F.col("a").alias("l")), "left") \
        .join(counts.select(F.col("words").alias("right"), F.col("a").alias("r")), "right")
    named = alone.select("words", F.posexplode("words").alias("place", "key")).join(words.select("key", "word", F.col("lang").alias("_lang")), "key") \
        .groupBy("words").agg(F.first("_lang").alias("lang"), F.array_sort(F.collect_list(F.struct("place", "word"))).alias("parts")) \
        .select("words", "lang", F.array_join("parts.word", " ").alias("phrase")).join(languages, "lang")
    wide = "decimal(19, 0)"
    # Of all cuts the greatest l * r has the least score before flooring; after it, ties go to the least k.
    scored = cuts.join(named, "words").withColumn(
        "score", F.expr(f"(cast(a as {wide}) * cast(1000 * cast(n as {wide}) as {wide})) div (cast(l as {wide}) * cast(r as {wide}))"))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")) \
        .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = best.withColumn("_salt", F.pmod(F.hash("phrase"), F.lit(SALTS)))
    best = best.withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).filter(F.col("_place") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
