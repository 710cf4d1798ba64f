import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from plumbline.llm import periods, registry
from tests.llm.rows import awkward, nothing, others_kept

SF = "/root/testdata/sf0.001"


def by_definition(words, exponent=4, least=6):
    """Every stretch with its least period, extended as far as the period goes."""
    n, runs = len(words), set()
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, exponent * q):
                part = words[i:i + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    runs.add((i, length, q))
            i = j + 1
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def caught(lists, **options):
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    flat = np.array([hash((w, 3)) & (2**64 - 1) for x in lists for w in x], np.uint64)
    found = [[] for _ in lists]
    for r, s, n, q in zip(*periods.word_runs(flat, offsets, **options)):
        found[r].append((int(s), int(n), int(q)))
    return found


def test_runs_equal_the_definition():
    rng = random.Random(5)
    lists = [[]]
    for _ in range(1500):
        letters = rng.choice([1, 2, 2, 3, 5])
        words = []
        while len(words) < rng.randrange(1, 120):
            part = [rng.randrange(letters) for _ in range(rng.choice([1, 1, 2, 3, 4, 5, 7, 8, 9, 13, 16, 17]))]
            words += part * rng.choice([1, 1, 2, 3, 4, 5, 6, 9])
            words = words[:-1] if rng.random() < 0.3 else words
        lists.append(words)
    assert caught(lists) == [by_definition(x) for x in lists]
    assert sum(map(len, caught(lists))) > 1000


def test_fibonacci_and_nested_runs():
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    lists = [b, ([0] * 7 + [1]) * 5 + [2], (([0, 1] * 5 + [2]) * 4) * 2, [0] * 500, list(range(500))]
    assert caught(lists) == [by_definition(x) for x in lists]
    assert caught(lists, exponent=5, least=9) == [by_definition(x, 5, 9) for x in lists]
    with pytest.raises(ValueError):
        caught(lists, exponent=3)


def expected_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = by_definition(words)
    top = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
    listed = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None, sha(listed), sha(collapsed(words, runs)))


def test_query_equals_brute_force(spark, tmp_path):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = [(i, t) for i, t in rows if len((t or "").split()) < 1500]
    rows += [(10**6 + i, "a b c " * i + "d e") for i in range(60)] + [(None, "x " * 9), (5, None), (6, ""), (None, None)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.op12_periods(spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted((expected_row(*r) for r in rows), key=repr)
    assert sum(r.n_runs > 0 for r in got) > 30


def test_awkward_rows(spark):
    docs = awkward(spark)
    found = periods.periodic(docs)
    assert others_kept(docs, found, "n_words", "runs", "collapsed")
    for r in found.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        runs = by_definition(words) if len(words) < 2500 else None
        if runs is not None:
            assert [tuple(x) for x in r.runs] == runs
            assert r.n_words == len(words) and r.collapsed == collapsed(words, runs)
    assert periods.periodic(nothing(spark)).count() == 0


def test_one_text_of_megabytes(spark):
    rng = random.Random(1)
    words = [f"w{rng.randrange(50_000)}" for _ in range(400_000)]
    words[100_000:100_000 + 4 * 20_000] = words[100_000:120_000] * 4
    row = periods.periodic(spark.createDataFrame([(" ".join(words),)], "text string")).first()
    start = 100_000
    while words[start - 1] == words[start + 19_999]:
        start -= 1
    assert [tuple(r) for r in row.runs] == [(start, 180_000 - start, 20_000)]
    assert len(row.collapsed.split()) == 400_000 - (180_000 - start) + 20_000
