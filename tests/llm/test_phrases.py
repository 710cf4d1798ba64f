import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from plumbline.llm import phrases, registry
from plumbline.llm.sql import ORACLE_SQL
from tests.conftest import MIDDLE
from tests.llm.rows import awkward, nothing

LOWER = {c: c + 32 for c in range(65, 91)}


def by_definition(rows, max_words=5, least=100, nested=100, top=2000):
    counts, sizes = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, max_words + 1):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        good = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = Counter()
        for p, a in good.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    covered[p[i:i + k]] = max(covered[p[i:i + k]], a)
        ranked = []
        for p, a in good.items():
            if p in covered and 100 * covered[p] >= nested * a:
                continue
            score, k = min((1000 * a * sizes[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


def test_quicksort_counts_prefixes():
    rng = np.random.default_rng(4)
    for least in (1, 5, 40):
        rows = rng.choice(np.array([-7, -2, 3, 9, 11]), (900, 4), p=[0.5, 0.2, 0.1, 0.1, 0.1])
        end = rng.integers(2, 5, 900)
        rows[np.arange(4) >= end[:, None]] = 0
        rows, weight = phrases.merged(rows, rng.integers(1, 4, 900))
        expected = Counter()
        for row, w in zip(rows.tolist(), weight.tolist()):
            for k in range(2, 5):
                if row[k - 1]:
                    expected[tuple(row[:k])] += w
        found = dict(zip(*phrases.sorted_counts(rows, weight, least)))
        assert all(expected[p] == n for p, n in found.items())
        assert {p for p, n in expected.items() if n >= least} <= set(found)
        low, high = min(rows.tolist()), max(rows.tolist())
        whole = lambda x: [tuple(x[:k]) for k in range(2, 5) if x[k - 1]]
        assert set(whole(low)) | set(whole(high)) <= set(found)
        assert len(found) == len(phrases.sorted_counts(rows, weight, least)[0])


@pytest.mark.parametrize("parts", [1, 9])
def test_query_equals_brute_force(spark, tmp_path, parts, monkeypatch):
    monkeypatch.setattr(phrases, "TASK_ROWS", 300 if parts > 1 else 10**6)  # many borders between tasks
    rng = random.Random(parts)
    vocabulary = ["the", "of", "A", "b\x01", "ñu", "Ñu", "x\x1fy", "c'd", " ", "zeta", *[f"r{i}" for i in range(4000)]]
    rows = []
    for i in range(700):
        words = rng.choices(vocabulary, weights=[40, 30, 30, 20, 20, 20, 10, 10, 5, 5] + [0.02] * 4000, k=rng.randrange(90))
        words += ["New", "york  city\tHall", "is"] * rng.randrange(3)
        sep = lambda: rng.choice([" "] * 12 + ["\t ", ". ", ",", "\n", "!?", "\r", "\x0b", ";"])
        rows.append((rng.choice(["en", "en", "de", None, "und", "é"]), "".join(w + sep() for w in words)))
    rows += [("en", None), (None, None), ("fr", ""), ("en", "the " * 300), ("it", "uno due " * 120)]
    spark.createDataFrame(rows, "lang string, text string").repartition(parts).write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(tuple(r) for r in registry.op11_phrases(spark, str(tmp_path)).collect())
    expected = by_definition(rows)
    assert found == expected and len({r[0] for r in found}) == 5
    assert any(len(r[2].split()) == 5 for r in found)


def test_other_parameters(spark):
    rows = [("en", "a b c d a b x. a b c"), ("en", "a b c d e f g")] * 8
    docs = spark.createDataFrame(rows, "tongue string, body string")
    for depth, least, nested, top in ((2, 8, 100, 50), (3, 8, 60, 50), (7, 8, 100, 50), (5, 16, 100, 2), (5, 999, 100, 2)):
        found = phrases.collocations(docs, "tongue", "body", depth, least, nested, top)
        assert sorted(tuple(r) for r in found.collect()) == by_definition(rows, depth, least, nested, top)


def test_bitmap_too_small_changes_nothing(spark, monkeypatch):
    rows = [("en", "a b c d a b x. a b c"), ("en", "a b c d e f g")] * 8
    docs = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(phrases, "bitmap", lambda pairs, count: np.full(256, 2**64 - 1, np.uint64))
    found = phrases.collocations(docs, min_count=8)
    assert sorted(tuple(r) for r in found.collect()) == by_definition(rows, least=8)


def test_sql(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("lang", "text").collect()
    expected = by_definition([tuple(r) for r in docs])
    assert sorted(tuple(r) for r in registry.op11_phrases(spark, MIDDLE).collect()) == expected
    base = duckdb.connect()
    base.sql(f"create view documents as select * from '{MIDDLE}/documents.parquet'")
    assert sorted(base.sql(ORACLE_SQL["op11_phrases"]).fetchall()) == expected


def test_awkward_rows(spark):
    assert phrases.collocations(nothing(spark)).count() == 0
    docs = awkward(spark)
    rows = [(r.lang, r.text) for r in docs.collect()]
    found = phrases.collocations(docs, min_count=3)
    assert sorted(tuple(r) for r in found.collect()) == by_definition(rows, least=3)
