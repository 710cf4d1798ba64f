from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import registry, repeats
from tests.conftest import SMALL
from tests.llm.rows import TEXTS, awkward, nothing, others_kept


def removed(texts, width):
    """Every window looked up in a dictionary of all windows."""
    seen, raw = {}, [(t or "").encode() for t in texts]
    for b in raw:
        for i in range(len(b) - width + 1):
            seen[b[i:i + width]] = seen.get(b[i:i + width], 0) + 1
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - width + 1):
            if seen[b[i:i + width]] > 1:
                gone[i:i + width] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def found(docs, width, group_rows):
    per = repeats.cut_texts(docs, width, group_rows).select(
        "text_key", "n_bytes", F.expr("aggregate(spans, 0L, (n, s) -> n + s.stop - s.start)").alias("r"),
        F.size("spans").alias("n"), F.sha2("kept", 256).alias("h"))
    return {r["at"]: (r.n_bytes, r.r, r.n, r.h) for r in repeats.of_rows(docs, per).select("at", "n_bytes", "r", "n", "h").collect()}


def variants(seed):
    rng = random.Random(seed)
    base = "".join(rng.choice("abcdefgh é\n") for _ in range(2500))
    out = [None, "", "x", "a" * 900, "ab" * 500, "é" * 300]
    for _ in range(30):
        part = list(base[rng.randrange(0, 800):rng.randrange(900, 2500)])
        for _ in range(rng.randrange(4)):
            part[rng.randrange(len(part))] = rng.choice("xyz")
        out.append("".join(rng.choice("pqrs") for _ in range(rng.randrange(50))) + "".join(part))
    return out + out[-3:]


@pytest.mark.parametrize("width,group_rows", [(40, 4096), (100, 3), (400, 4096)])
def test_brute_force(spark, width, group_rows):
    texts = variants(width)
    docs = spark.createDataFrame(list(enumerate(texts)), "at long, text string").repartition(4)
    got, want = found(docs, width, group_rows), removed(texts, width)
    assert [got[i] for i in range(len(texts))] == want


def test_portions_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PORTION", 1500)
    texts = variants(7)
    texts += ["".join(texts[8:14])]
    key = [b"k"] * len(texts)
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(key), pa.array([(t or "").encode() for t in texts], pa.binary()),
                                        pa.array([1] * len(texts))], ["text_key", "body", "copies"])
    windows = 0
    for out in repeats._members(100)([batch]):
        windows += sum(out.column(4).to_pylist())
    assert windows == sum(max(0, len((t or "").encode()) - 99) for t in texts)


def test_column_rounds_match_pairs():
    rng = np.random.default_rng(2)
    columns = rng.integers(0, 2, (40, 30)).astype(np.uint8)
    columns[20:] = columns[:20]
    columns[25, 11] ^= 1
    begin, end = rng.integers(0, 5, 40), rng.integers(25, 31, 40)
    group = np.sort(rng.integers(0, 3, 40))
    got = repeats.repeated_windows(columns, begin, end, group, 8)
    for i in range(40):
        for c in range(30):
            inside = begin[i] <= c and c + 8 <= end[i]
            want = inside and any(j != i and group[j] == group[i] and begin[j] <= c and c + 8 <= end[j]
                                  and (columns[i, c:c + 8] == columns[j, c:c + 8]).all() for j in range(40))
            assert got[i, c] == want


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    want = dict(zip([r.doc_id for r in docs], removed([r.text for r in docs], 400)))
    rows = registry.op8_repeats(spark, SMALL).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    for r in rows:  # the remaining text; half characters at a cut are replaced
        assert (r.text == texts[r.doc_id]) == (r.n_removed == 0)
        assert r.text.isascii() is False or len(r.text) == r.n_bytes - r.n_removed


def test_awkward(spark):
    docs = awkward(spark)
    per = repeats.cut_texts(docs)
    out = repeats.of_rows(docs, per)
    assert others_kept(docs, out, "kept")
    by_text = {r.text: (bytes(r["kept"]), r.spans) for r in out.collect()}
    assert by_text[None] == (b"", []) and by_text[""] == (b"", [])
    assert by_text["word"][0] == b"word" and by_text[TEXTS[8]][0] == b"" and by_text[TEXTS[12]][0] == b""
    empty = repeats.cut_texts(nothing(spark))
    assert empty.collect() == [] and repeats.of_rows(nothing(spark), empty).collect() == []
    with pytest.raises(ValueError):
        repeats.cut_texts(docs, 32)
