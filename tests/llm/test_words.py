from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

from plumbline.llm import words as w
from tests.llm.rows import TEXTS


def test_spans_are_the_pattern():
    texts = [*TEXTS, "\x0ba\x0cb\rc", "é è\xa0ü"]
    data, offsets = w.text_bytes(pa.array(texts, pa.string()))
    start, end, row = w.word_spans(data, offsets)
    found = [[] for _ in texts]
    for a, b, r in zip(start, end, row):
        found[r].append(data[a:b].tobytes().decode())
    assert found == [re.findall(w.WORD, t or "") for t in texts]


def test_equal_words_have_equal_hashes():
    data, offsets = w.text_bytes(pa.array(["one two one", None, "", "two on one"]))
    start, end, row = w.word_spans(data, offsets)
    h = w.word_hashes(data, start, end)
    assert h[0] == h[2] == h[5] and h[1] == h[3] and len(set(h.tolist())) == 3
    grams, at = w.ngram_hashes(h, row, 2)
    assert at.tolist() == [0, 1, 3, 4] and len(set(grams.tolist())) == 4


def test_sliced_arrays_and_portions():
    array = pa.array(["aa", "bbb", None, "c", "dd" * 50])[1:]
    data, offsets = w.text_bytes(array)
    assert offsets.tolist() == [0, 3, 3, 4, 104] and data.tobytes().startswith(b"bbbc")
    assert list(w.portions(offsets, 4)) == [(0, 3), (3, 4)]
    assert list(w.portions(np.array([0]))) == []
