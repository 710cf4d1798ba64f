"""Awkward rows for every operator: nulls, empty and very long texts, ties, repeated rows, clashing column names."""

from __future__ import annotations

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, shard int, _key long, _c0 string, "
          "row_key long, text_key string, kept boolean, score double, item_id long, n_words long, target double, _text string")

WORDS = ("the of and to in is that it was for on are as with his they at be this from have or by one had not but what all "
         "were when we there can an your which their said if do will each about how up out them then she many some so").split()


def prose(seed: int, words: int) -> str:
    """The same words for the same seed; different seeds share no long runs."""
    out, x = [], seed * 7919 + 13
    for _ in range(words):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)] + ("" if (x >> 16) % 3 else chr(97 + (x >> 20) % 26) + chr(97 + (x >> 11) % 26)))
    return " ".join(out)


TEXTS = [None, "", " \t\n", "word", "Of.", "12 34 !!", "x\ny\nx\ny", "ñandú Ωmega Привет мир", prose(1, 120), prose(1, 120), prose(2, 120),
         prose(3, 6000), "a" * 5000, "ab " * 2000, prose(4, 60), prose(4, 60) + " end", "#### $$$$ ||||" * 30]


def awkward(spark, texts=TEXTS):
    rows = [(i, t, None if i == 3 else "en", None if i % 4 == 0 else f"s{i % 3}", len(t or ""), 1, 2, 3, "c", 4, "k", True, 0.5, 7, 8, 9.0, "z")
            for i, t in enumerate(texts)]
    rows += [rows[8], rows[1], (None, *rows[10][1:]), (None, None, *rows[0][2:])]
    return spark.createDataFrame(rows, SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def others_kept(before, after, *replaced):
    """The columns that the operator does not set hold what they held."""
    same = [c for c in before.columns if c not in replaced]
    key = lambda r: str(tuple(r))
    return sorted(map(key, before.select(*same).collect())) == sorted(map(key, after.select(*same).collect()))
