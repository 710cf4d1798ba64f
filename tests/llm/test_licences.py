from __future__ import annotations

import textwrap

import duckdb
import pandas as pd

from plumbline.llm import licences, registry
from plumbline.llm.licence_texts import KNOWN, MIT
from plumbline.llm.sql import ORACLE_SQL
from tests.compare import connect, differences
from tests.conftest import MIDDLE
from tests.llm.rows import awkward, nothing, others_kept


def test_disguised_copies(spark):
    texts = {
        "MIT": [MIT, MIT.upper(), "Copyright (c) 2020 Somebody\nAll rights reserved.\n\n" + MIT, "  © 1999 A, B\n" + MIT.replace("\n", " \r\n "),
                MIT.replace('"AS IS"', "“as is”").replace(",", "").replace("sublicense", "sub-licence"), "/* Copyright X */\n" + MIT],
        None: [MIT[:-20], MIT + " And more.", MIT.replace("free of charge", "at a charge"), "", None, "Copyright 2001 X"],
        "BSD-3-Clause": [KNOWN["BSD-3-Clause"].replace("copyright holder nor", "copyright owner nor")],
    }
    rows = [(i, t, want) for i, (want, t) in enumerate((w, t) for w, ts in texts.items() for t in ts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, want string")
    assert [r for r in licences.scanned(docs).collect() if r.licence_id != r.want] == []


def test_both_canonical_forms_agree(spark):
    texts = [*KNOWN.values(), "Ünïcode Licence\n(C) nobody\nfulfil per cent", "a_b-c", "one\rcopyright x\ntwo",
             "one\u2028(c) x two\r\n© y\r\nthree"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in docs.select(licences.canonical(docs["text"])).collect()] == list(map(licences.canonical_text, texts))


def test_every_known_text_is_found(spark):
    docs = spark.createDataFrame(sorted(KNOWN.items()), "name string, text string")
    assert all(r.licence_id == r.name for r in licences.scanned(docs).collect())
    assert licences.digests({"b": "Same.", "a": "same", "c": "  "}) == {d: "a" for d in licences.digests({"a": "same"})}


def wrapped(text, width):
    """Every paragraph filled anew; width 0: the whole text on one line."""
    if not width:
        return " ".join(text.split())
    return "\n\n".join(textwrap.fill(" ".join(p.split()), width, break_long_words=False) for p in text.split("\n\n"))


def test_layout_does_not_change_a_licence(spark):
    usual = MIT.replace("THE AUTHORS OR\nCOPYRIGHT HOLDERS", "THE\nAUTHORS OR COPYRIGHT HOLDERS")
    rows = [("MIT", usual)] + [(name, notice + wrapped(text, width)) for name, text in sorted(KNOWN.items())
                               for width in (0, 1, 10, 20, 30, 40, *range(60, 121))
                               for notice in ("", "Copyright (c) 2020 Somebody\n", "copyright The X Authors\nCopyright 1999-2001\n\n")]
    assert any(line.startswith("COPYRIGHT HOLDER") for _, t in rows for line in t.split("\n"))
    docs = spark.createDataFrame(rows, "name string, text string")
    assert [(r.name, r.text) for r in licences.scanned(docs).collect() if r.licence_id != r.name] == []
    cut = MIT.replace("COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR\n", "")
    assert cut != MIT and licences.scanned(spark.createDataFrame([(cut,)], "text string")).first().licence_id is None


def test_sql_follows_the_operator_on_every_layout(spark):
    texts = [notice + wrapped(text, width) for text in KNOWN.values() for width in (0, 1, 10, 20, 40, 66, 72, 78, 80, 100)
             for notice in ("", "Copyright (c) 2020 Somebody\n", "copyright The X Authors\n\nCopyright 1999-2001\n")]
    texts += ["copyright\nholders\nx", "copyright\n2001\nx", "copyrighted\nx", "* copyright, in y\nz", "copyright inx\nz", "a copyright b\nc",
              "copyright or copyright notice\nx", "copyright or\ncopyright 2001\nx", "copyright © and\nx", "copyright", "copyright or", "©\n(c)\nx", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": range(len(texts)), "text": texts}).astype({"text": "object"}))
    got = licences.scanned(docs).select("doc_id", "licence_digest", "licence_id")
    assert differences(got, con, ORACLE_SQL["op7_licences"]) == []


def test_query(spark):
    assert differences(registry.op7_licences(spark, MIDDLE), connect(MIDDLE), ORACLE_SQL["op7_licences"]) == []


def test_awkward(spark):
    docs = awkward(spark)
    out = licences.scanned(docs)
    assert others_kept(docs, out, "licence_digest", "licence_id")
    assert all((r.licence_digest is None) == (r.text is None) and r.licence_id is None for r in out.collect())
    assert licences.scanned(nothing(spark)).collect() == []
    assert licences.scanned(docs, {}).filter("licence_id is not null").count() == 0
