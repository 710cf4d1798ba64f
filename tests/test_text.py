"""Extraction, classification, redaction."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plumbline.functions import address as a
from plumbline.functions import text as t
from plumbline.operators.references import (
    duplicate_variants, nearest_value, orphan_count, orphans, referenced)
from plumbline.plans import enrich


def one(spark, value, expression):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(expression(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("text, parts, real, masked", [
    ("12 Oak St, Austin TX 78701", ("12 Oak St", "Austin", "TX", "78701"), True, "[STREET], Austin TX [ZIP]"),
    ("1 Elm Dr, St. Paul MN 55101", ("1 Elm Dr", "St. Paul", "MN", "55101"), True, "[STREET], St. Paul MN [ZIP]"),
    ("12 Oak St, Austin ZZ 78701", ("12 Oak St", "Austin", "ZZ", "78701"), False, "[STREET], Austin ZZ [ZIP]"),
    ("12 Oak St, Austin TX 787", (None,) * 4, False, "[ADDRESS]"),
    ("12 Oak St, Austin TX 78701-1234", ("12 Oak St", "Austin", "TX", "78701-1234"), True, "[STREET], Austin TX [ZIP]"),
    ("12 N. Oak St., Austin TX 78701", ("12 N. Oak St.", "Austin", "TX", "78701"), True, "[STREET], Austin TX [ZIP]"),
    ("12 Oak St, Apt 4, Austin TX 78701", ("12 Oak St, Apt 4", "Austin", "TX", "78701"), True, "[STREET], Austin TX [ZIP]"),
    ("12 5th Ave Apt 4, Austin TX 78701", ("12 5th Ave Apt 4", "Austin", "TX", "78701"), True, "[STREET], Austin TX [ZIP]"),
    ("12 Oak St, Austin TX 78701-12", (None,) * 4, False, "[ADDRESS]"),
    ("n/a 501", (None,) * 4, False, "[ADDRESS]"),
    ("", (None,) * 4, False, "[ADDRESS]"),
    (None, (None,) * 4, None, None),
])
def test_addresses(spark, text, parts, real, masked):
    assert tuple(one(spark, text, a.extract_address)) == parts
    assert one(spark, text, a.is_us_address) is real
    assert one(spark, text, a.redact_address) == masked


@pytest.mark.parametrize("text, masked", [
    ("write to a.b+c@mail.example.org now", "write to [EMAIL] now"),
    ("from 10.0.0.1 and 192.168.1.20", "from [IP] and [IP]"),
    ("card 4111 1111 1111 1111 or 4111111111111111", "card [CARD] or [CARD]"),
    ("call +1 (555) 123-4567", "call [PHONE]"),
    ("call (512) 555-0100 or 512-555-0100.", "call [PHONE] or [PHONE]."),
    ("number 12345678901234567 is no card", "number 12345678901234567 is no card"),
    ("version 1.2.3.4.5 is no address, 1.2.3.4. is", "version 1.2.3.4.5 is no address, [IP]. is"),
    ("moved to 12 Oak St., Apt 4, St. Paul MN 55101-0001, in 2021", "moved to [ADDRESS], in 2021"),
    ("In 2020 he left, then 7 Elm Dr, Austin TX 78701 was home", "In 2020 he left, then [ADDRESS] was home"),
    ("nothing here", "nothing here"),
    (None, None),
])
def test_redaction(spark, text, masked):
    assert one(spark, text, t.redact) == masked


def test_whole_texts_are_read(spark):
    long = "word " * 50_000 + "a@b.org"
    assert one(spark, long, t.redact).endswith("word [EMAIL]")
    assert one(spark, long, lambda c: t.hits(c, "EMAIL")) == 1
    assert one(spark, None, lambda c: t.hits(c, "IP")) == 0


def test_counts_on_nothing(spark):
    none = spark.createDataFrame([], "text string")
    assert {(r.kind, r.texts, r.hits) for r in enrich.redaction_counts(none).collect()} == {
        (k, 0, 0) for k in t.PERSONAL_DATA}


def test_page_fields(spark):
    df = spark.createDataFrame([(1, "https://a.example:80/x?y", '<html lang="de"><title>T</title>'), (2, "ftp://x", "")],
                               "page_id long, url string, html string")
    assert [tuple(r) for r in enrich.page_fields(df).orderBy("page_id").collect()] == [
        (1, "de", "T", "a.example"), (2, None, None, None)]


def test_prompt_and_model(spark):
    model = t.batch_model(lambda texts: texts.str.len(), "long")
    assert one(spark, "abc", lambda c: t.prompt("<{0}|{1}>", c, F.upper(c))) == "<abc|ABC>"
    assert one(spark, "abc", lambda c: model(t.prompt("is {0} real?", c))) == 12


def test_nearest_value(spark):
    values = ("ELECTRONICS", "ACCESSORIES", "OFFICE")
    repaired = {v: one(spark, v, lambda c: nearest_value(c, values)) for v in ("ELECTRNICS", "ACCESORIES", "OFFICE", None)}
    assert repaired == {"ELECTRNICS": "ELECTRONICS", "ACCESORIES": "ACCESSORIES", "OFFICE": "OFFICE", None: None}
    assert one(spark, "x", lambda c: nearest_value(c, ("b", "a"))) == "a"


def test_references(spark):
    child = spark.createDataFrame([("p", "x")] * 500 + [("q", "x"), ("q", "y"), (None, "x"), ("r", "y")], "k string, s string")
    parent = spark.createDataFrame([("p",), ("p",), ("r",), (None,)], "k string")
    assert [tuple(r) for r in orphans(child, parent, "k").collect()] == [("q", 2)]
    assert tuple(orphan_count(child, parent, "k").first()) == (2, 1)
    assert tuple(orphan_count(parent, parent, "k").first()) == (0, 0)
    assert {tuple(r) for r in referenced(child, parent, "k", "s").collect()} == {("x", 500), ("y", 1)}
    assert tuple(duplicate_variants(child, "k").first()) == (500, 2, 502)
