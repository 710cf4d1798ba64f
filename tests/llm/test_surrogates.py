from __future__ import annotations

import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from plumbline.functions import text
from plumbline.llm import registry, surrogates
from tests.conftest import MIDDLE, SMALL
from tests.llm.rows import awkward, nothing, others_kept

# Written here on their own, so that a wrong pattern of the operator shows.
KINDS = {
    "email": r"[a-z]+\.\d+@mail\d+\.example\.com", "phone": r"\+1 \(\d{3}\) \d{3}-\d{4}", "card": r"(?<!\w)\d{16}(?!\w)",
    "ip": r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\d.])", "token": r"(?<!\w)[0-9a-fA-F]{40}(?!\w)",
}


def rewritten(spark, texts, key="k"):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.text, r.n_entities) for r in surrogates.replaced(docs, key).orderBy("doc_id").collect()]


def test_format_is_kept_and_entities_are_recognised_again(spark):
    [(a, n), (b, m)] = rewritten(spark, [
        "to Une.92@Mail6.example.com or une.92@mail6.example.com, +1 (974) 555-3436; 9807915762804490 is 9807-9157-6280-4490 from 97.51.17.173.",
        'token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde" = 2ABC3FF2CA8FB1E4C565A0EB63815530A948BDDE, une.92@mail6.example.com'])
    assert (n, m) == (6, 3)
    first = re.fullmatch(r"to ([A-Z][a-z]{2}\.\d\d@[A-Z][a-z]{3}\d\.[a-z]{7}\.com) or (\S+), \+1 \(\d{3}\) \d{3}-\d{4}; (\d{16}) is ([\d-]{19})"
                         r" from (\d+\.\d+\.\d+\.\d+)\.", a)
    assert first[1].lower() == first[2] and first[3] == first[4].replace("-", "") and first[3] != "9807915762804490"
    assert all(0 <= int(x) <= 255 for x in first[5].split("."))
    second = re.fullmatch(r'token = "([0-9a-f]{40})" = ([0-9A-F]{40}), (\S+)', b)
    assert second[1] == second[2].lower() and second[3] == first[2]


PHONES = ["(974) 555-3436", "974-555-3436", "974.555.3436", "974 555 3436", "(974)555-3436", "+1 974-555-3436", "1-974-555-3436",
          "1.974.555.3436", "+1.974.555.3436", "+1 (974) 555-3436", "(974 555-3436", "974) 555-3436", "+49 30 1234567", "+49 (30) 1234567",
          "+44 (0)20 7946 0958", "+33 1 23 45 67 89", "+49-30-1234567", "+14155550123", "+4930123456", "+353 1 234 5678"]


def test_shapes_of_phone_numbers(spark):
    out = rewritten(spark, [f"call {p}, or x" for p in PHONES] + [f"({p}) and {p}" for p in PHONES])
    spelt = lambda t: re.sub(r"\d", "0", t)
    for p, (once, n), (twice, m) in zip(PHONES, out, out[len(PHONES):]):
        made = re.fullmatch(r"call (.*), or x", once)[1]
        assert (n, m) == (1, 2) and spelt(made) == spelt(p) and made != p and twice == f"({made}) and {made}"
        assert not p.startswith("+") or made[:2] == p[:2]
    # However it is grouped, with or without North America's code, it is one entity.
    assert len({re.sub(r"\D", "", t[5:-6])[-10:] for t, _ in out[:12]}) == 1
    assert out[12][0][:8] == "call +49" and out[19][0][:9] == "call +353" and re.sub(r"\D", "", out[12][0]) == re.sub(r"\D", "", out[13][0])


def test_phones_are_those_of_redaction(spark):
    rng = random.Random(2)
    shapes = [f"{c}{o}974{e}{a}555{b}3436" for c in ("", "1-", "+1 ", "1.") for o in ("", "(") for e in ("", ")") for a in "-. " for b in "-. "]
    texts = [re.sub(r"(974|555|3436)", lambda m: "".join(rng.choice("0123456789") for _ in m[0]), s) for s in shapes]
    docs = spark.createDataFrame([(f"x {t} y",) for t in texts], "text string")
    assert docs.filter(text.hits(docs["text"], "PHONE") != 1).count() == 0
    assert surrogates.replaced(docs, "k").filter("n_entities != 1").count() == 0


def test_persons(spark):
    [(a, n), (b, _)] = rewritten(spark, ["Mr. Smith and John Smith met Mrs. Mary Jones; Мария Иванова. Frau Greta Müller", "Mary Smith, Ms Jones"])
    found = re.fullmatch(r"Mr\. (\w+) and (\w+) (\w+) met Mrs\. (\w+) (\w+); (\w+) (\w+)\. Frau (\w+) (\w+)", a)
    assert n == 5 and found[1] == found[3] not in ("Smith", found[5])
    assert found[2] in set(surrogates.GIVEN["m"]["Latin"]) - {"John"} and found[4] in set(surrogates.GIVEN["f"]["Latin"]) - {"Mary"}
    assert found[6] in set(surrogates.GIVEN["f"]["Cyrillic"]) - {"Мария"} and re.fullmatch("[А-Я][а-я]+", found[7])
    assert b == f"{found[4]} {found[1]}, Ms {found[5]}"


def name(k, end):
    return "Q" + "".join(chr(97 + k // 26 ** j % 26) for j in range(3)) + end


def persons_stay_distinct(spark):
    names = [f"{t} {name(k, 'u')}" for k in range(120) for t in ("Mr.", "Mrs.")] + [f"Mr. {n}" for n in surrogates.GIVEN["m"]["Latin"]]
    out = [t for t, _ in rewritten(spark, [f"{n} Khan met {n} Khan" for n in names] + ["Mr. Khan", "Господин Khan"])]
    pairs = [t.split(" met ") for t in out[:-2]]
    assert all(a == b and "Khan" not in a for a, b in pairs) and len({a for a, _ in pairs}) == len(names)
    assert len({t.split(" ")[-1] for t in out}) == 1
    assert all(a.split(" ")[0] == n.split(" ")[0] for (a, _), n in zip(pairs, names))


def test_given_names_stay_distinct(spark):
    persons_stay_distinct(spark)


def test_given_names_that_meet_are_drawn_anew(spark, monkeypatch):
    draw = surrogates._draw
    monkeypatch.setattr(surrogates, "_draw", lambda seed, *more: draw(seed, *more) % 4)
    persons_stay_distinct(spark)


def test_what_is_no_entity_stays(spark):
    texts = [None, "", "12345678901234567 1.2.3.4.5 999.1.1.1 a@b +1 974 12-34 deadbeef Maria sang", "x@y@z"]
    assert rewritten(spark, texts) == [(t, 0) for t in texts]


def test_another_key_gives_other_surrogates(spark):
    text = ["une.92@mail6.example.com 9807915762804490"]
    assert rewritten(spark, text) == rewritten(spark, text) != rewritten(spark, text, "other")


def test_collisions_are_resolved(spark, monkeypatch):
    """With draws of 0 to 3 many short surrogates meet."""
    draw = surrogates._draw
    monkeypatch.setattr(surrogates, "_draw", lambda seed, *more: draw(seed, *more) % 4)
    texts = [f"a{x}@b.io and a{x}@b.io, b{x}@b.io again" for x in "cdefg"]
    out = [re.fullmatch(r"(\S+) and (\S+), (\S+) again", t) for t, _ in rewritten(spark, texts)]
    assert all(m[1] == m[2] for m in out)
    made = [m[k] for m in out for k in (1, 3)]
    assert len(set(made)) == len(made)
    assert not {f"{a}{x}@b.io" for a in "ab" for x in "cdefg"} & set(made)


def test_a_format_without_free_surrogates_grows(spark, monkeypatch):
    monkeypatch.setattr(surrogates, "LONGER", 1)
    draw = surrogates._draw
    monkeypatch.setattr(surrogates, "_draw", lambda seed, *more: draw(seed, *more) % 1)
    out = [t for t, _ in rewritten(spark, ["a@b.io", "b@b.io", "c@b.io"])]
    assert len(set(out)) == 3 and not {"a@b.io", "b@b.io", "c@b.io"} & set(out)


def test_query(spark):
    before = {r.doc_id: r.text for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    after = {r.doc_id: r for r in registry.op4_surrogates(spark, MIDDLE).collect()}
    assert before.keys() == after.keys()
    made, total = defaultdict(set), 0
    for i, text in before.items():
        new = after[i].text
        for kind, pattern in KINDS.items():
            old = re.findall(pattern, text)
            total += len(old)
            assert not set(old) & set(re.findall(pattern, new))
            if kind != "email":
                assert len(re.findall(pattern, new)) == len(old)
        if not any(re.search(p, text) for p in KINDS.values()):
            assert new == text and after[i].n_entities == 0
        spots = re.compile(surrogates.EMAIL + "|" + surrogates.PHONE + "|" + surrogates.CARD)
        for a, b in zip(spots.findall(text), spots.findall(new)):
            made[a.lower()].add(b.lower())
    assert total > 50 and all(len(v) == 1 for v in made.values())
    assert len({next(iter(v)) for v in made.values()}) == len(made)


def test_no_python_in_the_plan(spark):
    plan = registry.op4_surrogates(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_awkward(spark):
    docs = awkward(spark)
    out = surrogates.replaced(docs, "k")
    assert others_kept(docs, out) and out.filter("n_entities > 0").count() == 0
    assert surrogates.replaced(nothing(spark), "k").collect() == []
    many = surrogates.replaced(docs.withColumn("text", F.repeat(F.lit("call +1 (974) 555-3436 "), 500)), "k").select("text", "n_entities").distinct().collect()
    assert len(many) == 1 and many[0].n_entities == 500
