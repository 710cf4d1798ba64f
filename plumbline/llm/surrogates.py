r"""Surrogate generation for personal data and secrets.

Found in a text are e-mail addresses, IPv4 addresses, phone numbers (9 to 15
digits with "+" and a country code, or ten grouped ones as in North America, which
are the same with and without its code), card numbers, long hexadecimal tokens, and persons (a title or a
known given name before a family name).  Each is replaced by a made-up one of the
same kind, derived from a secret key and the entity alone:

* The same entity gets the same surrogate everywhere (coreference).  Case of an
  address and grouping of digits do not make a different entity; they are kept in
  the surrogate: digits become digits, letters become letters of the same case,
  separators, country code and top-level domain stay.
* A given name becomes another one of the same gender and script, by a keyed
  permutation of the known names, and one that is not known a made-up one; a family
  name becomes a made-up one of the same script; a title stays, and "Mr. X" and
  "John X" stay one family.
* Different entities get different surrogates, none of which is itself an entity
  of the documents.  All different entities with their surrogates are checked,
  unknown given names by gender like entities of their own;
  where two meet, all but the first one count their attempt up until none do.
  Addresses and names grow longer where their format has no surrogate left.
  Nearly always there is nothing to do, and documents are rewritten in one pass;
  otherwise only the documents concerned get the attempts joined to them.

Everything is built-in expressions of the row and one aggregate over the different
entities; text is never shuffled unless a collision occurred.  Null texts stay
null, empty ones empty, and texts without an entity stay as they are.  Repeated
rows are rewritten alike.  An empty table gives no rows.  Extra columns are kept;
``n_entities`` replaces a column of that name.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.columns import aside
from plumbline.session import written

# Titles by gender, given names by gender and script.
TITLES = {"m": ("Mr", "Herr", "Monsieur", "Señor", "Господин"),
          "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Госпожа")}
GIVEN = {
    "m": {"Latin": ("John", "James", "Robert", "Michael", "William", "David", "Thomas", "Charles", "Peter", "Paul", "Hans", "Karl",
                    "Pierre", "Jean", "Carlos", "Miguel"),
          "Cyrillic": ("Иван", "Пётр", "Сергей", "Алексей", "Дмитрий", "Николай")},
    "f": {"Latin": ("Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Barbara", "Susan", "Sarah", "Julia", "Emma", "Greta",
                    "Claire", "Marie", "Sophie", "Carmen", "Lucia"),
          "Cyrillic": ("Мария", "Анна", "Ольга", "Елена", "Наталья", "Ирина")},
}
# Syllables of made-up family names.
SYLLABLES = {"Latin": ("ba", "be", "da", "do", "fe", "ga", "ha", "ka", "la", "lo", "ma", "mi", "na", "ra", "so", "ta"),
             "Cyrillic": ("ба", "ве", "га", "да", "зо", "ка", "ла", "ми", "на", "ро", "са", "та", "фе", "ха", "ша", "ле")}

# Endings of made-up given names.
ENDINGS = {"m": {"Latin": "n", "Cyrillic": "н"}, "f": {"Latin": "lia", "Cyrillic": "лия"}}

LONGER, MOST = 8, 64    # attempts from which surrogates grow, and at which it is an error

_NAME = r"\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?"
_GIVEN = "|".join(sorted(n for by in GIVEN.values() for names in by.values() for n in names))
_TITLE = "(?:" + "|".join(sorted(t for ts in TITLES.values() for t in ts)) + r")\.?"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IP = r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?![0-9])(?!\.[0-9])"
# Ten digits of the North American plan, with or without country code, and numbers of 9 to 15 digits with a country code.
_LOCAL = r"(?:\+?1[-. ]?)?(?:\([0-9]{3}\)[-. ]?|\(?[0-9]{3}\)?[-. ])[0-9]{3}[-. ][0-9]{4}"
PHONE = (r"\+[0-9]{1,3}[ .-]?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{4}(?![0-9])"
         rf"|(?<![0-9]){_LOCAL}(?![0-9])|(?<![0-9])\+[0-9](?:[ .-]?\(?[0-9]\)?){{8,14}}(?![0-9])")
# Country codes have one to three digits and none begins another; "1" may come without "+".
_COUNTRY = (r"^(?:\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
            r"|1(?=[^0-9]*(?:[0-9][^0-9]*){10}$))")
CARD = r"(?<![0-9A-Za-z])[0-9]{4}(?:[ -]?[0-9]{4}){3}(?![0-9A-Za-z])"
TOKEN = r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![0-9A-Za-z])"
PERSON = rf"(?<!\p{{L}})(?:{_TITLE} (?:{_NAME} )?{_NAME}|(?:{_GIVEN}) {_NAME})(?!\p{{L}})"
ENTITY = "|".join((EMAIL, IP, PHONE, CARD, TOKEN, PERSON))
_PARTS = rf"^({_TITLE} )?(?:({_NAME}) )?({_NAME})$"


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def kind_of(entity: Column) -> Column:
    return (F.when(F.contains(entity, F.lit("@")), "email").when(entity.startswith("+") | entity.rlike(f"^{_LOCAL}$"), "phone")
            .when(entity.rlike(r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$"), "ip").when(entity.rlike("^[0-9A-Fa-f]{32,64}$"), "token")
            .when(entity.rlike("^[0-9 -]+$"), "card").otherwise("name"))


def norm_of(entity: Column, kind: Column) -> Column:
    """What makes it the same entity: the family name of a person, the address without case, digits without grouping."""
    digits = F.regexp_replace(entity, "[^0-9]", "")
    return (F.when(kind == "name", F.regexp_extract(entity, _PARTS, 3)).when(kind.isin("email", "ip"), F.lower(entity))
            .when((kind == "phone") & ~entity.startswith("+"), F.concat(F.lit("+1"), F.right(digits, F.lit(10))))
            .otherwise(F.lower(F.regexp_replace(entity, "[^0-9A-Za-z+]", ""))))


def _draw(seed: Column, *more) -> Column:
    """A number below 2 ** 32 from the keyed digest."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", seed, *(m.cast("string") if isinstance(m, Column) else F.lit(m) for m in more)), 256), 1, 8), 16, 10).cast("long")


def _respelled(body: Column, seed: Column, letters: int) -> Column:
    """Digits for digits, letters for letters; the k-th letter or digit depends on the seed and k, not on separators."""
    def one(i: Column) -> Column:
        c = F.substr(body, i, F.lit(1))
        k = F.length(F.regexp_replace(F.substr(body, F.lit(1), i), "[^0-9A-Za-z]", ""))
        letter = F.substr(F.lit("abcdefghijklmnopqrstuvwxyz"), (_draw(seed, k) % letters + 1).cast("int"), F.lit(1))
        return (F.when(c.rlike("[0-9]"), (_draw(seed, k) % 10).cast("string"))
                .when(c.rlike("[A-Z]"), F.upper(letter)).when(c.rlike("[a-z]"), letter).otherwise(c))
    return F.when(F.length(body) > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.length(body)), one), "")).otherwise("")


def _made_up(seed: Column, script: str, syllables: int = 5) -> Column:
    parts = F.array(*(F.lit(s) for s in SYLLABLES[script]))
    return F.initcap(F.concat(*(F.get(parts, (_draw(seed, k) % len(SYLLABLES[script])).cast("int")) for k in range(syllables))))


def _longer(attempt: Column) -> Column:
    return F.when(attempt >= LONGER, F.repeat(F.lit("o"), attempt - LONGER + 1)).otherwise("")


def _given(key: str) -> Column:
    """Known given name to the next one in a keyed order of its gender and script."""
    pairs = []
    for by_script in GIVEN.values():
        for names in by_script.values():
            order = sorted(names, key=lambda n: hashlib.sha256(f"{key}|{n}".encode()).digest())
            pairs += list(zip(order, order[1:] + order[:1]))
    return F.create_map(*(F.lit(x) for pair in pairs for x in pair))


def given_kind(entity: Column) -> Column:
    """Kind of a person's given name if it is not known, otherwise null."""
    given = F.regexp_extract(entity, _PARTS, 2)
    known = [n for by in GIVEN.values() for names in by.values() for n in names]
    female = F.regexp_replace(F.regexp_extract(entity, _PARTS, 1), r"[. ]", "").isin(*TITLES["f"])
    return F.when((given != "") & ~given.isin(*known), F.when(female, "given f").otherwise("given m"))


def given_surrogate(given: Column, kind: Column, attempt: Column, key: str) -> Column:
    """A made-up given name; with its ending it is none of the known ones."""
    seed = F.concat_ws("|", F.lit(key), kind, attempt.cast("string"), given)

    def drawn(script: str) -> Column:
        return F.concat(_made_up(seed, script, 4), F.when(kind == "given f", ENDINGS["f"][script]).otherwise(ENDINGS["m"][script]))

    return F.concat(F.when(given.rlike(r"\p{IsCyrillic}"), drawn("Cyrillic")).otherwise(drawn("Latin")), _longer(attempt))


def _person(entity: Column, seed: Column, attempt: Column, given_attempt: Column, key: str) -> Column:
    title, given, own = (F.regexp_extract(entity, _PARTS, k) for k in (1, 2, 3))
    first = F.coalesce(F.try_element_at(_given(key), given), given_surrogate(given, given_kind(entity), given_attempt, key))
    # By the script of the name itself: a title of another script makes no other family.
    family = F.when(own.rlike(r"\p{IsCyrillic}"), _made_up(seed, "Cyrillic")).otherwise(_made_up(seed, "Latin"))
    return F.concat(title, F.when(given != "", F.concat(first, F.lit(" "))).otherwise(""), family, _longer(attempt))


def surrogate(entity: Column, kind: Column, norm: Column, attempt: Column, given_attempt: Column, key: str) -> Column:
    seed = F.concat_ws("|", F.lit(key), kind, attempt.cast("string"), norm)
    host = F.regexp_extract(entity, r"^(.*)(\.[A-Za-z]+)$", 1)
    octets = [(_draw(seed, k) % (256 if k else 223) + (0 if k else 1)).cast("string") for k in range(4)]
    # Where a format leaves too few surrogates, late attempts may be longer.
    longer = F.when(attempt >= LONGER, F.concat(F.lit("x"), attempt.cast("string"))).otherwise("")
    return (F.when(kind == "email", F.concat(longer, _respelled(host, seed, 26), F.regexp_extract(entity, r"(\.[A-Za-z]+)$", 1)))
            .when(kind == "ip", F.concat_ws(".", *octets))
            .when(kind == "phone", F.concat(F.regexp_extract(entity, _COUNTRY, 0), _respelled(F.regexp_replace(entity, _COUNTRY, ""), seed, 26)))
            .when(kind == "token", _respelled(entity, seed, 6)).when(kind == "card", _respelled(entity, seed, 26))
            .otherwise(_person(entity, seed, attempt, given_attempt, key)))


def _found(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))


def _keys(entities: DataFrame, *kept: str) -> DataFrame:
    """Different (kind, norm) of a column of entities; a person with an unknown given name has two."""
    entity, kind = F.col("entity"), F.col("kind")
    own = F.struct(kind.alias("kind"), norm_of(entity, kind).alias("norm"))
    given = F.when(kind == "name", F.struct(given_kind(entity).alias("kind"), F.regexp_extract(entity, _PARTS, 2).alias("norm")))
    one = entities.withColumn("kind", kind_of(entity)).select(*kept, F.explode(F.array(own, given)).alias("k"))
    return one.select(*kept, "k.kind", "k.norm").filter("kind is not null").distinct()


def inventory(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every different entity, and every unknown given name, as (kind, norm)."""
    return _keys(docs.select(F.explode(F.array_distinct(_found(F.col(f"`{text}`")))).alias("entity")))


def _named(known: DataFrame, key: str) -> DataFrame:
    kind, norm, attempt = F.col("kind"), F.col("norm"), F.col("attempt")
    made = norm_of(surrogate(norm, kind, norm, attempt, F.lit(0), key), kind)
    return known.withColumn("made", F.when(kind.startswith("given "), given_surrogate(norm, kind, attempt, key)).otherwise(made))


def attempts(docs: DataFrame, key: str, text: str = "text") -> DataFrame | None:
    """(kind, norm, attempt) of the entities whose first surrogate met another one; None if there are none."""
    known = written(_named(inventory(docs, text).withColumn("attempt", F.lit(0)), key), "surrogates")
    clashed = False
    for _ in range(MOST):
        first = known.groupBy("kind", "made").agg(F.min("norm").alias("keeps"), F.count("*").alias("n")).filter("n > 1").drop("n")
        taken = known.select("kind", F.col("norm").alias("made"))
        late = known.join(first, ["kind", "made"]).filter("norm != keeps").select("kind", "norm") \
            .unionByName(known.join(taken, ["kind", "made"], "left_semi").select("kind", "norm")).distinct()
        late = written(late, "surrogate-clashes")
        if late.isEmpty():
            return known.filter("attempt > 0").select("kind", "norm", "attempt") if clashed else None
        clashed = True
        again = known.join(late.withColumn("late", F.lit(1)), ["kind", "norm"], "left").select(
            "kind", "norm", (F.col("attempt") + F.coalesce("late", F.lit(0))).alias("attempt"))
        known = written(_named(again, key), "surrogates")
    raise RuntimeError(f"after {MOST} attempts some entities have no surrogate of their own")


def replaced(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with surrogates in the text, and ``n_entities``, the number of replaced places."""
    away, _ = aside(docs, "n_entities")
    kept = [c for c in docs.columns if c != "n_entities"]
    body = F.col(f"`{text}`")
    late = attempts(docs, key, text)
    rows = docs.select(*away, body.alias("_text"))
    if late is None:
        tried = lambda kind, norm: F.lit(0)
    else:
        rows = rows.withColumn("_key", F.xxhash64("*"))
        one = rows.select("_key", F.explode(F.array_distinct(_found(F.col("_text")))).alias("entity"))
        one = _keys(one, "_key").join(late, ["kind", "norm"])
        concerned = one.groupBy(F.col("_key").alias("_of")).agg(F.map_from_entries(F.collect_list(
            F.struct(F.concat_ws("|", "kind", "norm"), "attempt"))).alias("_tried"))
        rows = rows.join(concerned, F.col("_key") == F.col("_of"), "left")
        tried = lambda kind, norm: F.coalesce(F.try_element_at(F.col("_tried"), F.concat_ws("|", kind, norm)), F.lit(0))

    def made(entity: Column) -> Column:
        return _let(kind_of(entity), lambda kind: _let(norm_of(entity, kind), lambda norm: surrogate(
            entity, kind, norm, tried(kind, norm), tried(given_kind(entity), F.regexp_extract(entity, _PARTS, 2)), key)))

    rows = rows.withColumn("_found", _found(F.col("_text")))
    gaps = F.split(F.col("_text"), ENTITY, -1)
    whole = F.array_join(F.zip_with(gaps, F.transform("_found", made), lambda gap, entity: F.concat(gap, F.coalesce(entity, F.lit("")))), "")
    done = F.when(F.size("_found") > 0, whole).otherwise(F.col("_text"))
    return rows.select(*(done.alias(c) if c == text else F.col(f"_c{i}").alias(c) for i, c in enumerate(kept)),
                       F.greatest(F.size("_found"), F.lit(0)).cast("long").alias("n_entities"))
