"""Quality rules as a short-circuit cascade.

Each rule is a condition on the text that rejects a document.  On a sample of
bounded expected size, drawn from the whole table, the seconds that a rule takes and
the share of documents that it rejects are measured; rules then run in the order of rejections per second, and a
document rejected by one rule is not looked at by the later ones (a CASE
expression evaluates its branches in turn).  The order decides only the cost: a
document is kept if no rule rejects it.

Everything is a built-in expression of one row: no shuffle, no Python.  Null text
counts as one without words, which the base rules reject.  Extra columns are
kept; the columns added here replace columns of the same name.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.columns import aside
from plumbline.session import written

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "base_failed")
SEED = 17                   # of the sample
LEAST_SECONDS = 1e-3        # what a rule that costs nothing measurable is counted as
SPACE = "[\\x20\\x09-\\x0D]+"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def repeated_words(tokens: Column, window: int = 3) -> Column:
    """How many words lie in a window of words that occurs at least twice in the text.

    Windows are known by 64-bit hashes.  Without a repeated one there is nothing
    to do; otherwise (hash, position) pairs are sorted and equal neighbours give
    the positions.
    """
    def counted(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - window)
        hashes = F.transform(starts, lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(window))))
        return _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(_let(
            F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
            lambda s: F.size(F.array_distinct(F.flatten(F.transform(
                F.flatten(F.filter(F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: F.when(
                    a["h"] == b["h"], F.array(a["i"], b["i"]))), lambda pair: pair.isNotNull())),
                lambda i: F.array(*(i + k for k in range(window)))))))))
        )
    return F.when(F.size(tokens) > window, _let(tokens, counted)).otherwise(0)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines and base_failed."""
    away, back = aside(docs, *MEASURES)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: F.translate(line, " \t\n\x0b\f\r", "") != "")
    found = docs.select(
        *away, _let(words(F.col(f"`{text}`")), lambda w: F.struct(
            F.size(w).cast("long").alias("n"), repeated_words(w).cast("long").alias("r"))).alias("_words"),
        _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                       (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d"))).alias("_lines"),
        F.length(F.translate(body, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, "#*$%&|<>", ""))).cast("long").alias("n_symbols"))
    n, repeated = F.col("_words.n"), F.col("_words.r")
    return found.select(*back, n.alias("n_words"), "word_chars", "n_symbols", F.col("_lines.d").alias("n_dup_lines"),
                        repeated.alias("n_repeat_words"), F.col("_lines.n").alias("n_lines"),
                        ((n < 50) | (100 * repeated > 50 * n)).alias("base_failed"))


@dataclass(frozen=True)
class Rule:
    """Rejects a document when the condition (a SQL expression that is never null) holds."""

    name: str
    rejects: str


# Thresholds are wide: they are meant for text that is no prose at all.
RULES = (
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    Rule("symbols", "n_symbols > n_words"),
    Rule("duplicate_lines", "2 * n_dup_lines > n_lines"),
    Rule("capitals", r"2 * regexp_count(coalesce({text}, ''), '\\p{Lu}') > word_chars"),
    Rule("letters", r"3 * regexp_count(coalesce({text}, ''), '[^\\x20\\x09-\\x0D]*\\p{L}[^\\x20\\x09-\\x0D]*') < n_words"),
)


def _condition(rule: Rule, text: str) -> Column:
    return F.expr(rule.rejects.replace("{text}", f"`{text}`"))


def _seconds(rows: DataFrame, *work: Column) -> tuple[float, tuple]:
    """The better of two timings of one aggregate, and its values."""
    times = []
    for _ in range(2):
        start = time.perf_counter()
        values = rows.agg(*work).first()
        times.append(time.perf_counter() - start)
    return min(times), values


def cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text",
            sample_rows: int = 1000, repeats: int = 20) -> list[tuple[Rule, float, float]]:
    """(rule, seconds for the sample, share rejected), best first: the order by rejections per second.

    The sample is spread over the whole table, whole texts of any length, with
    ``sample_rows`` expected; it is written once and serves this estimate only.
    A rule is evaluated ``repeats`` times for each sampled text, and the time of
    the same job without a rule is subtracted, so that what is left is the rule's
    own work and not that of starting a job.
    """
    only = docs.select(F.col(f"`{text}`").cast("string").alias(text))
    sample = written(measures(only.sample(min(1.0, sample_rows / max(1, only.count())), SEED), text), "quality-sample")
    again = sample.withColumn("_again", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    read = F.sum(F.octet_length(F.col(f"`{text}`")))  # every job reads the texts
    bare, _ = _seconds(again, read, F.count("*"))
    found = []
    for rule in rules:
        taken, values = _seconds(again, read, F.avg(_condition(rule, text).cast("double")))
        found.append((rule, max(taken - bare, LEAST_SECONDS) / repeats, values[1] or 0.0))
    return sorted(found, key=lambda x: (-x[2] / x[1], x[1]))


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample_rows: int = 1000) -> DataFrame:
    """Adds the measures, ``kept``, and ``rejected_by``: the first rule of the cascade that rejects, null if none does.

    The base rules come first, being settled by the measures alone.
    """
    docs = docs.drop("rejected_by", "kept")
    verdict = F.when(F.col("base_failed"), "base")
    for rule, _, _ in cascade(docs, rules, text, sample_rows):
        verdict = verdict.when(_condition(rule, text), rule.name)
    return measures(docs, text).withColumn("rejected_by", verdict).withColumn("kept", F.col("rejected_by").isNull())
