"""Redaction and extraction on free text of any length, and model plug-ins."""

from __future__ import annotations

from collections.abc import Callable, Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -----------------------------------------------------------
# Kinds of personal data, masked in this order.  An address in free text has
# short streets and cities, so that it does not reach back over whole sentences.
PERSONAL_DATA = {
    "ADDRESS": r"[0-9]{1,6} [A-Za-z0-9.#-]+( [A-Za-z0-9.#-]+){0,4}(, (Apt|Unit|Suite|Ste)[.]? [A-Za-z0-9-]+)?, "
               r"[A-Za-z.]+( [A-Za-z.]+){0,2} [A-Z]{2} [0-9]{5}(-[0-9]{4})?",
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+([.][A-Za-z0-9-]+)+",
    "IP": r"(?<![0-9.])[0-9]{1,3}([.][0-9]{1,3}){3}(?![0-9])(?![.][0-9])",
    "CARD": r"(?<![0-9])[0-9]{4}([ -]?[0-9]{4}){3}(?![0-9])",
    "PHONE": r"(?<![0-9])([+]?1[-. ])?[(]?[0-9]{3}[)]?[-. ][0-9]{3}[-. ][0-9]{4}(?![0-9])",
}
PAGE_FIELDS = {
    "lang": ("html", r'<html lang="([a-z]+)"'),
    "title": ("html", r"<title>([^<]*)</title>"),
    "host": ("url", r"^https?://([^/:?#]+)"),
}
# A text without this character cannot hold an e-mail address.
EMAIL_MARK = "@"
# -----------------------------------------------------------------------------


def redact(text: Column, kinds: Mapping[str, str] = PERSONAL_DATA) -> Column:
    """The whole text with every hit replaced by ``[KIND]``."""
    for kind, pattern in kinds.items():
        masked = F.regexp_replace(text, pattern, f"[{kind}]")
        # The e-mail pattern rescans long words from every letter; most texts
        # can skip it after one cheap search.
        text = F.when(text.contains(EMAIL_MARK), masked).otherwise(text) if kind == "EMAIL" else masked
    return text


def hits(text: Column, kind: str) -> Column:
    """How often one kind of personal data occurs; NULL counts as none."""
    found = F.regexp_count(text, F.lit(PERSONAL_DATA[kind]))
    if kind == "EMAIL":
        found = F.when(text.contains(EMAIL_MARK), found)
    return F.coalesce(found, F.lit(0))


def extract_fields(fields: Mapping[str, tuple[str, str]]) -> list[Column]:
    """One column per field, from (source column, pattern with one group); a
    field that is not found is NULL."""
    return [F.nullif(F.regexp_extract(source, pattern, 1), F.lit("")).alias(name)
            for name, (source, pattern) in fields.items()]


def prompt(template: str, *args: Column) -> Column:
    """``{0}``, ``{1}`` … filled in row by row, as input for a batch model."""
    pieces: list[Column] = []
    rest = template
    for i, arg in enumerate(args):
        before, _, rest = rest.partition("{%d}" % i)
        pieces += [F.lit(before), arg]
    return F.concat(*pieces, F.lit(rest))


def batch_model(predict: Callable, returns: str) -> Callable[..., Column]:
    """A model as a column function.  ``predict`` takes and returns pandas
    series; Spark hands it Arrow batches in every task, so it scales with the
    partitions.  It can stand in wherever a rule is used."""
    def evaluate(values: pd.Series) -> pd.Series:
        return predict(values)

    return F.pandas_udf(evaluate, returns)
