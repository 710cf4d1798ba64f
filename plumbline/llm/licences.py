"""Licence scans by canonical digest lookup.

A text is brought to a canonical form in which differences that do not change a
licence vanish: case, copyright lines, punctuation and layout, and spellings that
count as equivalent.  A line that begins with "copyright" stays if licence wording
follows ("copyright holders", also on the next line), so that wrapping does not
change a licence.  Its SHA-256 is joined to the digests of known licences, so
an entire text either is one of them or is not.

Null texts have no digest and match nothing; texts that are empty in canonical
form have the digest of the empty text and match nothing.  Equal rows get equal
answers.  If several known names share a canonical text, the first name in
alphabetical order is given, so a document stays one row.  Extra columns are
kept; ``licence_digest`` and ``licence_id`` replace columns of the same name.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.columns import aside
from plumbline.llm.licence_texts import KNOWN

# What follows "copyright" within a licence, on whatever line it comes to stand.
WORDING = ("holders?|owners?|notices?|laws?|licen[sc]e[sd]?|statements?|permissions?|interests?|treaty|treaties|disclaimers?|"
           "protections?|and|or|in|on")
#: Lines that name a holder: they differ from copy to copy.
COPYRIGHT_LINE = (rf"(?m)^[^a-z0-9\n]*(copyright(?![a-z])(?![^a-z0-9©]*(?:{WORDING})(?![a-z]))|\(c\)|©|all rights reserved)[^\n]*$")
# Spellings that count as equivalent.
SPELLINGS = (
    ("licence", "license"), ("favour", "favor"), ("behaviour", "behavior"), ("organisation", "organization"),
    ("recognise", "recognize"), ("authorisation", "authorization"), ("acknowledgement", "acknowledgment"),
    ("fulfil ", "fulfill "), ("per cent", "percent"), ("non commercial", "noncommercial"), ("sub license", "sublicense"),
    ("copyright owner", "copyright holder"), ("https", "http"),
)


def canonical(text: Column) -> Column:
    """Lower case, without copyright lines, letters and digits only, one space between words, one spelling."""
    # "d": only a line feed ends a line, as elsewhere.
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE.replace("(?m)", "(?md)"), "")
    out = F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " "))
    for other, usual in SPELLINGS:
        out = F.replace(out, F.lit(other), F.lit(usual))
    return out


def canonical_text(text: str) -> str:
    """The same for one text on the driver: used for the few known licences only."""
    out = re.sub(COPYRIGHT_LINE, "", text.lower())
    out = re.sub(r"[\W_]+", " ", out).strip(" ")
    for other, usual in SPELLINGS:
        out = out.replace(other, usual)
    return out


def digests(known: dict[str, str] = KNOWN) -> dict[str, str]:
    """Digest to name."""
    found: dict[str, str] = {}
    for name in sorted(known):
        if form := canonical_text(known[name]):
            found.setdefault(hashlib.sha256(form.encode()).hexdigest(), name)
    return found


def scanned(docs: DataFrame, known: dict[str, str] = KNOWN, text: str = "text") -> DataFrame:
    """Adds licence_digest and licence_id (null: not a known licence)."""
    listed = docs.sparkSession.createDataFrame(sorted(digests(known).items()) or [], "_digest string, licence_id string")
    away, back = aside(docs, "licence_digest", "licence_id")
    hashed = docs.select(*away, F.sha2(canonical(F.col(f"`{text}`")).cast("binary"), 256).alias("licence_digest"))
    # The known texts are a list in code: a few dozen digests, whatever the table.
    return hashed.join(F.broadcast(listed), F.col("licence_digest") == F.col("_digest"), "left") \
        .select(*back, "licence_digest", "licence_id")
