"""Extraction, classification and redaction of postal addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -----------------------------------------------------------
# Number and street (with a unit, if any), city, state, ZIP or ZIP+4.
ADDRESS_BODY = (r"([0-9]+ [A-Za-z0-9][A-Za-z0-9 .#-]*(?:, (?:Apt|Unit|Suite|Ste)[.]? [A-Za-z0-9-]+)?), ([A-Za-z][A-Za-z .]*) ([A-Z]{2}) "
                r"([0-9]{5}(?:-[0-9]{4})?)")
ADDRESS = f"^{ADDRESS_BODY}$"
# The fields of an extracted address.
ADDRESS_FIELDS = ("street", "city", "state", "zip_code")
STATES = (
    "AL AK AZ AR CA CO CT DE DC FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS "
    "MO MT NE NV NH NJ NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY"
).split()
# -----------------------------------------------------------------------------


# Control characters cannot be part of a matched address.
_SEPARATOR = "\x01"


def address_parts(address: Column) -> Column:
    """The four parts as an array, NULL unless the whole address matches.

    One replacement finds all parts in a single match; as it always adds
    separators, an unchanged text is one that did not match.  Plans that need
    several results per address compute this column first and hand it on.
    """
    marked = F.regexp_replace(address, ADDRESS, _SEPARATOR.join(f"${i + 1}" for i in range(len(ADDRESS_FIELDS))))
    return F.split(F.nullif(marked, address), _SEPARATOR)


def extract_address(address: Column, parts: Column | None = None) -> Column:
    """A struct with one field per part; a part that is not found is NULL."""
    parts = address_parts(address) if parts is None else parts
    return F.struct(*[F.get(parts, F.lit(i)).alias(field) for i, field in enumerate(ADDRESS_FIELDS)])


def is_us_address(address: Column) -> Column:
    """Well formed and in a known state; NULL for NULL."""
    known = F.split(F.lit(" ".join(STATES)), " ")
    return F.array_contains(known, F.regexp_extract(address, ADDRESS, 3))


def redact_address(address: Column, parts: Column | None = None) -> Column:
    """Street and zip code masked, city and state kept; an address that cannot
    be taken apart is masked as a whole."""
    parts = address_parts(address) if parts is None else parts
    masked = F.concat(F.lit("[STREET], "), F.get(parts, F.lit(1)), F.lit(" "), F.get(parts, F.lit(2)), F.lit(" [ZIP]"))
    return F.coalesce(masked, F.when(address.isNotNull(), F.lit("[ADDRESS]")))
