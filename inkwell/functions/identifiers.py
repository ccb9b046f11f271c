"""Serial numbers of journals, and hashes of records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell.functions.text import clean


def issn(value: Column) -> Column:
    """XXXX-XXXX from any spelling with eight digits or X; else null."""
    signs = F.regexp_replace(F.upper(value), "[^0-9X]", "")
    return F.when(F.length(signs) == 8, F.concat_ws("-", F.substring(signs, 1, 4), F.substring(signs, 5, 4)))


def issn_valid(value: Column) -> Column:
    """Whether the check digit is right, modulo 11 with weights 8 to 2; false for null and for other forms."""
    s = F.upper(F.trim(F.replace(value, F.lit("-"), F.lit(""))))
    digit = lambda k: F.substring(s, k, 1).cast("int")
    total = sum((digit(k) * (9 - k) for k in range(2, 8)), digit(1) * 8)
    check = F.when(F.substring(s, 8, 1) == "X", 10).otherwise(F.substring(F.translate(s, "X", "0"), 8, 1).cast("int"))
    return F.coalesce(F.when(s.rlike("^[0-9]{7}[0-9X]$"), (total + check) % 11 == 0).otherwise(False), F.lit(False))


def issn_canonical(printed: Column, electronic: Column, linking: Column | None = None) -> Column:
    return F.coalesce(*(issn(c) for c in (linking, printed, electronic) if c is not None))


def issn_find(value: Column) -> Column:
    """The first serial number anywhere in a text."""
    t, pattern = clean(value), r"([0-9]{4})-?([0-9]{3}[0-9Xx])"
    a = F.regexp_extract(t, pattern, 1)
    return F.when(a != "", F.concat_ws("-", a, F.upper(F.regexp_extract(t, pattern, 2))))


def issn_list(value: Column) -> tuple[Column, Column]:
    """Of a comma-separated list the first valid number (print) and the second (electronic)."""
    found = F.filter(F.transform(F.split(value, ","), issn), lambda x: x.isNotNull())
    return F.get(found, F.lit(0)), F.get(found, F.lit(1))


def record_hash(*columns: Column) -> Column:
    """Sixteen hex digits of SHA-256 over the values joined by |; a null is an empty value."""
    return F.substring(F.sha2(F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns)), 256), 1, 16)
