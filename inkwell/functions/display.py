"""Values as a reader sees them; the stored ones stay as they are."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell.constants import WEEKS_PER_MONTH
from inkwell.functions.lookup import lookup

#: The mark of an unknown value, a fee of none, the weeks from which months are shown, names of origins.
UNKNOWN, NO_FEE, MONTHS_FROM = "N/D", "Sin costo", 8.7
ORIGINS = {"etl": "Publindex / ETL", "lider": "Directorio LIDER", "manual": "Agregada manualmente"}


def _or_unknown(value: Column, shown: Column) -> Column:
    return F.when(value.isNull(), UNKNOWN).otherwise(shown)


def fee(usd: Column, status: Column, text: Column) -> Column:
    """Whole dollars with points between thousands; without an amount the source's text, if it is more than a currency."""
    grouped = F.translate(F.format_number(F.floor(usd + 0.5), 0), ",", ".")
    said = F.when((text != "") & ~text.rlike(r"(?i)^~?\s*usd\s*$"), text)
    return F.when(status == "sin_costo", NO_FEE).when(usd.isNotNull(), F.concat(F.lit("USD "), grouped)).otherwise(F.coalesce(said, F.lit(UNKNOWN)))


def duration(weeks: Column, text: Column) -> Column:
    """The source's text if there is one; else weeks, or months with at most one decimal."""
    months = F.regexp_replace(F.format_string("%.1f", weeks / WEEKS_PER_MONTH), r"\.0$", "")
    shown = F.when(weeks >= MONTHS_FROM, F.concat(F.lit("~"), months, F.lit(" meses"))).otherwise(F.format_string("%.0f semanas", weeks))
    return F.when(text != "", text).otherwise(_or_unknown(weeks, shown))


def number(value: Column, digits: int = 1) -> Column:
    """Whole numbers without decimals, others with `digits`."""
    return _or_unknown(value, F.when(value == F.floor(value), F.format_string("%.0f", value)).otherwise(F.format_string(f"%.{digits}f", value)))


def score(value: Column) -> Column:
    return _or_unknown(value, F.format_string("%.3f", value))


def percent(share: Column) -> Column:
    """A share as a number from 0 to 100; 0 for null."""
    return F.when(share.isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(100.0), share * 100)))


def issn_label(print_: Column, electronic: Column) -> Column:
    return F.concat(F.lit("ISSN-E "), _or_unknown(electronic, electronic), F.lit(" · ISSN-P "), _or_unknown(print_, print_))


def origin(code: Column) -> Column:
    """The name of an origin; the code itself if it has none."""
    return F.coalesce(lookup(code, ORIGINS), code)
