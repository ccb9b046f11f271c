"""Yes and no, quartiles and ordinals, and the flags of the feature table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell.constants import CATEGORY_ORDINAL, FAST_WEEKS, LMIC, QUARTILE_ORDINAL
from inkwell.functions.lookup import lookup


def yes_no(value: Column, exact: bool = False) -> Column:
    """Three-valued truth; exact accepts Yes, No, yes, no, TRUE and FALSE alone."""
    if exact:
        return F.when(value.isin("Yes", "yes", "TRUE"), True).when(value.isin("No", "no", "FALSE"), False)
    t = F.lower(F.trim(value))
    return F.when(t == "yes", True).when(t == "no", False)


def truthy(value: Column) -> Column:
    return F.coalesce(F.upper(F.trim(value)).isin("TRUE", "1", "YES"), F.lit(False))


def category_list(value: Column) -> Column:
    """`Name (Q1); Other` to an array of (category, quartile); an entry without a quartile keeps its text."""

    def one(entry: Column) -> Column:
        q = F.regexp_extract(entry, r"^(.+?)\s*\(([Qq][1-4])\)", 2)
        name = F.when(q != "", F.regexp_extract(entry, r"^(.+?)\s*\(([Qq][1-4])\)", 1)).otherwise(entry)
        return F.struct(name.alias("category"), F.when(q != "", F.upper(q)).alias("quartile"))

    return F.transform(F.filter(F.transform(F.split(value, ";"), lambda x: F.trim(x)), lambda x: x != ""), one)


def best_quartile(categories: Column, reported: Column | None = None) -> Column:
    """The best quartile of category_list's result, else the reported one."""
    best = F.array_min(F.filter(F.transform(categories, lambda c: c["quartile"]), lambda q: q.isNotNull()))
    return best if reported is None else F.coalesce(best, reported)


def quartile_in_text(value: Column) -> Column:
    digits = F.regexp_extract_all(value, F.lit(r"(?i)Q\s*([1-4])"), 1)
    return F.concat(F.lit("Q"), F.array_min(digits))


def ordinal(value: Column, table: dict[str, int]) -> Column:
    """Rank of a grade; 0 for null and unknown ones."""
    return F.coalesce(lookup(F.upper(F.trim(value)), table), F.lit(0))


def category_ordinal(value: Column) -> Column:
    return ordinal(value, CATEGORY_ORDINAL)


def quartile_ordinal(value: Column) -> Column:
    return ordinal(value, QUARTILE_ORDINAL)


def ordinal_gap(a: Column, b: Column) -> tuple[Column, Column]:
    """(a - b, a / b): the ratio only where both are known."""
    return a - b, F.when((a > 0) & (b > 0), a / b)


def diamond(open_access: Column, before: Column, has_fee: Column, fee: Column) -> Column:
    """Open without a fee; an amount that is missing counts as none."""
    no = F.lit(False)
    return (F.coalesce(open_access, no) | F.coalesce(before, no)) & (~F.coalesce(has_fee, no) | (F.coalesce(fee, F.lit(0.0)) == 0))


def waiver(policy: Column, country: Column) -> Column:
    return F.coalesce(policy, F.lit(False)) | F.coalesce(country.isin(*LMIC), F.lit(False))


def open_review(review: Column) -> Column:
    return F.coalesce(F.lower(review).rlike("open|abierta"), F.lit(False))


def indexed(sources: Column, name: str = "doaj") -> Column:
    return F.coalesce(F.array_contains(sources, name), F.lit(False))


def is_country(country: Column, code: str = "CO") -> Column:
    return F.coalesce(country == code, F.lit(False))


def publishes_fast(weeks: Column) -> Column:
    return F.coalesce(weeks <= FAST_WEEKS, F.lit(False))


def cites_per_document(cites: Column, documents: Column, fallback: Column | None = None) -> Column:
    own = F.when(documents > 0, cites / documents)
    return own if fallback is None else F.coalesce(own, fallback)
