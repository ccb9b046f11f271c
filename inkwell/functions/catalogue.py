"""Columns of the catalogue: countries, access, publishers, topics, and rows of its two sources."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell.constants import COUNTRY_DISPLAY, COUNTRY_ISO, DEFAULT_TOPIC, LANGUAGE_NAMES, PUBLISHERS, TOPIC_RULES
from inkwell.functions.lookup import lookup
from inkwell.functions.text import clean, search_key, strip_marks, to_ascii


def country_iso(value: Column) -> Column:
    """Two letters by name, or the two letters that are given."""
    key = to_ascii(F.lower(F.trim(value)))
    return F.coalesce(lookup(key, COUNTRY_ISO), F.when(F.length(key) == 2, F.upper(key)))


def country_display(value: Column) -> Column:
    first = F.trim(F.get(F.split(clean(value), "[/;,]"), F.lit(0)))
    return F.coalesce(lookup(F.lower(strip_marks(first)), COUNTRY_DISPLAY), first)


def access_type(value: Column) -> Column:
    """Hybrid before open before subscription, by keyword; other texts stay."""
    t = clean(value)
    key = F.lower(strip_marks(t))
    return F.when(key.rlike("hibrid|hybrid"), "Híbrido").when(key.rlike(r"open|abiert|diamond|diamante|\boa\b"), "Open Access").when(key.rlike("suscrip|subscri|cerrad|closed|pago"), "Suscripción").otherwise(t)


def publisher(value: Column) -> Column:
    """The known publisher named first in a text; ties by name; other texts stay."""
    t = clean(value)
    places = F.array(*(F.struct(F.instr(F.lower(t), name.lower()).alias("at"), F.lit(name).alias("name")) for name in PUBLISHERS))
    return F.coalesce(F.array_min(F.filter(places, lambda p: p["at"] > 0))["name"], t)


def cost_status(usd: Column) -> Column:
    return F.when(usd.isNull(), "desconocido").when(usd <= 0, "sin_costo").otherwise("con_costo")


def topics(title: Column) -> Column:
    """At most four topics whose keywords the title holds, in the order of the rules."""
    key = F.concat(F.lit(" "), search_key(title), F.lit(" "))
    held = [F.when(reduce(lambda a, b: a | b, (key.contains(w) for w in words)), F.lit(topic)) for topic, words in TOPIC_RULES]
    found = F.slice(F.filter(F.array(*held), lambda x: x.isNotNull()), 1, 4)
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(DEFAULT_TOPIC)))


def has_letter(name: Column) -> Column:
    return F.coalesce(clean(name).rlike("[A-Za-zÁÉÍÓÚáéíóúÑñ]"), F.lit(False))


def is_url(value: Column) -> Column:
    return F.coalesce(clean(value).rlike(r"(?i)^https?://\S+$"), F.lit(False))


def language_names(value: Column) -> Column:
    """A comma-separated list of languages with Spanish names."""
    parts = F.filter(F.transform(F.split(clean(value), ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_join(F.transform(parts, lambda x: F.coalesce(lookup(F.lower(x), LANGUAGE_NAMES), x)), ", ")


def filled(*columns: Column) -> Column:
    """How many of the columns, as text, hold something."""
    return reduce(add, (F.coalesce((c.cast("string") != "").cast("int"), F.lit(0)) for c in columns))


def general(number: Column) -> Column:
    """A number with at most six decimals and no idle zeros: 12, 12.5, 0.001."""
    return F.regexp_replace(F.regexp_replace(F.format_string("%.6f", number), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")


def catalogue_fee(real: Column, has_fee: Column) -> Column:
    return F.when(real.isNotNull(), F.bround(real, 2)).when(has_fee == False, 0.0)  # noqa: E712


def catalogue_access(hybrid: Column, *open_flags: Column) -> Column:
    """open_flags: the declared one first; it alone can say that a journal is closed."""
    opened = reduce(lambda a, b: a | b, (F.coalesce(f, F.lit(False)) for f in open_flags))
    return F.when(F.coalesce(hybrid, F.lit(False)), "Híbrido").when(opened, "Open Access").when(open_flags[0] == False, "Suscripción")  # noqa: E712


def duration_text(weeks: Column) -> Column:
    """Weeks, or months from 8.7 weeks on; N/D if unknown."""
    return F.when(weeks.isNull(), "N/D").when(weeks >= 8.7, F.concat(general(F.bround(weeks / 4.345, 0)), F.lit(" meses"))).otherwise(F.concat(general(F.bround(weeks, 1)), F.lit(" semanas")))


def percent_text(share: Column) -> Column:
    return F.when(share.isNull(), "N/D").otherwise(F.concat(F.bround(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)) * 100, 0).cast("int").cast("string"), F.lit("%")))
