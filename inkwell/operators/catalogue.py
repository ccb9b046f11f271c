"""Catalogue queries: filters, search, pages and facets."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field, fields
from functools import reduce
from urllib.parse import parse_qs, urlencode

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions.catalogue import cost_status
from inkwell.functions.text import search_key

#: Columns whose values are picked from a list, and those with a lower bound.
LISTS = ("quartile", "publindex_category", "access_type", "country", "publisher", "submission_format")
LEAST = ("h_index", "sjr", "citescore", "impact_factor", "quality_cost_index")
SORTS = ("title", "apc_usd", "weeks_to_publication", "h_index", "sjr", "citescore", "impact_factor", "quality_cost_index", "quartile")
STATUSES = ("con_costo", "sin_costo", "desconocido")


@dataclass(frozen=True)
class Filters:
    """What a user picks; empty means no restriction. Nulls never pass a bound."""

    q: str = ""
    topics: tuple[str, ...] = ()
    languages: tuple[str, ...] = ()
    apc_status: str = ""
    apc_min: float | None = None
    apc_max: float | None = None
    weeks_max: float | None = None
    picks: dict[str, tuple[str, ...]] = field(default_factory=dict)
    least: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.apc_status and self.apc_status not in STATUSES:
            raise ValueError(f"apc_status must be one of {STATUSES}")
        if set(self.picks) - set(LISTS) or set(self.least) - set(LEAST):
            raise ValueError("unknown filter column")
        if any(x is not None and x < 0 for x in (self.apc_min, self.apc_max, self.weeks_max)):
            raise ValueError("bounds can't be negative")

    def to_query(self) -> str:
        """The filters as a url's query; from_query undoes it."""
        flat = [(f.name, getattr(self, f.name)) for f in fields(self) if f.name not in ("picks", "least")]
        pairs = [(n, x) for n, v in flat if v not in ("", (), None) for x in (v if isinstance(v, tuple) else (v,))]
        return urlencode(pairs + [(n, x) for n, v in sorted(self.picks.items()) for x in v] + [(f"{n}_min", x) for n, x in sorted(self.least.items())])

    @classmethod
    def from_query(cls, query: str) -> Filters:
        got = parse_qs(query)
        one = lambda n, kind: kind(got[n][0]) if n in got else None
        return cls(
            q=one("q", str) or "", topics=tuple(got.get("topics", ())), languages=tuple(got.get("languages", ())), apc_status=one("apc_status", str) or "",
            apc_min=one("apc_min", float), apc_max=one("apc_max", float), weeks_max=one("weeks_max", float),
            picks={n: tuple(got[n]) for n in LISTS if n in got}, least={n: float(got[f"{n}_min"][0]) for n in LEAST if f"{n}_min" in got},
        )

    def active(self) -> int:
        return sum(v not in ("", (), None, {}) for k, v in asdict(self).items() if k not in ("picks", "least")) + len(self.picks) + len(self.least)


def search(df: DataFrame, q: str, column: str = "search_text") -> DataFrame:
    """Rows whose search text holds every word of q, accents and case aside; no sign is a wildcard."""
    import unicodedata

    plain = "".join(c for c in unicodedata.normalize("NFKD", q) if not unicodedata.combining(c)).lower()
    return reduce(lambda d, term: d.where(F.col(column).contains(term)), plain.split(), df)


def with_search_text(df: DataFrame, columns: list[str], name: str = "search_text") -> DataFrame:
    return df.withColumn(name, search_key(*(F.col(c).cast("string") for c in columns)))


def apply_filters(df: DataFrame, f: Filters, topics: DataFrame | None = None) -> DataFrame:
    """topics: (id, topic); without it df.topics, an array, is looked in."""
    out = search(df, f.q) if f.q else df
    for column, values in f.picks.items():
        out = out.where(F.col(column).isin(*values))
    if f.topics:
        if topics is None:
            out = out.where(F.arrays_overlap("topics", F.array(*map(F.lit, f.topics))))
        else:
            out = out.join(topics.where(F.col("topic").isin(*f.topics)).select("id").distinct(), "id", "left_semi")
    if f.languages:
        out = out.where(reduce(lambda a, b: a | b, (F.col("language").contains(x) for x in f.languages)))
    if f.apc_status:
        out = out.where(cost_status(F.col("apc_usd")) == f.apc_status)
    for column, low, high in (("apc_usd", f.apc_min, f.apc_max), ("weeks_to_publication", None, f.weeks_max)):
        out = out if low is None else out.where(F.col(column) >= low)
        out = out if high is None else out.where(F.col(column) <= high)
    for column, low in f.least.items():
        out = out.where(F.col(column) >= low)
    return out


def page(df: DataFrame, sort: str, descending: bool = False, number: int = 1, size: int = 20, tie: str = "id") -> DataFrame:
    """One page in a total order: nulls last either way, ties by id."""
    if number < 1 or not 1 <= size <= 100:
        raise ValueError("page from 1, size from 1 to 100")
    if sort not in df.columns:
        raise ValueError(f"no column {sort}")
    c = F.col(sort)
    return df.orderBy(c.desc_nulls_last() if descending else c.asc_nulls_last(), tie).offset((number - 1) * size).limit(size)


def facet(df: DataFrame, column: str, by_value: bool = False) -> DataFrame:
    """(value, n) of the non-null values: most frequent first, or by value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return counts.orderBy("value") if by_value else counts.orderBy(F.desc("n"), "value")


def facet_list(df: DataFrame, column: str, separator: str = ",") -> DataFrame:
    """facet of the trimmed entries of a list in a text."""
    parts = df.select(F.explode(F.split(column, separator)).alias("raw")).select(F.trim("raw").alias("value")).where("value <> ''")
    return facet(parts, "value")


def facets(df: DataFrame, columns: list[str]) -> DataFrame:
    """(facet, value, n) of several columns in one pass."""
    pairs = ", ".join(f"'{c}', cast(`{c}` AS string)" for c in columns)
    long = df.select(F.expr(f"stack({len(columns)}, {pairs}) AS (facet, value)")).where("value IS NOT NULL")
    return long.groupBy("facet", "value").agg(F.count("*").alias("n"))


def bounds(df: DataFrame) -> DataFrame:
    """One row of what the filters' sliders need."""
    return df.agg(F.count("*").alias("total"), F.max("apc_usd").alias("apc_max"), F.max("weeks_to_publication").alias("weeks_max"), F.max("h_index").alias("h_index_max"))
