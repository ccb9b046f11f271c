"""Articles from the text of journal issues: anchors, titles, abstracts and keywords.

Finding all markers with their offsets in one text has no built-in expression, so
one Arrow pass yields the anchors; everything after it is columns and windows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import clean_abstract, clean_keywords, preprocess, squeeze
from inkwell.operators.dedupe import gap_clusters, repeated_lines

#: Section markers of the two languages, and the distances in characters.
MARKERS = {"es": re.compile(r"\b(resumen|resumo)\b\s*[:\-–]?", re.I), "en": re.compile(r"\babstract\b\s*[:\-–]?", re.I)}
KEYWORDS = {"es": re.compile(r"\b(palabras\s+claves?|descriptores)\b\s*[:\-–]?", re.I), "en": re.compile(r"\b(key\s*words?|index\s+terms)\b\s*[:\-–]?", re.I)}
KEYWORDS_WITHIN, TITLE_WITHIN, KEYWORDS_LONGEST, NEW_ARTICLE, ABSTRACT_LEAST, BODY_LEAST = 4000, 900, 400, 6000, 40, 200


def anchors_of(text: str) -> list[tuple[str, int, int, int, int]]:
    """(language, marker, abstract start, abstract end, keywords start) for markers with keywords near, of the same language first."""
    found = []
    for language, marker in MARKERS.items():
        other = "en" if language == "es" else "es"
        for m in marker.finditer(text):
            near = text[m.end() : m.end() + KEYWORDS_WITHIN]
            if k := KEYWORDS[language].search(near) or KEYWORDS[other].search(near):
                found.append((language, m.start(), m.end(), m.end() + k.start(), m.end() + k.end()))
    return sorted(found, key=lambda a: a[1])


def anchors(texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row for each anchor of each text, with the stretches of text that the later steps read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for i, t in zip(b["id"], b["text"]):
                t = t or ""
                for language, at, start, end, keywords in anchors_of(t):
                    rows.append((i, language, at, t[start:end], t[keywords : keywords + KEYWORDS_LONGEST], t[max(0, at - TITLE_WITHIN) : at]))
            yield pd.DataFrame(rows, columns=["id", "language", "at", "abstract", "keywords", "before"])

    kind = texts.schema[id_col].dataType.simpleString()
    return texts.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(run, f"id {kind}, language string, at long, abstract string, keywords string, before string")


def _title(before, repeated):
    """The first line that looks like a title, else the first that isn't repeated, else the first."""
    lines = F.filter(F.transform(F.split(before, "[\n\f]+"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != "")
    own = F.filter(lines, lambda x: ~F.array_contains(repeated, x))
    like = F.filter(own, lambda x: F.length(x).between(15, 220) & ~x.contains("@") & (F.regexp_count(x, F.lit("[0-9]")) < 6))
    return F.coalesce(F.get(like, F.lit(0)), F.get(own, F.lit(0)), F.get(lines, F.lit(0)))


def extract(texts: DataFrame, id_col: str = "id", text_col: str = "text", issn_col: str | None = None, name_col: str | None = None) -> DataFrame:
    """(id, issn, article, language, title, abstract, keywords, how), one row for each article and language.

    Pages are parted by form feeds. Anchors 6000 characters apart begin a new article. Abstracts under 40
    characters are dropped. A text without anchors gives one row from its beginning if that has 200 characters.
    """
    key = texts.withColumn("__issn", F.col(issn_col) if issn_col else F.lit(None).cast("string")).withColumn("__name", F.col(name_col) if name_col else F.col(id_col).cast("string"))
    lines = repeated_lines(texts, id_col, text_col).groupBy(F.col(id_col).alias("id")).agg(F.collect_list("line").alias("repeated"))
    found = gap_clusters(anchors(texts, id_col, text_col), ["id"], "at", NEW_ARTICLE, "article")
    found = found.join(lines, "id", "left").withColumn("repeated", F.coalesce("repeated", F.expr("cast(array() as array<string>)")))
    named = found.join(key.select(F.col(id_col).alias("id"), "__issn", "__name"), "id")
    marked = named.select(
        "id", F.col("__issn").alias("issn"), F.concat_ws("_", "__name", F.col("article").cast("string")).alias("article"), "language", _title(F.col("before"), F.col("repeated")).alias("title"),
        clean_abstract(F.col("abstract")).alias("abstract"), clean_keywords(F.col("keywords"), KEYWORDS_LONGEST).alias("keywords"), F.lit("marcadores").alias("how"),
    ).where(F.length("abstract") >= ABSTRACT_LEAST)
    bare = key.join(found.select(F.col("id").alias("__found")).distinct(), F.col(id_col) == F.col("__found"), "left_anti")
    body = squeeze(F.substring(text_col, 1, KEYWORDS_WITHIN))
    fallback = bare.where(F.length(body) >= BODY_LEAST).select(
        F.col(id_col).alias("id"), F.col("__issn").alias("issn"), F.concat("__name", F.lit("_0")).alias("article"), F.lit("desconocido").alias("language"), F.trim(F.translate("__name", "+_", "  ")).alias("title"),
        F.substring(body, 1, 1500).alias("abstract"), F.lit(None).cast("string").alias("keywords"), F.lit("respaldo_sin_marcadores").alias("how"),
    )
    return marked.unionByName(fallback)


def normalize(articles: DataFrame) -> DataFrame:
    """articles with *_normalized fields and tokens by each row's language; rows without tokens go."""

    def by_language(column: str):
        c = F.col(column)
        return F.when(F.col("language") == "es", preprocess(c, "es")).when(F.col("language") == "en", preprocess(c, "en")).otherwise(preprocess(c))

    out = articles.withColumns({f"{c}_normalized": by_language(c) for c in ("title", "abstract", "keywords")})
    tokens = squeeze(F.concat_ws(" ", "title_normalized", "abstract_normalized", "keywords_normalized"))
    out = out.withColumn("tokens", tokens).withColumn("n_tokens", F.when(tokens == "", 0).otherwise(F.size(F.split(tokens, " "))))
    return out.where("n_tokens > 0")


def token_bags(articles: DataFrame, key: str = "issn", order: str = "article") -> DataFrame:
    """(key, n_articles, languages, tokens, n_distinct) for each journal, articles in the order given."""
    rows = F.array_sort(F.collect_list(F.struct(order, "tokens")))
    bag = articles.groupBy(key).agg(F.countDistinct(order).alias("n_articles"), F.array_join(F.array_sort(F.collect_set("language")), ",").alias("languages"), F.array_join(F.transform(rows, lambda x: x["tokens"]), " ").alias("tokens"))
    return bag.withColumn("n_distinct", F.size(F.array_distinct(F.split("tokens", " "))))


def journal_corpus(articles: DataFrame, key: str = "issn", order: str = "article") -> DataFrame:
    """(key, text): the preprocessed manuscripts' texts of each journal, joined in order."""
    from inkwell.functions.text import manuscript_text

    rows = articles.withColumn("__text", manuscript_text(F.col("title"), F.col("abstract"), F.col("keywords")))
    return rows.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "__text"))), lambda x: x["__text"]), " ").alias("text"))
