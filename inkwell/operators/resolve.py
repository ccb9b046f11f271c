"""Entity resolution of one source into a base table, in stages from cheap to dear.

Each stage takes only what the one before left: equal serial numbers, equal
normalized titles, similar titles. The matches are a narrow table of row numbers,
and one last left join brings the source's columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.constants import FUZZY_THRESHOLD
from inkwell.operators.dedupe import first_by
from inkwell.operators.similarity import wratio_column


def _titles(df: DataFrame, row: str, title: str, name: str) -> DataFrame:
    return df.select(F.col(row).alias(name), F.col(title).alias("title")).where(F.col("title").isNotNull())


def candidates(left: DataFrame, right: DataFrame, threshold: float | None = None) -> DataFrame:
    """Pairs of (base_row, title) and (source_row, other) that share a word, each once.

    With a Jaccard threshold only the words that such a pair must share are joined: the rarest
    |words| - ceil(threshold * |words|) + 1 of each title. No pair that reaches it is lost, and
    common words join nothing. Similar titles without a common word (all misspelt) are not proposed.
    """
    words = lambda df, row: df.select(row, "title", F.array_distinct(F.split("title", " ")).alias("all")).select(row, "title", F.size("all").alias("n"), F.explode("all").alias("word"))
    l, r = words(left, "base_row"), words(right, "source_row")
    if threshold is not None:
        seen = l.select("word").unionByName(r.select("word")).groupBy("word").agg(F.count("*").alias("seen"))

        def rarest(df: DataFrame, row: str) -> DataFrame:
            place = F.row_number().over(Window.partitionBy(row).orderBy("seen", "word"))
            return df.join(seen, "word").withColumn("place", place).where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * threshold / 100 - 1e-9) + 1)

        l, r = rarest(l, "base_row"), rarest(r, "source_row")
    r = r.select("source_row", "word", F.col("title").alias("other"))
    return l.select("base_row", "word", "title").join(r, "word").groupBy("base_row", "source_row").agg(F.min("title").alias("title"), F.min("other").alias("other"))


def match(base: DataFrame, source: DataFrame, key: str, title: str, row: str, scorer: str = "wratio", threshold: float = FUZZY_THRESHOLD) -> DataFrame:
    """(base_row, source_row, match, score) with match `key`, `title` or `fuzzy`; a base row has one match at most.

    Of source rows with one key, or one title, the first counts, and of equal
    scores the first source row. Source rows used by key stay out of the later
    stages; several base rows may take one source row there. Null keys and titles
    match nothing. scorer: wratio or jaccard, from 0 to 100.
    """
    if scorer not in ("wratio", "jaccard"):
        raise ValueError(f"scorer must be wratio or jaccard, not {scorer!r}")
    keyed = first_by(source.where(F.col(key).isNotNull()), [key], F.col(row)).select(F.col(key).alias("k"), F.col(row).alias("source_row"))
    by_key = base.select(F.col(row).alias("base_row"), F.col(key).alias("k")).join(keyed, "k").select("base_row", "source_row", F.lit("key").alias("match"), F.lit(100.0).alias("score"))
    left = _titles(base, row, title, "base_row").join(by_key, "base_row", "left_anti")
    used = base.select(F.col(key).alias("k")).where("k IS NOT NULL").distinct()
    free = source.join(used, source[key] == used["k"], "left_anti")
    right = _titles(free, row, title, "source_row")
    exact_right = first_by(right, ["title"], F.col("source_row"))
    by_title = left.join(exact_right, "title").select("base_row", "source_row", F.lit("title").alias("match"), F.lit(100.0).alias("score"))
    rest = left.join(by_title, "base_row", "left_anti")
    pairs = candidates(rest, right, threshold if scorer == "jaccard" else None)
    if scorer == "wratio":
        score = wratio_column("title", "other")
    else:
        a, b = F.array_distinct(F.split("title", " ")), F.array_distinct(F.split("other", " "))
        score = F.lit(100.0) * F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))
    scored = pairs.withColumn("score", score).where(F.col("score") >= threshold)
    best = scored.groupBy("base_row").agg(F.max(F.struct("score", (-F.col("source_row")).alias("back"))).alias("best"))
    by_score = best.select("base_row", (-F.col("best.back")).alias("source_row"), F.lit("fuzzy").alias("match"), F.col("best.score").alias("score"))
    return by_key.unionByName(by_title).unionByName(by_score)


def enrich(base: DataFrame, source: DataFrame, matches: DataFrame, key: str, title: str, row: str, suffix: str) -> DataFrame:
    """base with the columns of its matched source rows; names it has already get _suffix, the title _suffix_dup.

    A fuzzy or title match brings no key.
    """
    brought = [c for c in source.columns if c not in (key, row)]
    named = {c: f"{c}_{suffix}_dup" if c == title else (f"{c}_{suffix}" if c in base.columns else c) for c in brought}
    values = source.select(F.col(row).alias("source_row"), *(F.col(c).alias(named[c]) for c in brought))
    found = matches.select("base_row", "source_row").join(values, "source_row").drop("source_row")
    return base.join(found, base[row] == found["base_row"], "left").drop("base_row")


def merge_log(base: DataFrame, matches: DataFrame, key: str, row: str, source: str) -> DataFrame:
    """(issn, fuente, tipo_cruce, resultado, similitud): what each match rests on. Keys once each."""
    named = matches.join(base.select(F.col(row).alias("base_row"), F.col(key).alias("issn")), "base_row")
    return named.select("issn", F.lit(source).alias("fuente"), F.when(F.col("match") == "key", "issn").otherwise("titulo").alias("tipo_cruce"), F.lit("match").alias("resultado"), F.col("score").alias("similitud")).distinct()


def coalesce_suffixes(df: DataFrame, suffixes: list[str], overriding: dict[str, list[str]] | None = None) -> DataFrame:
    """Columns name_suffix folded into name, suffix by suffix.

    A column of an overriding suffix wins where it isn't null; others only fill nulls. A suffixed
    column without a base takes the base's name. Columns that end in _dup stay.
    """
    overriding = overriding or {}
    for s in suffixes:
        for c in [c for c in df.columns if c.endswith(f"_{s}")]:
            name = c[: -len(s) - 1]
            if name in df.columns:
                pair = (c, name) if name in overriding.get(s, ()) else (name, c)
                df = df.withColumn(name, F.coalesce(*map(F.col, pair))).drop(c)
            else:
                df = df.withColumnRenamed(c, name)
    return df


def lookup_first(left: DataFrame, right: DataFrame, key: str, row: str) -> DataFrame:
    """left with the first right row of its key; columns left has already are not brought."""
    kept = [c for c in right.columns if c not in left.columns and c != row]
    return left.join(first_by(right.where(F.col(key).isNotNull()), [key], F.col(row)).select(key, *kept), key, "left")


def source_set(columns: dict[str, str], default: str = "publindex"):
    """Sorted names of the sources whose marker column is there, with the default always."""
    held = [F.when(F.col(c).isNotNull(), F.lit(name)) for name, c in columns.items()]
    return F.array_sort(F.array_distinct(F.filter(F.array(F.lit(default), *held), lambda x: x.isNotNull())))
