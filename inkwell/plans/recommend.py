"""The recommender: fitted tables, saved as Parquet, and rankings for many manuscripts in one plan."""

from __future__ import annotations

import json
from dataclasses import dataclass
from itertools import permutations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions.text import manuscript_text
from inkwell.operators import retrieval
from inkwell.operators.topsis import DIMENSIONS

ORDERS = list(permutations(DIMENSIONS))


@dataclass
class Model:
    """idf (term, df, idf), weights (id, term, weight), quality (doc_id, topsis_1 .. topsis_6), dense (id, vector) or None."""

    idf: DataFrame
    weights: DataFrame
    quality: DataFrame
    dense: DataFrame | None = None
    alpha: float = 1.0

    def save(self, path: str) -> None:
        for name in ("idf", "weights", "quality", "dense"):
            if (df := getattr(self, name)) is not None:
                df.write.mode("overwrite").parquet(f"{path}/{name}")
        spark = self.idf.sparkSession
        spark.createDataFrame([(json.dumps({"alpha": self.alpha, "dense": self.dense is not None}),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Model:
        meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
        read = lambda n: spark.read.parquet(f"{path}/{n}")
        return cls(read("idf"), read("weights"), read("quality"), read("dense") if meta["dense"] else None, meta["alpha"])

    def info(self) -> DataFrame:
        """(vocabulary, journals, alpha) in one row."""
        return self.idf.agg(F.count("*").alias("vocabulary")).crossJoin(self.weights.agg(F.countDistinct("id").alias("journals"))).withColumn("alpha", F.lit(self.alpha))


def fit(journals: DataFrame, quality: DataFrame, dense: DataFrame | None = None, alpha: float = 1.0) -> Model:
    """journals: (id, text), the preprocessed text of each; alpha is the share of TF-IDF where dense vectors are given."""
    if not 0 <= alpha <= 1:
        raise ValueError("alpha must be from 0 to 1")
    terms = retrieval.terms(journals, "id", "text")
    idf = retrieval.fit_idf(terms, journals.select("id").distinct())
    return Model(idf, retrieval.weigh(terms, idf), quality, dense, alpha)


def _cosines(model: Model, manuscripts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(query_id) of the manuscripts, and (query_id, doc_id, score) of those that share a term with a journal."""
    texts = manuscripts.select("id", manuscript_text(F.col("title"), F.col("abstract"), F.col("keywords")).alias("text"))
    queries = retrieval.weigh(retrieval.terms(texts, "id", "text"), model.idf)
    return texts.select(F.col("id").alias("query_id")), retrieval.cosine(queries, model.weights)


def thematic(model: Model, manuscripts: DataFrame, vectors: DataFrame | None = None) -> DataFrame:
    """(query_id, doc_id, tfidf, dense, score) of every manuscript (id, title, abstract, keywords) with every journal; vectors: (id, vector)."""
    queries, scores = _cosines(model, manuscripts)
    pairs = retrieval.all_pairs(scores, queries, model.weights.select(F.col("id").alias("doc_id"))).withColumnRenamed("score", "tfidf")
    if model.dense is None or vectors is None:
        return pairs.withColumn("dense", F.lit(0.0)).withColumn("score", retrieval.fuse(F.col("tfidf"), F.col("dense"), model.alpha))
    q, d = vectors.select(F.col("id").alias("query_id"), F.col("vector").alias("q")), model.dense.select(F.col("id").alias("doc_id"), F.col("vector").alias("d"))
    both = pairs.join(q, "query_id", "left").join(d, "doc_id", "left")
    dense = F.coalesce(retrieval.dense_cosine(F.col("q"), F.col("d")), F.lit(0.0))
    return both.withColumn("dense", dense).drop("q", "d").withColumn("score", retrieval.fuse(F.col("tfidf"), F.col("dense"), model.alpha))


def recommend(model: Model, manuscripts: DataFrame, k: int = 10, order: tuple[str, ...] = ORDERS[0], weight: float = 0.5, vectors: DataFrame | None = None, metadata: DataFrame | None = None, key: str = "issn") -> DataFrame:
    """(query_id, rank, doc_id, tfidf, dense, score, quality, final), the k best journals of each manuscript.

    Journals without a quality come last. Manuscripts without a word of the vocabulary rank by quality alone.
    metadata: rows about journals under key; see described(). Pairs are all made only where vectors give each a score.
    """
    if not 1 <= k <= 150:
        raise ValueError("k must be from 1 to 150")
    if tuple(order) not in ORDERS:
        raise ValueError(f"order must be a permutation of {DIMENSIONS}")
    quality = model.quality.select("doc_id", F.col(f"topsis_{ORDERS.index(tuple(order)) + 1}").alias("quality"))
    if model.dense is None or vectors is None:
        queries, scores = _cosines(model, manuscripts)
        fused = scores.withColumn("score", retrieval.fuse(F.col("score"), F.lit(0.0), model.alpha))
        best = retrieval.quality_top(fused, queries, model.weights.select(F.col("id").alias("doc_id")), quality, k, weight)
        best = best.join(scores.withColumnRenamed("score", "tfidf"), ["query_id", "doc_id"], "left").fillna(0.0, ["tfidf"]).withColumn("dense", F.lit(0.0))
    else:
        final = retrieval.with_quality(thematic(model, manuscripts, vectors), quality, weight)
        best = retrieval.top(final.withColumn("final", F.round("final", 12)), k, "final")
    best = best.select("query_id", "rank", "doc_id", "tfidf", "dense", "score", "quality", "final")
    return best if metadata is None else described(best, metadata, key)


def described(ranked: DataFrame, metadata: DataFrame, key: str = "issn") -> DataFrame:
    """ranked with the columns of metadata (title, fee, weeks, quartile or others), one row for each journal.

    Of several rows with one key the least by all columns is taken; journals without a row have nulls. Columns that
    ranked has already keep its values.
    """
    own = [c for c in metadata.columns if c != key and c not in ranked.columns]
    one = metadata.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(F.min(F.struct(*own)).alias("__row")) if own else None
    return ranked if one is None else ranked.join(one, ranked["doc_id"] == one["__key"], "left").select(*ranked.columns, *(F.col(f"__row.`{c}`").alias(c) for c in own))


def compare(model: Model, journal: str, k: int = 10, order: tuple[str, ...] | None = None) -> DataFrame:
    """The k journals most like one, itself left out; with an order quality counts half."""
    own = model.weights.where(F.col("id") == journal)
    others = model.weights.where(F.col("id") != journal)
    sides = retrieval.cosine(own, others), own.select(F.col("id").alias("query_id")), others.select(F.col("id").alias("doc_id"))
    if order is None:
        return retrieval.top_of_all(*sides, k)
    quality = model.quality.select("doc_id", F.col(f"topsis_{ORDERS.index(tuple(order)) + 1}").alias("quality"))
    return retrieval.quality_top(*sides, quality, k)
