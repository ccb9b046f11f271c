"""Thematic retrieval: TF-IDF in long form, dense cosines, fusion and top-k."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from inkwell.functions.text import clean_scientific, is_content, stem

#: Tokens of the vectorizer: a word character, then word characters and hyphens.
TOKEN = r"(?U)\b\w[\w-]+\b"
#: Queries that meet a block of documents in one product of matrices.
STEP = 128


def terms(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, term, tf): raw counts."""
    tokens = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(F.lower(text_col), F.lit(TOKEN), 0)).alias("term"))
    return tokens.groupBy("id", "term").agg(F.count("*").alias("tf"))


def prepared_terms(docs: DataFrame, id_col: str, text_col: str, language: str = "auto") -> DataFrame:
    """terms() of texts that are preprocessed here: each token is counted first, and every distinct one of an id stemmed once."""
    tokens = docs.select(F.col(id_col).alias("id"), F.explode(F.split(clean_scientific(F.col(text_col)), " ")).alias("token"))
    counted = tokens.where(is_content(F.col("token"), language)).groupBy("id", "token").agg(F.count("*").alias("n"))
    stems = counted.select("id", "n", F.explode(F.regexp_extract_all(F.lower(stem(F.col("token"), language)), F.lit(TOKEN), 0)).alias("term"))
    return stems.groupBy("id", "term").agg(F.sum("n").alias("tf"))


def fit_idf(docs_terms: DataFrame, documents: DataFrame, smooth: bool = True) -> DataFrame:
    """(term, df, idf). Smooth: ln((1 + n) / (1 + df)) + 1; else ln(n / df). n counts the documents without terms too."""
    n = documents.agg(F.count("*").alias("n"))
    df = docs_terms.groupBy("term").agg(F.count("*").alias("df")).crossJoin(F.broadcast(n))
    idf = F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1 if smooth else F.log(F.col("n") / F.col("df"))
    return df.select("term", "df", idf.alias("idf"))


def weigh(some_terms: DataFrame, idf: DataFrame) -> DataFrame:
    """(id, term, weight) of unit length; terms without an idf are dropped before."""
    raw = some_terms.join(idf.select("term", "idf"), "term").withColumn("w", F.col("tf") * F.col("idf"))
    norm = raw.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norm, "id").select("id", "term", (F.col("w") / F.col("norm")).alias("weight"))


def cosine(queries: DataFrame, documents: DataFrame) -> DataFrame:
    """(query_id, doc_id, score) of the pairs that share a term; other pairs have 0."""
    q = queries.select(F.col("id").alias("query_id"), "term", F.col("weight").alias("q"))
    d = documents.select(F.col("id").alias("doc_id"), "term", F.col("weight").alias("d"))
    return q.join(d, "term").groupBy("query_id", "doc_id").agg(F.sum(F.col("q") * F.col("d")).alias("score"))


def all_pairs(scores: DataFrame, queries: DataFrame, documents: DataFrame) -> DataFrame:
    """scores with 0 for the pairs it lacks, a product: only where another score is defined for every pair, and candidates are few. For the best k see filled()."""
    return queries.select("query_id").distinct().join(documents.select("doc_id").distinct()).join(scores, ["query_id", "doc_id"], "left").fillna(0.0, ["score"])


def filled(scores: DataFrame, queries: DataFrame, first: DataFrame, score: str = "score") -> DataFrame:
    """scores (query_id, doc_id, score >= 0), and with 0 what each query lacks of first (doc_id): (query_id, doc_id, score, scored).

    Pairs without a score tie at 0, so the k best of all pairs are among scores and the k candidates that the order of
    ties puts first. Those k are all that is paired with every query.
    """
    rest = queries.select("query_id").distinct().crossJoin(F.broadcast(first.select("doc_id"))).select("query_id", "doc_id", F.lit(0.0).alias(score), F.lit(False).alias("scored"))
    both = scores.select("query_id", "doc_id", score, F.lit(True).alias("scored")).unionByName(rest)
    return both.groupBy("query_id", "doc_id").agg(F.max(score).alias(score), F.max("scored").alias("scored"))


def top_of_all(scores: DataFrame, queries: DataFrame, documents: DataFrame, k: int) -> DataFrame:
    """top() of the scores with 0 for every pair of queries and documents that they lack, without making those pairs."""
    first = documents.select("doc_id").distinct().orderBy("doc_id").limit(k)
    return top(filled(scores, queries, first).drop("scored"), k)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)


def dense_cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; 0 if one has no length."""
    length = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(length > 0, dot(a, b) / length).otherwise(0.0)


def _widths(column: pa.ChunkedArray) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """The width of every vector, -1 for null ones and those that hold a null; and of each other width the place of every vector in a matrix, and that."""
    lists = column.combine_chunks()
    flat, size = lists.flatten(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    width = np.where(lists.is_null().to_numpy(zero_copy_only=False), -1, size)
    if flat.null_count:
        width[np.unique(np.repeat(np.arange(len(size)), size)[flat.is_null().to_numpy(zero_copy_only=False)])] = -1
    flat, start = flat.to_numpy(zero_copy_only=False).astype(np.float64), np.cumsum(size) - size
    found = {}
    for m in np.unique(width[width >= 0]).tolist():
        rows, place = np.flatnonzero(width == m), np.zeros(len(width), np.int64)
        place[rows] = np.arange(len(rows))
        found[m] = (place, flat[start[rows][:, None] + np.arange(m)])
    return width, found


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """dot() of vectors along the last axis, summed in the same order."""
    out = np.zeros(np.broadcast_shapes(a.shape[:-1], b.shape[:-1]))
    for i in range(a.shape[-1]):
        out = out + a[..., i] * b[..., i]
    return out


def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """dense_cosine() of vectors along the last axis."""
    length = np.sqrt(_dots(x, x)) * np.sqrt(_dots(y, y))
    return np.where((length > 0) | np.isnan(length), _dots(x, y) / np.where(length == 0, 1, length), 0.0)


def _best(query: pa.Table, documents: pa.Table, k: int, margin: float) -> pa.Table:
    """(query_id, doc_id, score) of one block of queries and one of documents: all that can be among the k best of a query once scores are rounded by less than margin.

    Products of unit vectors, by matrices, choose; what they choose is scored as dense_cosine() does. Of documents with the
    same score only the k smallest ids are left.
    """
    documents = documents.sort_by("doc_id")
    qid, cid = (t[x].to_numpy() for t, x in ((query, "query_id"), (documents, "doc_id")))
    (q_width, q_of), (c_width, c_of) = _widths(query["q"]), _widths(documents["d"])
    out = []

    def unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        length = np.sqrt((x * x).sum(axis=1))
        plain = (length > 1e-100) & (length < 1e100)
        return x / np.where(plain, length, 1)[:, None], np.flatnonzero(~plain)

    units = {m: unit(x) for m, (_, x) in c_of.items()}
    for at in range(0, len(qid), STEP):
        here = np.arange(at, min(at + STEP, len(qid)))
        near = np.zeros((len(here), len(cid)))  # -inf stands for null
        for m, (place, x) in q_of.items():
            rows = np.flatnonzero(q_width[here] == m)
            if not len(rows):
                continue
            x = x[place[here[rows]]]
            x_unit, x_odd = unit(x)
            for n, (_, y) in c_of.items():
                columns = np.flatnonzero(c_width == n)
                if n != m:
                    length = np.sqrt(_dots(x, x))[:, None] * np.sqrt(_dots(y, y))
                    near[np.ix_(rows, columns)] = np.where((length > 0) | np.isnan(length), -np.inf, 0.0)
                    continue
                y_unit, y_odd = units[n]
                part = x_unit @ y_unit.T
                part[x_odd] = [_exact(v, y) for v in x[x_odd]] if len(x_odd) else part[x_odd]
                for j in y_odd:
                    part[:, j] = _exact(x, y[j])
                near[np.ix_(rows, columns)] = part
        near[np.isnan(near)] = np.inf  # NaN is the largest
        own = qid[here][:, None] == cid[None, :]
        near[own] = -np.inf
        least = np.partition(near, max(0, len(cid) - k), axis=1)[:, max(0, len(cid) - k)]
        r, c = np.nonzero((near >= (least - margin)[:, None]) & ~own)
        score = near[r, c]
        for m in q_of.keys() & c_of.keys():
            pairs = np.flatnonzero((q_width[here[r]] == m) & (c_width[c] == m))
            for a in range(0, len(pairs), 1 << 16):
                p = pairs[a : a + (1 << 16)]
                score[p] = _exact(q_of[m][1][q_of[m][0][here[r[p]]]], c_of[m][1][c_of[m][0][c[p]]])
        value = np.where(np.isnan(score), np.inf, score)
        order = np.lexsort((c, -value, r))
        r, c, score, value = r[order], c[order], score[order], value[order]
        first = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (value[1:] != value[:-1])]) if len(r) else np.empty(0, np.int64)
        kept = np.arange(len(r)) - np.repeat(first, np.diff(np.r_[first, len(r)])) < k
        out.append((here[r[kept]], c[kept], score[kept]))
    q, c, score = (np.concatenate(x) for x in zip(*out))
    return pa.table([query["query_id"].take(pa.array(q)), documents["doc_id"].take(pa.array(c)), pa.array(score, mask=score == -np.inf)], ["query_id", "doc_id", "score"])


def dense_top(queries: DataFrame, documents: DataFrame, k: int, digits: int = 9, block: int = 1 << 14) -> DataFrame:
    """The k documents (doc_id, vector) of the largest cosine for each query (query_id, vector), itself left out: exact.

    Queries and documents are dealt into blocks of about `block`, and each block of one meets each of the other once, by
    products of matrices; of a meeting only what can be among the k best leaves its task. Scores are rounded before they
    are ranked; vectors without a length score 0, and those of different widths null.
    """
    q = queries.select("query_id", F.col("vector").cast("array<double>").alias("q")).where("query_id IS NOT NULL")
    d = documents.select("doc_id", F.col("vector").cast("array<double>").alias("d")).where("doc_id IS NOT NULL")
    of_q, of_d = (max(1, -(-x.count() // block)) for x in (q, d))
    part = lambda id_col, n: F.pmod(F.xxhash64(id_col), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = q.select("query_id", "q", part("query_id", of_q).alias("qb"), every(of_d).alias("db"))
    right = d.select("doc_id", "d", part("doc_id", of_d).alias("db"), every(of_q).alias("qb"))
    schema = StructType([q.schema["query_id"], d.schema["doc_id"], StructField("score", DoubleType())])
    margin = 2 * 10.0**-digits + 1e-12

    def meet(some: pa.Table, others: pa.Table) -> pa.Table:
        if not len(some) or not len(others):
            return pa.table([some["query_id"].slice(0, 0), others["doc_id"].slice(0, 0), pa.array([], pa.float64())], ["query_id", "doc_id", "score"])
        with np.errstate(all="ignore"):
            return _best(some, others, k, margin)

    met = left.groupBy("qb", "db").cogroup(right.groupBy("qb", "db")).applyInArrow(meet, schema)
    return top(met.select("query_id", "doc_id", F.round("score", digits).alias("score")), k)


def fuse(tfidf: Column, dense: Column, alpha: float) -> Column:
    return F.lit(alpha) * tfidf + F.lit(1 - alpha) * dense


def unit_range(score: Column, window: Window) -> Column:
    """Min-max over a window; 0.5 where it is flat."""
    low, high = F.min(score).over(window), F.max(score).over(window)
    return F.when(high > low, (score - low) / (high - low)).otherwise(0.5)


def with_quality(scores: DataFrame, quality: DataFrame, weight: float = 0.5) -> DataFrame:
    """(query_id, doc_id, score, quality) joined, with final = (1 - weight) * score's min-max over the query + weight * quality; null without a quality."""
    own = Window.partitionBy("query_id")
    return scores.join(quality, "doc_id", "left").withColumn("final", (1 - weight) * unit_range(F.col("score"), own) + weight * F.col("quality"))


def quality_top(scores: DataFrame, queries: DataFrame, documents: DataFrame, quality: DataFrame, k: int, weight: float = 0.5, digits: int = 12) -> DataFrame:
    """top() by final of with_quality() over every pair of queries and documents, scores >= 0 and 0 where they lack a pair, without making all pairs.

    A document without a score goes after those of its query that have a better quality, so only the k of best quality
    can be among the k best. final is rounded to digits before it is ranked, and those k are chosen by the rounded share.
    """
    every = documents.select("doc_id").distinct().join(quality.select("doc_id", "quality"), "doc_id", "left")
    first = every.orderBy(F.round(weight * F.col("quality"), digits).desc_nulls_last(), "doc_id").limit(k)
    n = every.agg(F.count("*").alias("__n"))
    own = Window.partitionBy("query_id")
    pairs = filled(scores, queries, first).crossJoin(F.broadcast(n))
    low = F.when(F.count_if("scored").over(own) < F.col("__n"), 0.0).otherwise(F.min("score").over(own))
    high = F.max("score").over(own)
    unit = F.when(high > low, (F.col("score") - low) / (high - low)).otherwise(0.5)
    both = pairs.withColumn("__unit", unit).join(quality.select("doc_id", "quality"), "doc_id", "left")
    final = F.round((1 - weight) * F.col("__unit") + weight * F.col("quality"), digits)
    return top(both.withColumn("final", final).drop("scored", "__n", "__unit"), k, "final")


def top(scores: DataFrame, k: int, score: str = "score", by: str = "query_id", id_col: str = "doc_id") -> DataFrame:
    """The k best of each query with rank from 1: nulls last, ties by id."""
    order = Window.partitionBy(by).orderBy(F.col(score).desc_nulls_last(), F.col(id_col))
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def collapse(ranked: DataFrame, entity: str, k: int, by: str = "query_id") -> DataFrame:
    """Of each query the best row of every entity, ranked anew; rows without an entity all stay."""
    own = Window.partitionBy(by, F.coalesce(F.col(entity).cast("string"), F.concat(F.lit("\x00"), F.col("doc_id").cast("string")))).orderBy("rank")
    first = ranked.withColumn("__k", F.row_number().over(own)).where("__k = 1").drop("__k")
    return first.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy("rank"))).where(F.col("rank") <= k)
