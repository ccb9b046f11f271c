"""Retrieval, TOPSIS and evaluation on the driver's tables: documents as papers, their sources as journals, benchmark passages as manuscripts."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.functions import text
from inkwell.operators import articles, corpus, evaluate, retrieval, topsis
from inkwell.plans.registered import query, t
from inkwell.plans.scalar_queries import PREPROCESSED, TITLE_SQL
from inkwell.staging import stored

ORDERS = [("quality", "cost", "efficiency"), ("cost", "efficiency", "quality")]

# --- token bags and languages


@query(f"WITH p AS (SELECT doc_id, source, lang, {PREPROCESSED('text')} AS tokens FROM documents) SELECT source, count(DISTINCT doc_id) AS n_articles, string_agg(DISTINCT lang, ',' ORDER BY lang) AS languages, md5(string_agg(tokens, ' ' ORDER BY doc_id)) AS tokens, CAST(len(list_distinct(string_split(string_agg(tokens, ' ' ORDER BY doc_id), ' '))) AS INTEGER) AS n_distinct FROM p GROUP BY source")
def token_bag(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", "source", F.col("lang").alias("language"), text.preprocess(F.col("text")).alias("tokens"))
    return articles.token_bags(d, "source", "doc_id").withColumn("tokens", F.md5("tokens"))


HINTS = lambda words: ", ".join(f"'{w}'" for w in words)


@query(
    f"""WITH f AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'English' WHEN doc_id % 5 = 1 THEN 'Spanish; English' WHEN doc_id % 5 = 2 THEN 'castellano' END AS langs, string_split({TITLE_SQL.format(x="lower(trim(text))")}, ' ') AS w FROM documents),
    h AS (SELECT doc_id, langs, len(w) AS n, len(list_filter(w, lambda x: x IN ({HINTS(text.HINTS_ES)}))) AS es, len(list_filter(w, lambda x: x IN ({HINTS(text.HINTS_EN)}))) AS en FROM f)
    SELECT doc_id, CASE WHEN n > 0 THEN CASE WHEN es > en THEN 'es' WHEN en > es THEN 'en' WHEN doc_id % 5 = 2 THEN 'es' WHEN doc_id % 5 = 0 THEN 'en' END END AS vote FROM h"""
)
def language_vote(spark, sf):
    langs = F.expr("CASE WHEN doc_id % 5 = 0 THEN 'English' WHEN doc_id % 5 = 1 THEN 'Spanish; English' WHEN doc_id % 5 = 2 THEN 'castellano' END")
    return t(spark, sf, "documents").select("doc_id", text.language_vote(F.col("text"), langs).alias("vote"))


@query()
def lang_split(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", F.col("text").alias("titulo_normalizado"), F.col("lang").alias("gran_area"), F.lit("English").alias("idiomas"))
    return corpus.bilingual(d).select("doc_id", "texto_espanol", "texto_ingles", "tokens_espanol", "tokens_ingles")


@query()
def article_extract(spark, sf):
    d = t(spark, sf, "documents")
    issue = F.concat_ws("\n", F.lit("REVISTA EJEMPLAR"), F.substring("text", 1, 60), F.lit("Autor A"), F.lit("Resumen:"), F.substring("text", 1, 300), F.lit("Palabras clave: redes, datos."), F.lit("Abstract: "), F.substring("text", 100, 300), F.lit("Keywords: networks; data."), F.lit("Introducción"), F.col("text"))
    whole = F.when(F.col("doc_id") % 10 == 0, F.col("text")).otherwise(F.concat_ws("\f", issue, F.lit("REVISTA EJEMPLAR\n2"), F.lit("REVISTA EJEMPLAR\n3")))
    return articles.normalize(articles.extract(d.select("doc_id", whole.alias("text"), F.col("source")), "doc_id", "text", "source"))


# --- TF-IDF: sources are documents

TERMS = r"""WITH j AS (SELECT source AS id, unnest(regexp_extract_all(lower(p), '\b\w[\w-]+\b')) AS term FROM (SELECT source, """ + PREPROCESSED("text") + r""" AS p FROM documents)),
tf AS (SELECT id, term, count(*) AS tf FROM j GROUP BY id, term), n AS (SELECT count(DISTINCT source) AS n FROM documents),
idf AS (SELECT term, count(*) AS df, ln((1 + (SELECT n FROM n)) / CAST(1 + count(*) AS DOUBLE)) + 1 AS idf FROM tf GROUP BY term),
w AS (SELECT id, term, tf * idf AS w FROM tf JOIN idf USING (term)), dn AS (SELECT id, sqrt(sum(w * w)) AS norm FROM w GROUP BY id), d AS (SELECT w.id, term, w / norm AS weight FROM w JOIN dn USING (id)),
qt AS (SELECT item_id AS id, unnest(regexp_extract_all(lower(p), '\b\w[\w-]+\b')) AS term FROM (SELECT item_id, """ + PREPROCESSED("text") + r""" AS p FROM benchmark)),
qtf AS (SELECT id, term, count(*) AS tf FROM qt GROUP BY id, term), qw AS (SELECT id, term, tf * idf AS w FROM qtf JOIN idf USING (term)), qn AS (SELECT id, sqrt(sum(w * w)) AS norm FROM qw GROUP BY id),
q AS (SELECT qw.id, term, w / norm AS weight FROM qw JOIN qn USING (id)),
s AS (SELECT q.id AS query_id, d.id AS doc_id, sum(q.weight * d.weight) AS score FROM q JOIN d USING (term) GROUP BY 1, 2),
every AS (SELECT item_id AS query_id, j.source AS doc_id, round(coalesce(score, 0), 9) AS score FROM benchmark CROSS JOIN (SELECT DISTINCT source FROM documents) j LEFT JOIN s ON s.query_id = item_id AND s.doc_id = j.source)"""
QUALITY = """l AS (SELECT source, avg(quality) AS q1, 1 - avg(toxic) AS q2 FROM documents JOIN labels USING (doc_id) GROUP BY source), b AS (SELECT source, avg(n_chars) AS e, count(*) AS c FROM documents GROUP BY source),
m AS (SELECT b.source AS doc_id, q1, q2, c, e FROM b LEFT JOIN l USING (source)), md AS (SELECT median(q1) AS a, median(q2) AS b, median(c) AS c, median(e) AS d FROM m),
x AS (SELECT doc_id, coalesce(q1, a, 0) AS x1, coalesce(q2, b, 0) AS x2, CAST(m.c AS DOUBLE) AS x3, m.e AS x4 FROM m, md), r AS (SELECT min(x1) AS a1, max(x1) AS b1, min(x2) AS a2, max(x2) AS b2, min(x3) AS a3, max(x3) AS b3, min(x4) AS a4, max(x4) AS b4 FROM x),
u AS (SELECT doc_id, CASE WHEN b1 > a1 THEN (x1 - a1) / (b1 - a1) ELSE 0 END AS u1, CASE WHEN b2 > a2 THEN (x2 - a2) / (b2 - a2) ELSE 0 END AS u2, 1 - CASE WHEN b3 > a3 THEN (x3 - a3) / (b3 - a3) ELSE 0 END AS u3, CASE WHEN b4 > a4 THEN (x4 - a4) / (b4 - a4) ELSE 0 END AS u4 FROM x, r),
i AS (SELECT min(u1) AS l1, max(u1) AS h1, min(u2) AS l2, max(u2) AS h2, min(u3) AS l3, max(u3) AS h3, min(u4) AS l4, max(u4) AS h4 FROM u),
dist AS (SELECT doc_id, pow(u1 - l1, 2) + pow(u2 - l2, 2) AS ql, pow(u1 - h1, 2) + pow(u2 - h2, 2) AS qh, pow(u3 - l3, 2) AS cl, pow(u3 - h3, 2) AS ch, pow(u4 - l4, 2) AS el, pow(u4 - h4, 2) AS eh FROM u, i)"""


def _topsis_sql(order) -> str:
    w = topsis.rank_weights(order)
    far = {n: f"sqrt({w['quality'] ** 2}::DOUBLE * q{n} + {w['cost'] ** 2}::DOUBLE * c{n} + {w['efficiency'] ** 2}::DOUBLE * e{n})" for n in "lh"}
    return f"CASE WHEN {far['l']} + {far['h']} = 0 THEN 0.5 ELSE {far['l']} / ({far['l']} + {far['h']}) END"


def _journal_terms(spark, sf):
    """Terms of each source: counted per document, so no journal's whole text is ever one value."""
    d = t(spark, sf, "documents").select("source", "text")
    # Several steps read the counts; stored, they are counted once.
    return stored(retrieval.prepared_terms(d, "source", "text")), d.select("source").distinct()


def _scores(spark, sf):
    """(scores, queries, documents): the cosines of the pairs that share a term, and the ids of either side."""
    terms, journals = _journal_terms(spark, sf)
    idf = retrieval.fit_idf(terms, journals)
    b = t(spark, sf, "benchmark").select("item_id", "text")
    queries = retrieval.weigh(retrieval.prepared_terms(b, "item_id", "text"), idf)
    scores = retrieval.cosine(queries, retrieval.weigh(terms, idf)).withColumn("score", F.round("score", 9))
    return scores, b.select(F.col("item_id").alias("query_id")), journals.select(F.col("source").alias("doc_id"))


def _metrics(spark, sf):
    d, labels = t(spark, sf, "documents").select("doc_id", "source", "n_chars"), t(spark, sf, "labels")
    judged = d.join(labels, "doc_id").groupBy("source").agg(F.avg("quality").alias("q1"), (1 - F.avg("toxic")).alias("q2"))
    return d.groupBy("source").agg(F.count("*").alias("c"), F.avg("n_chars").alias("e")).join(judged, "source", "left").withColumnRenamed("source", "doc_id")


def _quality(spark, sf, orders=None):
    return topsis.topsis(_metrics(spark, sf), {"quality": ["q1", "q2"], "cost": ["c"], "efficiency": ["e"]}, ["c"], orders=orders)


@query(f"{TERMS} SELECT id, count(*) AS terms, CAST(sum(tf) AS BIGINT) AS tokens, round(sum(weight * weight), 9) AS norm FROM d JOIN tf USING (id, term) GROUP BY id")
def tfidf_terms(spark, sf):
    terms, journals = _journal_terms(spark, sf)
    weights = retrieval.weigh(terms, retrieval.fit_idf(terms, journals))
    return weights.join(terms, ["id", "term"]).groupBy("id").agg(F.count("*").alias("terms"), F.sum("tf").alias("tokens"), F.round(F.sum(F.col("weight") * F.col("weight")), 9).alias("norm"))


@query(f"{TERMS} SELECT query_id, doc_id, CAST(k AS INTEGER) AS rank, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS k FROM every) WHERE k <= 5")
def tfidf_cosine_topk(spark, sf):
    return retrieval.top_of_all(*_scores(spark, sf), 5).select("query_id", "doc_id", "rank", F.round("score", 6).alias("score"))


@query(f"{TERMS} SELECT a.id AS query_id, b.id AS doc_id, round(sum(a.weight * b.weight), 6) AS score FROM d a JOIN d b ON a.term = b.term AND a.id <> b.id GROUP BY 1, 2")
def journal_similarity(spark, sf):
    terms, journals = _journal_terms(spark, sf)
    weights = retrieval.weigh(terms, retrieval.fit_idf(terms, journals))
    return retrieval.cosine(weights, weights).where("query_id <> doc_id").select("query_id", "doc_id", F.round("score", 6).alias("score"))


@query("SELECT query_id, vec_id, rank, round(score, 6) AS score FROM (SELECT a.vec_id AS query_id, b.vec_id, round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) / (sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])) * sqrt(list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[]))), 9) AS score, CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) / (sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])) * sqrt(list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[]))), 9) DESC, b.vec_id) AS INTEGER) AS rank FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id AND a.vec_id % 20 = 0) WHERE rank <= 5")
def dense_cosine_topk(spark, sf):
    """Stated queries, the ids divisible by 20, against all rows, block by block."""
    e = t(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))
    found = retrieval.dense_top(e.where("doc_id % 20 = 0").withColumnRenamed("doc_id", "query_id"), e, 5)
    return found.select("query_id", F.col("doc_id").alias("vec_id"), "rank", F.round("score", 6).alias("score"))


@query(f"{TERMS} SELECT query_id, doc_id, CAST(k AS INTEGER) AS rank, round(fused, 6) AS fused FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY fused DESC, doc_id) AS k FROM (SELECT query_id, doc_id, round(0.8::DOUBLE * score + 0.2::DOUBLE * (query_id % 7 + length(doc_id)) / 20, 9) AS fused FROM every)) WHERE k <= 3")
def thematic_fused_topk(spark, sf):
    dense = (F.col("query_id") % 7 + F.length("doc_id")) / 20  # a second score that every pair has
    fused = retrieval.all_pairs(*_scores(spark, sf)).select("query_id", "doc_id", F.round(retrieval.fuse(F.col("score"), dense, 0.8), 9).alias("fused"))
    return retrieval.top(fused, 3, "fused").select("query_id", "doc_id", "rank", F.round("fused", 6).alias("fused"))


@query(f"WITH {QUALITY} SELECT doc_id AS source, round({_topsis_sql(ORDERS[0])}, 6) AS topsis_1 FROM dist")
def topsis_index(spark, sf):
    return _quality(spark, sf, ORDERS[:1]).select(F.col("doc_id").alias("source"), F.round("topsis_1", 6).alias("topsis_1"))


@query(f"WITH {QUALITY} SELECT doc_id AS source, " + ", ".join(f"round({_topsis_sql(o)}, 6) AS topsis_{k}" for k, o in enumerate(__import__("itertools").permutations(topsis.DIMENSIONS), 1)) + " FROM dist")
def topsis_all_orders(spark, sf):
    return _quality(spark, sf).select(F.col("doc_id").alias("source"), *(F.round(f"topsis_{k}", 6).alias(f"topsis_{k}") for k in range(1, 7)))


@query(
    f"""{TERMS}, {QUALITY}, qc AS (SELECT doc_id, {_topsis_sql(ORDERS[0])} AS quality FROM dist),
    f AS (SELECT query_id, doc_id, round(0.5::DOUBLE * CASE WHEN max(score) OVER p > min(score) OVER p THEN (score - min(score) OVER p) / (max(score) OVER p - min(score) OVER p) ELSE 0.5 END + 0.5::DOUBLE * quality, 8) AS final FROM every LEFT JOIN qc USING (doc_id) WINDOW p AS (PARTITION BY query_id))
    SELECT query_id, doc_id, CAST(k AS INTEGER) AS rank, round(final, 6) AS final FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY final DESC NULLS LAST, doc_id) AS k FROM f) WHERE k <= 10"""
)
def quality_thematic_topk(spark, sf):
    """The recommendation: thematic similarity and the quality-cost index, half and half."""
    quality = _quality(spark, sf, ORDERS[:1]).select("doc_id", F.col("topsis_1").alias("quality"))
    return retrieval.quality_top(*_scores(spark, sf), quality, 10, digits=8).select("query_id", "doc_id", "rank", F.round("final", 6).alias("final"))


@query(f"{TERMS}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS k FROM every), e AS (SELECT *, CASE WHEN right(doc_id, 1) <> '7' THEN left(doc_id, 4) END AS entity FROM r WHERE k <= 15), c AS (SELECT *, row_number() OVER (PARTITION BY query_id, coalesce(entity, doc_id || '!') ORDER BY k) AS n FROM e) SELECT query_id, doc_id, entity, CAST(rank AS INTEGER) AS rank FROM (SELECT query_id, doc_id, entity, row_number() OVER (PARTITION BY query_id ORDER BY k) AS rank FROM c WHERE n = 1) WHERE rank <= 5")
def topn_collapse(spark, sf):
    ranked = retrieval.top_of_all(*_scores(spark, sf), 15).withColumn("entity", F.expr("CASE WHEN right(doc_id, 1) <> '7' THEN left(doc_id, 4) END"))
    return retrieval.collapse(ranked, "entity", 5).select("query_id", "doc_id", "entity", "rank")


# --- evaluation: rankings and judgements from orders

RUNS = "SELECT o_custkey % 50 AS query_id, o_orderkey AS item_id, CAST(row_number() OVER (PARTITION BY o_custkey % 50 ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank FROM orders"
RELS = "SELECT o_custkey % 50 AS query_id, o_orderkey AS item_id, CAST(1 + o_orderkey % 3 AS DOUBLE) AS rel FROM orders WHERE o_orderkey % 17 = 0 AND o_custkey % 50 < 45"


def _runs(spark, sf):
    t(spark, sf, "orders").createOrReplaceTempView("inkwell_orders")
    return tuple(spark.sql(q.replace("FROM orders", "FROM inkwell_orders")) for q in (RUNS, RELS))


AT = f"""WITH r AS ({RUNS}), g AS ({RELS}), h AS (SELECT g.query_id, sum(CASE WHEN rank <= 10 THEN 1 ELSE 0 END)::DOUBLE AS hits, sum(CASE WHEN rank <= 10 THEN (pow(2, rel) - 1) / log2(rank + 1) ELSE 0 END) AS dcg, count(*)::DOUBLE AS n FROM g LEFT JOIN r ON g.query_id = r.query_id AND g.item_id = r.item_id GROUP BY 1),
i AS (SELECT query_id, sum(CASE WHEN k <= 10 THEN (pow(2, rel) - 1) / log2(k + 1) ELSE 0 END) AS best FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rel DESC, item_id) AS k FROM g) GROUP BY 1)"""


@query(f"{AT} SELECT query_id, hits / 10 AS precision, round(hits / n, 9) AS recall, round(CASE WHEN hits > 0 THEN 2 * (hits / 10) * (hits / n) / (hits / 10 + hits / n) ELSE 0 END, 9) AS f1, CASE WHEN hits > 0 THEN 1::DOUBLE ELSE 0 END AS hit FROM h")
def eval_precision_recall(spark, sf):
    return evaluate.at_k(*_runs(spark, sf), 10).select("query_id", "precision", F.round("recall", 9).alias("recall"), F.round("f1", 9).alias("f1"), "hit")


@query(f"{AT} SELECT query_id, round(dcg / best, 6) AS ndcg FROM h JOIN i USING (query_id)")
def eval_ndcg(spark, sf):
    return evaluate.at_k(*_runs(spark, sf), 10).select("query_id", F.round("ndcg", 6).alias("ndcg"))


@query(f"WITH r AS ({RUNS}), g AS ({RELS}), x AS (SELECT query_id, rank, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS k, count(*) OVER (PARTITION BY query_id) AS n FROM g JOIN r USING (query_id, item_id)) SELECT query_id, round(sum(k / rank::DOUBLE) / max(n), 6) AS ap, round(1 / min(rank)::DOUBLE, 6) AS rr FROM x GROUP BY query_id")
def eval_map_mrr(spark, sf):
    return evaluate.over_ranking(*_runs(spark, sf)).select("query_id", F.round("ap", 6).alias("ap"), F.round("rr", 6).alias("rr"))


@query(f"{AT} SELECT metric, k, round(value, 6) AS value FROM (SELECT 'precision' AS metric, 10 AS k, avg(hits / 10) AS value FROM h UNION ALL SELECT 'recall', 10, avg(hits / n) FROM h UNION ALL SELECT 'hit', 10, avg(CASE WHEN hits > 0 THEN 1::DOUBLE ELSE 0 END) FROM h UNION ALL SELECT 'ndcg', 10, avg(dcg / best) FROM h JOIN i USING (query_id))")
def eval_summary(spark, sf):
    out = evaluate.summary(*_runs(spark, sf), [10])
    return out.where(F.col("metric").isin("precision", "recall", "hit", "ndcg")).select("metric", "k", F.round("value", 6).alias("value"))


GRID = "SELECT o_custkey % 20 AS query_id, o_orderkey AS item_id, (o_orderkey * 7 % 101) / 100 AS tfidf, (o_orderkey * 13 % 89) / 88 AS dense FROM orders"


@query(
    f"""WITH s AS (SELECT query_id, item_id, tfidf::DOUBLE AS tfidf, dense::DOUBLE AS dense FROM ({GRID})), g AS (SELECT query_id, item_id, 1 AS rel FROM s WHERE item_id % 3 = 0),
    f AS (SELECT a / 10::DOUBLE AS alpha, query_id, item_id, row_number() OVER (PARTITION BY a, query_id ORDER BY round(a / 10::DOUBLE * tfidf + (1 - a / 10::DOUBLE) * dense, 12) DESC, item_id) AS k FROM s, (SELECT unnest(generate_series(0, 10)) AS a)),
    d AS (SELECT alpha, f.query_id, sum(1 / log2(k + 1)) AS dcg FROM f JOIN g USING (query_id, item_id) WHERE k <= 10 GROUP BY 1, 2),
    i AS (SELECT query_id, sum(1 / log2(k + 1)) AS best FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY item_id) AS k FROM g) WHERE k <= 10 GROUP BY 1)
    SELECT a.alpha, round(avg(coalesce(dcg, 0) / best), 6) AS value FROM (SELECT DISTINCT alpha, i.query_id, best FROM f, i) a LEFT JOIN d ON a.alpha = d.alpha AND a.query_id = d.query_id GROUP BY 1"""
)
def alpha_grid(spark, sf):
    t(spark, sf, "orders").createOrReplaceTempView("inkwell_orders")
    s = spark.sql(GRID.replace("FROM orders", "FROM inkwell_orders"))
    return evaluate.alpha_grid(s, s.where("item_id % 3 = 0").select("query_id", "item_id", F.lit(1.0).alias("rel"))).select("alpha", F.round("value", 6).alias("value"))


@query()
def split_ids(spark, sf):
    return evaluate.split(t(spark, sf, "documents").select("doc_id"), "doc_id")
