import numpy as np
import pytest
from pyspark.sql import functions as F

from inkwell.functions.text import preprocess
from inkwell.operators import articles, catalogue, evaluate, features, impute, resolve, retrieval, topsis, upsert


def test_outliers_golden(spark):
    df = spark.createDataFrame([(float(x),) for x in (100, 110, 120, 105, 115, 95, 10000)], "v double")
    assert [r["v"] for r in features.outliers(df, "v").where("outlier").collect()] == [10000.0]


def test_scaling_without_spread(spark):
    out = features.scale(spark.createDataFrame([(1.0, 2.0), (None, 2.0), (3.0, 2.0)], "a double, b double"), ["a", "b"])
    assert [r["b_zscore"] for r in out.collect()] == [0.0] * 3
    assert sorted(r["a_minmax"] for r in out.collect() if r["a_minmax"] is not None) == [0.0, 1.0]


def test_one_hot(spark):
    out = features.one_hot(spark.createDataFrame([("CO", "CC BY"), (None, "CC BY"), ("BR", None)], "pais_iso string, licencia string"), ["pais_iso", "licencia"])
    assert out.columns == ["pais_iso_BR", "pais_iso_CO", "licencia_CC BY"]
    assert all(r["pais_iso_BR"] + r["pais_iso_CO"] <= 1 for r in out.collect())


def test_topsis_against_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.random((40, 4))
    rows = [(i, *(None if j == 1 and i % 7 == 0 else float(v) for j, v in enumerate(r))) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, d double")
    got = {r["id"]: r["topsis_1"] for r in topsis.topsis(df, {"quality": ["a", "b"], "cost": ["c"], "efficiency": ["d"]}, ["c"], orders=[("cost", "quality", "efficiency")]).collect()}
    m = np.array([[np.nan if v is None else v for v in r[1:]] for r in rows])
    m = np.where(np.isnan(m), np.nanmedian(m, axis=0), m)
    u = (m - m.min(0)) / (m.max(0) - m.min(0))
    u[:, 2] = 1 - u[:, 2]
    u = u * np.array([2, 2, 3, 1]) / 6
    lo, hi = np.sqrt(((u - u.min(0)) ** 2).sum(1)), np.sqrt(((u - u.max(0)) ** 2).sum(1))
    assert np.allclose([got[i] for i in range(40)], lo / (lo + hi))
    with pytest.raises(ValueError):
        topsis.rank_weights(("quality", "cost", "cost"))


def test_topsis_null_fee_has_no_index(spark):
    df = spark.createDataFrame([(1, 0.5, 10.0), (2, 0.9, None), (3, 0.1, 30.0)], "id int, q double, fee double")
    got = {r["id"]: r["topsis_1"] for r in topsis.topsis(df, {"quality": ["q"], "cost": ["fee"]}, ["fee"], "fee").collect()}
    assert got[2] is None and 0 <= got[1] <= 1 and topsis.topsis(df.limit(0), {"quality": ["q"]}).count() == 0


def test_ridge_against_numpy(spark):
    rng = np.random.default_rng(1)
    rows = [(float(a), "xy"[i % 2], float(100 + 50 * a + 20 * (i % 2) + rng.normal())) for i, a in enumerate(rng.random(60))]
    df = spark.createDataFrame([(a, g, None if i % 6 == 0 else y) for i, (a, g, y) in enumerate(rows)], "a double, g string, y double")
    _, w = impute.ridge(df, "y", ["a"], ["g"])
    known = [(a, g, y) for i, (a, g, y) in enumerate(rows) if i % 6]
    x = np.array([[1, a, g == "y"] for a, g, _ in known], float)
    assert np.allclose(w, np.linalg.solve(x.T @ x + np.diag([0, 1, 1]), x.T @ np.array([y for *_, y in known])))
    out = impute.impute(df, "y", ["a"], ["g"], [["g"], []])
    assert out.where("imputed").count() == 10 and out.where("y IS NULL").count() == 0


def test_openapc_overrides_declared(spark):
    df = spark.createDataFrame([(100.0, "declarado", 150.0, "observado")], "apc_monto_usd double, apc_tipo string, apc_monto_usd_openapc double, apc_tipo_openapc string")
    cols = ["apc_monto_usd", "apc_tipo"]
    assert tuple(resolve.coalesce_suffixes(df, ["openapc"], {"openapc": cols}).first()) == (150.0, "observado")
    assert tuple(resolve.coalesce_suffixes(df, ["openapc"]).first()) == (100.0, "declarado")


def test_match_stages(spark):
    base = spark.createDataFrame([(1, "A", "uno dos"), (2, None, "tres cuatro"), (3, None, "cinco seis siete"), (4, "B", None)], "row_idx long, issn string, title string")
    source = spark.createDataFrame([(10, "A", "x"), (11, "Z", "tres cuatro"), (12, "Y", "cinco seis siete ocho"), (13, "X", "tres cuatro")], "row_idx long, issn string, title string")
    for scorer in ("wratio", "jaccard"):
        got = {(r["base_row"], r["source_row"], r["match"]) for r in resolve.match(base, source, "issn", "title", "row_idx", scorer, 70.0).collect()}
        assert got == {(1, 10, "key"), (2, 11, "title"), (3, 12, "fuzzy")}


def test_metrics_golden(spark):
    ranked = spark.createDataFrame([("q", "a", 1), ("q", "b", 2), ("q", "c", 3)], "query_id string, item_id string, rank int")
    relevant = spark.createDataFrame([("q", "b", 1.0), ("q", "c", 1.0)], "query_id string, item_id string, rel double")
    two, one = evaluate.at_k(ranked, relevant, 2).first(), evaluate.at_k(ranked, relevant, 1).first()
    assert (two["precision"], two["recall"], two["f1"], one["hit"], two["hit"]) == (0.5, 0.5, 0.5, 0.0, 1.0)
    whole = evaluate.over_ranking(ranked, relevant).first()
    assert whole["ap"] == pytest.approx(0.5833, abs=1e-4) and whole["rr"] == 0.5


def test_alpha_prefers_the_lowest(spark):
    scores = spark.createDataFrame([("q", "a", 0.9, 0.9), ("q", "b", 0.1, 0.1)], "query_id string, item_id string, tfidf double, dense double")
    relevant = spark.createDataFrame([("q", "a", 1.0)], "query_id string, item_id string, rel double")
    assert evaluate.best_alpha(evaluate.alpha_grid(scores, relevant, "mrr")) == 0.0


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1, False), ("b", 2, True), ("c", 3, False), ("d", 4, True)], "key string, v int, modified boolean")
    new = spark.createDataFrame([("a", 10), ("b", 20), ("e", 50)], "key string, v int")
    actions = {r["key"]: r["action"] for r in upsert.plan_upsert(old, new, ["key"]).collect()}
    assert actions == {"a": "update", "b": "protected", "c": "prune", "d": "keep", "e": "create"}
    state = upsert.upsert(old, new, ["key"])
    again = upsert.plan_upsert(state, new, ["key"])
    assert sorted(map(tuple, state.collect())) == [("a", 10, False), ("b", 2, True), ("d", 4, True), ("e", 50, False)]
    assert again.where("action IN ('create', 'prune')").count() == 0


def test_filters_round_trip():
    f = catalogue.Filters("redes", ("IoT",), ("Inglés",), "sin_costo", 1.0, None, 12.0, {"quartile": ("Q1", "Q2")}, {"h_index": 5.0})
    assert catalogue.Filters.from_query(f.to_query()) == f and f.active() == 8
    with pytest.raises(ValueError):
        catalogue.Filters(apc_status="x")
    with pytest.raises(ValueError):
        catalogue.Filters(apc_min=-1)


def test_articles(spark):
    text = "REVISTA\nUn título bastante largo de prueba\nAutor\nResumen: " + "palabra " * 20 + "\nPalabras clave: redes, datos.\nAbstract: " + "word " * 20 + "\nKeywords: nets.\nIntroduction\fREVISTA\n2\fREVISTA\n3"
    df = spark.createDataFrame([(1, text, "0124-5376"), (2, "corto", None), (3, "largo " * 60, None), (4, None, None)], "id long, text string, issn string")
    got = sorted(articles.extract(df, "id", "text", "issn").collect(), key=lambda r: (r["id"], r["language"]))
    assert [(r["id"], r["language"], r["how"]) for r in got] == [(1, "en", "marcadores"), (1, "es", "marcadores"), (3, "desconocido", "respaldo_sin_marcadores")]
    assert got[1]["title"] == "Un título bastante largo de prueba" and got[1]["keywords"] == "redes, datos"
    assert articles.normalize(articles.extract(df, "id", "text", "issn")).where(F.col("n_tokens") > 0).count() == 3


def test_best_without_all_pairs(spark):
    """The k best of matching pairs and fillers are the k best of the whole product, ties and missing qualities included."""
    rng = np.random.default_rng(3)
    pairs = {(int(q), f"d{int(d):02}"): float(s) for q, d, s in zip(rng.integers(0, 12, 90), rng.integers(0, 30, 90), rng.integers(0, 4, 90) / 4)}
    pairs |= {(12, f"d{d:02}"): 0.5 for d in range(30)}  # flat, and no pair lacks a score
    scores = spark.createDataFrame([(q, d, s) for (q, d), s in pairs.items()], "query_id long, doc_id string, score double")
    queries = spark.range(15).withColumnRenamed("id", "query_id")
    documents = spark.createDataFrame([(f"d{d:02}",) for d in range(30)], "doc_id string")
    quality = spark.createDataFrame([(f"d{d:02}", None if d % 7 == 3 else (d * 5 % 8) / 8) for d in range(28)], "doc_id string, quality double")
    rows = lambda df, c: sorted((r["query_id"], r["rank"], r["doc_id"], r[c]) for r in df.collect())
    for k in (1, 4, 40):
        every = retrieval.all_pairs(scores, queries, documents)
        assert rows(retrieval.top_of_all(scores, queries, documents, k), "score") == rows(retrieval.top(every, k), "score")
        final = retrieval.with_quality(every, quality).withColumn("final", F.round("final", 12))
        assert [x[:3] for x in rows(retrieval.quality_top(scores, queries, documents, quality, k), "final")] == [x[:3] for x in rows(retrieval.top(final, k, "final"), "final")]
    empty = scores.limit(0)
    assert retrieval.top_of_all(empty, queries, documents, 2).count() == 30 and retrieval.top_of_all(empty, queries, documents.limit(0), 2).count() == 0


def test_dense_top_against_numpy(spark):
    v = np.random.default_rng(4).normal(size=(50, 6))
    v[7] = 0
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "doc_id long, vector array<double>")
    got = retrieval.dense_top(df.where("doc_id < 10").withColumnRenamed("doc_id", "query_id"), df, 3, block=7)
    n = np.linalg.norm(v, axis=1)
    cos = np.round(np.divide(v @ v.T, np.outer(n, n), out=np.zeros((50, 50)), where=np.outer(n, n) > 0), 9)
    want = {q: sorted((d for d in range(50) if d != q), key=lambda d: (-cos[q, d], d))[:3] for q in range(10)}
    found = {q: [d for _, d in sorted((r["rank"], r["doc_id"]) for r in got.collect() if r["query_id"] == q)] for q in range(10)}
    assert found == want


def plain_dense_top(queries, documents, k):
    """Every pair, by column expressions."""
    q, d = queries.withColumnRenamed("vector", "q"), documents.withColumnRenamed("vector", "d")
    score = F.round(retrieval.dense_cosine(F.col("q"), F.col("d")), 9)
    return retrieval.top(q.join(d, F.expr("query_id <> doc_id")).select("query_id", "doc_id", score.alias("score")), k)


def test_dense_top_of_odd_vectors(spark):
    """Nulls, other widths, no length, huge and tiny ones, copies and repeated ids score as the column expressions do."""
    v = np.random.default_rng(5).normal(size=(40, 4)).tolist()
    odd = [None, [], [0.0] * 4, [1.0, None, 0.0, 0.0], [float("nan"), 1.0, 0.0, 0.0], [float("inf"), 1.0, 0.0, 0.0], [1e200] * 4, [1e-200] * 4, [1e-160, 0.0, 0.0, 1e-170], [1.0, 2.0], [0.0, 0.0], v[3], v[3], v[3]]
    rows = list(enumerate(v + odd)) + [(3, v[3]), (None, v[3]), (41, v[1])]
    df = spark.createDataFrame(rows, "doc_id long, vector array<double>")
    queries = df.withColumnRenamed("doc_id", "query_id")
    for k, block in ((3, 7), (60, 1 << 14)):
        got, want = (sorted(str((r["query_id"], r["rank"], r["score"], r["doc_id"])) for r in x.collect()) for x in (retrieval.dense_top(queries, df, k, block=block), plain_dense_top(queries, df, k)))
        assert got == want
    names = df.select(F.col("doc_id").cast("string").alias("doc_id"), "vector")
    got, want = (sorted(str(tuple(r)) for r in x.collect()) for x in (retrieval.dense_top(names.withColumnRenamed("doc_id", "query_id"), names, 4), plain_dense_top(names.withColumnRenamed("doc_id", "query_id"), names, 4)))
    assert got == want
    assert retrieval.dense_top(queries.limit(0), df, 3).count() == retrieval.dense_top(queries, df.limit(0), 3).count() == 0


def test_dense_top_does_not_send_all_pairs(spark):
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.array(F.sin("id"), F.cos("id"), F.sin(F.col("id") * F.col("id"))).alias("vector"))
    out = retrieval.dense_top(df.withColumnRenamed("doc_id", "query_id"), df, 5, block=100)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "ProductJoin" not in plan and "NestedLoop" not in plan and "HashJoin" not in plan and "MergeJoin" not in plan
    assert out.count() == 2000


def test_prepared_terms(spark):
    texts = spark.createDataFrame([(1, "Redes neuronales co-authoring -datos- $x$ redes a b2b"), (1, "las redes"), (2, None), (3, "")], "id long, text string")
    want = retrieval.terms(texts.select("id", preprocess(F.col("text")).alias("p")), "id", "p")
    assert sorted(map(tuple, retrieval.prepared_terms(texts, "id", "text").collect())) == sorted(map(tuple, want.collect()))


def test_split_share(spark):
    ids = spark.range(1003)
    out = evaluate.split(ids, "id")
    first = {r[0] for r in ids.orderBy(F.xxhash64(F.lit(42), "id"), "id").limit(201).collect()}
    assert {r["id"] for r in out.where("test").collect()} == first and out.count() == 1003
    assert evaluate.split(ids.limit(0), "id").count() == 0 and evaluate.split(ids.limit(1), "id").first()["test"]
    assert evaluate.split(spark.createDataFrame([(None,)], "id string"), "id").first()["test"]


def test_medians_of_strata_with_nulls(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 3.0), ("x", None), (None, 10.0), (None, None), ("z", None)], "g string, y double")
    got = impute.impute(df, "y", [], [], [["g"], []])
    assert sorted((str(r["g"]), r["y"]) for r in got.where("imputed").collect()) == [("None", 10.0), ("x", 2.0), ("z", 3.0)]
    bare = impute.impute(df.limit(0), "y", [], [], [["g"], []])
    assert bare.count() == 0
