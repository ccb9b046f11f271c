"""Dedupe, resolution, features, reports and the catalogue on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.functions import text
from inkwell.functions.catalogue import filled
from inkwell.operators import catalogue, dedupe, features, impute, reports, resolve, upsert
from inkwell.plans.registered import query, t
from inkwell.plans.scalar_queries import FX, TITLE_SQL, _money

# --- dedupe and windows


@query("SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderkey % 10 <> 0 THEN year(o_orderdate) END DESC NULLS LAST, o_orderkey) AS k FROM orders) WHERE k = 1")
def keep_latest(spark, sf):
    o = t(spark, sf, "orders").withColumn("yr", F.expr("CASE WHEN o_orderkey % 10 <> 0 THEN year(o_orderdate) END"))
    return dedupe.keep_latest(o, "o_custkey", "yr", "o_orderkey").select("o_custkey", "o_orderkey", "o_orderdate")


@query("SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_orderkey * 10 + l_linenumber) AS k FROM lineitem) WHERE k = 1")
def keep_first(spark, sf):
    rows = t(spark, sf, "lineitem").withColumn("row", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return dedupe.keep_first(rows, ["l_partkey", "l_suppkey"], "row").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")


@query("SELECT k AS issn, o_orderkey FROM (SELECT CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END AS k, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders) WHERE k IS NULL OR n = 1")
def keyed_union_dedupe(spark, sf):
    o = t(spark, sf, "orders").select(F.expr("CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END").alias("issn"), "o_orderkey")
    return dedupe.keep_first_keyed(o, "issn", "o_orderkey")


@query("SELECT c_nationkey, c_custkey, n FROM (SELECT c_nationkey, c_custkey, n, row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, c_custkey) AS k FROM (SELECT c_nationkey, c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN 1 ELSE 0 END + CASE WHEN c_custkey % 5 <> 0 THEN 1 ELSE 0 END + 1 AS n FROM customer)) WHERE k = 1")
def most_complete(spark, sf):
    c = t(spark, sf, "customer").withColumn("n", filled(F.expr("CASE WHEN c_custkey % 3 <> 0 THEN c_name END"), F.expr("CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment ELSE '' END"), F.col("c_acctbal")))
    return dedupe.most_complete(c, "c_nationkey", F.col("n"), "c_custkey").select("c_nationkey", "c_custkey", "n")


@query("SELECT event_id, user_id, CAST(sum(b) OVER (PARTITION BY user_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cluster FROM (SELECT event_id, user_id, s, CASE WHEN s - lag(s) OVER (PARTITION BY user_id ORDER BY s) >= 6000 THEN 1 ELSE 0 END AS b FROM (SELECT event_id, user_id, CAST(floor(epoch(ts)) AS BIGINT) * 100000 + event_id % 100000 AS s0, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events))")
def gap_cluster(spark, sf):
    e = t(spark, sf, "events").withColumn("s", F.unix_timestamp(F.col("ts").cast("timestamp")))
    return dedupe.gap_clusters(e, ["user_id"], "s", 6000).select("event_id", "user_id", "cluster")


@query(r"""WITH p AS (SELECT doc_id, unnest(string_split(replace(text, '. ', chr(12)), chr(12))) AS body, unnest(generate_series(0, len(string_split(replace(text, '. ', chr(12)), chr(12))) - 1)) AS page FROM documents),
l AS (SELECT doc_id, page, trim(regexp_replace(unnest(string_split(body, chr(10))), '^\s+|\s+$', '', 'g')) AS line FROM p) SELECT doc_id, line, count(DISTINCT page) AS pages FROM l WHERE line <> '' GROUP BY doc_id, line HAVING count(DISTINCT page) >= 3""")
def repeated_lines(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", F.replace("text", F.lit(". "), F.lit("\f")).alias("text"))
    return dedupe.repeated_lines(d, "doc_id", "text")


# --- features


@query("SELECT p_partkey, coalesce(b, 'Desconocida') AS brand, count(*) OVER (PARTITION BY coalesce(b, 'Desconocida')) / CAST(count(*) OVER () AS DOUBLE) AS market_share FROM (SELECT p_partkey, CASE WHEN p_partkey % 9 <> 0 THEN p_brand END AS b FROM part)")
def market_share(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", F.expr("CASE WHEN p_partkey % 9 <> 0 THEN p_brand END").alias("b"))
    return features.market_share(p, "b").select("p_partkey", F.coalesce("b", F.lit("Desconocida")).alias("brand"), "market_share")


PRICES = "SELECT o_orderkey, CASE WHEN o_custkey % 4 <> 0 THEN o_custkey % 40 END AS g, CASE WHEN o_orderkey % 50 = 0 THEN o_totalprice * 100 WHEN o_orderkey % 21 <> 0 THEN o_totalprice END AS v FROM orders"


@query(f"WITH x AS ({PRICES}), s AS (SELECT g, quantile_cont(v, 0.25) AS a, quantile_cont(v, 0.75) AS b, count(v) AS n FROM x GROUP BY g) SELECT o_orderkey, coalesce(n >= 5 AND b > a AND (v < greatest(0, a - 3 * (b - a)) OR v > b + 3 * (b - a)), false) AS outlier FROM x JOIN s ON x.g IS NOT DISTINCT FROM s.g")
def outlier_iqr_group(spark, sf):
    t(spark, sf, "orders").createOrReplaceTempView("inkwell_orders")
    return features.outliers(spark.sql(PRICES.replace("FROM orders", "FROM inkwell_orders")), "v", "g").select("o_orderkey", "outlier")


@query(f"WITH x AS ({PRICES}), s AS (SELECT quantile_cont(v, 0.25) AS a, quantile_cont(v, 0.75) AS b FROM x) SELECT o_orderkey, coalesce(v < greatest(0, a - 3 * (b - a)) OR v > b + 3 * (b - a), false) AS outlier FROM x, s")
def outlier_iqr_global(spark, sf):
    t(spark, sf, "orders").createOrReplaceTempView("inkwell_orders")
    return features.outliers(spark.sql(PRICES.replace("FROM orders", "FROM inkwell_orders")), "v").select("o_orderkey", "outlier")


@query("SELECT c_custkey, round((v - avg(v) OVER ()) / stddev_samp(v) OVER (), 4) AS v_zscore, round((v - min(v) OVER ()) / (max(v) OVER () - min(v) OVER ()), 4) AS v_minmax, 0::DOUBLE AS flat_zscore, 0::DOUBLE AS flat_minmax FROM (SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS v FROM customer)")
def scale_columns(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", F.expr("CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END").alias("v"), F.lit(3.0).alias("flat"))
    return features.scale(c, ["v", "flat"]).select("c_custkey", "v_zscore", "v_minmax", "flat_zscore", "flat_minmax")


@query("SELECT c_custkey, " + ", ".join(f"CASE WHEN coalesce(s = '{v}', false) THEN 1 ELSE 0 END AS \"seg_{v}\"" for v in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")) + " FROM (SELECT c_custkey, CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END AS s FROM customer)")
def one_hot(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", F.expr("CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END").alias("seg"))
    return features.one_hot(c, ["seg"])


@query("SELECT p_partkey, coalesce(median(v) OVER (PARTITION BY p_brand, p_size), median(v) OVER (PARTITION BY p_brand)) AS med FROM (SELECT p_partkey, p_brand, p_size, CASE WHEN p_partkey % 3 = 0 THEN p_retailprice END AS v FROM part)")
def stratum_median(spark, sf):
    p = t(spark, sf, "part").withColumn("v", F.expr("CASE WHEN p_partkey % 3 = 0 THEN p_retailprice END"))
    return p.select("p_partkey", features.stratum_medians(p, "v", [["p_brand", "p_size"], ["p_brand"]]).alias("med"))


@query()
def impute_regression(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", "p_size", "p_brand", F.expr("CASE WHEN p_partkey % 5 <> 0 THEN p_retailprice END").alias("fee"))
    return impute.impute(p, "fee", ["p_size"], ["p_brand"], [["p_brand", "p_size"], ["p_brand"], []])


@query("SELECT p_partkey, coalesce(v, m) AS fee, v IS NULL AND m IS NOT NULL AS imputed, CASE WHEN v IS NULL AND m IS NOT NULL THEN 'mediana' END AS method FROM (SELECT p_partkey, v, coalesce(median(v) OVER (PARTITION BY p_brand), median(v) OVER ()) AS m FROM (SELECT p_partkey, p_brand, CASE WHEN p_partkey < 14 THEN p_retailprice END AS v FROM part))")
def impute_median(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", "p_brand", F.expr("CASE WHEN p_partkey < 14 THEN p_retailprice END").alias("fee"))
    return impute.impute(p, "fee", [], ["p_brand"], [["p_brand"], []]).select("p_partkey", "fee", "imputed", "method")


# --- reports

HOLES = "SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN 'NaN' ELSE c_name END AS name, CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END AS bal, c_mktsegment AS seg FROM customer"


def _holes(spark, sf):
    t(spark, sf, "customer").createOrReplaceTempView("inkwell_customer")
    return spark.sql(HOLES.replace("FROM customer", "FROM inkwell_customer"))


@query(f"WITH h AS ({HOLES}), s AS (SELECT count(*) AS total, count(*) FILTER (WHERE coalesce(lower(trim(name)) IN ('', 'nan', 'none', 'null'), true)) AS a, count(*) FILTER (WHERE bal IS NULL) AS b FROM h) SELECT variable, CAST(missing AS BIGINT) AS missing, total, round(missing * 100::DOUBLE / total, 2) AS percent FROM (SELECT 'name' AS variable, a AS missing, total FROM s UNION ALL SELECT 'bal', b, total FROM s UNION ALL SELECT 'seg', 0, total FROM s)")
def missing_profile(spark, sf):
    return reports.missing_profile(_holes(spark, sf), ["name", "bal", "seg"])


@query(f"WITH h AS ({HOLES}), m AS (SELECT c_custkey, coalesce(lower(trim(name)) IN ('', 'nan', 'none', 'null'), true) AS a, bal IS NULL AS b FROM h) SELECT c_custkey, concat_ws(', ', CASE WHEN a THEN 'name' END, CASE WHEN b THEN 'bal' END) AS missing, CAST(a AS INTEGER) + CAST(b AS INTEGER) AS n_missing FROM m")
def missing_by_row(spark, sf):
    return reports.missing_by_row(_holes(spark, sf), ["name", "bal", "seg"]).select("c_custkey", "missing", "n_missing")


@query("SELECT count(*) AS total, count(*) FILTER (WHERE c_acctbal < 0) AS negative, round(count(*) FILTER (WHERE c_acctbal < 0) * 100::DOUBLE / count(*), 2) AS negative_percent, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS building, round(count(*) FILTER (WHERE c_mktsegment = 'BUILDING') * 100::DOUBLE / count(*), 2) AS building_percent FROM customer")
def quality_summary(spark, sf):
    return reports.quality_summary(t(spark, sf, "customer"), {"negative": F.col("c_acctbal") < 0, "building": F.col("c_mktsegment") == "BUILDING"})


@query(f"{FX} SELECT coalesce(currency, 'sin_moneda') AS moneda, count(*) AS registros, count(amount) AS registros_con_monto, count(amount * rate) AS registros_convertidos, count(*) FILTER (WHERE amount IS NOT NULL AND amount * rate IS NULL) AS registros_sin_tasa, max(rate) AS tasa_usd, CASE WHEN count(*) FILTER (WHERE amount IS NOT NULL AND amount * rate IS NULL) > 0 THEN 'sin_tasa' WHEN count(amount) = 0 THEN 'sin_monto' ELSE 'convertida' END AS estado FROM c GROUP BY 1")
def currency_report(spark, sf):
    return reports.currency_report(_money(spark, sf), "currency", "amount", "usd", "rate")


# --- resolution: customers as the base, suppliers as a source that shares keys and titles

BASE = "SELECT c_custkey AS row_idx, CASE WHEN c_custkey % 5 <> 0 THEN concat('K', CAST(c_custkey % 7000 AS STRING)) END AS issn, concat('Journal of ', c_mktsegment, ' ', 'a', CAST(c_custkey % 61 AS STRING), ' b', CAST(c_custkey % 47 AS STRING)) AS titulo FROM customer"
SOURCE = "SELECT s_suppkey AS row_idx, concat('K', CAST(s_suppkey * 7 % 1000 AS STRING)) AS issn, concat(CASE s_suppkey % 3 WHEN 0 THEN 'BUILDING' WHEN 1 THEN 'Machinery' ELSE 'furniture' END, ' a', CAST(s_suppkey % 61 AS STRING), ' b', CAST(s_suppkey % 53 AS STRING)) AS titulo, s_acctbal AS fee, s_nationkey AS h FROM supplier"


def _pair(spark, sf):
    out = []
    for name, q in (("customer", BASE), ("supplier", SOURCE)):
        t(spark, sf, name).createOrReplaceTempView(f"inkwell_{name}")
        out.append(spark.sql(q.replace(f"FROM {name}", f"FROM inkwell_{name}")).withColumn("title", text.normalize_title(F.col("titulo"))))
    return tuple(out)


STAGES = f"""WITH base AS (SELECT *, {TITLE_SQL.format(x='titulo')} AS title FROM ({BASE})), src AS (SELECT *, {TITLE_SQL.format(x='titulo')} AS title FROM ({SOURCE})),
k AS (SELECT issn, min(row_idx) AS source_row FROM src GROUP BY issn),
m1 AS (SELECT base.row_idx AS base_row, source_row FROM base JOIN k USING (issn)),
free AS (SELECT * FROM src WHERE issn NOT IN (SELECT issn FROM base WHERE issn IS NOT NULL) AND title IS NOT NULL),
m2 AS (SELECT base.row_idx AS base_row, min(free.row_idx) AS source_row FROM base JOIN free USING (title) WHERE base.row_idx NOT IN (SELECT base_row FROM m1) GROUP BY 1),
p AS (SELECT base.row_idx AS base_row, free.row_idx AS source_row, list_distinct(string_split(base.title, ' ')) AS a, list_distinct(string_split(free.title, ' ')) AS b FROM base, free
      WHERE base.title IS NOT NULL AND base.row_idx NOT IN (SELECT base_row FROM m1) AND base.row_idx NOT IN (SELECT base_row FROM m2)),
j AS (SELECT base_row, source_row, 100::DOUBLE * len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) AS score FROM p),
m3 AS (SELECT base_row, source_row, score FROM (SELECT *, row_number() OVER (PARTITION BY base_row ORDER BY score DESC, source_row) AS n FROM j WHERE score >= 50) WHERE n = 1),
m AS (SELECT base_row, source_row, 'key' AS match, 100::DOUBLE AS score FROM m1 UNION ALL SELECT base_row, source_row, 'title', 100 FROM m2 UNION ALL SELECT base_row, source_row, 'fuzzy', score FROM m3)"""


@query(f"{STAGES} SELECT * FROM m")
def title_fuzzy_jaccard(spark, sf):
    base, source = _pair(spark, sf)
    return resolve.match(base, source, "issn", "title", "row_idx", "jaccard", 50.0)


@query()
def title_fuzzy_wratio(spark, sf):
    base, source = _pair(spark, sf)
    return resolve.match(base, source, "issn", "title", "row_idx", "wratio")


@query(f"{STAGES} SELECT base.row_idx, base.issn, base.titulo, src.titulo AS titulo_scimago, src.fee, src.h FROM base LEFT JOIN m ON base.row_idx = base_row LEFT JOIN src ON src.row_idx = source_row")
def enrich_issn_join(spark, sf):
    base, source = _pair(spark, sf)
    found = resolve.match(base, source, "issn", "title", "row_idx", "jaccard", 50.0)
    return resolve.enrich(base, source, found, "issn", "title", "row_idx", "scimago").select("row_idx", "issn", "titulo", "titulo_scimago", "fee", "h")


@query(f"{STAGES} SELECT DISTINCT base.issn, 'scimago' AS fuente, CASE WHEN match = 'key' THEN 'issn' ELSE 'titulo' END AS tipo_cruce, 'match' AS resultado, score AS similitud FROM m JOIN base ON base_row = row_idx")
def merge_log(spark, sf):
    base, source = _pair(spark, sf)
    return resolve.merge_log(base, resolve.match(base, source, "issn", "title", "row_idx", "jaccard", 50.0), "issn", "row_idx", "scimago")


@query("SELECT p_partkey, coalesce(b, a) AS fee, coalesce(a, c) AS title, c AS rango FROM (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_size END AS a, CASE WHEN p_partkey % 3 = 0 THEN p_size * 2 END AS b, CASE WHEN p_partkey % 5 = 0 THEN 7 END AS c FROM part)")
def suffix_coalesce(spark, sf):
    p = t(spark, sf, "part").selectExpr("p_partkey", "CASE WHEN p_partkey % 2 = 0 THEN p_size END AS fee", "CASE WHEN p_partkey % 3 = 0 THEN p_size * 2 END AS fee_openapc", "CASE WHEN p_partkey % 2 = 0 THEN p_size END AS title", "CASE WHEN p_partkey % 5 = 0 THEN 7 END AS title_scimago", "CASE WHEN p_partkey % 5 = 0 THEN 7 END AS rango_scimago")
    return resolve.coalesce_suffixes(p, ["scimago", "openapc"], {"openapc": ["fee"]})


@query("SELECT s_suppkey, s_nationkey, c_custkey, c_acctbal FROM supplier LEFT JOIN (SELECT * FROM (SELECT c_nationkey, c_custkey, c_acctbal, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS k FROM customer WHERE c_nationkey % 5 <> 0) WHERE k = 1) ON s_nationkey = c_nationkey")
def lookup_first(spark, sf):
    c = t(spark, sf, "customer").where("c_nationkey % 5 <> 0").select(F.col("c_nationkey").alias("s_nationkey"), F.col("c_custkey").alias("row"), "c_custkey", "c_acctbal")
    return resolve.lookup_first(t(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), c, "s_nationkey", "row").select("s_suppkey", "s_nationkey", "c_custkey", "c_acctbal")


@query("SELECT p_partkey, concat_ws(',', CASE WHEN p_partkey % 2 = 0 THEN 'doaj' END, CASE WHEN p_partkey % 3 = 0 THEN 'openapc' END, 'publindex') AS sources FROM part")
def source_set(spark, sf):
    p = t(spark, sf, "part").selectExpr("p_partkey", "CASE WHEN p_partkey % 2 = 0 THEN 1 END AS a", "CASE WHEN p_partkey % 3 = 0 THEN 1 END AS b")
    return p.select("p_partkey", F.array_join(resolve.source_set({"openapc": "b", "doaj": "a"}), ",").alias("sources"))


# --- the catalogue: parts as journals


def _journals(spark, sf):
    p = t(spark, sf, "part")
    j = p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_brand").alias("country"), F.col("p_type").alias("access_type"), F.expr("CASE WHEN p_partkey % 5 <> 0 THEN p_retailprice - 900 END").alias("apc_usd"), F.expr("CASE WHEN p_partkey % 3 <> 0 THEN p_size END").alias("weeks_to_publication"), F.col("p_size").alias("h_index"), F.expr("CASE p_partkey % 3 WHEN 0 THEN 'Español, Inglés' WHEN 1 THEN 'Inglés' END").alias("language"))
    return catalogue.with_search_text(j, ["title", "country", "access_type"])


JOURNALS = r"(SELECT *, trim(regexp_replace(lower(strip_accents(concat_ws(' ', title, country, access_type))), '\s+', ' ', 'g')) AS search_text FROM (SELECT p_partkey AS id, p_name AS title, p_brand AS country, p_type AS access_type, CASE WHEN p_partkey % 5 <> 0 THEN p_retailprice - 900 END AS apc_usd, CASE WHEN p_partkey % 3 <> 0 THEN p_size END AS weeks_to_publication, p_size AS h_index, CASE p_partkey % 3 WHEN 0 THEN 'Español, Inglés' WHEN 1 THEN 'Inglés' END AS language FROM part))"


@query(f"SELECT id, title, country FROM {JOURNALS} WHERE contains(search_text, 'a') AND contains(search_text, 'brand#1')")
def catalog_search(spark, sf):
    return catalogue.search(_journals(spark, sf), "Á BRAND#1").select("id", "title", "country")


@query(f"SELECT id, apc_usd, weeks_to_publication, h_index FROM {JOURNALS} WHERE country IN ('Brand#1', 'Brand#2', 'Brand#3') AND apc_usd > 0 AND apc_usd >= 1 AND apc_usd <= 900 AND weeks_to_publication <= 30 AND h_index >= 5 AND contains(language, 'Ingl')")
def catalog_filter(spark, sf):
    f = catalogue.Filters(languages=("Ingl",), apc_status="con_costo", apc_min=1, apc_max=900, weeks_max=30, picks={"country": ("Brand#1", "Brand#2", "Brand#3")}, least={"h_index": 5})
    return catalogue.apply_filters(_journals(spark, sf), f).select("id", "apc_usd", "weeks_to_publication", "h_index")


@query("SELECT p_partkey AS id, p_name AS title FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity IN (1, 2))")
def catalog_topic_semijoin(spark, sf):
    topics = t(spark, sf, "lineitem").select(F.col("l_partkey").alias("id"), F.col("l_quantity").cast("int").cast("string").alias("topic"))
    return catalogue.apply_filters(_journals(spark, sf), catalogue.Filters(topics=("1", "2")), topics).select("id", "title")


@query(f"SELECT id, apc_usd FROM {JOURNALS} ORDER BY apc_usd DESC NULLS LAST, id LIMIT 50 OFFSET 100")
def catalog_page(spark, sf):
    return catalogue.page(_journals(spark, sf), "apc_usd", True, 3, 50).select("id", "apc_usd")


@query(f"SELECT facet, value, count(*) AS n FROM (SELECT unnest(['country', 'access_type']) AS facet, unnest([country, access_type]) AS value FROM {JOURNALS}) GROUP BY ALL")
def facet_counts(spark, sf):
    return catalogue.facets(_journals(spark, sf), ["country", "access_type"])


@query(f"SELECT trim(v) AS value, count(*) AS n FROM (SELECT unnest(string_split(language, ',')) AS v FROM {JOURNALS}) GROUP BY 1")
def facet_multi(spark, sf):
    return catalogue.facet_list(_journals(spark, sf), "language")


@query(f"SELECT count(*) AS total, max(apc_usd) AS apc_max, max(weeks_to_publication) AS weeks_max, max(h_index) AS h_index_max FROM {JOURNALS}")
def catalog_stats(spark, sf):
    return catalogue.bounds(_journals(spark, sf))


ALIASES = "SELECT concat('I', CAST(o_custkey % 400 AS STRING)) AS issn, o_orderkey AS journal_id, CASE o_orderkey % 3 WHEN 0 THEN 'etl' WHEN 1 THEN 'lider' ELSE 'manual' END AS origin FROM orders"


def _aliases(spark, sf):
    t(spark, sf, "orders").createOrReplaceTempView("inkwell_orders")
    return spark.sql(ALIASES.replace("FROM orders", "FROM inkwell_orders"))


@query(f"SELECT issn, journal_id, origin FROM (SELECT *, row_number() OVER (PARTITION BY issn ORDER BY origin DESC, journal_id) AS k FROM ({ALIASES})) WHERE k = 1")
def alias_resolve(spark, sf):
    return upsert.resolve_aliases(_aliases(spark, sf))


@query(f"WITH a AS ({ALIASES}) SELECT c_custkey AS id FROM customer WHERE EXISTS (SELECT 1 FROM a WHERE a.issn IN (concat('I', CAST(c_custkey AS VARCHAR)), concat('I', CAST(c_custkey + 380 AS VARCHAR))) AND a.journal_id <> c_custkey)")
def duplicates(spark, sf):
    rows = t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.expr("array(concat('I', c_custkey), concat('I', c_custkey + 380))").alias("issns"))
    return upsert.duplicates(rows, _aliases(spark, sf)).select("id")


def _states(spark, sf):
    c = t(spark, sf, "customer")
    old = c.where("c_custkey % 4 <> 0").select(F.lit("etl").alias("origin"), F.col("c_custkey").alias("source_key"), F.col("c_name").alias("title"), F.expr("c_custkey % 10 = 0").alias("modified"))
    new = c.where("c_custkey % 6 <> 0").select(F.lit("etl").alias("origin"), F.col("c_custkey").alias("source_key"), F.concat("c_name", F.lit(" new")).alias("title"))
    return old, new


@query("SELECT 'etl' AS origin, c_custkey AS source_key, CASE WHEN c_custkey % 4 = 0 THEN 'create' WHEN c_custkey % 6 = 0 THEN CASE WHEN c_custkey % 10 = 0 THEN 'keep' ELSE 'prune' END WHEN c_custkey % 10 = 0 THEN 'protected' ELSE 'update' END AS action FROM customer WHERE c_custkey % 4 <> 0 OR c_custkey % 6 <> 0")
def upsert_actions(spark, sf):
    return upsert.plan_upsert(*_states(spark, sf), ["origin", "source_key"])


@query("SELECT 'etl' AS origin, c_custkey AS source_key, CASE WHEN c_custkey % 4 <> 0 AND c_custkey % 10 = 0 THEN c_name ELSE c_name || ' new' END AS title, c_custkey % 4 <> 0 AND c_custkey % 10 = 0 AS modified FROM customer WHERE (c_custkey % 4 <> 0 AND c_custkey % 10 = 0) OR c_custkey % 6 <> 0")
def upsert_state(spark, sf):
    return upsert.upsert(*_states(spark, sf), ["origin", "source_key"]).select("origin", "source_key", "title", "modified")


FILE = "SELECT c_custkey AS row, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE concat('I', CAST(300 + c_custkey % 200 AS STRING)) END AS issn FROM customer"


@query(f"WITH f AS ({FILE}), a AS (SELECT DISTINCT issn FROM ({ALIASES})), x AS (SELECT f.row, f.issn, a.issn IS NOT NULL AS known, coalesce(min(f.row) OVER (PARTITION BY f.issn) < f.row AND f.issn IS NOT NULL, false) AS earlier FROM f LEFT JOIN a ON f.issn = a.issn) SELECT row, CASE WHEN known THEN 'skip' ELSE 'create' END AS dry, CASE WHEN known OR earlier THEN 'update' ELSE 'create' END AS real FROM x")
def import_actions(spark, sf):
    t(spark, sf, "customer").createOrReplaceTempView("inkwell_customer")
    rows = spark.sql(FILE.replace("FROM customer", "FROM inkwell_customer")).select("row", F.array("issn").alias("issns"))
    dry, real = (upsert.plan_import(rows, _aliases(spark, sf), m, d).withColumnRenamed("action", n) for m, d, n in (("skip", True, "dry"), ("update", False, "real")))
    return dry.join(real, "row")


@query("WITH o AS (SELECT *, CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END AS e, year(o_orderdate) AS y, row_number() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate) DESC, o_orderkey) AS k FROM orders) SELECT a.o_orderkey, CASE WHEN a.e IS NOT NULL THEN (SELECT string_agg(DISTINCT o.o_orderstatus, ',' ORDER BY o.o_orderstatus) FROM o WHERE o.e = a.e) END AS aliases, CASE WHEN a.e IS NOT NULL THEN (SELECT count(*) - 1 FROM o WHERE o.e = a.e) ELSE -1 END AS n_history FROM o a WHERE a.e IS NULL OR a.k = 1")
def collapse_latest(spark, sf):
    o = t(spark, sf, "orders").withColumns({"e": F.expr("CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END"), "y": F.year("o_orderdate")})
    out = upsert.collapse_latest(o, "e", "y", "o_orderkey", ["o_orderstatus"], "o_orderpriority")
    return out.select("o_orderkey", F.array_join("aliases", ",").alias("aliases"), F.coalesce(F.size("history"), F.lit(-1)).cast("long").alias("n_history"))


@query("WITH k AS (SELECT * FROM (VALUES ('furniture', 1), ('BUILDING', 2)) AS x(name, topic_id)), n AS (SELECT DISTINCT c_mktsegment AS name FROM customer), w AS (SELECT lower(n.name) AS l, row_number() OVER (ORDER BY lower(n.name)) + 2 AS id FROM n LEFT JOIN k ON lower(n.name) = lower(k.name) WHERE k.name IS NULL) SELECT n.name, CAST(coalesce(k.topic_id, w.id) AS BIGINT) AS topic_id FROM n LEFT JOIN k ON lower(n.name) = lower(k.name) LEFT JOIN w ON lower(n.name) = w.l")
def topic_get_or_create(spark, sf):
    known = spark.createDataFrame([("furniture", 1), ("BUILDING", 2)], "name string, topic_id int")
    return upsert.topic_ids(t(spark, sf, "customer").select(F.col("c_mktsegment").alias("name")).distinct(), known).select("name", F.col("topic_id").cast("long"))


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 9 = 0 THEN 'patched' ELSE c_name END AS title, c_custkey % 9 = 0 OR c_custkey % 10 = 0 AS modified FROM customer")
def apply_patch(spark, sf):
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("title"), F.expr("c_custkey % 10 = 0").alias("modified"))
    return upsert.patch(c, c.where("id % 9 = 0").select("id", F.lit("patched").alias("title")))
