"""The scalar functions on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.constants import CATALOGUE_RATES, COUNTRY_ISO, PPP_FACTORS, PUBLISHERS, STOPWORDS_EN, STOPWORDS_ES, SUFFIXES_EN, SUFFIXES_ES, TITLE_STOPWORDS, TOPIC_RULES, USD_RATES
from inkwell.functions import catalogue, flags, identifiers, numbers, text
from inkwell.plans.registered import listed, query, t, values

# Texts in the forms of the sources, written from keys in SQL that both engines read.
ISSN = "concat(CASE o_orderkey % 4 WHEN 0 THEN 'ISSN: ' WHEN 1 THEN 'e-issn ' ELSE '' END, lpad(CAST(o_orderkey * 37 % 1000000 AS STRING), CAST(CASE WHEN o_orderkey % 9 = 0 THEN 6 ELSE 7 END AS INT), '0'), CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE CAST(o_orderkey % 10 AS STRING) END)"
PLAIN_ISSN = "concat(lpad(CAST(o_orderkey * 37 % 10000 AS STRING), 4, '0'), '-', lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0'), CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE CAST(o_orderkey % 10 AS STRING) END)"
CLEANED = "CASE WHEN length(regexp_replace(upper({x}), '[^0-9X]', '', 'g')) = 8 THEN concat(substr(regexp_replace(upper({x}), '[^0-9X]', '', 'g'), 1, 4), '-', substr(regexp_replace(upper({x}), '[^0-9X]', '', 'g'), 5, 4)) END"


@query(f"SELECT o_orderkey, raw, {CLEANED.format(x='raw')} AS issn FROM (SELECT o_orderkey, {ISSN} AS raw FROM orders)")
def issn_clean(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", F.expr(ISSN).alias("raw")).withColumn("issn", identifiers.issn(F.col("raw")))


@query(
    f"""SELECT o_orderkey, raw, CASE WHEN regexp_matches(s, '^[0-9]{{7}}[0-9X]$') THEN (CAST(substr(s, 1, 1) AS INT) * 8 + CAST(substr(s, 2, 1) AS INT) * 7 + CAST(substr(s, 3, 1) AS INT) * 6
    + CAST(substr(s, 4, 1) AS INT) * 5 + CAST(substr(s, 5, 1) AS INT) * 4 + CAST(substr(s, 6, 1) AS INT) * 3 + CAST(substr(s, 7, 1) AS INT) * 2
    + CASE WHEN substr(s, 8, 1) = 'X' THEN 10 ELSE CAST(substr(s, 8, 1) AS INT) END) % 11 = 0 ELSE false END AS valid
    FROM (SELECT o_orderkey, raw, replace(raw, '-', '') AS s FROM (SELECT o_orderkey, {PLAIN_ISSN} AS raw FROM orders))"""
)
def issn_checksum(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", F.expr(PLAIN_ISSN).alias("raw")).withColumn("valid", identifiers.issn_valid(F.col("raw")))


@query(
    f"""WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN {ISSN} END AS linking, CASE WHEN o_orderkey % 3 <> 2 THEN {PLAIN_ISSN} END AS printed, {PLAIN_ISSN.replace('o_orderkey', '(o_orderkey + 5)')} AS electronic FROM orders)
    SELECT o_orderkey, coalesce({CLEANED.format(x='linking')}, {CLEANED.format(x='printed')}, {CLEANED.format(x='electronic')}) AS issn FROM s"""
)
def issn_canonical(spark, sf):
    s = t(spark, sf, "orders").select("o_orderkey", F.expr(f"CASE WHEN o_orderkey % 3 = 0 THEN {ISSN} END").alias("l"), F.expr(f"CASE WHEN o_orderkey % 3 <> 2 THEN {PLAIN_ISSN} END").alias("p"), F.expr(PLAIN_ISSN.replace("o_orderkey", "(o_orderkey + 5)")).alias("e"))
    return s.select("o_orderkey", identifiers.issn_canonical(F.col("p"), F.col("e"), F.col("l")).alias("issn"))


@query(
    f"""SELECT o_orderkey, CASE WHEN regexp_extract(raw, '([0-9]{{4}})-?([0-9]{{3}}[0-9Xx])', 1) <> '' THEN concat(regexp_extract(raw, '([0-9]{{4}})-?([0-9]{{3}}[0-9Xx])', 1), '-', upper(regexp_extract(raw, '([0-9]{{4}})-?([0-9]{{3}}[0-9Xx])', 2))) END AS issn
    FROM (SELECT o_orderkey, {ISSN} AS raw FROM orders)"""
)
def issn_find(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", identifiers.issn_find(F.expr(ISSN)).alias("issn"))


LIST = f"concat({ISSN}, ', ', {PLAIN_ISSN}, ',', {PLAIN_ISSN.replace('o_orderkey', '(o_orderkey + 3)')})"


@query(
    f"""SELECT o_orderkey, found[1] AS issn_print, found[2] AS issn_electronic FROM (SELECT o_orderkey, list_filter(list_transform(string_split({LIST}, ','), lambda x: {CLEANED.format(x='x')}), lambda x: x IS NOT NULL) AS found FROM orders)"""
)
def issn_list_split(spark, sf):
    first, second = identifiers.issn_list(F.expr(LIST))
    return t(spark, sf, "orders").select("o_orderkey", first.alias("issn_print"), second.alias("issn_electronic"))


@query("SELECT o_orderkey, substr(sha256(concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus, o_orderpriority)), 1, 16) AS record_hash FROM orders")
def record_hash(spark, sf):
    return t(spark, sf, "orders").select("o_orderkey", identifiers.record_hash(*map(F.col, ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"))).alias("record_hash"))


def _folded(x: str) -> str:
    """strip_accents and the letters it leaves, as SQL."""
    for sign, letters in (("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("ø", "o"), ("ł", "l"), ("đ", "d"), ("ð", "d"), ("þ", "th"), ("ı", "i")):
        x = f"replace({x}, '{sign}', '{letters}')"
    return f"strip_accents({x})"


TITLE_SQL = f"nullif(array_to_string(list_filter(string_split(trim(regexp_replace(regexp_replace({_folded('lower(trim({x}))')}, '[^A-Za-z0-9_\\s]', ' ', 'g'), '\\s+', ' ', 'g')), ' '), lambda w: w NOT IN ('', {listed(TITLE_STOPWORDS)})), ' '), '')"


@query(f"SELECT doc_id, {TITLE_SQL.format(x='text')} AS title FROM documents")
def title_normalize(spark, sf):
    return t(spark, sf, "documents").select("doc_id", text.normalize_title(F.col("text")).alias("title"))


@query(
    f"""SELECT a.p_partkey, a.p_name, b.p_name AS other, coalesce(CASE WHEN x = y THEN 100.0::DOUBLE ELSE 100.0::DOUBLE * len(list_intersect(s, u)) / len(list_distinct(list_concat(s, u))) END, 0::DOUBLE) AS similarity
    FROM part a JOIN part b ON b.p_partkey = a.p_partkey % 97 + 1, LATERAL (SELECT {TITLE_SQL.format(x='a.p_name')} AS x, {TITLE_SQL.format(x='b.p_name')} AS y), LATERAL (SELECT list_distinct(string_split(x, ' ')) AS s, list_distinct(string_split(y, ' ')) AS u)"""
)
def title_similarity(spark, sf):
    p = t(spark, sf, "part")
    other = p.select(F.col("p_partkey").alias("k"), F.col("p_name").alias("other"))
    return p.join(other, F.col("k") == F.col("p_partkey") % 97 + 1).select("p_partkey", "p_name", "other", text.jaccard(F.col("p_name"), F.col("other")).alias("similarity"))


NUMBER = "CASE l_orderkey % 6 WHEN 0 THEN concat(CAST(l_orderkey % 900 + 1 AS STRING), '.', lpad(CAST(l_partkey % 1000 AS STRING), 3, '0'), ',', lpad(CAST(l_suppkey % 100 AS STRING), 2, '0')) WHEN 1 THEN concat('USD ', CAST(l_orderkey % 900 + 1 AS STRING), ',', lpad(CAST(l_partkey % 1000 AS STRING), 3, '0'), '.50') WHEN 2 THEN concat('0,', lpad(CAST(l_partkey % 1000 AS STRING), 3, '0')) WHEN 3 THEN concat(CAST(l_partkey % 5000 AS STRING), ' ') WHEN 4 THEN concat('-', CAST(l_linenumber AS STRING), '.5') ELSE 'n/d' END"


@query(
    f"""SELECT l_orderkey, l_linenumber, raw, CASE WHEN regexp_matches(p, '^[-+]?([0-9]+\\.?[0-9]*|\\.[0-9]+)$') THEN TRY_CAST(p AS DOUBLE) END AS number FROM (SELECT *, CASE WHEN strpos(s, ',') > 0 AND strpos(s, '.') > 0 THEN
    CASE WHEN strpos(reverse(s), ',') < strpos(reverse(s), '.') THEN replace(replace(s, '.', ''), ',', '.') ELSE replace(s, ',', '') END ELSE replace(s, ',', '.') END AS p
    FROM (SELECT l_orderkey, l_linenumber, raw, regexp_replace(raw, '[^0-9.,+-]', '', 'g') AS s FROM (SELECT l_orderkey, l_linenumber, {NUMBER} AS raw FROM lineitem)))"""
)
def number_parse_locale(spark, sf):
    return t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.expr(NUMBER).alias("raw")).withColumn("number", numbers.locale_number(F.col("raw")))


PLAIN = "CASE p_partkey % 4 WHEN 0 THEN concat('H: ', CAST(p_size AS STRING), ',5') WHEN 1 THEN concat(CAST(p_partkey AS STRING), '.25 pts') WHEN 2 THEN 'N/A' ELSE concat('-', CAST(p_size AS STRING)) END"


@query(
    f"""SELECT p_partkey, n AS number, CAST(round_even(n, 0) AS BIGINT) AS whole FROM (SELECT p_partkey, CASE WHEN raw <> 'N/A' THEN TRY_CAST(replace(regexp_extract(replace(raw, ' ', ''), '-?[0-9]+(?:[.,][0-9]+)?'), ',', '.') AS DOUBLE) END AS n
    FROM (SELECT p_partkey, {PLAIN} AS raw FROM part))"""
)
def number_parse_plain(spark, sf):
    return t(spark, sf, "part").select("p_partkey", numbers.plain_number(F.expr(PLAIN)).alias("number"), numbers.plain_int(F.expr(PLAIN)).alias("whole"))


FEE = "CASE p_partkey % 5 WHEN 0 THEN concat(CAST(p_partkey AS STRING), ' EUR') WHEN 1 THEN concat('$', CAST(p_size AS STRING), '.5') WHEN 2 THEN concat('gbp ', CAST(p_partkey % 90 + 10 AS STRING), ',25') WHEN 3 THEN concat(CAST(p_size AS STRING), '') ELSE 'none' END"


@query(
    f"""SELECT p_partkey, TRY_CAST(replace(nullif(regexp_extract(raw, '[0-9.,]+'), ''), ',', '.') AS DOUBLE) AS amount,
    CASE WHEN regexp_extract(upper(raw), '\\b[A-Z]{{3}}\\b') <> '' THEN regexp_extract(upper(raw), '\\b[A-Z]{{3}}\\b') WHEN raw LIKE '%$%' THEN 'USD' END AS currency FROM (SELECT p_partkey, {FEE} AS raw FROM part)"""
)
def fee_parse(spark, sf):
    amount, currency = numbers.declared_fee(F.expr(FEE))
    return t(spark, sf, "part").select("p_partkey", amount.alias("amount"), currency.alias("currency"))


COST = "CASE p_partkey % 8 WHEN 0 THEN concat('~USD ', CAST(p_size * 100 AS STRING)) WHEN 1 THEN concat('~USD ', CAST(p_size AS STRING), '-', CAST(p_size * 3 AS STRING)) WHEN 2 THEN concat('CHF ', CAST(p_size * 10 AS STRING)) WHEN 3 THEN concat('€ ', CAST(p_size % 9 + 1 AS STRING), '.500') WHEN 4 THEN 'Gratis' WHEN 5 THEN '~USD' WHEN 6 THEN concat('consultar | ', CAST(p_size AS STRING), ' GBP') ELSE '-' END"
RATES_SQL = f"(SELECT * FROM (VALUES {values(CATALOGUE_RATES)}) AS r(code, rate))"


@query(
    f"""WITH s AS (SELECT p_partkey, {COST} AS raw FROM part),
    seg AS (SELECT p_partkey, raw, unnest(string_split(raw, '|')) AS seg, unnest(generate_series(1, len(string_split(raw, '|')))) AS k FROM s),
    m AS (SELECT p_partkey, k, regexp_extract(seg, '(?i)(USD|US\\$|EUR|GBP|CHF|CAD|AUD|JPY|CNY|COP|BRL|MXN|€|£|\\$)?\\s*([0-9][0-9.,]*)(?:\\s*[-–—]\\s*([0-9][0-9.,]*))?\\s*(USD|EUR|GBP|CHF)?', ['cur', 'lo', 'hi', 'cur2']) AS x FROM seg),
    n AS (SELECT p_partkey, k, CASE WHEN regexp_matches(x.lo, '^[0-9]{{1,3}}([.,][0-9]{{3}})+$') THEN CAST(regexp_replace(x.lo, '[.,]', '', 'g') AS DOUBLE) ELSE TRY_CAST(replace(x.lo, ',', '.') AS DOUBLE) END AS lo,
          CASE WHEN x.hi = '' THEN NULL WHEN regexp_matches(x.hi, '^[0-9]{{1,3}}([.,][0-9]{{3}})+$') THEN CAST(regexp_replace(x.hi, '[.,]', '', 'g') AS DOUBLE) ELSE TRY_CAST(replace(x.hi, ',', '.') AS DOUBLE) END AS hi,
          upper(CASE WHEN x.cur <> '' THEN x.cur WHEN x.cur2 <> '' THEN x.cur2 ELSE 'USD' END) AS code FROM m WHERE x.lo <> ''),
    v AS (SELECT p_partkey, k, round_even((lo + coalesce(hi, lo)) / 2 * rate, 2) AS usd FROM n JOIN {RATES_SQL} USING (code))
    SELECT s.p_partkey, raw, CASE WHEN raw = 'Gratis' THEN 0::DOUBLE WHEN raw = '-' THEN NULL ELSE (SELECT usd FROM v WHERE v.p_partkey = s.p_partkey AND usd IS NOT NULL ORDER BY k LIMIT 1) END AS usd FROM s"""
)
def cost_parse(spark, sf):
    return t(spark, sf, "part").select("p_partkey", F.expr(COST).alias("raw")).withColumn("usd", numbers.cost_text(F.col("raw")))


DURATION = "CASE p_partkey % 6 WHEN 0 THEN concat(CAST(p_size AS STRING), '–', CAST(p_size + 3 AS STRING), ' meses') WHEN 1 THEN concat(CAST(p_size AS STRING), '-', CAST(p_size + 2 AS STRING), ' semanas') WHEN 2 THEN concat(CAST(p_size AS STRING), ' días') WHEN 3 THEN 'continuo' WHEN 4 THEN concat(CAST(p_size AS STRING), ',5 weeks') ELSE CAST(p_size AS STRING) END"


@query(
    f"""SELECT p_partkey, CASE WHEN x.lo <> '' THEN round_even((CAST(replace(x.lo, ',', '.') AS DOUBLE) + CAST(replace(CASE WHEN x.hi <> '' THEN x.hi ELSE x.lo END, ',', '.') AS DOUBLE)) / 2 *
    CASE WHEN lower(x.unit) LIKE 'm%' THEN 4.345::DOUBLE WHEN lower(x.unit) LIKE 's%' OR lower(x.unit) LIKE 'w%' THEN 1::DOUBLE ELSE 1::DOUBLE / 7 END, 1) END AS weeks
    FROM (SELECT p_partkey, regexp_extract(strip_accents({DURATION}), '(?i)([0-9]+(?:[.,][0-9]+)?)\\s*(?:[-–—a]\\s*([0-9]+(?:[.,][0-9]+)?))?\\s*(mes(?:es)?|months?|semanas?|weeks?|dias?|days?)', ['lo', 'hi', 'unit']) AS x FROM part)"""
)
def duration_weeks(spark, sf):
    return t(spark, sf, "part").select("p_partkey", numbers.weeks(F.expr(DURATION)).alias("weeks"))


@query("SELECT o_orderkey, CASE WHEN x > 1 THEN x / 100::DOUBLE ELSE x END AS share, CAST(trunc(TRY_CAST(concat(CAST(1990 + o_orderkey % 35 AS VARCHAR), CASE WHEN o_orderkey % 5 = 0 THEN 'a' ELSE '.0' END) AS DOUBLE)) AS INTEGER) AS yr, TRY_CAST(regexp_extract(concat('cerca de ', CAST(o_orderkey % 60 AS VARCHAR), ' semanas'), '([0-9]+)', 1) AS BIGINT) AS first_int FROM (SELECT *, (o_orderkey % 200) / 2::DOUBLE AS x FROM orders)")
def percent_year_int(spark, sf):
    o = t(spark, sf, "orders").withColumn("x", F.expr("(o_orderkey % 200) / 2"))
    y = F.expr("concat(CAST(1990 + o_orderkey % 35 AS STRING), CASE WHEN o_orderkey % 5 = 0 THEN 'a' ELSE '.0' END)")
    return o.select("o_orderkey", numbers.percent_fraction(F.col("x")).alias("share"), numbers.year(y).alias("yr"), numbers.first_int(F.expr("concat('cerca de ', CAST(o_orderkey % 60 AS STRING), ' semanas')")).alias("first_int"))


MONEY = "CASE l_orderkey % 5 WHEN 0 THEN 'EUR' WHEN 1 THEN 'usd ' WHEN 2 THEN 'JPY' WHEN 3 THEN 'XXX' END"
FX = f"""WITH r(code, rate) AS (VALUES {values(USD_RATES)}), m AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 10 <> 0 THEN l_extendedprice END AS amount, {MONEY} AS currency FROM lineitem),
c AS (SELECT m.*, CASE WHEN amount IS NULL THEN NULL WHEN currency IS NULL THEN 1::DOUBLE ELSE r.rate END AS rate FROM m LEFT JOIN r ON upper(trim(currency)) = code)"""


def _money(spark, sf):
    m = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.expr("CASE WHEN l_partkey % 10 <> 0 THEN l_extendedprice END").alias("amount"), F.expr(MONEY).alias("currency"))
    usd, rate = numbers.to_usd(F.col("amount"), F.col("currency"))
    return m.withColumn("usd", usd).withColumn("rate", rate)


@query(f"{FX} SELECT l_orderkey, l_linenumber, rate, round(round_even(amount * rate, 2), 1) AS usd FROM c")
def fx_convert(spark, sf):
    return _money(spark, sf).select("l_orderkey", "l_linenumber", "rate", F.round("usd", 1).alias("usd"))


@query(f"{FX} SELECT l_orderkey, l_linenumber, CASE WHEN amount IS NULL THEN 'sin_monto' WHEN amount * rate IS NULL THEN 'sin_tasa' ELSE 'convertida' END AS status FROM c")
def conversion_status(spark, sf):
    return _money(spark, sf).select("l_orderkey", "l_linenumber", numbers.conversion_status(F.col("amount"), F.col("usd")).alias("status"))


@query(f"WITH f(code, factor) AS (VALUES {values(PPP_FACTORS)}) SELECT c_custkey, country, round(round_even(c_acctbal / coalesce(factor, 1::DOUBLE), 2), 1) AS ppp FROM (SELECT c_custkey, c_acctbal, CASE c_nationkey % 4 WHEN 0 THEN 'co' WHEN 1 THEN 'CH ' WHEN 2 THEN 'ZZ' END AS country FROM customer) LEFT JOIN f ON upper(trim(country)) = code")
def ppp_convert(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", "c_acctbal", F.expr("CASE c_nationkey % 4 WHEN 0 THEN 'co' WHEN 1 THEN 'CH ' WHEN 2 THEN 'ZZ' END").alias("country"))
    return c.select("c_custkey", "country", F.round(numbers.to_ppp(F.col("c_acctbal"), F.col("country")), 1).alias("ppp"))


PLACE = "CASE n_nationkey % 6 WHEN 0 THEN 'España' WHEN 1 THEN 'united states' WHEN 2 THEN 'co' WHEN 3 THEN 'Perú' WHEN 4 THEN n_name ELSE 'xq' END"


@query(f"WITH m(name, code) AS (VALUES {values(COUNTRY_ISO)}) SELECT n_nationkey, coalesce(code, CASE WHEN length(k) = 2 THEN upper(k) END) AS iso FROM (SELECT n_nationkey, strip_accents(lower(trim({PLACE}))) AS k FROM nation) LEFT JOIN m ON k = name")
def country_iso(spark, sf):
    return t(spark, sf, "nation").select("n_nationkey", catalogue.country_iso(F.expr(PLACE)).alias("iso"))


@query("SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'Reino Unido' WHEN 1 THEN 'Países Bajos' WHEN 2 THEN n_name ELSE NULL END AS country FROM nation")
def country_display(spark, sf):
    raw = F.expr("CASE n_nationkey % 4 WHEN 0 THEN ' UK / London' WHEN 1 THEN 'Netherlands; Delft' WHEN 2 THEN concat(n_name, ', x') ELSE 'n/a' END")
    return t(spark, sf, "nation").select("n_nationkey", catalogue.country_display(raw).alias("country"))


ACCESS = "CASE p_partkey % 7 WHEN 0 THEN 'Híbrido' WHEN 1 THEN 'Open access (gold)' WHEN 2 THEN 'OA' WHEN 3 THEN 'Suscripción' WHEN 4 THEN 'Acceso abierto híbrido' WHEN 5 THEN '-' ELSE p_type END"


@query(
    f"""SELECT p_partkey, CASE WHEN regexp_matches(k, 'hibrid|hybrid') THEN 'Híbrido' WHEN regexp_matches(k, 'open|abiert|diamond|diamante|\\boa\\b') THEN 'Open Access' WHEN regexp_matches(k, 'suscrip|subscri|cerrad|closed|pago') THEN 'Suscripción' WHEN raw <> '-' THEN raw END AS access
    FROM (SELECT p_partkey, raw, lower(strip_accents(raw)) AS k FROM (SELECT p_partkey, {ACCESS} AS raw FROM part))"""
)
def access_normalize(spark, sf):
    return t(spark, sf, "part").select("p_partkey", catalogue.access_type(F.expr(ACCESS)).alias("access"))


MAKER = "CASE p_partkey % 5 WHEN 0 THEN 'Elsevier (Editorial Manager, APA)' WHEN 1 THEN concat(p_brand, ' wiley / springer') WHEN 2 THEN 'ieee and ACM' WHEN 3 THEN p_brand ELSE 'N/A' END"


@query(
    f"""WITH n(name) AS (VALUES {", ".join(f"({listed([p])})" for p in PUBLISHERS)}), s AS (SELECT p_partkey, nullif({MAKER}, 'N/A') AS raw FROM part)
    SELECT s.p_partkey, coalesce((SELECT name FROM n WHERE strpos(lower(raw), lower(name)) > 0 ORDER BY strpos(lower(raw), lower(name)), name LIMIT 1), raw) AS publisher FROM s"""
)
def publisher_normalize(spark, sf):
    return t(spark, sf, "part").select("p_partkey", catalogue.publisher(F.expr(MAKER)).alias("publisher"))


@query("SELECT p_partkey, CASE WHEN fee IS NULL THEN 'desconocido' WHEN fee <= 0 THEN 'sin_costo' ELSE 'con_costo' END AS status FROM (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 0::DOUBLE WHEN 1 THEN p_retailprice END AS fee FROM part)")
def cost_status(spark, sf):
    return t(spark, sf, "part").select("p_partkey", catalogue.cost_status(F.expr("CASE p_partkey % 3 WHEN 0 THEN 0D WHEN 1 THEN p_retailprice END")).alias("status"))


SUBJECT = "concat(p_name, CASE p_partkey % 6 WHEN 0 THEN ' Journal of Machine Learning' WHEN 1 THEN ' Sensor Networks, Security and Privacy' WHEN 2 THEN ' Computación en la nube: Cloud Computing Systems' WHEN 3 THEN ' AI ' ELSE '' END)"


@query(
    f"""WITH r(k, topic, words) AS (VALUES {", ".join(f"({k}, {listed([topic])}, [{listed(words)}])" for k, (topic, words) in enumerate(TOPIC_RULES))}),
    s AS (SELECT p_partkey, concat(' ', trim(regexp_replace(lower(strip_accents({SUBJECT})), '\\s+', ' ', 'g')), ' ') AS key FROM part),
    h AS (SELECT p_partkey, k, topic, row_number() OVER (PARTITION BY p_partkey ORDER BY k) AS n FROM s JOIN r ON len(list_filter(words, lambda w: contains(key, w))) > 0)
    SELECT s.p_partkey, coalesce(string_agg(topic, ';' ORDER BY k), 'Ingeniería General') AS topics FROM s LEFT JOIN h ON s.p_partkey = h.p_partkey AND n <= 4 GROUP BY s.p_partkey"""
)
def topic_infer(spark, sf):
    return t(spark, sf, "part").select("p_partkey", F.array_join(catalogue.topics(F.expr(SUBJECT)), ";").alias("topics"))


CATEGORY = "concat(p_brand, ' (Q', CAST(p_size % 4 + 1 AS STRING), '); ', p_type, CASE WHEN p_partkey % 3 = 0 THEN concat(' (q', CAST(p_size % 3 + 2 AS STRING), ')') ELSE '' END)"


@query(
    f"""WITH e AS (SELECT p_partkey, unnest(string_split({CATEGORY}, ';')) AS raw, unnest([1, 2]) AS k FROM part),
    x AS (SELECT p_partkey, k, trim(raw) AS entry, regexp_extract(trim(raw), '^(.+?)\\s*\\(([Qq][1-4])\\)', 2) AS q FROM e)
    SELECT p_partkey, CAST(k AS INTEGER) AS k, CASE WHEN q <> '' THEN regexp_extract(entry, '^(.+?)\\s*\\(([Qq][1-4])\\)', 1) ELSE entry END AS category, nullif(upper(q), '') AS quartile FROM x"""
)
def category_quartile_parse(spark, sf):
    rows = t(spark, sf, "part").select("p_partkey", F.posexplode(flags.category_list(F.expr(CATEGORY))).alias("k", "c"))
    return rows.select("p_partkey", (F.col("k") + 1).alias("k"), F.col("c.category").alias("category"), F.col("c.quartile").alias("quartile"))


@query(
    """SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN concat('Q', CAST(least(p_size % 4 + 1, p_size % 3 + 2) AS VARCHAR)) ELSE concat('Q', CAST(p_size % 4 + 1 AS VARCHAR)) END AS best, CASE WHEN p_partkey % 2 = 0 THEN concat('Q', CAST(least(p_size % 4 + 1, 3) AS VARCHAR)) END AS in_text FROM part"""
)
def best_quartile(spark, sf):
    mentioned = F.expr("CASE WHEN p_partkey % 2 = 0 THEN concat('Q', CAST(p_size % 4 + 1 AS STRING), '/q 3') ELSE 'sin cuartil' END")
    return t(spark, sf, "part").select("p_partkey", flags.best_quartile(flags.category_list(F.expr(CATEGORY))).alias("best"), flags.quartile_in_text(mentioned).alias("in_text"))


GRADES = ("CASE p_size % 5 WHEN 0 THEN 'A1' WHEN 1 THEN 'a2' WHEN 2 THEN 'B' WHEN 3 THEN 'C' END", "CASE p_partkey % 5 WHEN 0 THEN 'Q1' WHEN 1 THEN 'Q2' WHEN 2 THEN 'Q3' WHEN 3 THEN 'Q4' ELSE 'x' END")


@query("SELECT p_partkey, a, b, a - b AS gap, CASE WHEN a > 0 AND b > 0 THEN a / b::DOUBLE END AS ratio FROM (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 4 WHEN 1 THEN 3 WHEN 2 THEN 2 WHEN 3 THEN 1 ELSE 0 END AS a, CASE p_partkey % 5 WHEN 0 THEN 4 WHEN 1 THEN 3 WHEN 2 THEN 2 WHEN 3 THEN 1 ELSE 0 END AS b FROM part)")
def ordinal_gap(spark, sf):
    p = t(spark, sf, "part").select("p_partkey", flags.category_ordinal(F.expr(GRADES[0])).alias("a"), flags.quartile_ordinal(F.expr(GRADES[1])).alias("b"))
    gap, ratio = flags.ordinal_gap(F.col("a"), F.col("b"))
    return p.withColumn("gap", gap).withColumn("ratio", ratio)


FLAGS = ("CASE o_orderkey % 3 WHEN 0 THEN true WHEN 1 THEN false END", "CASE o_orderkey % 4 WHEN 0 THEN true WHEN 1 THEN false END", "CASE o_orderkey % 5 WHEN 0 THEN 0.0 WHEN 1 THEN 10.5 END", "CASE o_orderkey % 7 WHEN 0 THEN 'CO' WHEN 1 THEN 'US' WHEN 2 THEN 'ZW' END", "CASE o_orderkey % 6 WHEN 0 THEN 'Open peer review' WHEN 1 THEN 'Revisión abierta' WHEN 2 THEN 'Blind' END")


@query(
    f"""SELECT o_orderkey, coalesce(oa, false) AND (NOT coalesce(has_fee, false) OR coalesce(fee, 0) = 0) AS diamond, coalesce(has_fee, false) OR coalesce(country IN ('CO', 'ZW'), false) AS waiver, coalesce(regexp_matches(lower(review), 'open|abierta'), false) AS open_review,
    coalesce(country = 'CO', false) AS national, o_orderkey % 2 = 0 AS indexed, coalesce(weeks <= 12, false) AS fast
    FROM (SELECT o_orderkey, {FLAGS[0]} AS oa, {FLAGS[1]} AS has_fee, CAST({FLAGS[2]} AS DOUBLE) AS fee, {FLAGS[3]} AS country, {FLAGS[4]} AS review, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 30 END AS weeks FROM orders)"""
)
def binary_flags(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", *(F.expr(x).alias(n) for x, n in zip(FLAGS, ("oa", "has_fee", "fee", "country", "review"))), F.expr("CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 30 END").alias("weeks"), F.expr("CASE WHEN o_orderkey % 2 = 0 THEN array('doaj', 'publindex') ELSE array('publindex') END").alias("sources"))
    c = F.col
    return o.select("o_orderkey", flags.diamond(c("oa"), F.lit(None).cast("boolean"), c("has_fee"), c("fee").cast("double")).alias("diamond"), flags.waiver(c("has_fee"), c("country")).alias("waiver"), flags.open_review(c("review")).alias("open_review"), flags.is_country(c("country")).alias("national"), flags.indexed(c("sources")).alias("indexed"), flags.publishes_fast(c("weeks")).alias("fast"))


@query("SELECT p_partkey, CASE WHEN p_size > 5 THEN p_retailprice / p_size WHEN p_partkey % 2 = 0 THEN p_retailprice END AS ratio FROM part")
def cite_ratio(spark, sf):
    return t(spark, sf, "part").select("p_partkey", flags.cites_per_document(F.col("p_retailprice"), F.expr("CASE WHEN p_size > 5 THEN p_size ELSE 0 END"), F.expr("CASE WHEN p_partkey % 2 = 0 THEN p_retailprice END")).alias("ratio"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN true WHEN 1 THEN false END AS loose, CASE p_partkey % 4 WHEN 1 THEN false END AS exact, p_partkey % 4 IN (0, 3) AS truth FROM part")
def yes_no(spark, sf):
    p = t(spark, sf, "part")
    said = F.expr("CASE p_partkey % 4 WHEN 0 THEN 'YES' WHEN 1 THEN 'No' WHEN 2 THEN 'quizá' END")
    return p.select("p_partkey", flags.yes_no(said).alias("loose"), flags.yes_no(said, exact=True).alias("exact"), flags.truthy(F.coalesce(said, F.lit("1"))).alias("truth"))


def _cleaned(x: str) -> str:
    x = rf"regexp_replace({x}, '(?is)\b(?:equation|align|gather|math)\*?\b.*?\bend\b', ' ', 'g')"
    x = rf"regexp_replace({x}, '(?s)\$\$.*?\$\$|\\\(.*?\\\)|\\\[.*?\\\]', ' ', 'g')"
    x = rf"regexp_replace({x}, '\$(?:[^$]|\\\$)+\$', ' ', 'g')"
    x = rf"translate(replace(regexp_replace({x}, '\\[a-zA-Z]+\s*', ' ', 'g'), '--', ' '), '{{}}', '  ')"
    return rf"trim(regexp_replace(regexp_replace({_folded(f'lower({x})')}, '[^A-Za-z0-9_\s-]', ' ', 'g'), '\s+', ' ', 'g'))"


def _stemmed(w: str) -> str:
    cases = " ".join(f"WHEN {w} LIKE '%{s}' AND length({w}) >= {len(s) + 4} THEN left({w}, length({w}) - {len(s)})" for s in (*SUFFIXES_ES, *SUFFIXES_EN))
    return f"CASE WHEN length({w}) <= 4 OR regexp_matches({w}, '[0-9]') THEN {w} {cases} ELSE {w} END"


STOP = listed(sorted({*STOPWORDS_ES, *STOPWORDS_EN}))
PREPROCESSED = lambda x: f"array_to_string(list_transform(list_filter(string_split({_cleaned(x)}, ' '), lambda w: length(w) > 1 AND w NOT IN ({STOP})), lambda w: {_stemmed('w')}), ' ')"


@query(f"SELECT conv_id, turn, {_cleaned('text')} AS cleaned FROM conversations")
def clean_text(spark, sf):
    return t(spark, sf, "conversations").select("conv_id", "turn", text.clean_scientific(F.col("text")).alias("cleaned"))


@query(f"SELECT p_partkey, array_to_string(list_transform(string_split(lower(concat(p_name, ' ', p_type, ' studying evaluated aciones organizaciones normalization')), ' '), lambda w: {_stemmed('w')}), ' ') AS stems FROM part")
def lemmatize(spark, sf):
    words = F.split(F.lower(F.concat("p_name", F.lit(" "), "p_type", F.lit(" studying evaluated aciones organizaciones normalization"))), " ")
    return t(spark, sf, "part").select("p_partkey", F.array_join(F.transform(words, lambda w: text.stem(w)), " ").alias("stems"))


@query(f"SELECT doc_id, {PREPROCESSED('text')} AS tokens FROM documents")
def preprocess(spark, sf):
    return t(spark, sf, "documents").select("doc_id", text.preprocess(F.col("text")).alias("tokens"))


@query(f"SELECT item_id, {PREPROCESSED('''concat_ws(' ', nullif(trim(text), ''), nullif(trim(text), ''), CASE WHEN item_id % 2 = 0 THEN 'neural networks' END)''')} AS tokens FROM benchmark")
def manuscript_text(spark, sf):
    return t(spark, sf, "benchmark").select("item_id", text.manuscript_text(F.col("text"), F.col("text"), F.expr("CASE WHEN item_id % 2 = 0 THEN 'neural networks' END")).alias("tokens"))


@query(
    r"""SELECT doc_id, trim(regexp_replace(lower(strip_accents(concat_ws(' ', source, lang, text))), '\s+', ' ', 'g')) AS key FROM documents"""
)
def search_keys(spark, sf):
    return t(spark, sf, "documents").select("doc_id", text.search_key(F.col("source"), F.col("lang"), F.col("text")).alias("key"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'x' WHEN 3 THEN p_name END AS cleaned, p_partkey % 4 IN (0, 3) AS letter, p_partkey % 3 = 0 AS url FROM part")
def null_markers(spark, sf):
    raw = F.expr("CASE p_partkey % 4 WHEN 0 THEN ' x ' WHEN 1 THEN 'No disponible' WHEN 2 THEN ' — ' ELSE p_name END")
    link = F.expr("CASE WHEN p_partkey % 3 = 0 THEN concat('HTTPS://a.b/', p_brand) ELSE 'IEEE Xplore: x' END")
    return t(spark, sf, "part").select("p_partkey", text.clean(raw).alias("cleaned"), catalogue.has_letter(raw).alias("letter"), catalogue.is_url(link).alias("url"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'Inglés, Español' WHEN 1 THEN 'Francés, Klingon' END AS languages, (CASE WHEN p_partkey % 3 = 2 THEN 0 ELSE 1 END) + 2 AS filled FROM part")
def language_names(spark, sf):
    raw = F.expr("CASE p_partkey % 3 WHEN 0 THEN 'english, Spanish' WHEN 1 THEN 'French,Klingon,' END")
    return t(spark, sf, "part").select("p_partkey", catalogue.language_names(raw).alias("languages"), catalogue.filled(raw, F.col("p_name"), F.lit(""), F.col("p_size")).alias("filled"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN round_even(p_retailprice, 2) WHEN p_partkey % 3 = 1 THEN 0::DOUBLE END AS fee, CASE p_partkey % 4 WHEN 0 THEN 'Híbrido' WHEN 1 THEN 'Open Access' WHEN 2 THEN 'Suscripción' END AS access FROM part")
def catalogue_row(spark, sf):
    fee = catalogue.catalogue_fee(F.expr("CASE WHEN p_partkey % 3 = 0 THEN p_retailprice END"), F.expr("CASE WHEN p_partkey % 3 = 1 THEN false WHEN p_partkey % 3 = 2 THEN true END"))
    access = catalogue.catalogue_access(F.expr("p_partkey % 4 = 0"), F.expr("CASE p_partkey % 4 WHEN 1 THEN true WHEN 2 THEN false END"), F.lit(None).cast("boolean"))
    return t(spark, sf, "part").select("p_partkey", fee.alias("fee"), access.alias("access"))
