"""The journal pipeline: bronze files to silver tables to the gold catalogue. Silver tables, matches and the joined catalogue are written; what is between is one lazy plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions import flags, numbers
from inkwell.functions.catalogue import country_iso
from inkwell.functions.identifiers import issn, issn_canonical, issn_list, record_hash
from inkwell.functions.text import normalize_title
from inkwell.operators import features, resolve
from inkwell.operators.dedupe import keep_first, keep_first_keyed, keep_latest
from inkwell.operators.topsis import topsis
from inkwell.staging import stored

#: Fee columns in which an observed payment outranks what was declared.
OBSERVED = ("apc_monto_usd", "apc_tipo", "apc_monto_original", "apc_moneda_original", "apc_tasa_usd", "apc_monto_ppp_usd", "apc_fuente")
CRITERIA = {
    "quality": ["sjr_score", "h_index", "cuartil_sjr_ord"],
    "cost": ["apc_monto_ppp_usd_real"],
    "efficiency": ["semanas_pub", "ratio_citas_docs"],
}
COSTS = ["apc_monto_ppp_usd_real", "semanas_pub"]


def with_row(df: DataFrame) -> DataFrame:
    """df with row_idx, the order of a file that one task reads."""
    return df.withColumn("row_idx", F.monotonically_increasing_id())


def lineage(df: DataFrame, source: str, captured: str, version: str = "1.0", state: str = "validado") -> DataFrame:
    own = [c for c in df.columns if not c.startswith("_") and c != "row_idx"]
    return df.withColumns({"_fuente": F.lit(source), "_fecha_captura": F.lit(captured), "_version_proceso": F.lit(version), "_estado_calidad": F.lit(state), "_hash_registro": record_hash(*(F.col(c) for c in own))})


def silver_national(raw: DataFrame) -> DataFrame:
    """The national index: one row for each number, the latest year; rows without a number go."""
    key = issn_canonical(F.col("TXT_ISSN_P"), F.col("TXT_ISSN_E"), F.col("TXT_ISSN_L"))
    df = raw.select(
        "row_idx", key.alias("issn_normalizado"), issn(F.col("TXT_ISSN_P")).alias("issn_print"), issn(F.col("TXT_ISSN_E")).alias("issn_electronic"), F.col("NME_REVISTA_IN").alias("titulo"),
        normalize_title(F.col("NME_REVISTA_IN")).alias("titulo_normalizado"), numbers.year(F.col("NRO_ANO")).alias("anio_clasificacion"), F.col("ID_CLAS_REV").alias("categoria_publindex"), F.col("PAIS_REV_IN").alias("pais"),
        country_iso(F.col("PAIS_REV_IN")).alias("pais_iso"), F.col("NME_ESPECIALIDAD").alias("especialidad"), F.col("NME_AREA").alias("area_conocimiento"), F.col("NME_GRAN_AREA").alias("gran_area"), F.col("NME_INST_EDIT_1").alias("institucion_editora_1"),
        F.col("ID_REVISTA_P").alias("id_revista_publindex"),
    ).where("issn_normalizado IS NOT NULL")
    df = df.withColumn("categoria_publindex_ord", flags.category_ordinal(F.col("categoria_publindex")))
    return keep_latest(df, "issn_normalizado", "anio_clasificacion", "row_idx")


def silver_ranking(raw: DataFrame) -> DataFrame:
    """The bibliometric ranking: numbers with decimal commas, categories with quartiles."""
    first, second = issn_list(F.col("Issn"))
    parsed = flags.category_list(F.col("Categories"))
    n = lambda c: numbers.locale_number(F.col(f"`{c}`"))
    df = raw.select(
        "row_idx", F.coalesce(first, second).alias("issn_normalizado"), normalize_title(F.col("Title")).alias("titulo_normalizado"), F.col("Publisher").alias("editorial"), flags.yes_no(F.col("`Open Access`")).alias("open_access"),
        n("SJR").alias("sjr_score"), flags.best_quartile(parsed, F.col("`SJR Best Quartile`")).alias("cuartil_sjr"), n("H index").cast("long").alias("h_index"), n("Total Docs. (3years)").cast("long").alias("total_docs_3y"),
        n("Total Citations (3years)").cast("long").alias("total_citas_3y"), n("Citations / Doc. (2years)").alias("citas_por_doc_2y"), numbers.percent_fraction(n("%Female")).alias("porcentaje_mujeres"), F.col("Categories").alias("categorias_scimago"), F.col("Areas").alias("areas_scimago"), F.col("Rank").alias("rank_scimago"),
    ).where("issn_normalizado IS NOT NULL")
    df = df.withColumn("cuartil_sjr_ord", flags.quartile_ordinal(F.col("cuartil_sjr")))
    return keep_first(df, ["issn_normalizado"], "row_idx")


def silver_directory(raw: DataFrame) -> DataFrame:
    """The open-access directory, under names already mapped: rows without a number stay."""
    amount, currency = numbers.declared_fee(F.col("apc_declarado"))
    usd, rate = numbers.to_usd(F.col("apc_monto_original"), F.col("apc_moneda_original"))
    df = raw.withColumns({"issn_normalizado": issn_canonical(F.col("issn_print"), F.col("issn_electronic")), "titulo_normalizado": normalize_title(F.col("titulo")), "apc_monto_original": amount, "apc_moneda_original": currency})
    df = df.withColumns({"apc_monto_usd": usd, "apc_tasa_usd": rate, "tiene_apc": flags.yes_no(F.col("tiene_apc"), True), "politica_exencion": flags.yes_no(F.col("politica_exencion"), True), "semanas_pub": numbers.first_int(F.col("semanas_pub"))})
    df = df.withColumns({"apc_tipo": F.when(F.col("apc_monto_usd").isNotNull(), "declarado"), "estado_conversion": numbers.conversion_status(F.col("apc_monto_original"), F.col("apc_monto_usd")), "indexada_doaj": F.lit(True)})
    return keep_first_keyed(df.drop("titulo", "issn_print", "issn_electronic", "apc_declarado"), "issn_normalizado", "row_idx")


def silver_payments(raw: DataFrame, kind: str = "observado") -> DataFrame:
    """Observed payments under the names of read_fees: the first usable one of each number."""
    df = raw.withColumns({"issn_normalizado": issn(F.col("issn")), "titulo_normalizado": normalize_title(F.col("title")), "apc_monto_original": numbers.locale_number(F.col("amount")), "apc_moneda_original": F.coalesce(F.col("currency"), F.lit("EUR"))})
    usd, rate = numbers.to_usd(F.col("apc_monto_original"), F.col("apc_moneda_original"))
    df = df.withColumns({"apc_monto_usd": usd, "apc_tasa_usd": rate, "apc_tipo": F.lit(kind), "is_hybrid": flags.truthy(F.col("hybrid"))})
    df = df.select("row_idx", "issn_normalizado", "titulo_normalizado", "apc_monto_original", "apc_moneda_original", "apc_monto_usd", "apc_tasa_usd", "apc_tipo", "is_hybrid")
    return keep_first(df.dropna(subset=["issn_normalizado", "apc_monto_usd"]), ["issn_normalizado"], "row_idx")


@dataclass
class Gold:
    catalogue: DataFrame
    merge_log: DataFrame


def gold(national: DataFrame, sources: dict[str, DataFrame], scorer: str = "wratio", overriding: dict[str, list[str]] | None = None, captured: str = "") -> Gold:
    """The catalogue: national joined with scimago, doaj, facts and openapc in this order, which decides who owns a name.

    Matching and the features read their input many times over, so each input is a written table.
    """
    national = stored(national)
    base, log = national, None
    for name in [n for n in ("scimago", "doaj", "facts", "openapc") if n in sources]:
        source = stored(sources[name].withColumn(f"__in_{name}", F.lit(True)))
        found = stored(resolve.match(national, source, "issn_normalizado", "titulo_normalizado", "row_idx", scorer))
        entries = resolve.merge_log(national, found, "issn_normalizado", "row_idx", name)
        log = entries if log is None else log.unionByName(entries)
        base = resolve.enrich(base, source, found, "issn_normalizado", "titulo_normalizado", "row_idx", name)
    markers = {n: f"__in_{n}" for n in sources if f"__in_{n}" in base.columns}
    base = base.withColumn("_fuentes", resolve.source_set(markers)).drop(*markers.values())
    overriding = {"openapc": list(OBSERVED)} if overriding is None else overriding
    base = resolve.coalesce_suffixes(base, ["scimago", "doaj", "facts", "openapc"], overriding)
    return Gold(engineered(stored(keep_first(base, ["issn_normalizado"], "row_idx")), captured), log)


def engineered(df: DataFrame, captured: str = "") -> DataFrame:
    """The features; a column that no source brought is null first."""
    kinds = {"open_access": "boolean", "tiene_apc": "boolean", "politica_exencion": "boolean", "tipo_revision": "string", "apc_monto_usd": "double", "apc_tipo": "string", "semanas_pub": "long", "total_citas_3y": "long", "total_docs_3y": "long", "citas_por_doc_2y": "double", "sjr_score": "double", "h_index": "long", "cuartil_sjr": "string", "cuartil_sjr_ord": "int", "editorial": "string", "oa_diamond": "boolean"}
    df = df.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items() if c not in df.columns})
    c = F.col
    gap, ratio = flags.ordinal_gap(flags.category_ordinal(c("categoria_publindex")), flags.quartile_ordinal(c("cuartil_sjr")))
    real = F.lower(F.coalesce("apc_tipo", F.lit(""))).isin("observado", "declarado")
    ppp = numbers.to_ppp(c("apc_monto_usd"), c("pais_iso"))
    df = df.withColumns({
        "oa_diamond": flags.diamond(c("open_access"), c("oa_diamond"), c("tiene_apc"), c("apc_monto_usd")), "politica_exencion_lmic": flags.waiver(c("politica_exencion"), c("pais_iso")), "revision_abierta": flags.open_review(c("tipo_revision")),
        "indexada_doaj": flags.indexed(c("_fuentes")), "es_colombia": flags.is_country(c("pais_iso")), "publicacion_rapida": flags.publishes_fast(c("semanas_pub")), "brecha_ordinal": gap, "razon_ordinal": ratio,
        "cuartil_sjr_ord": flags.quartile_ordinal(c("cuartil_sjr")), "ratio_citas_docs": flags.cites_per_document(c("total_citas_3y"), c("total_docs_3y"), c("citas_por_doc_2y")), "apc_monto_ppp_usd": ppp,
        "apc_monto_usd_real": F.when(real, c("apc_monto_usd")), "apc_monto_ppp_usd_real": F.when(real, ppp),
    })
    df = features.market_share(df, "editorial", "cuota_mercado")
    df = features.outliers(df, "apc_monto_usd", "gran_area", name="apc_atipico")
    df = features.scale(df, ["sjr_score", "h_index", "apc_monto_usd"])
    df = topsis(df, CRITERIA, COSTS, "apc_monto_ppp_usd_real", [("quality", "cost", "efficiency")]).withColumnRenamed("topsis_1", "indice_topsis_calidad_costo")
    return lineage(df, "gold", captured)
