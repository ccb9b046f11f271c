"""Bilingual text of the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import preprocess, split_languages

#: Fields whose language is known, and those whose tokens decide.
SPANISH_FIELDS = ("especialidad", "area_conocimiento", "gran_area", "categoria_publindex")
ENGLISH_FIELDS = ("categorias_scimago", "categorias", "areas_scimago", "areas")
MIXED_FIELDS = ("titulo_normalizado", "titulo_normalizado_scimago_dup", "titulo_normalizado_doaj_dup", "titulo_alternativo", "palabras_clave", "materias")
REAL_FEES = ("observado", "declarado")


def bilingual(df: DataFrame, languages: str = "idiomas") -> DataFrame:
    """df with texto_espanol, texto_ingles (distinct tokens in order) and their counts; missing fields are skipped."""
    declared = F.col(languages) if languages in df.columns else F.lit(None).cast("string")
    parts = [split_languages(F.col(c), declared, d) for fields, d in ((SPANISH_FIELDS, "es"), (ENGLISH_FIELDS, "en"), (MIXED_FIELDS, None)) for c in fields if c in df.columns]
    empty = F.expr("cast(array() as array<string>)")
    for k, name in enumerate(("espanol", "ingles")):
        tokens = F.array_distinct(F.concat(*(p[k] for p in parts))) if parts else empty
        df = df.withColumn(f"texto_{name}", F.array_join(tokens, " ")).withColumn(f"tokens_{name}", F.size(tokens))
    return df


def real_fee(kind, imputed=None):
    """Whether a fee was observed or declared, and not imputed."""
    real = F.lower(F.coalesce(kind, F.lit(""))).isin(*REAL_FEES)
    return real if imputed is None else real & ~F.coalesce(imputed, F.lit(False))


def mask_fees(df: DataFrame, columns: list[str], kind: str = "apc_tipo", imputed: str = "apc_imputado") -> DataFrame:
    """Fee columns nulled where the fee isn't real; apc_real_disponible tells."""
    real = real_fee(F.col(kind), F.col(imputed) if imputed in df.columns else None)
    return df.withColumns({c: F.when(real, F.col(c)) for c in columns if c in df.columns}).withColumn("apc_real_disponible", real)


def journal_text(df: DataFrame, key: str, columns: tuple[str, ...] = ("texto_espanol", "texto_ingles")) -> DataFrame:
    """(key, text) for the model from the text columns there are; an error if there are none."""
    held = [c for c in columns if c in df.columns]
    if key not in df.columns or not held:
        raise ValueError(f"the table needs {key} and one of {columns}")
    return df.select(key, preprocess(F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in held))).alias("text"))
