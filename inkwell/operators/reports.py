"""Reports on completeness and fees."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing(column: Column) -> Column:
    """Null, blank, or a text that stands for a missing value."""
    return F.coalesce(F.lower(F.trim(column.cast("string"))).isin("", "nan", "none", "null"), F.lit(True))


def missing_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(variable, missing, total, percent), most missing first, then by name: one pass over df."""
    columns = columns or df.columns
    sums = df.agg(F.count("*").alias("__n"), *(F.count_if(missing(F.col(c))).alias(c) for c in columns))
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    rows = sums.select("__n", F.expr(f"stack({len(columns)}, {pairs}) AS (variable, missing)"))
    return rows.select("variable", "missing", F.col("__n").alias("total"), F.round(F.try_divide(F.col("missing") * 100.0, F.col("__n")), 2).alias("percent")).orderBy(F.desc("percent"), "variable")


def missing_by_row(df: DataFrame, columns: list[str], name: str = "missing") -> DataFrame:
    names = F.filter(F.array(*(F.when(missing(F.col(c)), F.lit(c)) for c in columns)), lambda x: x.isNotNull())
    return df.withColumn(name, F.array_join(names, ", ")).withColumn(f"n_{name}", F.size(names))


def quality_summary(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """One row: total, and count and percentage of each flag."""
    counts = df.agg(F.count("*").alias("total"), *(F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in flags.items()))
    return counts.select("total", *(x for n in flags for x in (F.col(n), F.round(F.try_divide(F.col(n) * 100.0, F.col("total")), 2).alias(f"{n}_percent"))))


def currency_report(df: DataFrame, currency: str, amount: str, usd: str, rate: str) -> DataFrame:
    """A row for each currency, null as a text of its own: rows, with amount, converted, without a rate, the rate and a status."""
    known = F.col(amount).isNotNull()
    out = df.groupBy(F.coalesce(F.col(currency), F.lit("sin_moneda")).alias("moneda")).agg(
        F.count("*").alias("registros"), F.count_if(known).alias("registros_con_monto"), F.count_if(known & F.col(usd).isNotNull()).alias("registros_convertidos"),
        F.count_if(known & F.col(usd).isNull()).alias("registros_sin_tasa"), F.max(rate).alias("tasa_usd"),
    )
    return out.withColumn("estado", F.when(F.col("registros_sin_tasa") > 0, "sin_tasa").when(F.col("registros_con_monto") == 0, "sin_monto").otherwise("convertida")).orderBy("moneda")


def completeness(columns: list[str]) -> Column:
    return reduce(add, (F.when(missing(F.col(c)), 0).otherwise(1) for c in columns))
