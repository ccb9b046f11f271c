"""One row for each key, chosen by a stated order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order. Null keys are one key."""
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("__rank = 1").drop("__rank")


def keep_latest(df: DataFrame, key: str, year: str, row: str) -> DataFrame:
    return first_by(df, [key], F.col(year).desc_nulls_last(), F.col(row))


def keep_first(df: DataFrame, keys: list[str], row: str) -> DataFrame:
    return first_by(df, keys, F.col(row))


def keep_first_keyed(df: DataFrame, key: str, row: str) -> DataFrame:
    """Rows with a key once for each, rows without one all."""
    return keep_first(df.where(F.col(key).isNotNull()), [key], row).unionByName(df.where(F.col(key).isNull()))


def most_complete(df: DataFrame, key: str, filled: Column, row: str) -> DataFrame:
    return first_by(df, [key], filled.desc(), F.col(row))


def gap_clusters(df: DataFrame, by: list[str], position: str, gap: float, name: str = "cluster") -> DataFrame:
    """Numbers from 0: a new cluster begins where the step from the row before is `gap` or more."""
    order = Window.partitionBy(*by).orderBy(position)
    begins = F.coalesce((F.col(position) - F.lag(position).over(order) >= gap).cast("int"), F.lit(0))
    return df.withColumn("__begins", begins).withColumn(name, F.sum("__begins").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("__begins")


def repeated_lines(df: DataFrame, id_col: str, text_col: str, least: int = 3) -> DataFrame:
    """(id, line, pages) of the trimmed lines on `least` or more pages, pages being parted by form feeds."""
    pages = df.select(id_col, F.posexplode(F.split(text_col, "\f")).alias("page", "body"))
    lines = pages.select(id_col, "page", F.explode(F.split("body", "\n")).alias("raw")).select(id_col, "page", F.regexp_replace("raw", r"^\s+|\s+$", "").alias("line"))
    return lines.where("line <> ''").groupBy(id_col, "line").agg(F.countDistinct("page").alias("pages")).where(F.col("pages") >= least)
