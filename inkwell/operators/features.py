"""Feature columns over groups and over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.constants import IQR_FACTOR


def market_share(df: DataFrame, publisher: str, name: str = "market_share") -> DataFrame:
    """Share of all rows that a row's publisher has; null publishers are one, `Desconocida`."""
    counts = df.groupBy(F.coalesce(publisher, F.lit("Desconocida")).alias("__p")).agg(F.count("*").alias("__n"))
    share = counts.crossJoin(F.broadcast(counts.agg(F.sum("__n").alias("__all")))).select("__p", (F.col("__n") / F.col("__all")).alias(name))
    return df.join(share, F.coalesce(df[publisher], F.lit("Desconocida")) == share["__p"], "left").drop("__p")


def outliers(df: DataFrame, value: str, by: str | None = None, factor: float = IQR_FACTOR, least: int = 5, name: str = "outlier") -> DataFrame:
    """Whether a value lies more than `factor` quartile ranges outside the quartiles of its group, or of all rows.

    Groups with fewer than `least` values, and groups without a range, have no outliers; the
    whole table counts even without a range. The lower bound is 0 at least. A null group is
    a group; a null value is none.
    """
    quartiles = [F.percentile(value, 0.25).alias("__q1"), F.percentile(value, 0.75).alias("__q3"), F.count(value).alias("__n")]
    if by is None:
        stats = df.agg(*quartiles)
        joined = df.crossJoin(F.broadcast(stats))
        eligible = F.lit(True)
    else:
        stats = df.groupBy(F.col(by).alias("__by")).agg(*quartiles)
        joined = df.join(stats, df[by].eqNullSafe(stats["__by"]), "left").drop("__by")
        eligible = (F.col("__n") >= least) & (F.col("__q3") > F.col("__q1"))
    spread = (F.col("__q3") - F.col("__q1")) * factor
    beyond = (F.col(value) < F.greatest(F.lit(0.0), F.col("__q1") - spread)) | (F.col(value) > F.col("__q3") + spread)
    return joined.withColumn(name, F.coalesce(eligible & beyond, F.lit(False))).drop("__q1", "__q3", "__n")


def scale(df: DataFrame, columns: list[str], decimals: int = 4) -> DataFrame:
    """column_zscore (sample deviation) and column_minmax for every column; without spread 0 for all rows, nulls too."""
    stats = df.agg(*(f(c).alias(f"__{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_samp), ("a", F.min), ("b", F.max))))
    out = df.crossJoin(F.broadcast(stats))
    for c in columns:
        s, a, b = F.col(f"__s_{c}"), F.col(f"__a_{c}"), F.col(f"__b_{c}")
        out = out.withColumn(f"{c}_zscore", F.when(s > 0, F.round((F.col(c) - F.col(f"__m_{c}")) / s, decimals)).otherwise(0.0))
        out = out.withColumn(f"{c}_minmax", F.when(b > a, F.round((F.col(c) - a) / (b - a), decimals)).otherwise(0.0))
    return out.drop(*stats.columns)


def categories(df: DataFrame, column: str, most: int = 1000) -> list[str]:
    """The sorted values of a column that is known to have few; an error beyond `most`, as they become columns."""
    found = [r[0] for r in df.select(F.col(column).cast("string")).where(F.col(column).isNotNull()).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values")
    return sorted(found)


def one_hot(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each column replaced by 0/1 columns column_value in the order of values; null is 0 in all."""
    for c in columns:
        values = categories(df, c)
        df = df.select(*(x for x in df.columns if x != c), *(F.coalesce((F.col(c).cast("string") == v).cast("int"), F.lit(0)).alias(f"{c}_{v}") for v in values))
    return df


def stratum_medians(df: DataFrame, value: str, strata: list[list[str]]) -> Column:
    """The first median there is: of a row's first stratum, else the next. Null keys are a stratum."""
    return F.coalesce(*(F.percentile(value, 0.5).over(Window.partitionBy(*s)) for s in strata))


def cost_efficiency(quality: Column, cost: Column) -> Column:
    """The legacy ratio, superseded by the TOPSIS index; scaling is the caller's."""
    return quality / (F.lit(0.1) + cost)
