"""Imputation of missing fees: a ridge regression if it can be trusted, else medians of strata."""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.operators.features import categories


def _design(df: DataFrame, numeric: list[str], dummies: list[str]) -> list:
    columns = [F.lit(1.0), *(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numeric)]
    for c in dummies:  # the first value is the reference
        columns += [F.coalesce((F.col(c) == v).cast("double"), F.lit(0.0)) for v in categories(df, c)[1:]]
    return columns


def ridge(df: DataFrame, target: str, numeric: list[str], dummies: list[str], penalty: float = 1.0) -> tuple[list, np.ndarray]:
    """Design columns and coefficients. One aggregate of cross products reaches the driver; the intercept is free."""
    x = _design(df, numeric, dummies)
    n = len(x)
    known = df.where(F.col(target) > 0).select(*(c.alias(f"x{i}") for i, c in enumerate(x)), F.col(target).cast("double").alias("y"))
    sums = known.agg(*(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"a{i}_{j}") for i in range(n) for j in range(i, n)), *(F.sum(F.col(f"x{i}") * F.col("y")).alias(f"b{i}") for i in range(n))).first()
    a = np.array([[sums[f"a{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(n)] for i in range(n)])
    a[range(1, n), range(1, n)] += penalty
    return x, np.linalg.solve(a, np.array([sums[f"b{i}"] or 0.0 for i in range(n)]))


def impute(df: DataFrame, target: str, numeric: list[str], dummies: list[str], strata: list[list[str]], least: int = 15, most: float = 20000.0) -> DataFrame:
    """df with nulls of target filled, and imputed boolean and method string added.

    The regression counts if `least` rows are known and positive and every prediction for a missing row lies
    between 0 and `most`; else the median of the first of `strata` that has one.
    """
    known = df.where(F.col(target) > 0).count()
    missing = F.col(target).isNull()
    if known >= least:
        x, w = ridge(df, target, numeric, dummies)
        predicted = sum((c * float(k) for c, k in zip(x[1:], w[1:])), x[0] * float(w[0]))
        fit = df.withColumn("__fit", predicted)
        wrong = fit.where(missing & ~((F.col("__fit") > 0) & (F.col("__fit") < most))).limit(1).count()
        if not wrong:
            filled = fit.withColumns({"imputed": missing, "method": F.when(missing, "regresion"), target: F.coalesce(target, F.round("__fit", 2))})
            return filled.drop("__fit")
    found = df
    for k, s in enumerate(strata):  # each stratum is aggregated on its own and joined back; nulls are a value of a stratum
        middle = df.groupBy(*(F.col(c).alias(f"__{k}_{i}") for i, c in enumerate(s))).agg(F.percentile(target, 0.5).alias(f"__median{k}"))
        if s:
            same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"__{k}_{i}")) for i, c in enumerate(s)))
            found = found.join(middle, same, "left").drop(*(f"__{k}_{i}" for i in range(len(s))))
        else:
            found = found.crossJoin(F.broadcast(middle))  # one row
    medians = [f"__median{k}" for k in range(len(strata))]
    found = found.withColumn("__median", F.coalesce(*medians)).drop(*medians)
    return found.withColumns({"imputed": missing & F.col("__median").isNotNull(), "method": F.when(missing & F.col("__median").isNotNull(), "mediana"), target: F.coalesce(target, "__median")}).drop("__median")
