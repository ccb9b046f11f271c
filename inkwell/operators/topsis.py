"""The quality-cost index: distances to the ideal and to the worst row over weighted criteria."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMENSIONS = ("quality", "cost", "efficiency")


def rank_weights(order: tuple[str, ...] | list[str], dimensions: tuple[str, ...] = DIMENSIONS) -> dict[str, float]:
    """3/6, 2/6, 1/6 by the place in the order."""
    if sorted(order) != sorted(dimensions):
        raise ValueError(f"order must be a permutation of {dimensions}")
    n = len(dimensions)
    return {d: (n - k) / (n * (n + 1) / 2) for k, d in enumerate(order)}


def topsis(df: DataFrame, criteria: dict[str, list[str]], costs: list[str] = (), eligible: str | None = None, orders: list[tuple[str, ...]] | None = None, dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """df with one index from 0 to 1 for each order of the dimensions, named topsis_1, topsis_2, ... in the order of `orders`.

    criteria: dimension to its columns. A null counts as its column's median; a column without values as 0, one
    without spread as 0; costs are inverted. Each criterion has its dimension's weight in full. Rows that are both
    ideal and worst get 0.5. If `eligible` is a column, rows where it is null get a null index but shape the ideals.
    One one-row aggregate is broadcast: a median lies between the least and the largest value, so it moves neither,
    and a scaled criterion with spread reaches both 0 and 1. All orders share one geometry.
    """
    orders = list(orders or permutations(dimensions))
    every = list(dict.fromkeys(c for d in dimensions for c in criteria.get(d, [])))
    number = lambda c: F.col(c).cast("double")
    found = df.agg(*(f(number(c)).alias(f"__{n}_{c}") for c in every for n, f in (("m", lambda x: F.percentile(x, 0.5)), ("a", F.min), ("b", F.max))))

    def unit(c: str):
        a, b = F.col(f"__a_{c}"), F.col(f"__b_{c}")
        x = (F.coalesce(number(c), F.col(f"__m_{c}")) - a) / (b - a)
        return F.when(b > a, 1 - x if c in costs else x)

    def square(c: str, end: str):
        """The squared distance from the worst or the ideal value, 0 and 1; 0 for a criterion without spread."""
        u = F.col(f"__u_{c}")
        return F.coalesce(F.pow(u if end == "lo" else u - 1, 2), F.lit(0.0))

    placed = df.crossJoin(F.broadcast(found)).withColumns({f"__u_{c}": unit(c) for c in every})
    out = placed.withColumns({f"__{n}_{d}": sum((square(c, n) for c in criteria.get(d, [])), F.lit(0.0)) for d in dimensions for n in ("lo", "hi")})
    for k, order in enumerate(orders, 1):
        w = rank_weights(order, dimensions)
        far = {n: F.sqrt(sum((F.col(f"__{n}_{d}") * w[d] ** 2 for d in dimensions), F.lit(0.0))) for n in ("lo", "hi")}
        total = far["lo"] + far["hi"]
        index = F.when(total == 0, 0.5).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), far["lo"] / total)))
        out = out.withColumn(f"topsis_{k}", index if eligible is None else F.when(F.col(eligible).isNotNull(), index))
    return out.drop(*(c for c in out.columns if c.startswith("__")))
