"""Every registered query of the engine's own operators, with its SQL oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from inkwell.plans import relational_queries, retrieval_queries, scalar_queries  # noqa: F401  they register their queries
from inkwell.plans.registered import ORACLES, QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
