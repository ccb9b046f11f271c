"""Where the queries of the engine's own operators are registered, each beside its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) by its name; sql is what DuckDB runs on the same tables."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def values(table: dict) -> str:
    """A fixed table as rows of a VALUES list."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'" if isinstance(x, str) else f"{x}::DOUBLE" if isinstance(x, float) else str(x)
    return ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in table.items())


def listed(items) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in items)
