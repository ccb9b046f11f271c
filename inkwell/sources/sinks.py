"""Sinks: tables as Parquet or CSV, and one-row reports as JSON."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Overwrites path; CSV by the suffix, else Parquet, partitioned if asked for."""
    writer = df.write.mode("overwrite")
    if by:
        writer = writer.partitionBy(*by)
    if path.endswith(".csv"):
        writer.csv(path, header=True)
    else:
        writer.parquet(path)


def report(df: DataFrame) -> str:
    """The one row of an aggregate as JSON text."""
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise ValueError("a report is one row")
    return json.dumps(rows[0].asDict(recursive=True), ensure_ascii=False, sort_keys=True, default=str)
