"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.staging import shared_folder, stored

__all__ = ["LOWER", "UPPER", "WORD", "ascii_lower", "cut", "shared_folder", "small", "stored", "table"]

#: Space and the ASCII controls from tab to carriage return, the separators of plain words.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Rows of a batch that goes to Python: whole texts are in it, several times over.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of sf_dir. Batches for Python hold BATCH_ROWS rows at most from then on in this session, unless it asks for fewer."""
    name_of = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(name_of))
    if not 0 < rows <= BATCH_ROWS:
        spark.conf.set(name_of, str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared folder and cut its lineage: a lost executor costs what was computed since, and staging.scratch() removes the folder."""
    return stored(df)


def ascii_lower(col):
    """Lower-case A-Z alone; other letters, É among them, stay as they are."""
    plain = F.length(col) == F.octet_length(col)
    return F.when(plain, F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def small(df: DataFrame, row_bytes: int, limit_bytes: int = 32 << 20) -> DataFrame:
    """Hint a broadcast only if df's rows, counted, stay below limit_bytes; else leave a shuffled join."""
    return F.broadcast(df) if df.limit(limit_bytes // row_bytes + 1).count() * row_bytes <= limit_bytes else df
