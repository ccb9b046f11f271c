"""Tables kept between stages in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: The folders written in each open scratch(), the innermost last.
_scopes: list[list[str]] = []
#: Spark removes what a query has shuffled as soon as it ends; else it stays until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: what spark.checkpoint.dir names, or one already set on the context.

    A temporary one is set only where neither names one and the master is local, as in tests.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or Path(tempfile.mkdtemp(prefix="inkwell-checkpoint-")).as_uri())
    return sc._jsc.sc().getCheckpointDir().get()


def stored(df: DataFrame) -> DataFrame:
    """df written as Parquet in the shared folder, and read again: its lineage ends there, and later scans take the columns they need.

    Inside scratch() the shuffle files of the write go when it has ended.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"
    if not _scopes:
        df.write.parquet(path)
    else:
        _scopes[-1].append(path)
        before = spark.conf.get(CLEANUP, None)
        spark.conf.set(CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Yields keep(df), which stores df; every other folder that stored() writes inside is removed at the end.

    What is kept belongs to the scratch() around this one, if there is one. Tables that read a removed folder must not be used afterwards.
    """
    made: list[str] = []
    kept: list[str] = []
    _scopes.append(made)

    def keep(df: DataFrame) -> DataFrame:
        out = stored(df)
        kept.append(made[-1])
        return out

    try:
        yield keep
    finally:
        _scopes.remove(made)
        if _scopes:
            _scopes[-1].extend(kept)
        jvm = spark._jvm
        for path in set(made) - set(kept):
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
