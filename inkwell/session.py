"""Session settings shared by the tests, the bench and local runs."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | None = None, app: str = "inkwell", **extra: str) -> SparkSession:
    """A local session; on a cluster the caller's own session is used instead."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    conf = {
        "spark.master": f"local[{cpus}]",
        "spark.app.name": app,
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | extra
    spark = SparkSession.builder.config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
