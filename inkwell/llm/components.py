"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Edges (u, v) of longs, u <> v, to (u, root): the smallest node that u reaches, for every u but the roots.

    Every round is cut in the shared folder, so a lost executor costs one round;
    only two numbers a round reach the driver. An empty table gives an empty table.
    """
    edges = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    mark = None
    while True:
        edges = cut(_small_star(_large_star(edges)))
        seen = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == mark or not seen[0]:
            return edges.withColumnRenamed("v", "root")
        mark = seen
