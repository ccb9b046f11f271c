"""Evaluation of rankings against sets of relevant items."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def judged(ranked: DataFrame, relevant: DataFrame) -> DataFrame:
    """ranked (query_id, item_id, rank) with rel: the relevance, 0 for items that aren't in relevant (query_id, item_id, rel)."""
    return ranked.join(relevant.select("query_id", "item_id", "rel"), ["query_id", "item_id"], "left").fillna(0.0, ["rel"])


def at_k(ranked: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    """(query_id, precision, recall, f1, hit, ndcg) at k for every query in relevant; precision is over k even if fewer were ranked."""
    rows = judged(ranked.where(F.col("rank") <= k), relevant)
    gain = (F.pow(F.lit(2.0), F.col("rel")) - 1) / F.log2(F.col("rank") + 1.0)
    hits = rows.groupBy("query_id").agg(F.sum((F.col("rel") > 0).cast("double")).alias("hits"), F.sum(gain).alias("dcg"))
    ideal = relevant.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("rel").desc(), "item_id")))
    ideal = ideal.groupBy("query_id").agg(F.sum((F.col("rel") > 0).cast("double")).alias("n"), F.sum(F.when(F.col("rank") <= k, gain)).alias("best"))
    both = ideal.join(hits, "query_id", "left").fillna(0.0, ["hits", "dcg"])
    p, r = F.col("hits") / k, F.when(F.col("n") > 0, F.col("hits") / F.col("n")).otherwise(0.0)
    return both.select("query_id", p.alias("precision"), r.alias("recall"), F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0).alias("f1"), (F.col("hits") > 0).cast("double").alias("hit"), F.when(F.col("best") > 0, F.col("dcg") / F.col("best")).otherwise(0.0).alias("ndcg"))


def over_ranking(ranked: DataFrame, relevant: DataFrame) -> DataFrame:
    """(query_id, ap, rr) over the full ranking; ap is over all relevant items."""
    rows = judged(ranked, relevant).where("rel > 0")
    found = rows.withColumn("k", F.row_number().over(Window.partitionBy("query_id").orderBy("rank"))).groupBy("query_id").agg(F.sum(F.col("k") / F.col("rank")).alias("total"), (1.0 / F.min("rank")).alias("rr"))
    n = relevant.where("rel > 0").groupBy("query_id").agg(F.count("*").alias("n"))
    return n.join(found, "query_id", "left").select("query_id", F.coalesce(F.col("total") / F.col("n"), F.lit(0.0)).alias("ap"), F.coalesce("rr", F.lit(0.0)).alias("rr"))


def summary(ranked: DataFrame, relevant: DataFrame, cutoffs: list[int]) -> DataFrame:
    """(metric, k, value): macro means over the queries; map and mrr have no k."""
    parts = None
    for k in cutoffs:
        means = at_k(ranked, relevant, k).agg(*(F.avg(c).alias(c) for c in ("precision", "recall", "f1", "hit", "ndcg")))
        rows = means.select(F.lit(k).alias("k"), F.expr("stack(5, 'precision', precision, 'recall', recall, 'f1', f1, 'hit', hit, 'ndcg', ndcg) AS (metric, value)"))
        parts = rows if parts is None else parts.unionByName(rows)
    whole = over_ranking(ranked, relevant).agg(F.avg("ap").alias("ap"), F.avg("rr").alias("rr"))
    rows = whole.select(F.lit(None).cast("int").alias("k"), F.expr("stack(2, 'map', ap, 'mrr', rr) AS (metric, value)"))
    return (rows if parts is None else parts.unionByName(rows)).select("metric", "k", "value")


def alpha_grid(scores: DataFrame, relevant: DataFrame, by: str = "ndcg", k: int = 10, steps: int = 11) -> DataFrame:
    """(alpha, value) of scores (query_id, item_id, tfidf, dense) fused at each alpha from 0 to 1; by ndcg at k, or mrr."""
    grid = scores.sparkSession.range(steps).select((F.col("id") / (steps - 1.0)).alias("alpha"))
    fused = scores.crossJoin(F.broadcast(grid)).withColumn("score", F.round(F.col("alpha") * F.col("tfidf") + (1 - F.col("alpha")) * F.col("dense"), 12))
    pair = F.struct("alpha", "query_id").alias("query_id")
    order = Window.partitionBy("alpha", "query_id").orderBy(F.col("score").desc(), "item_id")
    ranked = fused.withColumn("rank", F.row_number().over(order)).select(pair, "item_id", "rank")
    wanted = relevant.crossJoin(F.broadcast(grid)).select(pair, "item_id", "rel")
    each = at_k(ranked, wanted, k).withColumnRenamed("ndcg", "value") if by == "ndcg" else over_ranking(ranked, wanted).withColumnRenamed("rr", "value")
    return each.groupBy(F.col("query_id.alpha").alias("alpha")).agg(F.avg("value").alias("value"))


def best_alpha(grid: DataFrame) -> float:
    """The lowest alpha among the best."""
    return grid.orderBy(F.col("value").desc(), "alpha").first()["alpha"]


def split(ids: DataFrame, id_col: str, share: float = 0.2, seed: int = 42) -> DataFrame:
    """ids with test boolean: the max(1, round(n * share)) first by a seeded hash, all rows of an id alike.

    Counts of 65536 ranges of the hash tell in which the boundary lies; that range alone is sorted, and no ids meet in one task.
    """
    place = F.struct(F.xxhash64(F.lit(seed), F.col(id_col)).alias("h"), F.col(id_col).alias("id"))
    placed = ids.select(place.alias("at")).withColumn("range", F.shiftright("at.h", 48))
    counts = placed.groupBy("range").count().orderBy("range").collect()
    rest = max(1, round(sum(c["count"] for c in counts) * share))
    for c in counts:
        if rest <= c["count"]:
            last = placed.where(F.col("range") == c["range"]).orderBy("at").offset(rest - 1).limit(1).select("at.*").first()
            kinds = placed.select("at.*").schema
            edge = F.struct(*(F.lit(last[f.name]).cast(f.dataType).alias(f.name) for f in kinds))
            return ids.withColumn("test", place <= edge)
        rest -= c["count"]
    return ids.withColumn("test", F.lit(False))
