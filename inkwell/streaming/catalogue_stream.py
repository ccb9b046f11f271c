"""Extensions in streaming form: continuous upserts, sessions and windowed counts. The reference runs in batch alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.operators.upsert import upsert


def upsert_stream(changes: DataFrame, path: str, key: list[str], checkpoint: str, order: str):
    """A query that merges each micro-batch of changes into versions of a table under path; the latest change of a key wins.

    Every batch writes a new version, named by its number, so a repeated batch rewrites its own version and nothing is merged twice.
    """
    from inkwell.operators.dedupe import first_by

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = first_by(batch, key, F.col(order).desc())
        current = spark.read.parquet(f"{path}/v{number - 1}") if number else None
        state = rows.withColumn("modified", F.lit(False)) if current is None else upsert(current, rows, key, prune=False)
        state.write.mode("overwrite").parquet(f"{path}/v{number}")

    return changes.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)


def sessions(events: DataFrame, ts: str = "ts", user: str = "user_id", gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """(user, start, end, n) of each user's sessions; in a stream, events later than `late` are dropped."""
    held = events.withWatermark(ts, late) if events.isStreaming else events
    out = held.groupBy(F.session_window(ts, gap).alias("w"), user).agg(F.count("*").alias("n"))
    return out.select(user, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def windowed_counts(events: DataFrame, ts: str = "ts", by: str = "event_type", width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    held = events.withWatermark(ts, late) if events.isStreaming else events
    out = held.groupBy(F.window(ts, width).alias("w"), by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), by, "n", "total")
