"""The bounded sample of labelled rows that a classifier is fitted to."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Over
from pyspark.sql import functions as F

from inkwell.llm import bytecnn
from inkwell.llm.common import cut

#: The most different labels a classifier is fitted to.
MOST_LABELS = 256


def remainder(id_col: str, n: int) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n))


def labelled_rows(docs: DataFrame, labels: DataFrame, per_label: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, label, h, text), stored: the per_label ids of each label with the smallest hashes h, all if there are fewer, with their whole texts.

    labels: (id, label), nulls left out, repeated ones once; over MOST_LABELS
    labels are an error. Of several texts under one id the least is taken. Only
    ids and labels are ranked, and of these hardly more than the sample: a share of
    each label's hashes that its count gives. What is broadcast is per_label ids of
    MOST_LABELS labels at most.
    """
    known = labels.select("id", "label").dropna().distinct().withColumn("h", F.xxhash64(F.col("id").cast("string")))
    counts = known.groupBy("label").agg(F.count("*").alias("n")).limit(MOST_LABELS + 1).collect()
    if len(counts) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels")
    # Six standard deviations more than are wanted, so that enough remain to rank.
    share = F.lit(per_label + 6 * per_label**0.5 + 36) / F.count("*")
    shares = known.groupBy("label").agg(F.least(share, F.lit(1.0)).alias("share"))
    place = F.col("h").cast("double") / float(1 << 64) + 0.5
    few = known.join(F.broadcast(shares), "label").where(place <= F.col("share"))
    rank = F.row_number().over(Over.partitionBy("label").orderBy("h", "id"))
    chosen = cut(few.withColumn("k", rank).where(F.col("k") <= per_label).select("id", "label", "h"))
    read = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).where(F.col(text_col).isNotNull())
    found = read.join(F.broadcast(chosen), F.col("doc") == F.col("id"))
    return cut(found.groupBy("id", "label", "h").agg(F.min("text").alias("text")))


def sampled_windows(rows: DataFrame, size: int, overlap: int, most: int, marks: bool = True) -> tuple[np.ndarray, list]:
    """(windows, labels): `most` of all windows of the whole texts of labelled rows, drawn by hashes of row and place.

    A window's weight is one over the number of its row's, so that long texts do
    not crowd out short ones. Executors cut the texts up; `most` windows reach the
    driver. Reruns agree.
    """
    step, context = size - overlap, bytecnn.LAGS + bytecnn.RUN
    kind = rows.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for label, h, text in zip(b.column(0), b.column(1), b.column(2).cast(pa.binary())):
                t = text.as_py()
                total = -(-max(len(t), 1) // step)
                for first in range(0, max(len(t), 1), step << 12):
                    starts = range(first, min(max(len(t), 1), first + (step << 12)), step)
                    pieces = [t[max(0, a - context) : a + size] for a in starts]
                    n = len(pieces)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([label.as_py()] * n, label.type), pa.array([h.as_py()] * n), pa.array(starts, pa.int64()), pa.array(pieces, pa.binary()), pa.array([min(a, context) for a in starts], pa.int64()), pa.array([total] * n, pa.int64())],
                        ["label", "h", "at", "piece", "lead", "of"],
                    )

    made = rows.select("label", "h", "text").mapInArrow(run, f"label {kind}, h long, at long, piece binary, lead long, of long")
    even = F.xxhash64("h", "at").cast("double") / float(1 << 64) + (0.5 + 2.0**-54)
    found = made.orderBy(-F.log(even) * F.col("of"), "h", "at", "label").limit(most).select("label", "piece", "lead").collect()
    if not found:
        return np.empty((0, size), np.int16), []
    lead = np.array([r["lead"] for r in found])
    own = np.array([max(1, min(step, len(r["piece"]) - r["lead"])) for r in found])
    return bytecnn.windows([bytes(r["piece"]) for r in found], size, overlap, lead, own, marks)[0], [r["label"] for r in found]
