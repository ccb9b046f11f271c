"""Quality scores by a byte-level convolutional network over overlapping chunks.

Filters are learned on chunks of labelled texts. A document's chunks, which
cover all of it, give a mean, a smallest and a largest response of the network;
a logistic regression on these three gives the document's one probability. It is
learned on whole texts of every length, of rows that the filters did not see.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm import bytecnn
from inkwell.llm.common import table
from inkwell.llm.sampling import labelled_rows, remainder, sampled_windows

#: Filters by width, chunk in bytes, and the bounds of the sample: rows of a label, chunks of all these rows.
WIDTHS, CHUNK, PER_LABEL, EXAMPLES = {3: 16, 5: 16}, 256, 3000, 16000


class Model:
    """network: classes 0 and 1; combine: weights of the mean, smallest and largest margin, and a constant."""

    def __init__(self, network: bytecnn.Network | None, combine: np.ndarray):
        self.network, self.combine = network, combine

    def margins(self, texts: list[bytes]) -> np.ndarray:
        total, size = np.zeros(len(texts)), np.zeros(len(texts))
        low, high = np.full(len(texts), np.inf), np.full(len(texts), -np.inf)
        for view, of, new in bytecnn.pieces(texts, self.network.window, self.network.overlap):
            logits = self.network.logits(view)
            m, w = np.clip(logits[:, 1] - logits[:, 0], -20, 20), np.maximum(new, 1)
            np.add.at(total, of, m * w)
            np.add.at(size, of, w)
            np.minimum.at(low, of, m)
            np.maximum.at(high, of, m)
        return np.stack([total / size, low, high, np.ones(len(texts))], 1)

    def probability(self, texts: list[bytes]) -> np.ndarray:
        if self.network is None:
            return np.full(len(texts), self.combine[-1])
        return 1 / (1 + np.exp(-(self.margins(texts) @ self.combine)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_label: int = PER_LABEL, examples: int = EXAMPLES) -> Model:
    """labels: (id, label) with label 0 or 1; an id with both is learned from as both. With one label alone, or none, every score is that label, or a half."""
    rows = labelled_rows(docs, labels, per_label, id_col, text_col)
    there = sorted(r["label"] for r in rows.select("label").distinct().collect())
    if len(there) < 2:
        return Model(None, np.array([float(there[0]) if there else 0.5]))
    # A quarter of the rows is kept from the filters, and the combination is learned there, on whole texts.
    fold = F.pmod(F.xxhash64("h"), F.lit(4)) == 0
    rest = rows.where(fold)
    if rest.select("label").distinct().count() < 2 or rows.where(~fold).select("label").distinct().count() < 2:
        fold, rest = F.lit(False), rows
    view, y = sampled_windows(rows.where(~fold), CHUNK, max(WIDTHS) - 1, examples)
    y = np.array([int(v) for v in y])
    model = Model(bytecnn.train(view, y, bytecnn.weights(y), [0, 1], WIDTHS), np.zeros(4))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = model.margins(b.column(2).cast(pa.binary()).to_pylist()) if len(b) else np.zeros((0, 4))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1).cast(pa.int64()), *map(pa.array, m.T.copy())], ["h", "label", "mean", "low", "high", "one"])

    found = rest.select("h", "label", "text").mapInArrow(run, "h long, label long, mean double, low double, high double, one double").orderBy("h", "label").collect()
    x, target = np.array([r[2:] for r in found]), np.array([r["label"] for r in found])
    balance = np.where(target == 1, 0.5 / max(1, (target == 1).sum()), 0.5 / max(1, (target == 0).sum()))
    for _ in range(30):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-(x @ model.combine)))
        hessian = (x * (balance * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(4)
        model.combine -= np.linalg.solve(hessian, x.T @ (balance * (p - target)) + 1e-3 * model.combine)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row of docs: the probability of label 1 for the whole text.

    Null and empty texts are one empty chunk and are scored as such. Repeated
    rows score alike. Other columns of docs are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = model.probability([t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()]) if len(b) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p)], ["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, score double")


def op2(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.where(remainder("doc_id", 3) != 1).select(F.col("doc_id").alias("id"), F.col("quality").alias("label")))
    held = F.coalesce(remainder("id", 3) == 1, F.lit(False))
    return score(docs, model).select(F.col("id").alias("doc_id"), held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
