"""Language identification by a byte convolutional network.

The network is trained in numpy on the driver, on a bounded sample of the
windows of a bounded sample of labelled rows, whose texts are cut up whole, and
applied to batches of fixed-length windows over whole texts. A text's
probabilities are the mean of its windows', each weighted by the bytes that are
new in it. Repetitions aren't marked here: they say nothing of a language, and
marked bytes would hardly be learned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm import bytecnn
from inkwell.llm.common import table
from inkwell.llm.sampling import labelled_rows, remainder, sampled_windows

#: Filters by width, window in bytes, and the bounds of the sample: rows of a language, windows of all these rows.
WIDTHS, WINDOW, PER_LABEL, EXAMPLES = {2: 8, 3: 16, 4: 16}, 256, 1500, 12000
UNDETERMINED = "und"


def fit(docs: DataFrame, learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_label: int = PER_LABEL, examples: int = EXAMPLES) -> bytecnn.Network | None:
    """A network for the languages of docs's rows with a language where learn holds; None without such rows with a letter. Ids tell rows apart; rows without one are not learned from."""
    known = docs if learn is None else docs.where(learn)
    rows = labelled_rows(docs, known.select(F.col(id_col).alias("id"), F.col(lang_col).alias("label")), per_label, id_col, text_col)
    view, labels = sampled_windows(rows.where(F.col("text").rlike(r"\p{L}")), WINDOW, max(WIDTHS) - 1, examples, marks=False)
    if not labels:
        return None
    classes = sorted(set(labels))
    y = np.array([classes.index(x) for x in labels])
    return bytecnn.train(shortened(view), y, bytecnn.weights(y), classes, WIDTHS, epochs=12)


def shortened(view: np.ndarray, seed: int = 7) -> np.ndarray:
    """The windows, half of them cut to between 12 and WINDOW bytes, so that texts with little evidence are learned too."""
    rng = np.random.default_rng(seed)
    size = np.where(rng.random(len(view)) < 0.5, rng.integers(12, WINDOW + 1, len(view)), WINDOW)
    return np.where(np.arange(view.shape[1])[None, :] < size[:, None], view, 0)


def probabilities(net: bytecnn.Network, texts: list[bytes]) -> np.ndarray:
    total, size = np.zeros((len(texts), len(net.classes))), np.zeros(len(texts))
    for view, of, new in bytecnn.pieces(texts, net.window, net.overlap, marks=False):
        np.add.at(total, of, bytecnn.softmax(net.logits(view)) * np.maximum(new, 1)[:, None])
        np.add.at(size, of, np.maximum(new, 1))
    return total / size[:, None]


def identify(docs: DataFrame, net: bytecnn.Network | None, text_col: str = "text") -> DataFrame:
    """docs with lang_pred string and score double (the probability of lang_pred) added.

    A null text, or one without a letter, is `und` with score 0, as is every text
    if there was nothing to learn from. Ties go to the language first in order.
    All rows and columns stay; columns called lang_pred or score are replaced.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    at = len(kept)
    mine = "__mine"
    while any(c.startswith(mine) for c in docs.columns):
        mine += "_"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            has, text = b.column(at + 1).to_numpy(zero_copy_only=False).astype(bool), b.column(at)
            pred, score = np.array([UNDETERMINED] * len(b), object), np.zeros(len(b))
            if net is not None and has.any():
                p = probabilities(net, text.filter(pa.array(has)).cast(pa.binary()).to_pylist())
                pred[has], score[has] = np.array(net.classes, object)[p.argmax(axis=1)], p.max(axis=1)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(at)), pa.array(pred.tolist(), pa.string()), pa.array(score)], [*(f.name for f in kept), "lang_pred", "score"])

    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    schema = StructType([*kept, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return docs.select(*(docs[f.name] for f in kept), F.col(text_col).alias(f"{mine}text"), letters.alias(f"{mine}letters")).mapInArrow(run, schema)


def op9(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = fit(docs, learn=remainder("doc_id", 4) != 2)
    found = identify(docs.select("doc_id", "text"), net)
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")
