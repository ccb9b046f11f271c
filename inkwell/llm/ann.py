"""Nearest neighbours by largest inner product, through score-aware anisotropic quantisation.

A vector is cut into pairs of components and each pair is replaced by one
of sixteen code words: four bits. The code words and the assignment minimise a
loss that weighs the part of the residual parallel to the vector, which moves
large inner products, more than the part across it. A query becomes a table of
its products with all code words, two pieces to a look-up; candidates are
scanned by table sums, and the best are reranked by the exact inner product in
double precision.

Every query meets every row, block against block: a task holds one block of
queries and one of candidates, whatever the size of the tables. Of rows with the
same vector only the k + 1 smallest ids can be among a query's k nearest, so no
more are scanned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm.common import cut, table

PIECE, WORDS = 2, 16
#: Rows of the training sample, of a block of queries and of candidates, and candidates of a block that are reranked.
SAMPLE, QUERY_BLOCK, BLOCK, RERANK = 4096, 16384, 16384, 256


class Quantiser:
    """words: (pieces, WORDS, PIECE). ratio: the weight of the parallel residual, that of the rest being 1."""

    def __init__(self, words: np.ndarray, ratio: float):
        self.words, self.ratio = words, ratio

    @property
    def width(self) -> int:
        return self.words.shape[0] * PIECE

    def pad(self, x: np.ndarray) -> np.ndarray:
        return np.pad(x, ((0, 0), (0, self.width - x.shape[1])))

    def assign(self, x: np.ndarray, sweeps: int = 3) -> np.ndarray:
        """Code words (n, pieces): nearest ones first, then each piece in turn is chosen anew under the anisotropic loss."""
        x = self.pad(x)
        n, m = len(x), self.words.shape[0]
        pieces = x.reshape(n, m, PIECE)
        unit = pieces / np.linalg.norm(x, axis=1)[:, None, None]
        off = np.stack([((pieces[:, j, None] - self.words[j]) ** 2).sum(-1) for j in range(m)], 1)
        along = np.stack([((pieces[:, j, None] - self.words[j]) * unit[:, j, None]).sum(-1) for j in range(m)], 1)
        code = off.argmin(-1)
        rows = np.arange(n)
        total = np.take_along_axis(along, code[:, :, None], 2)[:, :, 0].sum(1)
        for _ in range(sweeps):
            for j in range(m):
                rest = total - along[rows, j, code[:, j]]
                code[:, j] = (off[:, j] + (self.ratio - 1) * (rest[:, None] + along[:, j]) ** 2).argmin(1)
                total = rest + along[rows, j, code[:, j]]
        return code

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Two pieces to a byte: (n, ceil(pieces / 2))."""
        code = self.assign(x).astype(np.uint8)
        if code.shape[1] % 2:
            code = np.pad(code, ((0, 0), (0, 1)))
        return code[:, ::2] << 4 | code[:, 1::2]

    def tables(self, q: np.ndarray) -> np.ndarray:
        """For each query the products with all pairs of code words: (n, bytes, 256)."""
        single = np.einsum("nmp,mwp->nmw", self.pad(q).reshape(len(q), -1, PIECE), self.words)
        if single.shape[1] % 2:
            single = np.pad(single, ((0, 0), (0, 1), (0, 0)))
        return (single[:, ::2, :, None] + single[:, 1::2, None, :]).reshape(len(q), -1, 256).astype(np.float32)


def train(x: np.ndarray, threshold: float = 0.2, rounds: int = 6, seed: int = 3) -> Quantiser:
    """Fit to a sample of unpadded vectors; threshold is the cosine from which inner products matter."""
    d = x.shape[1]
    m = -(-d // PIECE)
    rng = np.random.default_rng(seed)
    ratio = max(1.0, (d - 1) * threshold**2 / (1 - threshold**2))
    full = np.pad(x, ((0, 0), (0, m * PIECE - d)))
    words = full[rng.integers(0, len(x), (m, WORDS)), :].reshape(m, WORDS, m, PIECE)[np.arange(m), :, np.arange(m)]
    words = words + rng.normal(0, 1e-3 * (np.abs(full).mean() + 1e-12), words.shape)
    model, norm = Quantiser(words, ratio), np.linalg.norm(x, axis=1)
    unit = full / norm[:, None]
    size = m * WORDS * PIECE
    for r in range(rounds):
        code = model.assign(x, 0 if r < 2 else 2)
        # The words that minimise the loss solve one linear system over all pieces.
        at = ((np.arange(m) * WORDS + code)[:, :, None] * PIECE + np.arange(PIECE)).reshape(len(x), -1)
        pairs = np.zeros((size, size))
        for a in range(0, len(x), 256):
            u, k = unit[a : a + 256], at[a : a + 256]
            w = (ratio - 1) * u[:, :, None] * u[:, None, :]
            np.add.at(pairs, (k[:, :, None], k[:, None, :]), w)
        diagonal = np.bincount(at.ravel(), minlength=size).astype(float)
        right = np.bincount(at.ravel(), weights=(ratio * full).ravel(), minlength=size)
        pairs[np.arange(size), np.arange(size)] += diagonal + 1e-3
        words = np.linalg.solve(pairs, right + 1e-3 * model.words.ravel()).reshape(m, WORDS, PIECE)
        model = Quantiser(words, ratio)
    return model


def scan(model: Quantiser, query_id: np.ndarray, query: np.ndarray, vec_id: np.ndarray, vector: np.ndarray, code: np.ndarray, k: int, rerank: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of one block of candidates for each query but itself: (query ids, candidate ids, exact scores)."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    columns = np.ascontiguousarray(code.T).astype(np.intp)
    for at in range(0, len(query), 128):
        q, qid = query[at : at + 128], query_id[at : at + 128]
        sums = np.zeros((len(q), len(vec_id)), np.float32)
        look = model.tables(q)
        for j, column in enumerate(columns):
            sums += np.take(look[:, j], column, axis=1)
        if len(vec_id) > rerank:
            least = np.partition(sums, len(vec_id) - rerank, axis=1)[:, len(vec_id) - rerank]
            r, c = np.nonzero(sums >= least[:, None])
        else:
            r, c = np.nonzero(np.ones_like(sums, bool))
        other = qid[r] != vec_id[c]
        r, c = r[other], c[other]
        score = np.empty(len(r))
        for a in range(0, len(r), 1 << 14):
            score[a : a + (1 << 14)] = (q[r[a : a + (1 << 14)]].astype(np.float64) * vector[c[a : a + (1 << 14)]].astype(np.float64)).sum(axis=1)
        order = np.lexsort((vec_id[c], -score, r))
        r, c, score = r[order], c[order], score[order]
        first = np.searchsorted(r, np.arange(len(q)))
        best = np.arange(len(r)) - first[r] < k
        out.append((qid[r[best]], vec_id[c[best]], score[best]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))


def _matrix(column: pa.ChunkedArray, d: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def nearest(vectors: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, rerank: int = RERANK) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row where is_query(id column) holds, the k nearest of all others.

    Nearness is the inner product, largest first, ties to the smaller id. Rows
    with a null id, and vectors that are null, empty, zero, or hold nulls or
    non-finite numbers, take no part; nor do those of another length than most
    (ties to the shorter). Of rows with the same id the one with the least vector
    takes part. Other columns are not read. An empty table gives an empty one.
    """
    spark = vectors.sparkSession
    v = F.col("v")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    sound = F.col("id").isNotNull() & v.isNotNull() & F.forall(v, finite) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where(sound)
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    out = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], out)
    d, n = lengths["d"], lengths["count"]
    rows = rows.where(F.size("v") == d).groupBy("id").agg(F.min("v").alias("v"))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()
    model = train(np.array([r["v"] for r in sample], np.float64))
    kind = dict(rows.dtypes)["v"]

    def encode(batches):
        for b in batches:
            x = _matrix(pa.chunked_array([b.column(1)]), d).astype(np.float64)
            code = model.encode(x) if len(x) else np.zeros((0, 1), np.uint8)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([c.tobytes() for c in code], pa.binary())], ["id", "v", "code"])

    index = cut(rows.mapInArrow(encode, f"id long, v {kind}, code binary"))
    queries = index.where(is_query(F.col("id"))).select("id", "v")
    blocks, query_blocks = -(-n // BLOCK), max(1, -(-queries.count() // QUERY_BLOCK))
    kept = index.withColumn("k", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("k") <= k + 1)
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("cb")
    of_query = F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int").alias("qb")
    left = queries.select("id", "v", of_query, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("cb"))
    right = kept.select("id", "v", "code", block, F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"))

    def meet(q: pa.Table, c: pa.Table) -> pa.Table:
        if len(q) and len(c):
            code = np.frombuffer(b"".join(c["code"].to_pylist()), np.uint8).reshape(len(c), -1)
            found = scan(model, q["id"].to_numpy(), _matrix(q["v"], d), c["id"].to_numpy(), _matrix(c["v"], d), code, k, rerank)
        else:
            found = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        return pa.table(list(map(pa.array, found)), ["query_id", "vec_id", "score"])

    met = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInArrow(meet, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)
