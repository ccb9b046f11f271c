"""Near-duplicates by SimHash, compared through a table of distances to reference fingerprints.

Text becomes a 64-bit fingerprint, and each distinct fingerprint gets its row of
the pivot table once: its distances to PIVOTS reference fingerprints. The Hamming
distance is a metric, so a pair whose distances to any reference differ by more
than `bits` cannot be linked; it is discarded by its largest coordinate
difference, and the survivors are verified by their own distance.

The search is partitioned without loss: fingerprints within `bits` of each other
(4 at most) agree on all but four of any number of bit blocks, so each goes, with
its row of the table, to one partition for every choice of the others. Blocks are
six up to 2^27 distinct fingerprints, then seven, then eight: the keys widen with
the table, so that partitions stay small.

A partition is not expanded into pairs: it yields one edge for each member that
joins a class. A partition over TILE members is split into pairs of tiles, each
a task of its own. Exact copies share one fingerprint row throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from inkwell.llm.common import cut, small
from inkwell.llm.components import components

SEED, PIVOTS, TILE = 42, 32, 4096
#: Blocks by the most distinct fingerprints, as a power of two, they serve; a pair agrees on all blocks but four.
BLOCKS = ((27, 6), (33, 7), (63, 8))


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """SimHash of one text as an unsigned number; 0 for a null text or one without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z alone, and exactly the separators of WORD
    if not words:
        return 0
    k = min(shingle, len(words))
    joined, size = b" ".join(words), np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    starts, ends = (end - size)[: len(words) - k + 1].tolist(), end[k - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return folded(np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends)], np.uint64))


def folded(hashes: np.ndarray) -> int:
    """The fingerprint of a text's shingles by their hashes: a bit is set if over half of them have it; 0 for none."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        h = hashes[at : at + (1 << 16)].astype(">u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp) for every row of docs; fp holds the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, fp long")


def references(n: int = PIVOTS) -> np.ndarray:
    """Fixed reference fingerprints: the splitmix64 sequence from SEED."""
    z = np.uint64(SEED) + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def pivot_table(fps: DataFrame) -> DataFrame:
    """Distinct fingerprints (fp, ...) with far: their distances to the references, a byte each."""
    width = fps.columns.index("fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(width).to_numpy(zero_copy_only=False).view(np.uint64)
            far = np.bitwise_count(fp[:, None] ^ references()[None, :]).astype(np.uint8)
            rows = pa.FixedSizeBinaryArray.from_buffers(pa.binary(PIVOTS), len(b), [None, pa.py_buffer(far.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, rows], [*b.schema.names, "far"])

    return fps.mapInArrow(run, StructType([*fps.schema.fields, StructField("far", BinaryType())]))


def _keys(fp: Column, blocks: int) -> Column:
    """One key for each choice of all blocks but four: their bits, under the number of the choice."""
    width = [64 // blocks + (i < 64 % blocks) for i in range(blocks)]
    start = np.cumsum([0, *width]).tolist()
    block = [F.shiftrightunsigned(fp, a).bitwiseAND((1 << w) - 1) for a, w in zip(start, width)]
    keys = []
    for k, chosen in enumerate(combinations(range(blocks), blocks - 4)):
        key = F.lit(k).cast("long")
        for i in chosen:
            key = F.shiftleft(key, width[i]).bitwiseOR(block[i])
        keys.append(key)
    return F.array(*keys)


def join_runs(key: np.ndarray, fp: np.ndarray, far: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Members of runs of equal keys, each with the first member of its class in the run; lone members are left out. far: their rows (n, PIVOTS) of the pivot table."""
    table = far.T.astype(np.int8)
    label = np.arange(len(key))
    left, step = np.flatnonzero(key[1:] == key[:-1]), 1
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    while len(left):
        i, j = left, left + step
        open_ = label[i] != label[j]
        i, j = i[open_], j[open_]
        for column in table:
            near = np.abs(column[i] - column[j]) <= bits
            i, j = i[near], j[near]
        near = np.bitwise_count(fp[i] ^ fp[j]) <= bits
        for a, b in zip(i[near].tolist(), j[near].tolist()):
            x, y = label[a], label[b]
            if x != y:
                s = first[np.searchsorted(first, a, "right") - 1]
                e = np.searchsorted(first, a, "right")
                run = label[s : first[e] if e < len(first) else len(key)]
                run[run == max(x, y)] = min(x, y)
        step += 1
        left = left[left + step < len(key)]
        left = left[key[left] == key[left + step]]
    joined = np.flatnonzero(label != np.arange(len(key)))
    return fp[joined], fp[label[joined]]


def keyed(table: DataFrame, blocks: int | None = None) -> DataFrame:
    """Each row of a table of fingerprints (fp, ...) under all its keys; fingerprints within 4 bits share one. blocks: chosen by the number of rows unless given."""
    n = table.count() if blocks is None else 0
    blocks = blocks or next(b for power, b in BLOCKS if n <= 1 << power)
    return table.select("*", F.explode(_keys(F.col("fp"), blocks)).alias("key"))


def links(table: DataFrame, bits: int = 4, blocks: int | None = None) -> DataFrame:
    """A pivot table (fp, far) to edges (u, v) that connect exactly the fingerprints reachable through distances of at most `bits`.

    blocks: chosen by the number of fingerprints unless given; the result is the same for any.
    """
    rows = keyed(table.select("fp", "far"), blocks)
    hot = cut(rows.groupBy("key").count().where(F.col("count") > TILE))
    split = rows.join(small(hot, 16), "key", "left").withColumn("g", F.coalesce(F.ceil(F.col("count") / TILE), F.lit(1)))
    mine = F.pmod(F.xxhash64("fp"), F.col("g"))
    tiled = split.withColumn("mine", mine).select("fp", "far", "key", "mine", F.explode(F.sequence(F.lit(0).cast("long"), F.col("g") - 1)).alias("other"))
    # Two runs with one number would only be compared in vain: what is found is verified.
    tiled = tiled.select("fp", "far", F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("run"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp, far = np.empty(0, np.int64), np.empty(0, np.uint64), np.empty((0, PIVOTS), np.uint8)
        for b in batches:
            if not len(b):
                continue
            key = np.r_[key, b.column(2).to_numpy(zero_copy_only=False)]
            fp = np.r_[fp, b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)]
            far = np.concatenate([far, np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(-1, PIVOTS)])
            whole = np.searchsorted(key, key[-1])  # the last run may go on in the next batch
            yield edges(key[:whole], fp[:whole], far[:whole])
            key, fp, far = key[whole:], fp[whole:], far[whole:]
        yield edges(key, fp, far)

    def edges(key: np.ndarray, fp: np.ndarray, far: np.ndarray) -> pa.RecordBatch:
        u, v = join_runs(key, fp, far, bits) if len(key) else (fp, fp)
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    return tiled.repartition("run").sortWithinPartitions("run").mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, bits: int = 4) -> DataFrame:
    """One row for each row of docs: (id, fp, component), component the smallest id reachable through links.

    Null and word-less texts have fingerprint 0 and are linked like any other.
    A null id takes part but never names a component unless all ids of it are null.
    Repeated rows stay, in one component. Other columns of docs are not read.
    """
    if not 0 <= bits <= 4:
        raise ValueError("bits must be from 0 to 4: wider distances need other blocks")
    table = cut(fingerprints(docs, id_col, text_col, shingle))
    classes = cut(pivot_table(table.groupBy("fp").agg(F.min("id").alias("least"))))
    found = cut(components(links(classes, bits)))
    member = found.select(F.col("u").alias("fp"), "root").unionByName(found.select(F.col("root").alias("fp"), "root").distinct())
    member = member.join(classes, "fp")
    least = member.groupBy("root").agg(F.min("least").alias("component"))
    named = member.join(least, "root").select("fp", "component")
    every = classes.join(named, "fp", "left").select("fp", F.coalesce("component", "least").alias("component"))
    return table.join(every, "fp").select("id", "fp", "component")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op3(spark, sf_dir: str) -> DataFrame:
    from inkwell.llm.common import table

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), hex_digits(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))
