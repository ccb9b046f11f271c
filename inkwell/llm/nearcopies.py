"""Documents alike in their runs of words: all pairs of a Jaccard similarity of four fifths or more, without loss.

Texts are compared as sets of runs of five words. SimHash fingerprints of these
runs, linked by the operator's pivot tables, find all pairs within four bits; each
is verified on its texts. No distance of 64-bit fingerprints separates a similarity
of 0.8 from less, so pairs beyond four bits, and only those, come from a prefix join,
which is exact: two sets that alike share one of the first fifth of their members, in
whatever order all sets are sorted. No pair is looked for by both. Members frequent in a sample come last, so
common lines make no candidates; a wrong guess costs time and never a pair.

Equal texts are one class throughout. Either way classes are joined first to a few
members of each group of candidates, while that leaves clearly fewer pairs in different
components; then each of those is tried, the nearest of every component before the
rest. So a large group of near copies is not expanded into its pairs. A pair is tried
on sketches of 512 bits, where its members meet and before its texts do: each bit is
the parity of the members that fall on it, so two sets differ in as many members as
bits at least, and a pair that differs in too many is discarded for sure.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm import simhash
from inkwell.llm.common import cut, small
from inkwell.llm.components import components
from inkwell.staging import scratch

#: Words of a run; the fewest classes in the sample, and its frequent runs that are kept, which bound what is broadcast; pairs made at a time.
RUN, SAMPLE, FREQUENT, STEP = 5, 4096, 1 << 18, 1 << 16
#: Members of a group of candidates that all others are compared with in a turn, and the pairs for each row that are left to the last step.
HUBS, LEFT = 8, 4
#: One class in so many is in the sample at least; longs of a sketch.
SHARE, SKETCH = 16, 8
#: Links up to which one task follows them all; more go through rounds over all tasks.
FEW = 1 << 18
#: Bits in which fingerprints that SimHash links differ at most: pairs within are its own, all others the prefix join's.
BITS = 4
ODD = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(RUN)], np.uint64)


def runs(text: bytes) -> np.ndarray:
    """The distinct hashes of a text's runs of five words, sorted; of all its words if they are fewer."""
    words = text.lower().split()  # bytes: A-Z alone
    if not words:
        return np.empty(0, np.uint64)
    digest, k = xxhash.xxh64_intdigest, min(RUN, len(words))
    w = np.array([digest(x) for x in words], np.uint64)
    n = len(w) - k + 1
    h = reduce(np.add, (w[i : i + n] * ODD[i] for i in range(k)))
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(h ^ (h >> np.uint64(32)))


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets have a Jaccard similarity of 0.8 at least; two empty ones have."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 5 * both >= 4 * (len(a) + len(b) - both)


def text_class(text: Column) -> Column:
    """A number for each distinct text; 0 for those without words and null."""
    return F.when(text.rlike(r"[^\x20\x09-\x0D]"), F.xxhash64(text)).otherwise(F.lit(0).cast("long"))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """Each class of a task once, with its runs; copies and texts without words left out."""
    seen = {0}
    for b in batches:
        for c, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary())):
            if c not in seen:
                seen.add(c)
                yield c, runs(text.as_py())


def _batches(rows: Iterator[tuple[np.ndarray, ...]], names: list[str]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[0])
        if size >= STEP:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held)], names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held)], names)


def _frequent(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Runs that several classes of the sample have, sorted, and how many have them."""
    share = min(SHARE, max(1, texts.count() // SAMPLE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(((h.view(np.int64), np.full(len(h), c)) for c, h in _texts(batches)), ["key", "c"])

    sample = texts.where(F.pmod(F.xxhash64("c", F.lit(7)), F.lit(share)) == 0).mapInArrow(run, "key long, c long")
    counted = sample.distinct().groupBy("key").agg(F.count("*").cast("int").alias("n")).where("n > 1")
    found = counted.orderBy(F.desc("n"), "key").limit(FREQUENT).toArrow()
    key, n = found["key"].to_numpy().view(np.uint64), found["n"].to_numpy()
    order = np.argsort(key)
    return key[order], n[order]


def _shared(texts: DataFrame) -> DataFrame:
    """(key, c, n, at): the runs in the prefixes of two classes or more; n runs has the class, and this is its at-th."""
    frequent = texts.sparkSession.sparkContext.broadcast(_frequent(texts))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, times = frequent.value

        def rows() -> Iterator[tuple[np.ndarray, ...]]:
            for c, h in _texts(batches):
                n, seen = len(h), np.zeros(len(h), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    seen = np.where(known[at] == h, times[at], 0)
                first = h[np.lexsort((h, seen))][: n - -(-4 * n // 5) + 1]
                yield first.view(np.int64), np.full(len(first), c), np.full(len(first), n, np.int32), np.arange(len(first), dtype=np.int32)

        return _batches(rows(), ["key", "c", "n", "at"])

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by key and class to those of keys with several classes, each once."""
        last = before = None
        held = None  # the first row of a key, until a second class comes
        for b in batches:
            key, c = (b.column(i).to_numpy() for i in (0, 1))
            new = np.r_[True, (key[1:] != key[:-1]) | (c[1:] != c[:-1])]
            new[0] = (key[0], c[0]) != (last, before) if len(key) else False
            if not len(key):
                continue
            last, before = key[-1], c[-1]
            rows = b.filter(pa.array(new))
            if held is not None:
                rows = pa.Table.from_batches([held, rows]).combine_chunks().to_batches()[0]
            key = rows.column(0).to_numpy()
            if not len(key):
                continue
            same = key[1:] == key[:-1]
            keep = np.r_[False, same] | np.r_[same, False]
            # The last key may go on; its last row comes again as the first of the next batch, and is dropped by distinct().
            held = rows.slice(len(key) - 1, 1)
            yield rows.filter(pa.array(keep))

    rows = texts.mapInArrow(prefixes, "key long, c long, n int, at int").repartition("key").sortWithinPartitions("key", "c")
    found = cut(rows.mapInArrow(several, "key long, c long, n int, at int").distinct())
    frequent.unpersist()
    return found


def _fit(n: str, m: str, at: str, by: str) -> Column:
    """Whether sets of n and m runs can be alike if the at-th and by-th are the first that they share."""
    both = F.least(F.col(n) - F.col(at), F.col(m) - F.col(by))
    return (9 * both >= 4 * (F.col(n) + F.col(m))) & (5 * F.least(n, m) >= 4 * F.greatest(n, m))


def _crossing(nearest: bool, within: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (key, c, n, at, root, fp, b0, ... b7) sorted by key to the pairs of classes of a key in different components that can be alike, by their sketches too.

    nearest: of a class's pairs with one component only that of the least distance of sketches.
    within: pairs whose fingerprints differ in BITS at most; else those that differ in more.
    """

    def pairs(x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if not len(x):
            return
        _, place, size = np.unique(x[:, 4], return_inverse=True, return_counts=True)
        x = x[np.argsort(place == size.argmax(), kind="stable")]  # the largest component comes last, its members don't meet
        for i in range(len(x) - size.max()):
            _, c, n, at, root, fp = x[i, :6]
            y = x[i + 1 :]
            both = np.minimum(n - at, y[:, 2] - y[:, 3])
            y = y[(y[:, 4] != root) & (9 * both >= 4 * (n + y[:, 2])) & (5 * np.minimum(n, y[:, 2]) >= 4 * np.maximum(n, y[:, 2]))]
            y = y[(np.bitwise_count((y[:, 5] ^ fp).view(np.uint64)) <= BITS) == within]
            differ = np.bitwise_count((y[:, 6:] ^ x[i, 6:]).view(np.uint64)).sum(axis=1, dtype=np.int64)
            likely = 9 * differ <= n + y[:, 2]
            y, differ = y[likely], differ[likely]
            if nearest and len(y) > 1:
                y = y[np.lexsort((differ, y[:, 4]))]
                y = y[np.r_[True, y[1:, 4] != y[:-1, 4]]]
            if len(y):
                yield np.minimum(y[:, 1], c), np.maximum(y[:, 1], c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            held = np.empty((0, 6 + SKETCH), np.int64)
            for b in batches:
                held = np.concatenate([held, np.stack([x.to_numpy().astype(np.int64) for x in b.columns], axis=1)])
                starts = np.flatnonzero(np.r_[True, held[1:, 0] != held[:-1, 0]]) if len(held) else np.empty(0, np.int64)
                for s, e in zip(starts[:-1], starts[1:]):
                    yield from pairs(held[s:e])
                held = held[starts[-1] :] if len(starts) else held
            yield from pairs(held)

        yield from _batches(groups(), ["a", "b"])

    return run


def _sketched(texts: DataFrame) -> DataFrame:
    """texts (c, text) to (c, n, fp, b0, ... b7): the number of runs, their SimHash fingerprint, and the parities of the runs on each of 512 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for c, h in _texts(iter([b])):
                parity = np.packbits(np.bincount(h >> np.uint64(55), minlength=64 * SKETCH) & 1).view(np.int64)
                rows.append([c, len(h), np.uint64(simhash.folded(h)).view(np.int64), *parity])
            found = np.array(rows, np.int64).reshape(-1, 3 + SKETCH)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found.T.copy()], names)

    names = ["c", "n", "fp", *(f"b{i}" for i in range(SKETCH))]
    return cut(texts.select("c", "text").mapInArrow(run, ", ".join(f"{x} long" for x in names)))


def _verified(pairs: DataFrame, texts: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are alike."""
    one, two = (sketches.select(F.col("c").alias(x), F.col("n").alias(f"n_{x}"), *(F.col(f"b{i}").alias(f"{x}{i}") for i in range(SKETCH))) for x in "ab")
    differ = reduce(Column.__add__, (F.bit_count(F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}"))) for i in range(SKETCH)))
    likely = pairs.join(small(two, 256), "b").join(small(one, 256), "a").where(9 * differ <= F.col("n_a") + F.col("n_b")).select("a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, left = None, None
        for b in batches:
            keep = []
            for x, s, t in zip(b.column(0).to_pylist(), b.column(2).cast(pa.binary()), b.column(3).cast(pa.binary())):
                if x != a:
                    a, left = x, runs(s.as_py())
                keep.append(alike(left, runs(t.as_py())))
            yield b.filter(pa.array(keep, pa.bool_())).select([0, 1])

    left, right = (texts.select(F.col("c").alias(x), F.col("text").alias(f"text_{x}")) for x in "ab")
    return cut(cut(likely).join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long"))


def _rooted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All edges (u, v) to (u, root): the least node that u reaches, for every node but the roots."""
    ends = [np.stack([x.to_numpy() for x in b.columns], axis=1) for b in batches]
    nodes, at = np.unique(np.concatenate(ends), return_inverse=True) if ends else (np.empty(0, np.int64), np.empty(0, np.int64))
    root = list(range(len(nodes)))  # nodes are sorted, so the least index is the least node

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for u, v in at.reshape(-1, 2).tolist():
        a, b = top(u), top(v)
        root[max(a, b)] = min(a, b)
    least = np.array([top(x) for x in range(len(nodes))], np.int64)
    moved = np.flatnonzero(least != np.arange(len(nodes)))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[least[moved]])], ["u", "root"])


def _connected(edges: DataFrame, n: int) -> DataFrame:
    """components() of n edges, in a single small task if they are few."""
    return edges.coalesce(1).mapInArrow(_rooted, "u long, root long") if n <= FEW else components(edges)


def joined(texts: DataFrame) -> DataFrame:
    """texts (c, text), c the text_class, to (c, root): the least class that c reaches through pairs alike, for all c but the roots. Nothing else that it stores remains."""
    with scratch(texts.sparkSession) as keep:
        return keep(_joined(texts))


def _joined(texts: DataFrame) -> DataFrame:
    spark = texts.sparkSession
    shared = _shared(texts)
    wanted = shared.select("c").distinct()
    # Only classes of several rows are shuffled to become one row each.
    several = cut(texts.groupBy("c").agg(F.count("*").alias("rows")).where("rows > 1").join(small(wanted, 64), "c", "left_semi").select("c"))
    own = texts.join(small(wanted, 64), "c", "left_semi").join(small(several, 64), "c", "left_anti").select("c", "text")
    own = cut(own.unionByName(texts.join(small(several, 64), "c", "left_semi").select("c", "text").dropDuplicates(["c"])))
    sketches = _sketched(own)
    found = None

    def labelled(keyed: DataFrame) -> tuple[DataFrame, int]:
        """keyed with each class's root and fingerprint, where a key still has several roots; and how many pairs under a key have different ones."""
        names = sketches.select("c", "fp")
        names = names.withColumn("root", F.col("c")) if found is None else names.join(small(found, 64), "c", "left").withColumn("root", F.coalesce("root", "c"))
        rows = keyed.join(small(cut(names), 72), "c")
        each = rows.groupBy("key", "root").agg(F.count("*").alias("n")).groupBy("key")
        open_ = cut(each.agg(F.count("*").alias("roots"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("inside")).where("roots > 1"))
        left = open_.agg(F.sum((F.col("n") * F.col("n") - F.col("inside")) / 2)).first()[0] or 0
        return cut(rows.join(small(open_.select("key"), 48), "key", "left_semi").select("key", "c", "n", "at", "root", "fp")), left

    def connect(pairs: DataFrame) -> None:
        nonlocal found
        with scratch(spark) as keep:
            edges = _verified(pairs, own, sketches).select(F.col("a").alias("u"), F.col("b").alias("v"))
            n = edges.count()
            if not n:
                return
            if found is not None:
                edges, n = edges.unionByName(found.select(F.col("c").alias("u"), F.col("root").alias("v"))), n + found.count()
            found = keep(_connected(edges, n).select(F.col("u").alias("c"), "root"))

    def closed(keyed: DataFrame, within: bool) -> None:
        """Connect all classes alike that share a key of keyed (key, c, n, at) and whose fingerprints differ in BITS at most, or in more."""
        turn, rows_in_all, last = 0, keyed.count(), float("inf")
        while True:
            rows, left = labelled(keyed)
            few = left <= LEFT * rows_in_all
            if few or 10 * left > 9 * last:
                break
            last = left
            hub = rows.groupBy("key", F.pmod(F.xxhash64("c", F.lit(-1 - turn)), F.lit(HUBS))).agg(F.min(F.struct(F.xxhash64("c", F.lit(turn)).alias("h"), "c", "n", "at", "root", "fp")).alias("hub")).select("key", "hub")
            met = rows.join(hub, "key").select("c", "n", "at", "root", "fp", F.col("hub.c").alias("d"), F.col("hub.n").alias("m"), F.col("hub.at").alias("by"), F.col("hub.root").alias("other"), F.col("hub.fp").alias("mark"))
            met = met.where("root <> other").where(_fit("n", "m", "at", "by")).where((F.bit_count(F.col("fp").bitwiseXOR(F.col("mark"))) <= BITS) == F.lit(within))
            turn += 1
            connect(cut(met.select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b")).distinct()))
        # First each class with the nearest of every other component, then all that are still apart: a member to be joined does not meet the whole of its group.
        marks = sketches.select("c", *(f"b{i}" for i in range(SKETCH)))
        # Few pairs of fingerprints are tried at once.
        for turn, nearest in enumerate((False,) if within and few else (True, False)):
            rows, left = labelled(keyed) if turn else (rows, left)
            if not left:
                break
            marked = rows.join(small(marks, 96), "c").select("key", "c", "n", "at", "root", "fp", *marks.columns[1:])
            pairs = cut(marked.repartition("key").sortWithinPartitions("key").mapInArrow(_crossing(nearest, within), "a long, b long").distinct())
            if pairs.isEmpty():  # then there are none to the second either
                break
            connect(pairs)

    first, linked = _fingerprinted(sketches)
    connect(first)
    closed(linked, True)
    closed(shared, False)
    return found if found is not None else spark.createDataFrame([], "c long, root long")


def _fingerprinted(sketches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) that connect the classes SimHash links, of one fingerprint or of two within its bits; and (key, c, n, at): these classes under all keys of their fingerprints, so that each pair within the bits shares one."""
    least = cut(simhash.pivot_table(sketches.groupBy("fp").agg(F.min("c").alias("c"))))
    edges = cut(simhash.links(least.select("fp", "far"), BITS).distinct())
    same = cut(sketches.select("fp", F.col("c").alias("id")).join(least, "fp").where("id <> c").select("fp", F.col("c").alias("a"), F.col("id").alias("b")))
    u, v = (least.select(F.col("fp").alias(x), F.col("c").alias(y)) for x, y in (("u", "a"), ("v", "b")))
    near = edges.join(u, "u").join(v, "v").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    linked = edges.select(F.col("u").alias("fp")).unionByName(edges.select(F.col("v").alias("fp"))).unionByName(same.select("fp")).distinct()
    rows = sketches.select("c", "n", "fp").join(small(cut(linked), 48), "fp", "left_semi")
    keyed = simhash.keyed(rows).select("key", "c", "n", F.lit(0).alias("at"))
    return cut(same.select("a", "b").unionByName(near).distinct()), cut(keyed)


def _judged(docs: DataFrame, class_: Column, id_col: str, text_col: str) -> DataFrame:
    """(id, c, rows, stays) of the components of several members or rows: whether of this id and class one row stays."""
    found = joined(docs.select(class_.alias("c"), F.col(text_col).alias("text")))
    # Ids and classes alone are grouped; of the rows themselves only those move that share both.
    light = docs.select(F.col(id_col).alias("id"), class_.alias("c")).groupBy("id", "c").agg(F.count("*").alias("rows"))
    light = light.join(small(found, 64), "c", "left").select("id", "c", "rows", F.coalesce("root", "c").alias("root"))
    place = F.struct(F.col("id").isNull().alias("none"), "id", "c")
    judged = light.groupBy("root").agg(F.min(place).alias("least"), F.count("*").alias("members"), F.max("rows").alias("most")).where("members > 1 OR most > 1")
    return light.join(small(cut(judged), 96), "root").select("id", "c", "rows", (F.col("id").eqNullSafe(F.col("least.id")) & (F.col("c") == F.col("least.c"))).alias("stays"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs for every component of texts alike: that with the smallest id, a null id last; of equal ids the least class of texts, and of its rows the smallest by the columns that have an order.

    Rows are told apart by their text and not by their id. Texts without words, and null ones, are one component.
    """
    class_ = text_class(F.col(text_col))
    with scratch(docs.sparkSession) as keep:
        judged = keep(_judged(docs, class_, id_col, text_col))
    named = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), class_.alias("c"))

    def met(listed: DataFrame, how: str) -> DataFrame:
        other = small(listed.select(F.col("id").alias("i"), F.col("c").alias("k")), 64)
        return named.join(other, F.col("id").eqNullSafe(F.col("i")) & (F.col("c") == F.col("k")), how)

    alone = met(judged.where("NOT stays OR rows > 1"), "left_anti").select("row")
    row = F.col("row")
    ordered = [f.name for f in docs.schema.fields if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    if len(ordered) == len(docs.columns):
        least = F.min("row")
    else:  # maps have no order
        least = F.min_by("row", F.struct(*(row.getField(c).alias(f"c{k}") for k, c in enumerate(ordered))))
    once = met(judged.where("stays AND rows > 1"), "left_semi").groupBy("id", "c").agg(least.alias("row")).select("row")
    return alone.unionByName(once).select("row.*")
