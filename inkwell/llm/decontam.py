"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

Every benchmark item is cut into windows of `width` consecutive words (an item of
fewer words is one window); a window is the set of its shingles of three words,
each at its place. A document holds a window only if it holds all of them, so the
window's rarest shingle is the whole of its necessary prefix. Shingles are ordered
by their number of occurrences in all documents.

One pass cuts the documents into words. What their places have in common with the
benchmark's shingles is stored in the shared folder: (row, place, shingle). Rarity,
the join on the prefixes, the positional and length bounds and the verification
all work on that table. A candidate is verified when all shingles of its window
stand at their places; they overlap, so its words are then equal one by one.

The benchmark's shingles are broadcast below a byte limit. Beyond it the documents'
places are shuffled on the shingle, each with its three words alone: no row ever
carries the word list of a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import ascii_lower, small, stored, table

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a shingle; a window of fewer words is one shingle.
SHINGLE = 3
#: Bytes that a shingle, a window and a document's key take in a broadcast, rated high.
SHINGLE_BYTES, WINDOW_BYTES, KEY_BYTES = 128, 512, 64


def words(text: Column) -> Column:
    """The words of a text, lowered; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def item_windows(items: DataFrame, item_col: str = "item_id", text_col: str = "text", width: int = 10) -> DataFrame:
    """(item, window) for every window of every item that has words, its words joined by spaces; repeated items and windows once."""
    every = items.select(F.col(item_col).alias("item"), F.explode(F.array(words(F.col(text_col)))).alias("w")).where("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))
    return every.select("item", "w", F.explode(starts).alias("at")).select("item", F.array_join(F.slice("w", F.col("at"), width), " ").alias("window")).distinct()


def _run(w: Column, at: Column, size: Column, sizes: list[int], made=lambda words: F.concat_ws(" ", *words)) -> Column:
    """The `size` words from place `at` on, counted from 0, joined by spaces (or what `made` makes of them); null if the words end before."""
    word = lambda i: F.get(w, at + i)
    return F.coalesce(*(F.when((size == k) & word(k - 1).isNotNull(), made([word(i) for i in range(k)])) for k in sizes))


def _hash(words: list[Column]) -> Column:
    return F.xxhash64(*words)


def _shingled(windows: DataFrame, sizes: list[int]) -> DataFrame:
    """windows (window, ...) to a row for each shingle: n, the window's number of words, offset and shingle added."""
    split = windows.select("*", F.explode(F.array(F.split("window", " "))).alias("w")).withColumn("n", F.size("w"))
    size = F.least(F.col("n"), F.lit(SHINGLE))
    placed = split.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - size)).alias("offset"))
    return placed.withColumn("shingle", _run(F.col("w"), F.col("offset"), size, sizes)).drop("w")


def _places(docs: DataFrame, known: DataFrame, sizes: list[int], limit_bytes: int) -> DataFrame:
    """docs (id, text) to (id, mark, n_words, at, shingle): each place where a known shingle begins, and for each row of docs the place -1 with an empty shingle.

    mark is a hash of the text. The row of place -1 carries the number of words, so the texts are read and cut up once.
    """
    # The generator of one element keeps the optimiser from writing the split into every use of w.
    cut_up = docs.select("id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"), F.explode(F.array(words(F.col("text")))).alias("w"))
    placed = cut_up.select("id", "mark", F.size("w").alias("n_words"), "w", F.explode(F.sequence(F.lit(-1), F.size("w") - 1)).alias("at"))
    if len(sizes) == 1:
        placed = placed.withColumn("size", F.lit(sizes[0]))
    else:
        placed = placed.select("*", F.explode(F.array(*map(F.lit, sizes))).alias("size")).where((F.col("at") >= 0) | (F.col("size") == sizes[0]))
    place = (F.col("w"), F.greatest("at", F.lit(0)), F.col("size"), sizes)
    token = F.when(F.col("at") < 0, F.lit(0).cast("long")).otherwise(_run(*place, _hash))
    here = F.when(F.col("at") < 0, F.lit("")).otherwise(_run(*place))
    parts = F.split("shingle", " ")
    every = known.select(_run(parts, F.lit(0), F.size(parts), sizes, _hash).alias("token"), "shingle").distinct()
    every = every.unionByName(docs.sparkSession.createDataFrame([(0, "")], "token long, shingle string"))
    placed, listed = placed.withColumn("own", token).alias("p"), small(every, SHINGLE_BYTES, limit_bytes)
    if listed is every:  # shuffled: a place takes its own words along, not the list
        placed = placed.select("id", "mark", "n_words", "at", "own", here.alias("here"))
        here = F.col("here")
    # Numbers are joined, and words compared where they agree: by an equality the words would be a key, made for every place.
    same = here.startswith(F.col("shingle")) & F.startswith(F.col("shingle"), here)
    return placed.join(listed, (F.col("own") == F.col("token")) & same).select("id", "mark", "n_words", "at", "shingle")


def _prefixes(shingled: DataFrame, places: DataFrame) -> DataFrame:
    """(window, n, offset, shingle): the rarest shingle of each window; a window with a shingle that no document has is ruled out."""
    seen = places.groupBy("shingle").agg(F.count("*").alias("times"))
    rarest = F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "shingle", "offset")).alias("p")
    chosen = shingled.join(seen, "shingle", "left").groupBy("window", "n").agg(rarest).where("p.times > 0")
    return chosen.select("window", "n", "p.offset", "p.shingle")


def _verified(places: DataFrame, prefixes: DataFrame, sizes: list[int], limit_bytes: int) -> DataFrame:
    """(id, mark, start, n, window) for every occurrence of a window."""
    start = F.col("at") - F.col("offset")
    fits = (start >= 0) & (start + F.col("n") <= F.col("n_words"))
    candidates = places.join(small(prefixes, WINDOW_BYTES, limit_bytes), "shingle").where(fits).select("id", "mark", start.alias("start"), "window")
    asked = _shingled(candidates.select(F.col("id").alias("i"), F.col("mark").alias("m"), "start", "window"), sizes)
    asked = asked.select("i", "m", "start", "window", "n", (F.col("start") + F.col("offset")).alias("place"), F.col("shingle").alias("s"))
    met = asked.join(places, F.col("i").eqNullSafe(F.col("id")) & (F.col("m") == F.col("mark")) & (F.col("place") == F.col("at")) & (F.col("s") == F.col("shingle")))
    whole = F.col("n") - F.least(F.col("n"), F.lit(SHINGLE)) + 1
    return met.groupBy("id", "mark", "start", "n", "window").agg(F.count("*").alias("k")).where(F.col("k") == whole).drop("k")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = 10, limit_bytes: int = 32 << 20) -> DataFrame:
    """One row for each row of docs: (id, n_words, n_hit, hit_items).

    n_hit counts the words inside any occurrence of any window, hit_items holds
    the items concerned. A null text has no words; so have items of punctuation
    alone, which hit nothing. Null ids, repeated ids and repeated rows each keep
    their own row: rows are told apart by id and text together. Items without an
    id are one item, null in hit_items. Without items nothing is hit. Other
    columns of either table are not read. limit_bytes bounds each broadcast.
    """
    return _marked(docs, items, id_col, text_col, item_col, item_text_col, width, limit_bytes).drop("mark")


def _marked(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, width: int, limit_bytes: int) -> DataFrame:
    """contamination() with the hash of each row's text, mark."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    windows = stored(item_windows(items, item_col, item_text_col, width))
    size = F.least(F.size(F.split("window", " ")), F.lit(SHINGLE))
    sizes = sorted(r["k"] for r in windows.select(size.alias("k")).distinct().collect()) or [SHINGLE]
    shingled = stored(_shingled(windows.select("window").distinct(), sizes))
    found = stored(_places(own, shingled, sizes, limit_bytes))
    rows, places = found.where("at < 0").select("id", "mark", F.col("n_words").cast("long").alias("n_words")), found.where("at >= 0")
    occurs = _verified(places.distinct(), stored(_prefixes(shingled, places)), sizes, limit_bytes)
    held = occurs.join(small(windows, WINDOW_BYTES, limit_bytes), "window").groupBy("id", "mark")
    # One array for a document and not a row for a word: it is as long as the document at most, for each length of window.
    spans = held.agg(F.collect_set(F.struct("start", "n")).alias("spans"), F.collect_set(F.struct("item")).alias("held"))
    reach = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, s: F.struct((acc["n"] + F.greatest(s["start"] + s["n"] - F.greatest(acc["end"], s["start"]), F.lit(0))).alias("n"), F.greatest(acc["end"], s["start"] + s["n"]).alias("end")),
    )["n"]
    hits = stored(spans.select(F.col("id").alias("hid"), F.col("mark").alias("hmark"), reach.alias("hits"), F.transform("held", lambda x: x["item"]).alias("hit_items")))
    kind = items.schema[item_col].dataType.simpleString()
    both = rows.join(small(hits, 16 * KEY_BYTES, limit_bytes), F.col("id").eqNullSafe(F.col("hid")) & (F.col("mark") == F.col("hmark")), "left")
    return both.select("id", "mark", "n_words", F.coalesce("hits", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("hit_items", F.expr(f"cast(array() as array<{kind}>)")).alias("hit_items"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = 10, limit_bytes: int = 32 << 20) -> DataFrame:
    """The rows of docs that hold no window of any item, all columns kept. Rows with one id, or none, are judged each by its own text."""
    hit = _marked(docs, items, id_col, text_col, item_col, item_text_col, width, limit_bytes).where("n_hit > 0")
    found = hit.select(F.col("id").alias("__hit"), F.col("mark").alias("__mark")).distinct()
    mark = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    found = small(stored(found), KEY_BYTES, limit_bytes)
    return docs.join(found, docs[id_col].eqNullSafe(found["__hit"]) & (mark == found["__mark"]), "left_anti")


def op8(spark, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("hit_items", lambda x: x.cast("string"))), ",")
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


#: DuckDB: the same windows by a plain join on whole windows.
OP8_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS g
       FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d CROSS JOIN lens WHERE len(w) >= n)),
hit AS (SELECT DISTINCT doc_id, i, dw.n AS n, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos ON d.doc_id = pos.doc_id LEFT JOIN it ON d.doc_id = it.doc_id
"""
