"""Mixing sources to target weights by systematic sampling.

Each document's expected copies are its source's rate, target over size. Along an
order of the source's documents the expected copies are summed, one random offset
is added, and a document is emitted once for each integer boundary its own share
crosses. The order runs through hash bins and, inside a bin, by size, upward and
downward in turn, so that large and small documents are thinned alike and what
the source yields stays within about a document of its target.

The prefix sums are taken in two levels: over the counts of (source, bin), and
over the rows of one bin. Bins grow in number with the table, so a source with a
third of all rows is dealt over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm.common import WORD, cut, table

#: Rows of the whole table to a bin, and the fewest bins.
BIN_ROWS, LEAST_BINS = 16384, 256


def hash32(text: Column, salt: str) -> Column:
    """A number from 0 to 2^32 - 1 that any SQL engine with md5 can repeat."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(salt), F.coalesce(text, F.lit("\x00null")))), 1, 8), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) to (source, source_size, target), one row for each source.

    Sources by code point, null last, take the weights in turn and share
    `share` of all sizes. No target exceeds `most` times its source's size; what
    is over goes to the others by weight until none is above. That end is found
    at once: in the order of most * size / weight the full sources come first.
    """
    spark_order = Window.orderBy(F.col("source").isNull(), "source")
    w = F.array(*(F.lit(float(x)) for x in weights))[(F.row_number().over(spark_order) - 1) % len(weights)]
    t = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    upto = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = F.coalesce(F.sum("cap").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(upto.rowsBetween(0, Window.unboundedFollowing))
    t = t.withColumn("level", (F.sum("source_size").over(every) * share - full) / rest)
    # The level holds from the first source that it does not fill.
    level = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), "level"))).over(every)["level"]
    return t.select("source", "source_size", F.least(F.coalesce(level * F.col("w"), F.col("cap")), F.col("cap")).alias("target"))


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: str = "mix") -> DataFrame:
    """docs, all columns kept, with size, source_size, target and copies (0, 1, ... at most ceil(most)); columns of these names are replaced.

    Size is the number of words, 0 for null and empty texts. A null source is a
    source of its own, the last. Rows without words are copied at their source's
    rate and add nothing; a source without any words yields no copies. Repeated
    rows are sampled one by one; rows with one id are told apart by a hash of their
    text. Runs on the same rows agree. Bins follow the number of rows, so a row more
    may deal all rows anew.
    """
    own = {c: c.replace("__mix_", "__own_", 1) for c in docs.columns if c.startswith("__mix_")}
    if own:
        found = copies(docs.withColumnsRenamed(own), *(own.get(c, c) for c in (id_col, text_col, source_col)), weights, share, most, seed)
        return found.withColumnsRenamed({new: old for old, new in own.items()})
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    # Rows without an id are dealt by their text, so that they don't fall into one bin.
    mark = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("\x00null"), mark.cast("string")))
    light = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"))
    per_source = cut(targets(light.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")).drop("n"), weights, share, most))
    bins = max(LEAST_BINS, -(-docs.select(id_col).count() // BIN_ROWS))
    bin_of = F.pmod(hash32(key, f"{seed}-bin-"), F.lit(bins))
    counts = docs.select(F.col(source_col).alias("source"), bin_of.alias("bin")).groupBy("source", "bin").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("bin")) - F.col("n")
    named = per_source.select(F.col("source").alias("__mix_source"), F.col("source_size").alias("__mix_source_size"), F.col("target").alias("__mix_target"))
    rate = F.when(F.col("__mix_source_size") > 0, F.col("__mix_target") / F.col("__mix_source_size")).otherwise(0.0)
    offset = hash32(F.col("__mix_source"), f"{seed}-offset-") / F.lit(float(1 << 32))
    plan = counts.select("source", F.col("bin").alias("__mix_bin_of"), before.alias("__mix_before")).join(named, F.col("source").eqNullSafe(F.col("__mix_source"))).drop("source")
    plan = cut(plan.withColumns({"__mix_rate": rate, "__mix_offset": offset}))
    sized = docs.withColumns({"__mix_size": size, "__mix_bin": bin_of, "__mix_tie": hash32(key, f"{seed}-tie-"), "__mix_mark": mark})
    within = Window.partitionBy(source_col, "__mix_bin").orderBy(F.when(F.col("__mix_bin") % 2 == 0, F.col("__mix_size")).otherwise(-F.col("__mix_size")), "__mix_tie", F.col(id_col).asc_nulls_first(), "__mix_mark")
    ranked = sized.withColumn("__mix_rank", F.row_number().over(within))
    joined = ranked.join(plan, ranked[source_col].eqNullSafe(F.col("__mix_source")) & (F.col("__mix_bin") == F.col("__mix_bin_of")))
    upto = lambda k: F.floor((F.col("__mix_before") + k) * F.col("__mix_rate") + F.col("__mix_offset"))
    n = upto(F.col("__mix_rank")) - upto(F.col("__mix_rank") - 1)
    kept = [docs[c] for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    return joined.select(*kept, F.col("__mix_size").alias("size"), F.col("__mix_source_size").alias("source_size"), F.col("__mix_target").alias("target"), n.cast("long").alias("copies"))


def mix(docs: DataFrame, number: str | None = None, **options) -> DataFrame:
    """The mixed rows themselves: each row of docs as often as it is copied, with docs's columns.

    number: a column for the number of the copy, from 1; one of that name is replaced.
    """
    wide = docs.select(F.struct(*docs.columns).alias("row"), *(F.col(options.get(f"{c}_col", d)).alias(d) for c, d in (("id", "doc_id"), ("text", "text"), ("source", "source"))))
    options = {k: v for k, v in options.items() if not k.endswith("_col")}
    drawn = copies(wide, **options).where("copies > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("nth"))
    if number is None:
        return drawn.select("row.*")
    return drawn.select(*(F.col("row")[c].alias(c) for c in docs.columns if c != number), F.col("nth").alias(number))


def op4(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return copies(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP4_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
  CAST(concat('0x', substr(md5('mix-bin-' || CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) % (SELECT greatest(256, (count(*) + 16383) // 16384) FROM documents) AS bin,
  CAST(concat('0x', substr(md5('mix-tie-' || CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) AS tie FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source),
l AS (SELECT *, 2.0::DOUBLE * source_size AS cap FROM s),
v AS (SELECT *, ((SELECT sum(source_size) FROM l) * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
       / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM l),
e AS (SELECT level FROM v WHERE level * w <= cap ORDER BY cap / w, level LIMIT 1),
t AS (SELECT source, source_size, least(coalesce((SELECT level FROM e) * w, cap), cap) AS target FROM v),
r AS (SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
       CAST(concat('0x', substr(md5('mix-offset-' || coalesce(d.source, chr(0) || 'null')), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS o,
       row_number() OVER (PARTITION BY d.source ORDER BY bin, CASE WHEN bin % 2 = 0 THEN size ELSE -size END, tie, doc_id) AS k
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(size * (floor(k * rate + o) - floor((k - 1) * rate + o)) AS BIGINT) AS taken FROM r
"""
