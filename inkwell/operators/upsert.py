"""Upserts, imports and aliases of the catalogue: each a function from tables to the next table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def plan_upsert(current: DataFrame, incoming: DataFrame, key: list[str], modified: str = "modified", prune: bool = True) -> DataFrame:
    """(key, action): create, update, protected (edited by hand), prune (gone from the source) or keep. Keys are unique in either table."""
    old = current.select(*key, F.coalesce(F.col(modified), F.lit(False)).alias("__m"), F.lit(True).alias("__old"))
    new = incoming.select(*key, F.lit(True).alias("__new"))
    both = old.join(new, key, "full_outer")
    gone = F.when(F.col("__m"), "keep").otherwise("prune" if prune else "keep")
    action = F.when(F.col("__old").isNull(), "create").when(F.col("__new").isNull(), gone).when(F.col("__m"), "protected").otherwise("update")
    return both.select(*key, action.alias("action"))


def upsert(current: DataFrame, incoming: DataFrame, key: list[str], modified: str = "modified", prune: bool = True) -> DataFrame:
    """The next state: running it again with the same incoming rows changes nothing."""
    plan = plan_upsert(current, incoming, key, modified, prune)
    kept = current.join(plan.where(F.col("action").isin("protected", "keep")).select(*key), key, "left_semi")
    taken = incoming.join(plan.where(F.col("action").isin("create", "update")).select(*key), key, "left_semi")
    return kept.unionByName(taken.withColumn(modified, F.lit(False)) if modified not in incoming.columns else taken, allowMissingColumns=True)


def counters(plan: DataFrame) -> DataFrame:
    return plan.groupBy("action").agg(F.count("*").alias("n"))


def resolve_aliases(aliases: DataFrame) -> DataFrame:
    """aliases (issn, journal_id, origin) to one journal for each number: origin descending, then the smaller id."""
    order = Window.partitionBy("issn").orderBy(F.desc("origin"), "journal_id")
    return aliases.withColumn("__k", F.row_number().over(order)).where("__k = 1").drop("__k")


def duplicates(rows: DataFrame, aliases: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows one of whose numbers (array issns) another journal has."""
    each = rows.select(F.col(id_col).alias("row_id"), F.explode("issns").alias("issn"))
    hit = each.join(aliases.select("issn", "journal_id"), "issn").where("row_id <> journal_id").select("row_id").distinct()
    return rows.join(hit, rows[id_col] == hit["row_id"], "left_semi")


def plan_import(rows: DataFrame, aliases: DataFrame, mode: str = "skip", dry_run: bool = True, id_col: str = "row") -> DataFrame:
    """(row, action) for the rows of a file: create, or skip, update, add by the mode where a number is known.

    A dry run sees the catalogue alone. Otherwise a row also meets the rows before it with one of its numbers;
    chains over rows that share no number are not followed.
    """
    if mode not in ("skip", "update", "add"):
        raise ValueError("mode must be skip, update or add")
    each = rows.select(F.col(id_col).alias("row"), F.explode_outer("issns").alias("issn"))
    first = F.min("row").over(Window.partitionBy("issn"))
    each = each.withColumn("earlier", F.when(F.col("issn").isNotNull(), first < F.col("row")).otherwise(False))
    known = each.join(aliases.select("issn").distinct().withColumn("known", F.lit(True)), "issn", "left")
    hit = F.max(F.coalesce("known", F.lit(False)) | (F.lit(not dry_run) & F.col("earlier")))
    found = known.groupBy("row").agg(hit.alias("hit"))
    return found.select("row", F.when(~F.col("hit"), "create").otherwise({"skip": "skip", "update": "update", "add": "create"}[mode]).alias("action"))


def collapse_latest(df: DataFrame, entity: str, year: str, row: str, issn_columns: list[str], category: str) -> DataFrame:
    """The latest row of each entity with aliases (sorted distinct numbers of all its rows) and history (year, category) of the others; rows without an entity stay as they are."""
    keyed = df.where(F.col(entity).isNotNull())
    order = Window.partitionBy(entity).orderBy(F.col(year).desc_nulls_last(), F.col(row))
    ranked = keyed.withColumn("__k", F.row_number().over(order))
    numbers = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.filter(F.array(*issn_columns), lambda x: x.isNotNull())))))
    past = F.array_sort(F.collect_list(F.when(F.col("__k") > 1, F.struct(F.col("__k").alias("k"), F.col(year).alias("year"), F.col(category).alias("category")))))
    group = ranked.groupBy(entity).agg(numbers.alias("aliases"), F.transform(past, lambda x: F.struct(x["year"].alias("year"), x["category"].alias("category"))).alias("history"))
    latest = ranked.where("__k = 1").drop("__k").join(group, entity)
    return latest.unionByName(df.where(F.col(entity).isNull()), allowMissingColumns=True)


def topic_ids(names: DataFrame, topics: DataFrame) -> DataFrame:
    """(name, topic_id): the id of the topic with that name, case aside, or a new one after the largest."""
    known = names.join(topics.select(F.lower("name").alias("__n"), "topic_id"), F.lower(names["name"]) == F.col("__n"), "left").drop("__n")
    new = known.where("topic_id IS NULL").select(F.lower("name").alias("__n")).distinct()
    last = topics.agg(F.coalesce(F.max("topic_id"), F.lit(0)).alias("__last"))
    fresh = new.crossJoin(F.broadcast(last)).withColumn("__id", F.col("__last") + F.row_number().over(Window.orderBy("__n")))
    return known.join(fresh, F.lower(known["name"]) == fresh["__n"], "left").select("name", F.coalesce("topic_id", "__id").alias("topic_id"))


def patch(journals: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """journals with the non-null values of changes, which mark a row as modified."""
    renamed = changes.select(F.col(key), *(F.col(c).alias(f"__{c}") for c in changes.columns if c != key))
    both = journals.join(renamed.withColumn("__changed", F.lit(True)), key, "left")
    out = both.withColumns({c: F.coalesce(f"__{c}", c) for c in changes.columns if c != key})
    if "modified" in journals.columns:
        out = out.withColumn("modified", F.coalesce("__changed", "modified", F.lit(False)))
    return out.select(*journals.columns)
