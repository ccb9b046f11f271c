"""URL filters: fixed host and path rules first, then association rules mined from labels.

FP-growth mines the token combinations of labelled urls that go with a bad label,
of all tokens of a url; what no rule can come of is not grown. A mined rule is kept if enough bad rows support it, if its confidence is
enough by itself and against the share of bad rows at large (their ratio, the
lift, and the distance in standard deviations), and if no shorter kept rule whose
tokens it contains does as well. Rules match through
an inverted index: each is filed under its tokens, a url's tokens are joined with
the index, and a rule fires when the tokens it met are all it has.
"""

from __future__ import annotations

import math
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import UPPER, LOWER, cut, small, table

#: The fixed rules of the digest: (verdict, host, path).
RULES = (
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
)


def host(url: Column) -> Column:
    """What follows the first :// up to / ? # or the end, A-Z lowered; empty for null or without ://."""
    raw = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)).otherwise(F.lit(""))
    return F.coalesce(F.translate(raw, UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ? # or the end; empty for null or without ://."""
    return F.coalesce(F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)), F.lit(""))


def fixed(host_: Column, path_: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest fixed rule that fits a host and a path, null if none does.

    A rule fits its host and all subdomains if the path starts with its path.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host_ == h) | host_.endswith(f".{h}")) & path_.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def tokens(url: Column) -> Column:
    """Distinct tokens of a url: every domain suffix of its host, the words of its path and the names in its query. Numbers of a path become their count of digits."""
    h = F.split(host(url), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(h)), lambda i: F.concat(F.lit("h:"), F.array_join(F.slice(h, i, F.size(h)), ".")))
    parts = F.transform(F.filter(F.split(F.lower(path(url)), r"[/._-]+"), lambda x: x != ""), lambda x: F.concat(F.lit("p:"), F.when(x.rlike("^[0-9]+$"), F.concat(F.lit("#"), F.length(x).cast("string"))).otherwise(x)))
    names = F.transform(F.filter(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), lambda x: x != ""), lambda x: F.concat(F.lit("q:"), F.regexp_extract(x, "^[^=]*", 0)))
    labels = F.array(F.concat(F.lit("s:"), F.lower(F.regexp_extract(url, "^([^:/?#]*):", 1))))
    return F.when(url.isNull(), F.expr("cast(array() as array<string>)")).otherwise(F.array_distinct(F.concat(labels, suffixes, parts, names)))


def _grow(group: pa.Table, need: int) -> pa.Table:
    """(rule, n_bad, good) of the combinations of a token t with tokens of its prefixes (t, prefix, n_bad, good) that `need` bad rows have.

    Patterns grow by one token at a time over the rows that hold them. A token that takes no good row from a pattern
    makes it no better than the pattern without it, whatever else is added, so neither it nor what holds it is grown.
    """
    t, prefixes = group["t"][0].as_py(), group["prefix"].to_pylist()
    n_bad, good = (group[c].to_numpy() for c in ("n_bad", "good"))
    names = sorted(set(chain.from_iterable(prefixes)))
    at, has = {x: i for i, x in enumerate(names)}, np.zeros((len(names), len(prefixes)), bool)
    for row, prefix in enumerate(prefixes):
        has[[at[x] for x in prefix], row] = True
    found, todo = [], [((), np.arange(len(prefixes)), range(len(names)))]
    while todo:
        pattern, rows, others = todo.pop()
        left = good[rows].sum()
        if pattern:
            found.append((sorted([t, *(names[i] for i in pattern)]), int(n_bad[rows].sum()), int(left)))
        more = []
        for y in others if left else ():
            held = rows[has[y, rows]]
            fewer = good[held].sum()
            if n_bad[held].sum() < need or fewer == left:
                continue
            if all(good[has[[y, *(z for z in pattern if z != x)]].all(axis=0)].sum() > fewer for x in pattern):
                more.append((y, held))
        todo += [((*pattern, y), held, [z for z, _ in more[i + 1 :]]) for i, (y, held) in enumerate(more)]
    rule, bads, goods = zip(*found) if found else ((), (), ())
    return pa.table([pa.array(rule, pa.list_(pa.string())), pa.array(bads, pa.int64()), pa.array(goods, pa.int64())], ["rule", "n_bad", "good"])


def patterns(labelled: DataFrame, need: int) -> DataFrame:
    """labelled (tokens, n_bad, good) to (rule, n_bad, good): combinations of tokens that `need` bad rows have, by FP-growth.

    Each token mines, apart from the others, the distinct sets of more frequent tokens that stand beside it. Left out are
    only combinations beside which a shorter one is as good: that as many bad rows have at least, and no more good ones.
    """
    each = labelled.select("n_bad", "good", F.explode("tokens").alias("token"))
    known = cut(each.groupBy("token").agg(F.sum("n_bad").alias("n_bad"), F.sum("good").alias("good")).where(F.col("n_bad") >= need))
    every = labelled.agg(F.sum("good")).first()[0] or 0
    # A token without good rows can't become better, one in all good rows makes nothing better.
    mixed = known.where((F.col("good") > 0) & (F.col("good") < every)).select("token", (F.col("n_bad") + F.col("good")).alias("rows"))
    numbered = cut(labelled.withColumn("row", F.expr("uuid()")))
    held = numbered.select("row", "n_bad", "good", F.explode("tokens").alias("token")).join(small(mixed, 128), "token")
    lists = held.groupBy("row").agg(F.first("n_bad").alias("n_bad"), F.first("good").alias("good"), F.sort_array(F.collect_list(F.struct((-F.col("rows")).alias("s"), "token"))).alias("o"))
    lists = lists.select("n_bad", "good", F.transform("o", lambda x: x["token"]).alias("o"))
    beside = lists.select("n_bad", "good", "o", F.posexplode("o").alias("i", "t"))
    beside = beside.groupBy("t", F.slice("o", F.lit(1), F.col("i")).alias("prefix")).agg(F.sum("n_bad").alias("n_bad"), F.sum("good").alias("good"))
    grown = beside.groupBy("t").applyInArrow(lambda group: _grow(group, need), "rule array<string>, n_bad long, good long")
    return known.select(F.array("token").alias("rule"), "n_bad", "good").unionByName(grown)


def mine(labelled: DataFrame, support: float = 0.0, confidence: float = 0.5, least: int = 20, lift: float = 1.5, deviations: float = 3.0) -> DataFrame:
    """labelled (tokens, bad boolean) to rules (rule, n, confidence): sorted tokens that go with bad.

    A rule stands on `least` bad rows, and on bad rows that are `support` of all
    labelled rows, at least; its confidence is `confidence` and `lift` times the
    share of bad rows at least, and `deviations` (not negative) standard deviations
    above that share for as many rows as hold its tokens. All tokens of a row are
    mined. Without labelled rows there are no rules.
    """
    tokens_ = F.array_sort(F.array_distinct(F.array_compact("tokens")))
    sets = labelled.where("size(tokens) > 0").groupBy(tokens_.alias("tokens")).agg(F.count_if(F.coalesce("bad", F.lit(False))).alias("n_bad"), F.count("*").alias("n"))
    sets = cut(sets.select("tokens", "n_bad", (F.col("n") - F.col("n_bad")).alias("good")))
    bad, good = sets.agg(F.sum("n_bad"), F.sum("good")).first()
    if not bad or bad < least:
        return labelled.sparkSession.createDataFrame([], "rule array<string>, n int, confidence double")
    base, rows = bad / (bad + good), F.col("n_bad") + F.col("good")
    found = patterns(sets, max(least, math.ceil(support * (bad + good)))).withColumn("confidence", F.col("n_bad") / rows)
    above = (F.col("confidence") - base) * F.sqrt(rows) >= deviations * (base * (1 - base)) ** 0.5
    found = found.where((F.col("confidence") >= max(confidence, lift * base)) & above)
    rules = cut(found.select("rule", F.size("rule").alias("n"), "confidence"))
    # A rule is idle beside a shorter one with a subset of its tokens that holds as well; found through one token of the shorter.
    short = rules.select(F.col("rule").alias("r"), F.col("n").alias("m"), F.col("confidence").alias("c"), F.element_at("rule", 1).alias("t"))
    long = rules.select("rule", "n", "confidence", F.explode("rule").alias("t"))
    idle = long.join(short, "t").where("m < n AND c >= confidence AND size(array_except(r, rule)) = 0").select("rule").distinct()
    return cut(rules.join(idle, "rule", "left_anti"))


def fired(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """urls (url) to the distinct urls that some rule matches in whole, through the inverted index on tokens."""
    numbered = rules.select("rule", "n", F.xxhash64("rule").alias("id"))
    index = numbered.select("id", "n", F.explode("rule").alias("token"))
    met = urls.select("url").distinct().select("url", F.explode(tokens(F.col("url"))).alias("token")).join(small(index, 64), "token")
    return met.groupBy("url", "id", "n").agg(F.count("*").alias("k")).where("k = n").select("url").distinct()


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", fixed_rules=RULES) -> DataFrame:
    """pages, all columns kept, with host, path, rule and verdict added.

    The longest fitting fixed rule decides and is named in rule. Without one, rule
    is null and the verdict is block if a mined rule fires and allow otherwise. A
    null url, or one without ://, has an empty host and path and no fixed rule; a
    null one is allowed. Repeated rows are judged alike.
    """
    named = pages.withColumns({"host": host(F.col(url_col)), "path": path(F.col(url_col))})
    named = named.withColumn("__fixed", fixed(F.col("host"), F.col("path"), fixed_rules))
    hit = fired(named.where("__fixed IS NULL").select(F.col(url_col).alias("url")), rules).select(F.col("url").alias("__hit"))
    both = named.join(hit, F.col(url_col) == hit["__hit"], "left")
    verdict = F.coalesce(F.col("__fixed.verdict"), F.when(hit["__hit"].isNotNull(), "block").otherwise("allow"))
    kept = [named[c] for c in named.columns if c not in ("__fixed", "rule", "verdict")]
    return both.select(*kept, F.col("__fixed.rule").alias("rule"), verdict.alias("verdict"))


def page_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(tokens, bad): a page carries the labels of the document whose number its path holds; low quality or toxic is bad.

    The tables name no other tie between pages and labels. Pages without a number, or whose document has no label, teach nothing.
    """
    number = F.expr("try_cast(regexp_extract(url, '/([0-9]+)', 1) AS bigint)")
    known = labels.select(F.col("doc_id").alias("number"), (F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("bad"))
    return pages.select("url", number.alias("number")).join(known, "number").select(tokens(F.col("url")).alias("tokens"), "bad")


def op6(spark, sf_dir: str) -> DataFrame:
    pages, labels = table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels")
    return judge(pages, mine(page_labels(pages, labels))).select("page_id", "host", "path", "rule", "verdict")
