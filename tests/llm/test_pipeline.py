"""The pipeline against a brute-force version, row by row; its edges; what it leaves behind."""

import hashlib
import math
import random
import re
import sys
import time
from pathlib import Path

import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
from test_core import five_word_runs, plain_contamination

import corpus_pipeline as pipeline
from inkwell import staging
from inkwell.llm import langid, nearcopies, pii
from inkwell.llm.components import components

SF, SCHEMA = "/root/testdata/sf0.001", "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The tables of SF, with near copies, passages of the benchmark, personal data, null and repeated ids, and junk added to documents."""
    out = tmp_path_factory.mktemp("tables")
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if r["text"]]
    rng, rows = random.Random(2), list(docs)
    for k in range(60):
        id_, text, lang, source, _ = rng.choice(docs)
        words = (text or "").split(" ")
        for _ in range(rng.choice([0, 1, 2, 5])):
            words[rng.randrange(len(words))] = "neu"
        text = " ".join(words) + (f" {rng.choice(items)}" if k % 7 == 0 else "") + (" a.b@c.de +1 (212) 555-0199" if k % 5 == 0 else "")
        rows.append((rng.choice([None, id_, 10_000 + k]), text, lang, rng.choice([None, source]), len(text)))
    rows += [(None, None, None, None, None), (20_000, "", "en", "a", 0), (20_001, "123 !? 456", None, "a", 10), (20_002, None, "en", None, None), rows[-1], rows[5]]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{out}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{out}/benchmark.parquet")
    return str(out)


def first_of_each_component(rows):
    texts = sorted({r[1] for r in rows if r[1] is not None} | {""})
    runs, root = [five_word_runs(t) for t in texts], list(range(len(texts)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(runs[i] & runs[j])
            if 5 * both >= 4 * (len(runs[i]) + len(runs[j]) - both):
                root[top(i)] = top(j)
    at, best = {t: i for i, t in enumerate(texts)}, {}
    for r in rows:
        mark = xxhash.xxh64_intdigest((r[1] or "").encode(), 42) if re.search(r"[^\x20\x09-\x0D]", r[1] or "") else 0
        order = (r[0] is None, r[0] or 0, mark - (mark >> 63 << 64), [(x is not None, x) if x is not None else (False, "") for x in r[1:]])
        k = top(at[r[1] or ""])
        if k not in best or order < best[k][0]:
            best[k] = (order, r)
    return [r for _, r in best.values()]


def plain_mix(rows):
    """Each row as often as systematic sampling takes it, its number added."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(n for n, r in zip(size, rows) if r[3] == s) for s in sources}
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sources)}
    target, open_ = {}, set(sources)
    while open_:
        rest, all_ = 1.5 * sum(total.values()) - sum(target.values()), sum(weight[s] for s in open_)
        over = [s for s in open_ if rest * weight[s] / all_ > 2 * total[s]]
        target |= {s: 2.0 * total[s] for s in over} if over else {s: rest * weight[s] / all_ for s in open_}
        open_ -= set(over or open_)
    h = lambda salt, s: int(hashlib.md5((salt + s).encode()).hexdigest()[:8], 16)
    out = []
    for s in sources:
        mine = []
        for n, r in zip(size, rows):
            if r[3] == s:
                mark = xxhash.xxh64_intdigest((r[1] or "").encode(), 42)
                mark -= (mark >> 63) << 64
                key = f"\x00null{mark}" if r[0] is None else str(r[0])
                bin_ = h("mix-bin-", key) % max(256, -(-len(rows) // 16384))
                mine.append(((bin_, n if bin_ % 2 == 0 else -n, h("mix-tie-", key), r[0] is not None, r[0] or 0, mark), r))
        rate, offset = target[s] / total[s] if total[s] else 0, h("mix-offset-", "\x00null" if s is None else s) / 2**32
        for k, (_, r) in enumerate(sorted(mine, key=lambda x: x[0]), 1):
            taken = math.floor(k * rate + offset) - math.floor((k - 1) * rate + offset)
            out += [(*r, c) for c in range(1, taken + 1)]
    return out


def test_pipeline_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    net = langid.fit(docs, learn=pipeline.remainder("doc_id", 4) != 2)
    known = []
    for r in rows:
        if r[1] is not None and any(c.isalpha() for c in r[1]):
            if langid.probabilities(net, [r[1].encode()])[0].max() >= min(1.0, 1.2 / len(net.classes)):
                known.append(r)
    single = first_of_each_component(known)
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    clean = [r for r, c in zip(single, plain_contamination([r[:2] for r in single], items)) if not c[2]]
    model, masked = pii.train(), []
    for r in clean:
        text = pii.masked(r[1], sum(pii.all_spans(r[1], model), []))
        masked.append((r[0], text, r[2], r[3], len(text)))
    out = pipeline.run(spark, folder).collect()
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, plain_mix(masked)))
    assert len(clean) < len(single) < len(known) < len(rows)


def test_stages_keep_what_brute_force_keeps(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    got = pipeline.near_duplicates(spark, docs, folder).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, first_of_each_component(rows)))
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    got = pipeline.decontamination(spark, docs, folder).collect()
    want = [r for r, c in zip(rows, plain_contamination([r[:2] for r in rows], items)) if not c[2]]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want)) and len(want) < len(rows)


def test_stages_at_the_edges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "Du le de la.", None, "a", 3), (1, "Du le de la.", None, "a", 3)], SCHEMA)
    assert [stage(spark, odd, SF).count() for _, stage in pipeline.STAGES[:-1]] == [2, 2, 3, 3]
    wide = docs.withColumn("more", F.create_map(F.lit("a"), F.lit(1)))
    for name, stage in pipeline.STAGES:
        assert "more" in stage(spark, wide, SF).columns and stage(spark, wide, SF).count() > 0, name


def test_run_leaves_only_its_result(spark, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda s: tmp_path.as_uri())
    out = pipeline.run(spark, folder)
    assert len(list(tmp_path.iterdir())) == 1 and out.count() > 0


def test_near_duplicates_keep_one_table(spark, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda s: tmp_path.as_uri())
    out = pipeline.near_duplicates(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    assert len(list(tmp_path.iterdir())) == 1 and out.count() > 0


def test_what_a_scratch_table_shuffled_goes_with_its_write(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda s: tmp_path.as_uri())
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {f for f in re.findall(r"shuffle_\d+_\d+_\d+\.data", files.getAllFiles().mkString(" "))}
    before, name = shuffled(), staging.CLEANUP
    held = spark.conf.get(name, None)
    with staging.scratch(spark) as keep:
        table = keep(spark.range(1000).repartition(7, "id").groupBy((F.col("id") % 10).alias("k")).count())
        end = time.time() + 20
        while shuffled() - before and time.time() < end:
            time.sleep(0.2)
        assert not shuffled() - before and table.count() == 10
    assert spark.conf.get(name, None) == held


def test_few_links_are_followed_in_one_task(spark, monkeypatch):
    rng = random.Random(5)
    edges = [(a, b) for a, b in ((rng.randrange(-(2**63), 2**63) if rng.random() < 0.3 else rng.randrange(400), rng.randrange(400)) for _ in range(300)) if a != b]
    df = spark.createDataFrame(edges, "u long, v long")
    want = sorted(map(tuple, components(df).collect()))
    one = nearcopies._connected(df, len(edges))
    assert one.rdd.getNumPartitions() == 1 and sorted(map(tuple, one.collect())) == want
    monkeypatch.setattr(nearcopies, "FEW", len(edges) - 1)
    assert sorted(map(tuple, nearcopies._connected(df, len(edges)).collect())) == want
    assert nearcopies._connected(df.limit(0), 0).count() == 0
