"""simhash, decontamination, mixing: brute force and edge cases."""

import random
import re
import sys
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from duck import same

import corpus_pipeline
from inkwell.llm import decontam, htmlwrap, langid, licenses, mixing, nearcopies, pii, quality, registry, simhash, urlrules

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, source string, component string, n_chars long"


def documents(spark, seed=0):
    """Copies, near copies, nulls, empty and long texts, repeated rows, and columns whose names an operator might use."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5))) for _ in range(60)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 80))) for _ in range(60)]
    for k in range(40):
        t = texts[rng.randrange(60)].split(" ")
        if t:
            t[rng.randrange(len(t))] = "neu"
        texts.append(" ".join(t))
    texts += [None, "", " \t\n", "A", "a b", "Ä É", texts[0], texts[0], "wort " * 3000]
    rows = [(i, t, None if i % 11 == 0 else f"s{i % 3}", "x", 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[:3], SCHEMA)


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))
    if not w:
        return 0
    k = min(4, len(w))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(len(w) - k + 1)]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def components(ids, fps, bits=4):
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                parent[root(i)] = root(j)
    least = {}
    for i in range(len(ids)):
        least[root(i)] = min(least.get(root(i), ids[i]), ids[i])
    return [least[root(i)] for i in range(len(ids))]


def test_near_duplicates_against_brute_force(spark):
    docs = documents(spark)
    got = [(r["id"], r["fp"] % (1 << 64), r["component"]) for r in simhash.near_duplicates(docs).collect()]
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.collect()]
    ids, fps = zip(*rows)
    assert sorted(got) == sorted(zip(ids, fps, components(ids, fps)))


def test_near_duplicates_of_nothing(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    lone = simhash.near_duplicates(spark.createDataFrame([(None, None, None, None, None)], SCHEMA)).first()
    assert (lone["id"], lone["fp"], lone["component"]) == (None, 0, None)


def test_joined_runs_lose_no_link(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    flips = [sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)) for _ in range(300)]
    fps = sorted({int(centre[i % 3]) ^ f for i, f in enumerate(flips)} | {int(x) for x in rng.integers(0, 1 << 63, 100)})
    monkeypatch.setattr(simhash, "TILE", 16)  # every hot key is split into tiles
    df = simhash.pivot_table(spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long"))
    assert all(list(r["far"]) == [bin((r["fp"] % (1 << 64)) ^ int(p)).count("1") for p in simhash.references()] for r in df.limit(20).collect())
    from inkwell.llm.components import components as connect

    signed = [int(np.uint64(x).view(np.int64)) for x in fps]
    want = components(signed, fps)
    for blocks in (None, 6, 7, 8):
        got = {r["u"]: r["root"] for r in connect(simhash.links(df, blocks=blocks)).collect()}
        assert [got.get(s, s) for s in signed] == want


def five_word_runs(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def near_copies(seed=5):
    """Texts with 0 to 5 words changed, a common line in all, groups whose members are alike in part, and what documents() has."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    common, texts = " ".join(word() for _ in range(12)), [None, "", " \t", "A", "a", "Ein Satz mit vier Ä", "ein satz mit vier Ä"]
    for size in (6, 30, 100, 300):
        for _ in range(12):
            base = [word() for _ in range(size)]
            texts.append(f"{common} {' '.join(base)}")
            for changes in range(6):
                t = list(base)
                for at in rng.sample(range(size), changes):
                    t[at] = word()
                texts.append(f"{common} {' '.join(t)}")
    return texts


def test_near_copies_against_brute_force(spark):
    texts = near_copies() + [r["text"] for r in documents(spark).collect()]
    runs = [five_word_runs(t) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(runs[i] & runs[j])
            if 5 * both >= 4 * (len(runs[i]) + len(runs[j]) - both):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(r["doc_id"] for r in nearcopies.representatives(docs).collect())
    assert got == sorted({root(i) for i in range(len(texts))}) and len(got) < len(texts) * 0.7
    assert nearcopies.representatives(docs.limit(0)).count() == 0


def test_large_group_is_not_expanded_into_pairs(spark, monkeypatch):
    """Near copies of one text, alike in part: those still apart after the hubs meet the nearest of each component, not all its members."""
    rng, made = random.Random(12), []
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base, texts = [word() for _ in range(120)], set()
    while len(texts) < 500:
        t = list(base)
        for at in rng.sample(range(120), rng.choice([2, 3, 4])):
            t[at] = word()
        texts.add(" ".join(t))
    verified = nearcopies._verified

    def counted(pairs, *rest):
        made.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(nearcopies, "_verified", counted)
    df = spark.createDataFrame([(t,) for t in sorted(texts)], "text string").select(nearcopies.text_class(F.col("text")).alias("c"), "text")
    groups = df.join(nearcopies.joined(df), "c", "left").groupBy(F.coalesce("root", "c")).agg(F.collect_list("text")).collect()
    texts, seen, left = sorted(texts), set(), set(texts)
    runs = {t: five_word_runs(t) for t in texts}
    want = []
    while left:
        group, todo = set(), [left.pop()]
        while todo:
            group.add(x := todo.pop())
            near = {y for y in left if 5 * len(runs[x] & runs[y]) >= 4 * len(runs[x] | runs[y])}
            left -= near
            todo += near
        want.append(sorted(group))
    assert sorted(sorted(g[1]) for g in groups) == sorted(want)
    assert sum(made[-2:]) < 10 * len(texts)


def test_stage_drops_near_copies_beyond_four_bits(spark, sf):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(100)]
    texts = [" ".join("neu" if i in at else w for i, w in enumerate(base)) for at in ((), (30,), (40, 70))]
    fps = [plain_fingerprint(t) for t in texts]
    assert all(bin(fps[0] ^ f).count("1") > 4 for f in fps[1:])
    docs = spark.createDataFrame([(i + 1, t, "en", "a", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, sf).collect()] == [1]


def test_pairs_within_four_bits_are_left_to_simhash(spark, sf, monkeypatch):
    """What the stage keeps depends on SimHash's links: the join looks for no pair that is theirs."""
    rng = random.Random(10)
    base = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(400)]
    texts = [" ".join("neu" if i in at else w for i, w in enumerate(base)) for at in ((), (200,), range(20, 400, 50))]
    fps = [simhash.folded(nearcopies.runs(t.encode())) for t in texts]
    assert [(fps[0] ^ f).bit_count() for f in fps[1:]] == [2, 10]
    docs = spark.createDataFrame([(i + 1, t, "en", "a", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = lambda: sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, sf).collect())
    assert kept() == [1]
    links = simhash.links
    monkeypatch.setattr(simhash, "links", lambda *a, **k: links(*a, **k).limit(0))
    assert kept() == [1, 2]


@pytest.mark.parametrize("share", [1, 3])
def test_simhash_loses_no_pair_within_its_bits(spark, monkeypatch, share):
    """All pairs are SimHash's if all fingerprints are one (share 1), and part of them if there are three, far from each other."""
    sketched = nearcopies._sketched
    monkeypatch.setattr(nearcopies, "_sketched", lambda texts: sketched(texts).withColumn("fp", F.pmod(F.xxhash64("c"), F.lit(share)) * 0x111111111111111))
    test_near_copies_against_brute_force(spark)


def test_decontamination_edges(spark):
    items = spark.createDataFrame([(1, "Alpha beta GAMMA delta"), (2, None), (3, "?!"), (4, " ".join(f"w{i}" for i in range(14))), (4, "nur zwei"), (5, "é")], "item_id long, text string")
    body = " ".join(f"W{i}" for i in range(14))
    docs = spark.createDataFrame([(1, "x alpha, beta. gamma-delta y"), (1, "x alpha, beta. gamma-delta y"), (2, f"{body} {body} nur zwei"), (3, None), (4, ""), (None, "É é"), (5, "alpha beta gamma"), (6, "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9")], "doc_id long, text string")
    got = sorted(((r["id"] is not None, r["id"] or 0, r["n_words"], r["n_hit"], sorted(r["hit_items"])) for r in decontam.contamination(docs, items).collect()))
    assert got == [(False, 0, 2, 1, [5]), (True, 1, 6, 4, [1]), (True, 1, 6, 4, [1]), (True, 2, 30, 30, [4]), (True, 3, 0, 0, []), (True, 4, 0, 0, []), (True, 5, 3, 0, []), (True, 6, 10, 10, [4])]
    assert sorted(r["doc_id"] for r in decontam.clean(docs, items).collect()) == [3, 4, 5]
    assert decontam.contamination(docs, items.limit(0)).where("n_hit > 0").count() == 0
    assert decontam.contamination(docs.limit(0), items).count() == 0


def plain_contamination(docs, items, width=10):
    """(doc_id, n_words, n_hit, items) by comparing every window of every item with every place of every text."""
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(ASCII))
    wanted = {}
    for item, text in items:
        w = cut(text)
        for i in range(max(len(w) - width + 1, 1) if w else 0):
            wanted.setdefault(tuple(w[i : i + width]), set()).add(item)
    out = []
    for id_, text in docs:
        w, hit, held = cut(text), set(), set()
        for g, of in wanted.items():
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i : i + len(g)]) == g:
                    hit |= set(range(i, i + len(g)))
                    held |= of
        out.append((id_, len(w), len(hit), sorted(held, key=str)))
    return out


@pytest.mark.parametrize("limit_bytes", [32 << 20, 0])
def test_decontamination_against_brute_force(spark, limit_bytes):
    """Both ways: shingles broadcast, and the documents' places shuffled."""
    rng = random.Random(12)
    words = [*"abcdefgh", "é", "É", "Ab", "word", "x1"]
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(words) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([1, 2, 2, 3, 4, 9, 10, 11, 14, 25, 25])] + [(None, text(12)), (None, text(3)), (3, text(10)), (20, None), (21, "?!"), (22, "the the the the the the the the the the")]
    docs = [(i, text(rng.randint(0, 60))) for i in range(40)] + [(i, f"{text(5)} {rng.choice(items)[1]} {text(5)}") for i in range(40, 90)]
    docs += [(None, docs[50][1]), (None, docs[50][1]), (None, "nothing here at all"), (7, docs[60][1]), (8, None), (9, ""), (91, "the " * 5000), (92, f"{items[9][1]} {text(3000)} {items[9][1]}")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = [(r["id"], r["n_words"], r["n_hit"], sorted(r["hit_items"], key=str)) for r in decontam.contamination(d, b, limit_bytes=limit_bytes).collect()]
    want = plain_contamination(docs, items)
    assert sorted(map(str, got)) == sorted(map(str, want))
    clean = decontam.clean(d, b, limit_bytes=limit_bytes)
    assert sorted(map(str, clean.collect())) == sorted(str(r) for r, w in zip(d.collect(), want) if not w[2])


def test_decontamination_shuffles_no_word_list(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k")], "id long, text string")
    known = spark.createDataFrame([("a b c",)], "shingle string")
    plan = decontam._places(docs, known, [3], 0)._jdf.queryExecution().executedPlan().toString().splitlines()
    exchange = next(i for i, line in enumerate(plan) if "hashpartitioning(own" in line)
    carried = [re.sub(r".* AS |#.*", "", c) for c in plan[exchange + 1].partition("[")[2].split("#") if " AS " in c]
    assert not any("BroadcastHashJoin" in line for line in plan) and carried[-2:] == ["own", "here"]
    assert "w" not in re.findall(r"(?:^|, )(\w+)#\d+L?(?=,|\])", re.sub(r"CASE .*? END AS", "", plan[exchange + 1].partition("[")[2]))


def test_rows_without_own_ids_are_judged_by_text(spark, sf):
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    rows = [(None, "x alpha beta gamma"), (None, "rein und leer"), (1, "alpha beta gamma y"), (1, "auch sauber"), (1, "ganz anders"), (2, "auch sauber")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clean = decontam.clean(docs, items)
    assert sorted(map(str, clean.collect())) == sorted(map(str, docs.where("text NOT LIKE '%beta%'").collect()))
    kept = corpus_pipeline.near_duplicates(spark, docs.unionByName(spark.createDataFrame([(None, "auch sauber")], docs.schema)), sf)
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.where("NOT (doc_id <=> 2)").collect()))


def test_mixing(spark):
    docs = documents(spark)
    rows = mixing.copies(docs).collect()
    assert len(rows) == docs.count() and rows[0].asDict()["component"] == "x"
    sizes, taken, target = {}, {}, {}
    for r in rows:
        assert r["copies"] * r["size"] <= 2 * r["size"] and r["target"] <= 2 * r["source_size"] + 1e-9
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * r["copies"]
        target[r["source"]] = r["target"]
    assert all(r["source_size"] == sizes[r["source"]] for r in rows)
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert sorted(map(str, rows)) == sorted(map(str, mixing.copies(docs).collect()))
    assert mixing.copies(docs.limit(0)).count() == 0
    assert mixing.mix(docs).count() == sum(r["copies"] for r in rows) and mixing.mix(docs).columns == docs.columns
    empty = mixing.copies(spark.createDataFrame([(1, None, None, None, None)], SCHEMA)).first()
    assert (empty["size"], empty["target"], empty["copies"]) == (0, 0.0, 0)


def test_targets_reshare_by_weight(spark):
    sizes = {"a": 1, "b": 1000, "c": 500, None: 10}
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")).collect()}
    order = ["a", "b", "c", None]
    weight, want, rest, open_ = dict(zip(order, (3, 1, 2, 3))), {}, 1.5 * sum(sizes.values()), set(order)
    while True:  # the rule as stated: what is over goes to the others by weight
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if rest * weight[s] / total > 2 * sizes[s]]
        if not over:
            want |= {s: rest * weight[s] / total for s in open_}
            break
        for s in over:
            want[s] = 2.0 * sizes[s]
            open_.remove(s)
        rest = 1.5 * sum(sizes.values()) - sum(want.values())
    assert all(got[s] == pytest.approx(want[s]) for s in order)


def test_hot_source_meets_its_target(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(1, 60), "hot" if i % 3 else f"s{i % 5}") for i in range(4000)]
    got = mixing.copies(spark.createDataFrame(rows, "doc_id long, text string, source string")).selectExpr("source", "target", "size * copies AS taken").groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    assert all(abs(r["sum(taken)"] / r["max(target)"] - 1) < 0.02 for r in got)


#: Names that the operators use for columns of their own.
TAKEN = "id fp component size source_size target copies copy taken lang_pred score held_out predicted spans row own mark w at token item window hit_items n_hit host path rule verdict html label h k n found paragraph family __mine __mix_bin __kept __hit __text".split()


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "Ein Satz mit Wort und a@b.de", "s"), (2, None, None), (3, "", "s"), (None, "Ein Satz mit Wort und a@b.de", "s")], "doc_id long, text string, source string")
    wide = docs.withColumns({c: F.lit("x") for c in TAKEN})
    pages = spark.createDataFrame([(1, "http://a.com/x", "<p>eins</p>"), (2, None, None)], "page_id long, url string, html string").withColumns({c: F.lit("x") for c in TAKEN if c != "html"})
    items = spark.createDataFrame([(1, "nicht da")], "item_id long, text string").withColumns({c: F.lit("x") for c in TAKEN})
    net = langid.fit(docs.withColumn("lang", F.lit("de")))
    rules = spark.createDataFrame([(["h:com"], 1, 0.9)], "rule array<string>, n int, confidence double")
    results = [
        langid.identify(wide, net), simhash.near_duplicates(wide), mixing.copies(wide), mixing.mix(wide), mixing.mix(wide, number="copy"), decontam.contamination(wide, items), decontam.clean(wide, items),
        pii.find(wide), pii.redact(wide), licenses.scan(wide), quality.score(wide, quality.fit(wide, docs.select(F.col("doc_id").alias("id"), F.lit(1).alias("label")))),
    ]
    assert all(d.count() == 4 for d in results[:3] + results[5:]) and all(len(set(d.columns)) == len(d.columns) for d in results)
    assert mixing.mix(wide).columns == wide.columns and sorted(mixing.mix(wide, number="copy").columns) == sorted(wide.columns)
    assert htmlwrap.extract(pages).count() == 2
    judged = urlrules.judge(pages, rules)
    assert judged.count() == 2 and len(set(judged.columns)) == len(judged.columns)


def test_stages_with_clashing_names(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    wide = docs.withColumns({c: F.lit("x") for c in TAKEN})
    for name, stage in corpus_pipeline.STAGES:
        plain, out = stage(spark, docs, sf), stage(spark, wide, sf)
        assert set(wide.columns) <= set(out.columns), name
        assert sorted(str(r["doc_id"]) for r in out.select("doc_id").collect()) == sorted(str(r["doc_id"]) for r in plain.select("doc_id").collect()), name


def test_base_patterns_are_leftmost():
    rng = random.Random(4)
    email, ip = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(20000):
        t, u = ("".join(rng.choice(c) for _ in range(rng.randint(0, 24))) for c in ("a1.@@% -é\n", "12.. "))
        assert [("email", *m.span()) for m in email.finditer(t)] == list(pii.emails(t))
        assert [m.span() for m in ip.finditer(u)] == [m.span() for m in pii.BASE["ip"].finditer(u)]
    long = "a" * 500_000 + " x@y.de " + "0" * 6000 + "1.2.3.4"
    assert [(k, b - a) for k, a, b in pii.base_spans(long)] == [("email", 6), ("ip", 6007)]


@pytest.mark.parametrize("text, want", [
    ("x\nReleased under the MIT License.", "1:mit"), ("Licensed under CC BY-NC 4.0.\n\nAll rights reserved.", "0:cc-by-nc,2:proprietary"),
    ("This work is licensed under the GNU General Public License, version 3.", "0:gpl"), ("Licensed under the Apache License, Version 2.0.", "0:apache"),
    ("The driver was licensed to drive the work of the foundation.", ""), ("", ""), (None, ""), ("license", ""), ("mit\ncopyright\nversion 2.0", ""),
])
def test_licences(spark, text, want):
    found = licenses.scan(spark.createDataFrame([(1, text), (1, text), (None, text)], "doc_id long, text string")).collect()
    assert len(found) == 3 and {",".join(f"{x['paragraph']}:{x['family']}" for x in r["found"]) for r in found} == {want}


def test_licences_held_out_accuracy():
    m = licenses.train()
    rng, right, n = random.Random(99), 0, 600
    for _ in range(n):
        words, family = licenses._written(rng)
        z = np.array(m.bias) + sum((np.array(m.weights[f]) for f in licenses.features(words) if f in m.weights), np.zeros(len(m.bias)))
        right += m.families[int(z.argmax())] == family
    assert right / n >= 0.95


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_agrees_with_sql(spark, sf, name):
    same(spark, sf, registry.queries()[name], registry.oracle_sql()[name])
