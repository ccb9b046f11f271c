"""The learned operators: held-out accuracy, brute force, edge cases; and the pipeline."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkwell.llm import ann, bytecnn, htmlwrap, langid, pii, quality, registry, sampling, urlrules

SF = "/root/testdata/sf0.01"


def test_windows_cover_every_byte_once():
    texts = [bytes(random.Random(i).choices(range(97, 123), k=n)) for i, n in enumerate((0, 1, 5, 252, 253, 256, 2000, 5000))]
    for most in (300, 1000, 1 << 20):
        seen = {i: b"" for i in range(len(texts))}
        for view, of, new in bytecnn.pieces(texts, 256, 3, most):
            for v, i, n in zip(view, of, new):
                seen[i] += bytes((v[:n] % 256).astype(np.uint8))
        assert [seen[i] for i in range(len(texts))] == texts


def test_pieces_score_as_the_whole():
    rng = np.random.default_rng(0)
    net = bytecnn.train(rng.integers(97, 120, (64, 256)).astype(np.int16), rng.integers(0, 2, 64), np.ones(64, np.float32), [0, 1], {2: 3, 4: 3}, epochs=1)
    text = bytes(rng.integers(97, 120, 9000).astype(np.uint8)) + b"abab" * 200
    whole = net.logits(bytecnn.windows([text], 256, net.overlap)[0])
    parts = np.concatenate([net.logits(v) for v, _, _ in bytecnn.pieces([text], 256, net.overlap, 1000)])
    assert np.allclose(whole, parts, atol=1e-5)


def test_network_against_a_plain_convolution():
    """Logits by one multiplication for each byte, filter and place, with the bytes' marks found by comparison."""
    rng = np.random.default_rng(4)
    net = bytecnn.train(rng.integers(97, 120, (64, 64)).astype(np.int16), rng.integers(0, 2, 64), np.ones(64, np.float32), [0, 1], {2: 2, 4: 3}, epochs=1)
    text = b"x" * 3 + bytes(rng.integers(97, 120, 40).astype(np.uint8)) + b"abcabcabcabcabc" * 2
    marked = [any(i >= lag + bytecnn.RUN - 1 and all(text[i - k] == text[i - k - lag] for k in range(bytecnn.RUN)) for lag in range(2, bytecnn.LAGS + 1)) for i in range(len(text))]
    sym = [c + 256 * m for c, m in zip(text, marked)]
    view, _, _ = bytecnn.windows([text], 64, net.overlap)
    first = [*sym, *[0] * 64][:64]
    assert view[0].tolist() == first
    tops = []
    for f in range(len(net.bias)):
        weights = [t[:, f] for t in net.tables if f < t.shape[1]]
        tops.append(max(0.0, max(sum(float(w[first[a + i]]) for i, w in enumerate(weights)) for a in range(64 - net.overlap)) + float(net.bias[f])))
    assert np.allclose(np.array(tops) @ net.dense + net.offset, net.logits(view[:1])[0], atol=1e-4)


@pytest.mark.parametrize("per_label", [1, 10, 16, 90])
def test_labelled_rows_are_bounded_exactly(spark, per_label):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(300)] + [(None, "x"), (5, "a text")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 3) for i in range(240)] + [(1, 1), (None, 1), (7, None), (999, 2)], "id long, label int")
    rows = sampling.labelled_rows(docs, labels, per_label).collect()
    by = {k: sorted(r["id"] for r in rows if r["label"] == k) for k in range(3)}
    assert [len(v) for v in (by[0], by[1])] == [min(per_label, 80)] * 2 and len(by[2]) >= min(per_label, 80) - 1
    assert all(r["text"] == ("a text" if r["id"] == 5 else f"text {r['id']}") for r in rows)
    assert sampling.labelled_rows(docs, labels.limit(0), per_label).count() == 0
    with pytest.raises(ValueError):
        sampling.labelled_rows(docs, spark.range(300).select("id", F.col("id").alias("label")), per_label)


def test_sampled_windows_come_from_whole_texts(spark):
    text = "".join(chr(97 + i * i % 26) for i in range(5000)) + "abcd" * 40
    rows = spark.createDataFrame([("a", 1, text), ("b", 2, ""), ("b", 3, "kurz é")], "label string, h long, text string")
    view, labels = sampling.sampled_windows(rows, 64, 3, 1000)
    whole = bytecnn.windows([text.encode(), b"", "kurz é".encode()], 64, 3)[0]
    assert sorted(map(bytes, view.astype(np.int16))) == sorted(map(bytes, whole.astype(np.int16))) and sorted(set(labels)) == ["a", "b"]
    few, _ = sampling.sampled_windows(rows, 64, 3, 7)
    assert len(few) == 7 and (few == sampling.sampled_windows(rows, 64, 3, 7)[0]).all()


def test_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = registry.queries()["op9_langid_cnn"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) >= 0.97
    net = langid.fit(docs)
    # Two function words over and over are no evidence for a net that learned on prose; a real document is, at any length.
    french = docs.where("lang = 'fr' AND length(text) > 500").orderBy("doc_id").first()["text"]
    odd = spark.createDataFrame([(None, None, "a"), (1, "", "b"), (2, "123 !?", "c"), (2, "123 !?", "c"), (3, french * (350_000 // len(french)), "d")], "doc_id long, text string, score string")
    out = langid.identify(odd, net)
    assert out.columns == ["doc_id", "text", "lang_pred", "score"]
    assert [r["lang_pred"] for r in out.collect()] == ["und"] * 4 + ["fr"]
    nothing = langid.identify(odd, langid.fit(docs.limit(0)))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"} and langid.identify(odd.limit(0), net).count() == 0


def test_quality(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = registry.queries()["op2_quality_cnn"](spark, SF).join(labels, "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in got)
    assert sum(r["quality"] == r["predicted"] for r in held) / len(held) >= 0.93
    texts = {r["doc_id"]: len(r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for low, high in ((0, 400), (400, 2000), (2000, 10**9)):
        band = [r["quality"] == r["predicted"] for r in held if low <= texts[r["doc_id"]] < high]
        print(f"quality, held out, {low} to {high} characters: {sum(band)} of {len(band)} right")
        assert not band or sum(band) / len(band) >= 0.9
    docs = spark.createDataFrame([(None, None), (1, ""), (1, "")], "doc_id long, text string")
    model = quality.fit(docs, spark.createDataFrame([], "id long, label int"))
    assert [r["score"] for r in quality.score(docs, model).collect()] == [0.5] * 3


def plain_spans(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if max(map(int, m[0].split("."))) <= 255:
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 13 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def test_personal_data_base(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rng = random.Random(0)
    texts += [(10**6 + i, "".join(rng.choice("0123456789 .-+()@aé") for _ in range(200))) for i in range(100)]
    texts += [(-1, None), (-2, ""), (-2, ""), (-3, "4111 1111 1111 1111 at a.b@c.de, 1.2.3.4.5 +1 (212) 555-0199")]
    model = pii.train()
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = pii.find(docs, model=model).collect()
    assert len(got) == len(texts)
    by = dict(texts)
    for r in got:
        base = [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["base"]]
        assert base == plain_spans(by[r["id"]] or "")
        for s in r["spans"]:
            assert s["base"] or all(s["end"] <= b or a >= s["end"] or s["start"] >= b for _, a, b in base)
    row = registry.queries()["op5_pii_boosted"](spark, SF).where("n_email > 0").first()
    spans = plain_spans(by[row["doc_id"]])
    assert row["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
    masked = {r["doc_id"]: r["text"] for r in pii.redact(docs, model=model).collect()}
    assert masked[-3] == "[CARD] at [EMAIL], [IP].5 [PHONE]" and masked[-1] is None


def test_personal_data_boosted():
    model, rng = pii.train(), random.Random(77)
    hit = wrong = good = 0
    for _ in range(800):
        before, span, after, label = pii._written(rng)
        base, added = pii.all_spans(before + span + after, model)
        exact = any(a == len(before) and b == len(before) + len(span) for _, a, b in base + added)
        good += label
        hit += label and exact
        wrong += not label and bool(added)  # base spans are the contract's, right or wrong
    assert hit / good >= 0.95 and wrong <= 8
    assert pii.all_spans("Version 2.0.1, page 12-14, 2024-05-06 and 10:22:33.", model) == ([], [])


def test_fixed_url_rules(spark):
    urls = ["http://EXAMPLE.com/en/x", "https://www.example.com/en/", "http://a.www.example.com/en/1?q", "http://b.example.com/fr/", "http://x.net/es/1", "http://net/fr/", "http://xnet/fr/", "http://a.com", "http://a.com?x/", None, "no scheme", "http://h.org/en/", "http://example.com/EN/"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(0, urls[0])], "page_id long, url string")
    none = spark.createDataFrame([], "rule array<string>, n int, confidence double")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlrules.judge(df, none).collect()}
    assert got[0] == ("example.com", "/en/x", "example.com/en/", "block") and got[1][2:] == ("www.example.com/en/", "allow") and got[2][2:] == ("www.example.com/en/", "allow")
    assert got[3][2:] == ("com/", "allow") and got[4][2:] == ("net/es/", "block") and got[5][2:] == ("net/fr/", "block") and got[6][2:] == (None, "allow")
    assert got[7] == ("a.com", "", None, "allow") and got[8] == ("a.com", "", None, "allow") and got[9] == ("", "", None, "allow") and got[10] == ("", "", None, "allow") and got[12][2:] == ("com/", "allow")


def test_mined_url_rules(spark):
    rows = [(["h:bad.org", "p:en", f"q:{i % 3}"], True) for i in range(60)] + [(["h:good.org", "p:en", f"q:{i % 3}"], i % 10 == 0) for i in range(200)] + [([], True), (None, False)]
    rules = urlrules.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean"), 0.01)
    assert [r["rule"] for r in rules.collect()] == [["h:bad.org"]]
    pages = spark.createDataFrame([(1, "http://x.bad.org/1"), (2, "http://good.org/1")], "page_id long, url string")
    assert {r["page_id"]: r["verdict"] for r in urlrules.judge(pages, rules).collect()} == {1: "block", 2: "allow"}
    assert urlrules.mine(spark.createDataFrame([], "tokens array<string>, bad boolean")).count() == 0


def plain_rules(rows, least, confidence, lift, deviations):
    """Every combination of tokens of every bad row, counted over all rows; those with a shorter one that holds as well left out."""
    rows = [(frozenset(t), bool(b)) for t, b in rows if t]
    base = sum(b for _, b in rows) / len(rows)
    found = {}
    for t, b in rows:
        for n in range(1, len(t) + 1) if b else ():
            for c in map(frozenset, itertools.combinations(sorted(t), n)):
                if c not in found:
                    of = [bad for tokens, bad in rows if c <= tokens]
                    share = sum(of) / len(of)
                    if sum(of) >= least and share >= max(confidence, lift * base) and (share - base) * len(of) ** 0.5 >= deviations * (base * (1 - base)) ** 0.5:
                        found[c] = share
    return sorted(sorted(c) for c, p in found.items() if not any(d < c and q >= p for d, q in found.items()))


def test_mined_rules_against_brute_force(spark):
    rng = random.Random(21)
    rows = []
    for _ in range(400):
        t = sorted({rng.choice(["h:a", "h:b", "h:c"]), *rng.sample(["p:x", "p:y", "p:z", "q:1", "q:2"], rng.randint(0, 4))})
        rows.append((t, rng.random() < (0.9 if {"h:a", "p:x"} <= set(t) else 0.8 if "q:2" in t and "p:y" in t else 0.2)))
    rows += [([], True), (["h:a"], None)]
    got = urlrules.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean"), least=15, confidence=0.5, lift=1.3, deviations=2.0)
    want = plain_rules(rows, 15, 0.5, 1.3, 2.0)
    assert sorted(r["rule"] for r in got.collect()) == want and len(want) > 1


def test_many_frequent_tokens_stay_bounded(spark):
    """60 tokens in every bad url would make 2 ** 60 combinations."""
    rows = [([f"p:{i:02}" for i in range(60)], True)] * 40 + [(["h:good"], False)] * 100
    rules = urlrules.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean")).collect()
    assert rules and all(r["n"] == 1 and r["confidence"] == 1.0 for r in rules)


def test_rules_of_tokens_beyond_the_eighth(spark):
    """Rows of up to 14 frequent tokens, where the pair that tells goes least with bad by each of its tokens."""
    rng, rows = random.Random(4), []
    for _ in range(300):
        t = sorted(x for x in [f"p:{i:02}" for i in range(12)] if rng.random() < 0.75) + [x for x in ("q:x", "q:y") if rng.random() < 0.6]
        rows.append((t, rng.random() < (0.95 if {"q:x", "q:y"} <= set(t) else 0.1 if {"q:x", "q:y"} & set(t) else 0.6)))
    got = urlrules.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean"), least=40, confidence=0.5, lift=1.3, deviations=2.0)
    want = plain_rules(rows, 40, 0.5, 1.3, 2.0)
    assert sorted(r["rule"] for r in got.collect()) == want and ["q:x", "q:y"] in want


def article(text, header="", cls="", outer=""):
    return f"<html><body><nav><a href=/>Start</a></nav><div class='{outer}'><article class='{cls}'>{header}<p>{text}</p></article></div><footer>Impressum</footer></body></html>"


def texts_of(spark, pages, **options):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = htmlwrap.wrappers(df, **options) if options else None
    return {r["id"]: r["text"] for r in htmlwrap.extract(df, found=found).collect()}


def test_wrapper_edges(spark):
    deep = "<div>" * 10_000 + "tief" + "</div>" * 10_000 + "<p>danach</p>"
    pages = [
        (1, "http://a/1", article("Text eins.", "<header class='entry-header'><h1>Titel</h1></header>")),
        (2, "http://b/1", article("Text zwei.", outer="has-sidebar no-ads")),
        (3, "http://c/1", "<body><form id=aspnet><main><p>Formular a<math><mi>x</mi></math>b</p></main></form></body>"),
        (4, "http://d/1", "<body><div class='social-policy'><p>Sozialpolitik ist ein weites Feld, lang genug.</p></div><div class='share-buttons'>teilen</div></body>"),
        (5, "http://e/1", f"<body>{deep}</body>"), (6, "http://f/1", ""), (7, None, None), (8, None, "<p>ohne Adresse</p>"),
        (9, "http://g/1", article("Neun.") + "<div id=comments><article class=comment-body>Leser</article></div>"),
    ]
    got = texts_of(spark, pages)
    assert got[1] == "Titel\nText eins." and got[2] == "Text zwei." and got[3] == "Formular axb" and got[4].startswith("Sozialpolitik") and "teilen" not in got[4]
    assert got[5] == "tief\ndanach" and got[6] == "" and got[7] == "" and got[8] == "ohne Adresse" and got[9] == "Neun."


def test_wrapper_without_tags_that_tell(spark):
    """Two templates of one host, no article, main or telling class: the text that stays the same is the wrapper's."""
    rng = random.Random(3)
    text = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(40))
    want, pages = {}, []
    for i in range(24):
        t = text()
        want[i] = t
        fixed = "<p class=x7>Every page of this place says this, and it says it at some length, again and again.</p>"
        body = f"<div class=q1><div class=q2><p>{t}</p>{fixed}</div></div>" if i % 2 else f"<table><tr><td class=z>{t}</td></tr></table>{fixed}"
        pages.append((i, "http://h/%d" % i, f"<html><body><div class=k9><a href=/>{'Start'}</a> <a href=/x>Mehr</a></div>{body}</body></html>"))
    got = texts_of(spark, pages)
    assert {i: got[i] for i in range(1, 24, 2)} == {i: want[i] for i in range(1, 24, 2)}
    assert all(got[i].startswith(want[i]) for i in range(0, 24, 2))


def test_host_of_many_expressions(spark):
    """Partial wrappers, level by level, give the texts that one task gives."""
    rng = random.Random(6)
    pages = [(i, "http://h/x", "<body>" + "".join(f"<{rng.choice(['ul', 'ol', 'pre', 'section'])} class=c{rng.choice('abcdefgh')}>mehr</{'ul'}>" for _ in range(4)) + f"<article><p>Text {i}</p><p>und mehr</p></article></body>") for i in range(300)]
    one, levels = texts_of(spark, pages), texts_of(spark, pages, fan=8)
    assert one == levels and all(one[i].startswith(f"Text {i}") for i in one)


def test_nearest_recall_and_ties(spark):
    got = registry.queries()["op7_ann_anisotropic"](spark, SF).collect()
    e = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    x, ids = np.array([r["embedding"] for r in e], np.float64), np.array([r["vec_id"] for r in e])
    hit = total = 0
    for q in ids[ids % 20 == 0]:
        s = x @ x[ids == q][0]
        s[ids == q] = -np.inf
        want = set(ids[np.lexsort((ids, -s))[:20]])
        mine = sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == q)
        assert [k for k, _ in mine] == list(range(1, 21))
        hit, total = hit + len(want & {v for _, v in mine}), total + 20
    assert hit / total >= 0.9


def test_nearest_edges(spark):
    rows = [(i, [1.0, 0.0, 0.5]) for i in range(60)] + [(60 + i, [float(i), 1.0, 0.0]) for i in range(10)]
    odd = [(100, None), (120, [0.0, 0.0, 0.0]), (140, [float("nan"), 1.0, 1.0]), (160, [None, 1.0, 1.0]), (180, [float("inf"), 1.0, 1.0]), (200, []), (220, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (0, [1.0, 0.0, 0.5])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    got = ann.nearest(df, lambda i: i % 20 == 0).collect()
    x = dict(rows)
    assert {r["query_id"] for r in got} == {0, 20, 40, 60}
    for q in (0, 20, 40, 60):
        want = sorted((-float(np.dot(x[q], v)), i) for i, v in rows if i != q)[:20]
        assert [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == [(i, -s) for s, i in want]
    assert ann.nearest(df.limit(0), lambda i: i % 20 == 0).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head><body class="has-sidebar"><nav><ul><li><a href="/">Home</a></li></ul></nav>
<header>Site</header><div class="ad">Buy</div><article><h1>Title %d &amp; more</h1><p>First&nbsp;<b>bold %d</b>
 text.<br><p>Second %d</p><div class="share-box">share</div><form>mail <input></form><section id="comments"><p>me too</p></section></article><aside>x</aside><footer>&copy; f</footer></body></html>"""


def test_pages(spark):
    rows = [(i, "http://a.org/%d" % i, PAGE % (i, i, i)) for i in range(5)]
    rows += [(10, "http://b.org/", None), (11, None, ""), (12, "x", "just text < 3 &lt;b&gt;"), (13, "http://c.org/", "<html><body><div class=menu><a href=x>a</a></div><div><p>one</p><p>two <i>x</i></p><ul><li>three</ul></div></body>"), (0, rows[0][1], rows[0][2])]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = {(r["id"]): r["text"] for r in htmlwrap.extract(df).collect()}
    assert got[3] == "Title 3 & more\nFirst bold 3 text.\nSecond 3"
    assert got[10] == "" and got[11] == "" and got[12] == "just text < 3 <b>" and got[13] == "one\ntwo x\nthree"
    assert htmlwrap.extract(df).count() == len(rows) and htmlwrap.extract(df.limit(0)).count() == 0


def test_pages_of_mixed_templates(spark):
    text = "Ein langer Absatz mit eigenem Text und der Nummer %d, der auf dieser Seite steht."
    teasers = "".join('<article class=card><a href="/%d">Mehr</a></article>' % k for k in range(3))
    shapes = {
        "article": "<body><nav>x</nav><article><p>%s</p></article></body>", "main": "<body><main><p>%s</p></main></body>", "div": "<body><div class=content><p>%s</p></div></body>",
        "other": "<body><table><tr><td>%s</td></tr></table></body>", "cards": f"<body><main><p>%s</p>{teasers}</main></body>", "beside": f"<body><div class=content><p>%s</p></div><div>{teasers}</div></body>",
    }
    rows = [(f"{host}{name}{i}", url, shape % (text % i)) for host, url in (("a", "http://mixed.org/x"), ("b", None)) for name, shape in shapes.items() for i in range(6)]
    got = {r["id"]: r["text"] for r in htmlwrap.extract(spark.createDataFrame(rows, "page_id string, url string, html string")).collect()}
    assert all(text % int(name[-1]) in t for name, t in got.items()) and len(got) == len(rows)
    assert got["aarticle3"] == got["bdiv3"] == got["aother3"] == text % 3
    plain = htmlwrap.extract(spark.createDataFrame([x for x in rows if "div" in x[0] or "other" in x[0]], "page_id string, url string, html string")).collect()
    assert all(r["text"] == text % int(r["id"][-1]) for r in plain)


def test_wrapper_is_a_union_free_expression():
    pages = ["<html><body><h1>a</h1><p>x</p></body></html>", "<html><body><h1>b</h1><p>y</p><p>z</p></body></html>", "<html><body><h1>b</h1><div class=k>n</div><p>y</p></body></html>"]
    assert htmlwrap.infer([htmlwrap.blocks(p)[0] for p in pages]) == "html(body(h1(#) div.k(#)? p(#)+))"


def test_pages_against_article_tags(spark):
    from html import unescape

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in registry.queries()["op10_html_wrappers"](spark, SF).collect():
        inner = re.search("<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        parts = [" ".join(unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r["text"] == "\n".join(p for p in parts if p) and r["n_chars"] == len(r["text"])
