"""Personal data: candidate spans by wide generators, judged by boosted trees.

Four kinds are sought. A base of exact patterns is always kept. Beside it,
generators of high recall propose spans that may overlap: addresses written with
(at), colon-separated network addresses, digit groups in national telephone and
card layouts. Boosted trees judge each by its format and by the words around it,
and a threshold for each kind, calibrated on generated text held back from
training to the precision asked for, selects what is added. An added span never
overlaps a base span, nor a better added one.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inkwell.llm import boosting
from inkwell.llm.common import table

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

#: An email is sought from its @, an ip from the start of its digits: the leftmost matches of the plain patterns,
#: without their quadratic time on long runs of letters or digits.
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
BASE = {
    "email": re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
#: Nothing can be found in a text without any of these.
ANY = re.compile(r"[0-9@(\[{]")
DIGIT = re.compile(r"[0-9]")
GENERATORS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[(\[{] ?(?:at|AT|@) ?[)\]}] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[(\[{] ?(?:dot|DOT|\.) ?[)\]}]) ?[A-Za-z0-9-]{1,63}){1,4}"),
    "ip": re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){1,7}(?::|(?::?[0-9A-Fa-f]{1,4})(?::[0-9A-Fa-f]{1,4}){0,6})(?![0-9A-Za-z:])"),
    "card": re.compile(r"(?<![0-9A-Za-z])[0-9]{4}(?:[ ./_-]{1,3}[0-9]{4}){2}[ ./_-]{1,3}[0-9]{1,7}(?![0-9A-Za-z])"),
    "phone": re.compile(r"(?<![0-9A-Za-z.,+])(?:\([0-9]{2,5}\)|[0-9]{2,5})(?:[ ./-]{1,2}\(?[0-9]{2,5}\)?){1,5}(?![0-9A-Za-z])"),
}
#: Fixed lists: words before a span that speak for a kind, and against any.
SPEAKS = {
    "email": re.compile(r"mail|contact|write|reach|kontakt|correo|courriel|adresse", re.I),
    "ip": re.compile(r"\bip\b|ipv6|host|server|address|client|login|serveur|servidor", re.I),
    "card": re.compile(r"card|visa|master|amex|credit|debit|karte|carte|tarjeta|payment", re.I),
    "phone": re.compile(r"tel|phone|call|fax|mobil|cell|whatsapp|sms|anruf|appel|llam|ring", re.I),
}
AGAINST = re.compile(r"isbn|issn|doi|version|\bno\.?\s*$|order|invoice|page|pp|vol|serial|ref|id\b|sku|build|date|year|time|score|km|eur|usd|[$€£#=]\s*$", re.I)
FEATURES = 22


def luhn(digits: str) -> bool:
    total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """Leftmost, non-overlapping: the local part reaches left from an @ that a domain follows, up to the match before."""
    end = 0
    for m in BASE["email"].finditer(text):
        start = m.start()
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if start < m.start():
            end = m.end()
            yield "email", start, end


def base_spans(text: str) -> list[Span]:
    """The exact patterns, leftmost and non-overlapping for each kind; a match that fails its test is dropped and not retried."""
    out: list[Span] = []
    if "@" in text:
        out += emails(text)
    if DIGIT.search(text):
        for m in BASE["ip"].finditer(text):
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in m[0].split(".")):
                out.append(("ip", m.start(), m.end()))
        for m in BASE["card"].finditer(text):
            digits = re.sub("[ -]", "", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in BASE["phone"].finditer(text):
                if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
                    out.append(("phone", m.start(), m.end()))
    return out


def candidates(text: str) -> list[Span]:
    """What the generators propose; spans of different kinds may overlap."""
    return [(kind, m.start(), m.end()) for kind, g in GENERATORS.items() for m in g.finditer(text)]


def features(text: str, span: Span) -> list[float]:
    kind, a, b = span
    s, before, after = text[a:b], text[max(0, a - 40) : a], text[b : b + 20]
    digits = re.sub("[^0-9]", "", s)
    groups = [len(x) for x in re.findall("[0-9]+", s)]
    marks = re.findall(r"[^0-9A-Za-z]+", s)
    return [
        *(float(kind == k) for k in KINDS),
        len(s), len(digits), len(groups), max(groups, default=0), min(groups, default=0), groups[-1] if groups else 0,
        float(bool(digits) and luhn(digits)), float(len(set(marks)) <= 1), float("(" in s or "[" in s or "{" in s),
        float(s.startswith("00")), float(s.startswith("0")), float(bool(digits) and digits[0] in "3456"), len(set(digits)),
        s.count("."), s.count(":"), float(bool(SPEAKS[kind].search(before))), float(bool(AGAINST.search(before[-16:]))),
        float(bool(re.match(r"\s*(?:%|[$€£]|km|kg|eur|usd|pages|x\b)", after, re.I))),
    ]


def _written(rng: random.Random) -> tuple[str, str, str, int]:
    """One generated example: text before, span, text after, and 1 if it is personal data."""
    word = lambda: "".join(rng.choice("abcdefghilmnoprstuv") for _ in range(rng.randint(2, 9)))
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    plain, fore = f"{word()} {word()} ", rng.random() < 0.5
    say = {
        "phone": ["tel. ", "phone: ", "call ", "fax ", "mobile: ", "Telefon ", "appelez "], "card": ["card ", "visa: ", "credit card no ", "Karte ", "tarjeta "],
        "ip": ["from ip ", "host ", "server ", "client address "], "email": ["mail ", "contact: ", "write to ", ""],
        "no": ["ISBN ", "order ", "version ", "invoice no. ", "ref ", "id ", "pages ", "doi ", "$", "build ", "serial ", ""],
    }
    what = rng.choice(["email", "ip", "card", "phone", "phone", "no", "no", "no", "no", "no"])
    lead = rng.choice(say[what])
    if what == "email":
        at, dot = rng.choice([(" (at) ", " (dot) "), (" [at] ", " [dot] "), ("(at)", "."), ("[at]", "."), (" {at} ", " {dot} ")])
        return plain + lead, f"{word()}{rng.choice(['.', '_', ''])}{word()}{at}{word()}{dot}{rng.choice(['com', 'org', 'net', 'de'])}", " " + word(), 1
    if what == "ip":
        full = [f"{rng.randrange(65536):x}" for _ in range(8)]
        s = ":".join(full) if rng.random() < 0.5 else f"{rng.choice(['2001', 'fe80', '2a02', 'fd00'])}:{full[0]}::{full[1]}"
        return plain + (lead if fore else ""), s, " " + word(), 1
    if what == "card":
        d = rng.choice("3456") + num(14)
        d += next(c for c in "0123456789" if luhn(d + c))
        sep = rng.choice([".", "/", "  ", " - ", "_"])
        return plain + (lead if fore else ""), sep.join(d[i : i + 4] for i in range(0, 16, 4)), " " + word(), 1
    if what == "phone":
        s = rng.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}"]).format(num(3), num(3), num(4)) if rng.random() < 0.5 else f"0{rng.choice(['0', ''])}{num(3)}{rng.choice(' /-')}{num(3)}{rng.choice(' -')}{num(4)}"
        return plain + lead, s, rng.choice([" ", ". ", ", "]) + word(), 1
    s = rng.choice(
        [
            lambda: f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", lambda: f"{rng.randint(10, 28)}/{rng.randint(10, 12)}/{rng.randint(1900, 2030)}", lambda: f"{num(3)}-{num(2)}-{num(3)}-{num(4)}",
            lambda: " ".join(num(rng.randint(2, 4)) for _ in range(rng.randint(2, 5))), lambda: " ".join(str(rng.randint(1900, 2030)) for _ in range(4)), lambda: f"{num(2)}.{num(3)}.{num(3)}", lambda: f"{num(3)} {num(3)} {num(3)}",
            lambda: f"{rng.randint(10, 23)}:{rng.randint(10, 59)}:{rng.randint(10, 59)}", lambda: f"{num(4)}-{num(4)}-{num(4)}-{num(4)}", lambda: f"{num(3)}-{num(3)}-{num(4)}", lambda: f"{num(4)} {num(4)} {num(4)} {num(4)}", lambda: f"{rng.randint(1, 9)}:{rng.randint(10, 99)}",
        ]
    )()
    return plain + lead, s, rng.choice([" ", " %", ". ", " km "]) + word(), 0


class Model:
    def __init__(self, trees: boosting.Boosted, threshold: dict[str, float]):
        self.trees, self.threshold = trees, threshold


@cache
def train(examples: int = 6000, precision: float = 0.99, seed: int = 11) -> Model:
    """Trees on generated text; thresholds on its last third, the lowest whose precision there reaches `precision`."""
    rng, x, y, kind = random.Random(seed), [], [], []
    for _ in range(examples):
        before, span, after, good = _written(rng)
        text = before + span + after
        for c in candidates(text):
            exact = good and c[1] == len(before) and c[2] == len(before) + len(span)
            if exact or not good:
                x.append(features(text, c))
                y.append(int(exact))
                kind.append(c[0])
    x, y, kind = np.array(x), np.array(y), np.array(kind)
    cutoff = len(y) * 2 // 3
    trees = boosting.fit(x[:cutoff], y[:cutoff])
    p, threshold = trees.probability(x[cutoff:]), {}
    for k in KINDS:
        mine = kind[cutoff:] == k
        order = np.argsort(-p[mine], kind="stable")
        right = np.cumsum(y[cutoff:][mine][order]) / np.arange(1, mine.sum() + 1)
        enough = np.flatnonzero(right >= precision)
        threshold[k] = max(0.5, float(p[mine][order][enough[-1]])) if len(enough) else 1.1
    return Model(trees, threshold)


def all_spans(text: str, model: Model) -> tuple[list[Span], list[Span]]:
    """Base spans and added spans of one text, each by kind and then start."""
    if not ANY.search(text):
        return [], []
    base, added = base_spans(text), []
    clear = lambda s, taken: all(s[2] <= t[1] or t[2] <= s[1] for t in taken)
    near: dict[int, list[Span]] = {}
    for s in base:
        for cell in range(s[1] >> 7, (s[2] >> 7) + 1):
            near.setdefault(cell, []).append(s)
    around = lambda s: [t for cell in range(s[1] >> 7, (s[2] >> 7) + 1) for t in near.get(cell, ())]
    proposed = [s for s in candidates(text) if clear(s, around(s))]
    if proposed:
        p = model.trees.probability(np.array([features(text, s) for s in proposed]))
        for k in np.argsort(-p, kind="stable").tolist():
            s = proposed[k]
            if p[k] >= model.threshold[s[0]] and clear(s, around(s)):
                added.append(s)
                for cell in range(s[1] >> 7, (s[2] >> 7) + 1):
                    near.setdefault(cell, []).append(s)
    rank = lambda s: (KINDS.index(s[0]), s[1])
    return sorted(base, key=rank), sorted(added, key=rank)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """(id, spans) for every row of docs: an array of (kind, start, end, base), by kind and start, in code points, end exclusive.

    A null text is empty and has none. Repeated rows and null ids each keep their
    row. Other columns of docs are not read.
    """
    model = model or train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
        for b in batches:
            out = []
            for t in b.column(1):
                base, added = all_spans(t.as_py() or "", model)
                both = [(*s, True) for s in base] + [(*s, False) for s in added]
                both.sort(key=lambda s: (KINDS.index(s[0]), s[1], not s[3]))
                out.append([dict(zip(("kind", "start", "end", "base"), s)) for s in both])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, kind)], ["id", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, spans array<struct<kind:string,start:long,end:long,base:boolean>>")


def masked(text: str, spans: list[Span]) -> str:
    """The text with every stretch covered by spans replaced by [KIND] of the span that begins it."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2], KINDS.index(s[0]))):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text_col: str = "text", model: Model | None = None) -> DataFrame:
    """docs with the personal data in text_col masked; all rows and columns stay, a null text stays null."""
    model = model or train()
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t if t is None else masked(t, sum(all_spans(t, model), [])) for t in b.column(at).to_pylist()]
            yield b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))

    return docs.mapInArrow(run, StructType(docs.schema.fields))


def op5(spark, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    told = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select(
        F.col("id").alias("doc_id"), *(count(k) for k in KINDS),
        F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"),
    )


def digest(spans: list[Span]) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
