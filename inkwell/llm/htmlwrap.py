"""Main text of web pages through wrappers: union-free regular expressions inferred for each host.

A page is read as a stream of block tags and text slots. Equal neighbours in it
become a repeated group, so a page is an expression like
    body(nav(ul(li(#)+))article(h1(#)p(#)+)footer(#)).
The expressions of a host are aligned one after another: where the streams agree
they are merged, what one of them lacks becomes optional, what any repeats
becomes repeated, and differing text is a slot. The result is the host's wrapper.
Its slots are then judged as wholes, on what all pages of the host have in them:
slots of an article or main region hold the text, or else the containers with
most varying, unlinked text do. A host may mix templates, so each page takes the
best region that holds its own text. Menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments are known
by their tags, roles, classes and ids.

Text that stays the same on all pages of a host, in a region where other text
varies, is part of the wrapper and of no article.

A host reaches one task only as expressions and its slots' sums, which are added
up before the shuffle; pages themselves are not gathered. Of many distinct
expressions, about FAN at a time are aligned to partial wrappers, and these again.
What one task must hold is the wrapper itself: the distinct paths of a host.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import cut, small, table
from inkwell.llm.urlrules import host

#: Fixed lists: elements by their part in HTML.
BLOCKS = frozenset("html body address article aside blockquote canvas center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption head title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg textarea select button title audio video map noembed noframes".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"thead", "tbody", "tfoot", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"}, "body": {"head"},
}
SCOPES = frozenset("ul ol dl table".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form dialog menu fieldset head title".split())
AROUND = frozenset("form fieldset dialog".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words in class names and ids. Strong ones mark boilerplate wherever they stand, weak ones only as the thing named:
#: the last word that isn't of the third list. Words of the fourth turn the name around, those of the fifth make a header the article's own.
STRONG = re.compile(r"ads?|adv|advert\w*|adsense|sponsor\w*|promo\w*|sidebar|navbar|navigation|breadcrumbs?|masthead|cookies?|consent|gdpr|popup|modal|newsletter|subscribe|subscription|signup|comments?|commentlist|disqus|pagination")
WEAK = re.compile(r"banner|side|nav|menu\w*|header|topbar|footer|foot|bottombar|notices?|notification|alert|overlay|login|share|sharing|social|related|recommend\w*|respond|reply|replies|widgets?|toolbar|pager|skip|hidden")
GENERIC = frozenset("area author bar block body bottom box button buttons center container content count form group holder icon icons inner item items label left link links list media meta n next outer panel post posts previous primary right secondary section slot text title top unit wrap wrapper".split())
NEGATES = frozenset("has have no non not with without".split())
OWN_HEADER = frozenset("article content entry post story".split())
#: Pages from which on an unchanging text is taken for the wrapper's; expressions aligned in one task; levels of nesting that an expression has.
FIXED, FAN, DEEPEST = 5, 256, 128
REGION_WORDS = re.compile(r"content|article|articlebody|post|entry|story|main|body|text")
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|</?[A-Za-z][^<>]*>?|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)


def label(tag: str, attributes: str) -> str:
    """An element as it stands in expressions: tag, then its class and id words and its role, numbers as N."""
    if not attributes.strip():
        return tag
    words = []
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        mark = {"class": ".", "id": ".", "role": "@", "itemprop": "@", "hidden": ".hidden"}[name]
        words += [mark + x for x in re.findall(r"\w[\w-]*", re.sub("[0-9]+", "N", value))] if name != "hidden" else [mark]
    return tag + "".join(dict.fromkeys(words))


def blocks(html: str) -> tuple[str, list[tuple[str, str, int]]]:
    """The page's expression, and its blocks in page order: (path of labels, text, characters inside links)."""
    stack: list[tuple[str, str, list[str]]] = [("", "", [])]  # tag, label, what it holds so far
    found: list[tuple[str, str, int]] = []
    text: list[str] = []
    links, inside, deeper = 0, 0, 0

    def flush() -> None:
        nonlocal links
        if text:
            words = " ".join("".join(text).split())
            text.clear()
            if words:
                found.append((">".join(x[1] for x in stack[1:]), words, min(links, len(words))))
                add(stack[-1][2], "#")
        links = 0

    def add(held: list[str], part: str) -> None:
        """Equal neighbours, alone or in twos and threes, become one repeated group."""
        held.append(part)
        for n in (1, 2, 3):
            if len(held) >= 2 * n and [x.rstrip("+") for x in held[-n:]] == [x.rstrip("+") for x in held[-2 * n : -n]]:
                kept = held[-2 * n : -n]
                del held[-2 * n :]
                held += [x if x.endswith("+") or x == "#" else x + "+" for x in kept]
                return

    def close(upto: int) -> None:
        flush()
        while len(stack) > upto:
            _, name, held = stack.pop()
            add(stack[-1][2], f"{name}({' '.join(held)})" if held else name)

    at, end = 0, len(html)
    while at < end:
        m = TOKEN.match(html, at)
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            if html[m.start()] != "<" or m[0] == "<":
                piece = unescape(m[0]) if "&" in m[0] else m[0]
                text.append(piece)
                links += len(piece) if inside else 0
            continue
        if m[1]:
            if tag == "a":
                inside = max(0, inside - 1)
            if tag in BLOCKS and deeper:
                flush()
                deeper -= 1
            elif tag in BLOCKS:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        close(k)
                        break
                else:
                    flush()
            continue
        if tag in RAW:
            if not m[3].rstrip().endswith("/"):
                shut = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(html, at)
                at = shut.end() if shut else (end if tag in ("script", "style") else at)
            text.append(" ")
        elif tag == "a":
            inside += 1
        elif tag == "br":
            text.append(" ")
        elif tag in BLOCKS:
            flush()
            if len(stack) > DEEPEST:  # deeper blocks are blocks of the last level
                deeper += tag not in VOID and tag not in CLOSES and tag != "p"
                continue
            if stack[-1][0] == "p":  # a block ends an open paragraph
                close(len(stack) - 1)
            ends = CLOSES.get(tag, ())
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in ends:
                    close(k)
                    if tag not in ("tr", "tbody", "tfoot"):
                        break
                elif stack[k][0] in SCOPES or tag not in CLOSES:
                    break
            if tag not in VOID:
                stack.append((tag, label(tag, m[3]), []))
    close(1)
    return " ".join(stack[0][2]), found


# An expression as a tree: [label, mark, children]; the mark is "", "?", "+" or "*". "#" is a text slot.
def parse(expression: str) -> list:
    root: list = ["", "", []]
    stack = [root]
    for name, sign in re.findall(r"([^\s()?+*]+)|([()?+*])", expression):
        if name:
            stack[-1][2].append([name, "", []])
        elif sign == "(":
            stack.append(stack[-1][2][-1])
        elif sign == ")":
            stack.pop()
        else:
            stack[-1][2][-1][1] = sign
    return root[2]


def written(nodes: list) -> str:
    return " ".join(n + (f"({written(c)})" if c else "") + m for n, m, c in nodes)


def _mark(a: str, b: str) -> str:
    repeated, optional = "+" in a + b or "*" in a + b, bool(set(a + b) & set("?*"))
    return ("*" if optional else "+") if repeated else ("?" if optional else "")


def align(a: list, b: list) -> list:
    """Two lists of siblings merged: common ones by the longest common subsequence of labels, the others made optional."""
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i][0] == b[j][0]:
            out.append([a[i][0], _mark(a[i][1], b[j][1]), align(a[i][2], b[j][2])])
            i, j = i + 1, j + 1
        elif j >= m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            out.append([a[i][0], _mark(a[i][1], "?"), a[i][2]])
            i += 1
        else:
            out.append([b[j][0], _mark(b[j][1], "?"), b[j][2]])
            j += 1
    return folded(out)


def folded(nodes: list) -> list:
    """Neighbours with one label become one repeated group: the resolution of a mismatch by an iterator."""
    out: list = []
    for x in nodes:
        if out and out[-1][0] == x[0] and x[0] != "#":
            out[-1] = [x[0], "*" if set(out[-1][1] + x[1]) & set("?*") else "+", align(out[-1][2], x[2])]
        elif not (out and out[-1][0] == x[0]):
            out.append(x)
    return out


def infer(expressions: list[str]) -> str:
    """The wrapper of a host from its pages' distinct expressions, in sorted order, so reruns agree."""
    wrapper: list | None = None
    for e in sorted(expressions, key=lambda e: (len(e), e)):
        wrapper = folded(parse(e)) if wrapper is None else align(wrapper, folded(parse(e)))
    return written(wrapper or [])


def slots(nodes: list, path: tuple[str, ...] = ()) -> list[str]:
    """The paths of a wrapper's text slots."""
    return [">".join(path)] * any(n == "#" for n, _, _ in nodes) + [p for n, _, c in nodes if n != "#" for p in slots(c, (*path, n))]


def boilerplate(name: str) -> bool:
    """Whether a class name or id marks boilerplate."""
    words = re.split(r"[-_]+", name.lower())
    if NEGATES.intersection(words):
        return False
    if any(map(STRONG.fullmatch, words)):
        return True
    named = next((w for w in reversed(words) if w not in GENERIC), "")
    return bool(WEAK.fullmatch(named)) and not (named == "header" and OWN_HEADER.intersection(words))


def unwanted(path: str) -> bool:
    """Whether a label of the path marks boilerplate. A form or dialog around an article or main region is none."""
    inner, names = False, path.split(">") if path else []
    regions = [k for k, x in enumerate(names) if re.match(r"(article|main)\b", x)]
    for k, x in enumerate(names):
        tag, *marks = re.split(r"(?=[.@])", x)
        around = bool(regions) and k < regions[-1]
        if tag in BOILERPLATE_TAGS - (AROUND if around else frozenset()) or (tag == "header" and not inner):
            return True
        inner |= tag in ("article", "main")
        if tag in ("html", "body", "main"):
            continue
        for mark in marks:
            if mark[0] == "@" and mark[1:] in BOILERPLATE_ROLES - (AROUND if around else frozenset()):
                return True
            if mark[0] == "." and mark[1:] and boilerplate(mark[1:]):
                return True
    return False


def content(wrapper: str, sums: dict[str, tuple[int, int, int, bool]]) -> list[list[str]]:
    """The regions of a wrapper that can hold main text, best first, as slots: article, main, then containers until none with text is left.

    sums: path to (pages, characters, of them linked, the same text on all pages).
    """
    wanted = [p for p in dict.fromkeys(slots(parse(wrapper))) if not unwanted(p)]

    def under(test) -> list[str]:
        return [p for p in wanted if any(test(x) for x in p.split(">"))]

    tests = (lambda x: re.match(r"article\b|[a-z0-9]+.*@articlebody\b", x), lambda x: re.match(r"main\b|[a-z0-9]+.*@main\b", x))
    regions = [_varying(r, sums) for r in map(under, tests) if r]
    taken = {p for r in map(under, tests) for p in r}
    rest = [p for p in wanted if p not in taken]
    while rest:
        region = _container(rest, sums)
        if not region:
            return regions or [rest]
        regions.append(_varying(region, sums))
        rest = [p for p in rest if p not in set(region)]
    return regions


def _varying(region: list[str], sums: dict[str, tuple[int, int, int, bool]]) -> list[str]:
    """A region without the slots that are filled alike on all pages that have their container, if the text in its other slots is the more."""
    held: dict[str, int] = {}
    for p in region:
        names = p.split(">")
        for k in range(len(names)):
            key = ">".join(names[:k])
            held[key] = max(held.get(key, 0), sums.get(p, (0,))[0])
    alike = {p for p in region if p in sums and sums[p][3] and sums[p][0] == held[p.rpartition(">")[0]] >= FIXED}
    chars = lambda ps: sum(sums.get(p, (0, 0, 0, False))[1] for p in ps)
    varying = [p for p in region if p not in alike]
    return varying if chars(varying) > chars(alike) else region


def _container(wanted: list[str], sums: dict[str, tuple[int, int, int, bool]]) -> list[str]:
    """The slots of the deepest container with nearly all varying, unlinked text; none without such text."""
    mass: dict[str, float] = {}
    for p in wanted:
        pages, chars, linked, same = sums.get(p, (0, 0, 0, False))
        weight = 0.0 if same and pages >= 5 else max(0.0, chars - 2.0 * linked)
        names = p.split(">") if p else [""]
        for k in range(1, len(names) + 1):
            named = any(REGION_WORDS.fullmatch(w) for w in re.split(r"[^a-z]+", names[k - 1])[1:])
            key = ">".join(names[:k])
            mass[key] = mass.get(key, 0.0) + weight * (1.2 if named else 1.0)
    if not mass or not max(mass.values()):
        return []
    most = max(mass.values())
    region = max((k for k in mass if mass[k] >= 0.8 * most), key=lambda k: (k.count(">"), mass[k], k))
    if re.match(r"p|h[1-6]|li|td|dd|blockquote|pre", region.rpartition(">")[2]) and ">" in region:
        region = region.rpartition(">")[0]
    return [p for p in wanted if p == region or p.startswith(f"{region}>")]


def chosen(found: list[tuple[str, str, int]], regions: list[set[str]]) -> set[str]:
    """A page's region: the first with half as much unlinked text on this page as any other has, or else the first with text at all."""
    held = [[(len(text), linked) for path, text, linked in found if path in r] for r in regions]
    mass = [sum(max(0, n - 2 * linked) for n, linked in h) for h in held]
    most = max(mass, default=0)
    return next((r for r, h, m in zip(regions, held, mass) if h and 2 * m >= most), set())


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each expression of a host, and for each of its slots, in a batch of pages."""
    for b in batches:
        sums: dict[tuple[str, bool, str], list] = {}
        for h, page in zip(b.column(0).to_pylist(), b.column(1)):
            expression, found = blocks(page.as_py() or "")
            sums.setdefault((h, False, expression), [0, 0, 0, 0, 0])[0] += 1
            own: dict[str, list] = {}
            for path, text, linked in found:
                x = own.setdefault(path, [0, 0, xxhash.xxh64()])
                x[0], x[1] = x[0] + len(text), x[1] + linked
                x[2].update(text)
            for path, (chars, linked, digest) in own.items():
                mark = digest.intdigest() >> 1
                x = sums.setdefault((h, True, path), [0, 0, 0, mark, mark])
                x[:] = [x[0] + 1, x[1] + chars, x[2] + linked, min(x[3], mark), max(x[4], mark)]
        keys, values = list(zip(*sums)) or [(), (), ()], list(zip(*sums.values())) or [()] * 5
        kinds = [pa.string(), pa.bool_(), pa.string(), *[pa.int64()] * 5]
        yield pa.RecordBatch.from_arrays([pa.array(list(v), k) for v, k in zip([*keys, *values], kinds)], ["host", "slot", "what", "pages", "chars", "linked", "low", "high"])


def _partial(rows: pa.Table) -> pa.Table:
    return pa.table([rows["host"][:1], pa.array([infer(rows["what"].to_pylist())])], ["host", "what"])


def _inferred(rows: pa.Table) -> pa.Table:
    r = rows.to_pylist()
    wrapper = infer([x["what"] for x in r if not x["slot"]])
    sums = {x["what"]: (x["pages"], x["chars"], x["linked"], x["low"] == x["high"]) for x in r if x["slot"]}
    return pa.table([pa.array([r[0]["host"]]), pa.array([wrapper]), pa.array([content(wrapper, sums)], pa.list_(pa.list_(pa.string())))], ["host", "wrapper", "regions"])


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html", fan: int = FAN) -> DataFrame:
    """(host, wrapper, regions) for every host: its expression, and the paths of its main text by region, best first. Pages without a host are one host, ''."""
    read = pages.select(host(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    seen = read.mapInArrow(_gathered, "host string, slot boolean, what string, pages long, chars long, linked long, low long, high long")
    seen = cut(seen.groupBy("host", "slot", "what").agg(F.sum("pages").alias("pages"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"), F.min("low").alias("low"), F.max("high").alias("high")))
    held = seen.where("NOT slot").select("host", "what")
    while True:  # by levels: a task aligns about fan expressions, whatever a host has
        counts = held.groupBy("host").agg(F.count("*").alias("n")).where(F.col("n") > fan)
        many = cut(counts.select(F.col("host").alias("of"), F.ceil(F.col("n") / fan).alias("parts")))
        if not many.limit(1).count():
            break
        dealt = held.join(small(many, 256), F.col("host") == F.col("of"), "left").withColumn("part", F.pmod(F.xxhash64("what"), F.coalesce("parts", F.lit(1))))
        merged = dealt.where("parts IS NOT NULL").select("host", "what", "part").groupBy("host", "part").applyInArrow(_partial, "host string, what string")
        held = cut(merged.unionByName(dealt.where("parts IS NULL").select("host", "what")).distinct())
    none = [F.lit(None).cast("long").alias(c) for c in ("pages", "chars", "linked", "low", "high")]
    both = held.select("host", F.lit(False).alias("slot"), "what", *none).unionByName(seen.where("slot"))
    return both.groupBy("host").applyInArrow(_inferred, "host string, wrapper string, regions array<array<string>>")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", found: DataFrame | None = None) -> DataFrame:
    """(id, url, text) for every page: its blocks in the best of its host's regions for this page, joined by newlines.

    Character references are decoded, white space inside a block is one space. A
    null or empty page has an empty text, and so has one with text in no region.
    Repeated rows give repeated rows. Other columns are not read. found: wrappers
    inferred before; every host of pages must be among them. Blocks nested deeper
    than DEEPEST levels count as blocks of that level, none of their text is lost.
    """
    found = cut(found if found is not None else wrappers(pages, url_col, html_col)).select(F.col("host").alias("__host"), "regions")
    read = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host(F.col(url_col)).alias("__h"))
    # The hosts are broadcast only if their paths, measured, take less than 64 MB.
    size = found.agg(F.sum(F.aggregate(F.flatten("regions"), F.lit(0).cast("long"), lambda n, p: n + F.length(p) + 64) + 256)).first()[0] or 0
    joined = read.join(F.broadcast(found) if size < 64 << 20 else found, F.col("__h") == F.col("__host"), "left").select("id", "url", "html", "regions")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for page, where in zip(b.column(2), b.column(3).to_pylist()):
                found = blocks(page.as_py() or "")[1]
                keep = chosen(found, [set(r) for r in where or ()])
                out.append("\n".join(t for path, t, _ in found if path in keep))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], ["id", "url", "text"])

    kind = pages.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(run, f"id {kind}, url string, text string")


def op10(spark, sf_dir: str) -> DataFrame:
    found = extract(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))
