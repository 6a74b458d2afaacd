"""Main text of web pages by deducing each host's template from equivalence classes of tokens.

A page is a sequence of tokens: tags, told apart by their path of enclosing elements, and runs of
text. Tokens of a host that occur equally often on every page (the same occurrence vector) are an
equivalence class; a fingerprint of the vector is built by map-side aggregation, so no host has to
pass one task. A class is valid if its tags, in order, are well bracketed and lie in elements of
valid classes that occur on as many pages or more. The valid classes make up the template: the root
class, whose tags occur once on every page, and the classes nested in its slots, which stand for
parts that only some pages have. On a page the classes count that it holds completely and in order;
a page without its host's root class is deduced alone.

Text lies in the slots between a class's tags. The article is the element of those classes that is
named so or, going down from the body, the last one whose slots still hold nearly all of the text.
Extraction takes the slots inside it and leaves out constant text, elements that hold links on most
pages of the host, and elements that name another purpose.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.text import texts_of
from daytally.session import scratch_path

# How HTML names its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark picture q rp rt ruby s samp "
    "small source span strike strong sub sup time tt u var wbr".split()
)
LEAVES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Elements, and words in a class or id, that serve another purpose than the article.
OTHER_ELEMENTS = frozenset(
    "head script style noscript template nav footer aside form button input select textarea iframe object svg canvas "
    "menu dialog audio video map xmp noembed noframes title".split()
)
OTHER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside widget footer header masthead cookie cookies consent notice notices alert popup modal "
    "newsletter subscribe signup login share sharing social related recommended comment comments comentarios kommentare "
    "commentaires disqus respond replies reply form search pagination pager toolbar".split()
)

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.DOTALL,
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
PAGE = 0  # the token that every page has once


@dataclass(frozen=True)
class Deduction:
    """``share`` of a host's pages that a template token occurs on; constant text also needs
    ``constant_pages`` pages and the greater ``constant_share``. An element with ``link_share`` of its
    text in links, over as many pages, is a list of links."""

    share: float = 0.5
    constant_pages: int = 8
    constant_share: float = 0.9
    descend: float = 0.7
    link_share: float = 0.6


@dataclass
class Run:
    """Text between two block tags."""

    element: int  # the innermost one around it
    other: bool  # one around it serves another purpose
    parts: list[str] = field(default_factory=list)
    linked: int = 0  # characters inside links

    @property
    def raw(self) -> str:
        return "".join(self.parts)


@dataclass
class Page:
    """Tokens of a page in order. Elements are numbered as they open, 0 stands for the whole page, so
    what lies inside an element has the numbers up to its last one."""

    path: list[int] = field(default_factory=lambda: [PAGE])
    parent: list[int] = field(default_factory=lambda: [0])
    tag: list[str] = field(default_factory=lambda: [""])
    last: list[int] = field(default_factory=lambda: [0])
    tags: list[tuple[bool, int]] = field(default_factory=list)  # (opens, element)
    runs: list[Run] = field(default_factory=list)
    breaks: list[int] = field(default_factory=list)  # positions in runs before which a block ends

    def once(self) -> dict[int, int]:
        """Path to element, of the paths that occur once."""
        count = Counter(self.path[1:])
        return {p: n for n, p in enumerate(self.path) if n and count[p] == 1}

    def within(self, sizes: list[int]) -> list[int]:
        """Sums of ``sizes`` (one per element) over all that lies inside each element."""
        out = list(sizes)
        for n in range(len(out) - 1, 0, -1):
            out[self.parent[n]] += out[n]
        return out

    def chars(self) -> tuple[list[int], list[int]]:
        """Per element the characters that may belong to an article, and those of them in links."""
        size, linked = [0] * len(self.path), [0] * len(self.path)
        for run in self.runs:
            if not run.other:
                size[run.element] += len(run.raw.strip())
                linked[run.element] += run.linked
        return self.within(size), self.within(linked)


def _purpose(tag: str, attributes: str, article: bool) -> tuple[str, bool, bool]:
    """(class words for the path, serves another purpose, is the main part)."""
    words, other, main = "", tag in OTHER_ELEMENTS or (tag == "header" and not article), tag in ("article", "main")
    for name, value in _NAMES.findall(attributes) if attributes else ():
        value = value.strip("\"'").lower()
        if name.lower() == "role":
            main |= value in ("main", "article")
            other |= value in ("navigation", "banner", "complementary", "contentinfo", "search", "form")
            continue
        parts = value.split()
        if name.lower() == "class":
            words = "." + ".".join(re.sub(r"(?<=[-_])\d+", "", p) for p in sorted(parts))  # post-17: a page's own number
        for part in parts:
            pieces = re.split(r"[-_]+|\d+", part)
            if part in OTHER_WORDS or (pieces[0] in OTHER_WORDS or pieces[-1] in OTHER_WORDS) and pieces[0] not in ("has", "with", "no", "is", "not"):
                other = other or tag not in ("html", "body", "main", "article")
    return words, other, main


def read_page(source: str) -> Page:
    """Tokens of a page. Elements that HTML closes by implication are closed; inline ones are text.

    Paths are 64-bit hashes of the enclosing path and the own name, and open elements are looked up by
    name, so time and memory are linear in the page however deep it nests.
    """
    page = Page()
    stack = [0]
    flags = [(False, False)]  # per open element: (serves another purpose, is an article or inside one)
    opened: dict[str, list[int]] = {}  # depths of the open elements of a name
    links = 0

    def leave(depth: int) -> None:
        nonlocal links
        while len(stack) > depth:
            gone = stack.pop()
            flags.pop()
            opened[page.tag[gone]].pop()
            page.last[gone] = len(page.path) - 1
            page.tags.append((False, gone))
        page.breaks.append(len(page.runs))
        links = 0

    def text(raw: str) -> None:
        if not raw:
            return
        # Inline elements do not part a run of text.
        if not page.runs or (page.breaks and page.breaks[-1] == len(page.runs)):
            page.runs.append(Run(stack[-1], flags[-1][0]))
        run = page.runs[-1]
        run.parts.append(raw)
        if links:
            run.linked += len(raw.strip())

    def deepest(names: set[str]) -> int:
        return max((opened[n][-1] for n in names if opened.get(n)), default=0)

    at, end = 0, len(source)
    while at < end:
        found = _TOKEN.search(source, at)
        if not found:
            text(source[at:])
            break
        text(source[at : found.start()])
        at = found.end()
        closing, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            text(" ")
        elif tag in INLINE:
            if tag == "a":
                links = 0 if closing else 1
        elif closing:
            if opened.get(tag):
                leave(opened[tag][-1])
        else:
            if tag in LEAVES_P or tag in SIBLINGS:
                drop, bound = SIBLINGS.get(tag, ({"p"}, {"td", "th", "table", "button"}))
                while (depth := deepest(drop)) > deepest(bound - drop):
                    leave(depth)
                    if tag != "tr":
                        break
            page.breaks.append(len(page.runs))
            if tag in VOID:
                continue
            words, other, main = _purpose(tag, attributes, flags[-1][1])
            if tag in ("html", "body") and opened.get(tag):
                continue
            number = len(page.path)
            page.path.append(name_of(f"{page.path[stack[-1]]}/{tag}{words}"))
            page.parent.append(stack[-1])
            page.tag.append(tag)
            page.last.append(number)
            page.tags.append((True, number))
            opened.setdefault(tag, []).append(len(stack))
            stack.append(number)
            flags.append((flags[-1][0] or other, flags[-1][1] or main))
            if tag in RAW:
                close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(source, at)
                stop = close.start() if close else end
                if not flags[-1][0]:
                    text(source[at:stop])
                leave(len(stack) - 1)
                at = close.end() if close else end
            elif attributes and attributes.endswith("/") and ":" in tag:
                leave(len(stack) - 1)
    leave(1)
    page.last[0] = len(page.path) - 1
    return page


def clean(raw: str) -> str:
    """Text with character references decoded and white space turned into single blanks."""
    return " ".join(entities.unescape(raw).split())


def name_of(token: str) -> int:
    return xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass")) - (1 << 63) or 1


def close_of(path: int) -> int:
    """The token of an element's end."""
    return name_of(f">{path}")


def text_of(path: int, said: str) -> int:
    return name_of(f"#{path}#{said}")


def page_tokens(source: str) -> list[tuple]:
    """(token, path, above, kind, n, at, chars, linked) of each different token of a page.

    ``kind`` is < or > and the name of a tag, empty for the page's own token and null for text; ``at``
    is the first place; the characters are those of an element's slots.
    """
    page = read_page(source)
    chars, linked = page.chars()
    out: dict[int, list] = {PAGE: [PAGE, PAGE, PAGE, "", 1, -1, chars[0], linked[0]]}

    def add(token: int, path: int, above: int, kind: str | None, at: int, size: int, links: int) -> None:
        row = out.setdefault(token, [token, path, above, kind, 0, at, 0, 0])
        row[4] += 1
        row[6] += size
        row[7] += links

    for at, (opens, n) in enumerate(page.tags):
        path, above = page.path[n], page.path[page.parent[n]]
        if opens:
            add(path, path, above, "<" + page.tag[n], at, chars[n], linked[n])
        else:
            add(close_of(path), path, above, ">" + page.tag[n], at, 0, 0)
    for run in page.runs:
        if said := clean(run.raw):
            path = page.path[run.element]
            add(text_of(path, said), path, path, None, 0, 0, 0)
    return [tuple(row) for row in out.values()]


def choose_main(page: Page, chars: dict[int, float], descend: float) -> int:
    """The element that holds the article, of those that ``chars`` gives characters for; 0 for all.

    An article or main element wins, the one with the most text; otherwise the way down from the
    body goes on as long as one element inside holds nearly all of the text. Two that are not one
    inside the other cannot both do so, which is why one pass in order of opening is enough.
    """
    order = sorted(chars)
    for wanted in ("article", "main"):
        if named := [n for n in order if page.tag[n] == wanted]:
            return max(named, key=lambda n: (chars[n], -n))
    at = next((n for n in order if page.tag[n] == "body"), 0)
    whole = chars.get(at, max(chars.values(), default=0.0))
    for n in order:
        if whole and at < n <= page.last[at] and chars[n] >= descend * whole:
            at, whole = n, chars[n]
    return at


def valid_classes(classes: list[dict]) -> list[dict]:
    """The template: valid classes, the root first, as (root, order of tokens, paths, chars).

    Only tags that occur once where they occur are ordered; repeated ones are records inside a slot.
    In a class all tokens are on the same pages, so their mean places have the order that they share;
    whether a page keeps to it is checked there.
    """
    kept, paths = [], {PAGE}

    def support(c: dict) -> tuple:
        tokens = c["tokens"]
        return (all(t["token"] != PAGE for t in tokens), -tokens[0]["pages"], min(t["at"] for t in tokens), c["vector"])

    for c in sorted(classes, key=support):
        root = any(t["token"] == PAGE for t in c["tokens"])
        tags = sorted((t for t in c["tokens"] if t["kind"] and t["most"] == 1), key=lambda t: t["at"])
        both = {t["path"] for t in tags if t["kind"][0] == "<"} & {t["path"] for t in tags if t["kind"][0] == ">"}
        order, own, inside, bracketed = [], {}, [], True
        for t in tags:
            if t["path"] not in both:
                continue
            if t["kind"][0] == "<":
                if t["above"] not in paths and t["above"] not in own:
                    continue  # lies in no element of the template
                own[t["path"]] = t["chars"] / t["pages"]
                inside.append(t["path"])
                order.append(t["token"])
            elif t["path"] in own:
                bracketed &= bool(inside) and inside.pop() == t["path"]
                order.append(t["token"])
        if root or (own and bracketed and not inside):
            paths |= own.keys()
            kept.append({"root": root, "order": order, "paths": list(own), "chars": list(own.values())})
    return kept


def deduce(classes: list[dict], total: int, rules: Deduction) -> dict:
    """What extraction needs of a host: its valid classes, constant texts, and elements of links."""
    enough = total >= rules.constant_pages
    tokens = [t for c in classes for t in c["tokens"] if t["most"] == 1 and enough and t["pages"] >= rules.constant_share * total]
    constant = [t["token"] for t in tokens if t["kind"] is None]
    links = [t["path"] for t in tokens if t["kind"] and t["chars"] and t["linked"] >= rules.link_share * t["chars"]]
    return {"classes": valid_classes(classes), "constant": sorted(constant), "links": sorted(links)}


def classes_on(page: Page, once: dict[int, int], template: dict) -> dict[int, float] | None:
    """Characters of the elements of those classes that the page holds whole and in order.

    None where the root class is not among them.
    """
    place = {}
    for at, (opens, n) in enumerate(page.tags):
        if once.get(page.path[n]) == n:
            place[page.path[n] if opens else close_of(page.path[n])] = at
    chars: dict[int, float] = {}
    for c in template["classes"]:
        places = [place.get(token, -1) for token in c["order"]]
        if all(p >= 0 for p in places) and all(a < b for a, b in zip(places, places[1:])):
            chars |= {once[path]: size for path, size in zip(c["paths"], c["chars"], strict=True)}
        elif c["root"]:
            return None
    return chars


def extract(source: str, template: dict | None, rules: Deduction) -> str:
    """Main text of a page: the slots of the main element, block by block."""
    page = read_page(source)
    once = page.once()
    chars = classes_on(page, once, template) if template is not None else None
    constant: set[int] = set()
    left_out: list[int] = []
    if chars is None:
        sizes = page.chars()[0]
        chars = {n: sizes[n] for n in once.values()}
    else:
        constant = set(template["constant"])
        left_out = [once[path] for path in template["links"] if path in once]
    main = choose_main(page, chars, rules.descend)
    skipped = np.zeros(len(page.path), bool)
    for n in left_out:
        if not n <= main <= page.last[n]:
            skipped[n : page.last[n] + 1] = True
    blocks, parts = [], []
    breaks = set(page.breaks)
    for i, run in enumerate(page.runs):
        if i in breaks and parts:
            blocks.append(clean("".join(parts)))
            parts = []
        if run.other or not main <= run.element <= page.last[main] or skipped[run.element]:
            continue
        if constant and (said := clean(run.raw)) and text_of(page.path[run.element], said) in constant:
            continue
        parts.append(run.raw)
    if parts:
        blocks.append(clean("".join(parts)))
    return "\n".join(b for b in blocks if b)


TOKEN = pa.struct(
    [("token", pa.int64()), ("path", pa.int64()), ("above", pa.int64()), ("kind", pa.string()), ("n", pa.int32())]
    + [("at", pa.int32()), ("chars", pa.int64()), ("linked", pa.int64())]
)
TOKENS = "array<struct<token:long,path:long,above:long,kind:string,n:int,at:int,chars:long,linked:long>>"
CLASSES = pa.list_(
    pa.struct([("root", pa.bool_()), ("order", pa.list_(pa.int64())), ("paths", pa.list_(pa.int64())), ("chars", pa.list_(pa.float64()))])
)
TEMPLATE = pa.struct([("classes", CLASSES), ("constant", pa.list_(pa.int64())), ("links", pa.list_(pa.int64()))])
TEMPLATES = (
    "classes array<struct<root:boolean,order:array<long>,paths:array<long>,chars:array<double>>>, "
    "constant array<long>, links array<long>"
)


def tokens_column():
    def tokens(column: pa.Array) -> pa.Array:
        found = [page_tokens(t) for t in texts_of(column)]
        flat = [pa.array([row[i] for page in found for row in page], TOKEN[i].type) for i in range(TOKEN.num_fields)]
        ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
        return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(flat, names=[f.name for f in TOKEN]))

    return F.arrow_udf(tokens, TOKENS)


def host_templates(pages: DataFrame, rules: Deduction) -> DataFrame:
    """(host, template) of every host of (host, html).

    A template has tokens of most pages only, so its size is bounded by that of a few pages.
    """
    numbered = pages.select(F.monotonically_increasing_id().alias("_row"), "host", "html")
    each = numbered.select("_row", "host", F.explode(tokens_column()("html")).alias("t")).select("_row", "host", "t.*")
    counted = each.groupBy("host", "token").agg(
        F.count("*").alias("pages"),
        F.bit_xor(F.xxhash64("_row", "n")).alias("vector"),
        *[F.max(name).alias(name) for name in ("path", "above", "kind")],
        F.max("n").alias("most"),
        F.avg("at").alias("at"),
        F.sum("chars").alias("chars"),
        F.sum("linked").alias("linked"),
    )
    often = counted.where((F.col("pages") > 1) | (F.col("token") == PAGE) | F.col("kind").isNotNull())
    totals = pages.groupBy("host").agg(F.count("*").alias("total"))
    kept = often.join(totals, "host").where(F.col("pages") >= F.lit(rules.share) * F.col("total"))
    token = F.struct("token", "path", "above", "kind", "pages", "most", "at", "chars", "linked")
    classes = kept.groupBy("host", "total", "vector").agg(F.collect_list(token).alias("tokens"))
    hosts = classes.groupBy("host", "total").agg(F.collect_list(F.struct("vector", "tokens")).alias("classes"))

    def decide(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for classes_, totals_ in columns:
            made = [deduce(c, n, rules) for c, n in zip(classes_.to_pylist(), totals_.to_pylist(), strict=True)]
            yield pa.array(made, TEMPLATE)

    made = F.arrow_udf(decide, TEMPLATES)("classes", "total")
    return hosts.select("host", made.alias("template"))


def main_texts(pages: DataFrame, rules: Deduction = Deduction()) -> DataFrame:
    """page_id, url, text and n_chars of every row; null html has no text, pages without a url share
    one host. A page without tags is its own text."""
    spark = pages.sparkSession
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]+)", 1))
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))
    path = scratch_path(spark, "templates")
    host_templates(rows.select("host", "html"), rules).write.parquet(path)
    templates = spark.read.parquet(path)

    def texts(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for sources, found in columns:
            said = [extract(s, t, rules) for s, t in zip(sources.to_pylist(), found.to_pylist(), strict=True)]
            yield pa.array(said, pa.string())

    done = rows.join(templates, "host", "left").withColumn("text", F.arrow_udf(texts, "string")("html", "template"))
    return done.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
