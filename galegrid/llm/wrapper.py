"""Main text of web pages by wrappers inferred from the pages of a host.

A page becomes a stream of tokens: block elements (name and class), and text. Pages of one host
are aligned one after another into a wrapper, a regular expression without unions over such
tokens. Where a page and the wrapper disagree, the mismatch is resolved: what one of them lacks
becomes an optional group, what comes again a repeated group, and texts become slots that keep
how much text and how many links they hold and whether it is the same on every page.

Each task aligns the pages it reads and sends one wrapper for each host; wrappers are aligned
with each other in the same way, first in parts of a host and then for the host, so no task sees
all pages of a host. Then the slots of each wrapper are told apart (`main_slots`), the wrapper
goes back to the pages of its host, and each page is aligned with it once more to read its main
slots.
"""

from __future__ import annotations

import html as _html
import json
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import checked_join
from ..session import cut_lineage
from .common import fresh, lower_ascii

#: Wrappers that a task holds before it sends them on.
HELD = 2000
#: Parts of a host that are aligned apart before they meet.
PARTS = 32
#: How far back a repeated group may reach among the children of an element.
LOOK_BACK = 3
#: Pages of different articles from which a text that never changes counts as part of the template.
TEMPLATE_PAGES = 8
_SLICE = 200

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter "
    "q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base col embed hr input link meta param source track".split())
#: Elements without readable content of the page.
DROPPED = frozenset(
    "script style noscript template iframe svg math object canvas audio video map textarea select "
    "button title datalist".split()
)
#: Those of them that hold elements; one that is never closed holds nothing.
PASSED_OVER = frozenset("noscript template svg math object canvas audio video select button".split())
#: Elements around the article.
AROUND = frozenset("head nav aside footer form menu dialog fieldset".split())
#: Words in a class, id or role that mark what is no part of the article.
_MARKS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|adbox|banner\w*|sponsor\w*|promo\w*|nav|navbar|navigation|menu\w*|"
    r"breadcrumbs?|sidebar|sidenav|aside|footer|masthead|site-?header|page-?header|topbar|cookies?|consent|gdpr|notices?|"
    r"notification|alert|popup|modal|newsletter|subscri\w*|signup|login|share|sharing|social|related|"
    r"recommend\w*|comments?|commentlist|disqus|repl(?:y|ies)|responses?|widget|toolbar|pagination|pager|"
    r"contentinfo|complementary|search|paywall)(?:$|[\s_-])"
)
_CONTENT = re.compile(r"(?:^|[\s_-])(?:article|content|post|entry|story|main)(?:$|[\s_-])")
_CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "body": ("head",),
}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title|iframe|noembed|noframes|xmp)"
    r"\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?/][^>]*+>?"
    r"|([^<]++|<(?![a-zA-Z!?/]))",
    re.DOTALL | re.IGNORECASE,
)
_NAMED = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_DIGITS = re.compile(r"\d+")


class Node:
    """An element of a wrapper, with what the text directly in it was like."""

    __slots__ = ("sym", "parent", "children", "optional", "repeated", "pages", "chars", "links", "code", "same", "seen", "index")

    def __init__(self, sym: str, parent: Node | None):
        self.sym, self.parent, self.children = sym, parent, []
        self.optional = self.repeated = False
        self.pages, self.chars, self.links, self.code, self.same = 1, 0, 0, 0, True
        #: Hashes of the articles of the pages that have the node, the least TEMPLATE_PAGES; for texts that never change.
        self.seen: tuple[int, ...] = ()
        self.index = -1


def _symbol(name: str, attributes: str) -> str:
    """The name of an element with its class, id and role; numbers in them do not count."""
    if not attributes or "=" not in attributes:
        return name
    found = " ".join(m[2] or m[3] or m[4] or "" for m in _NAMED.finditer(attributes))
    return f"{name} {_DIGITS.sub('0', found.lower()).strip()}".rstrip()


def parse(page: str | None) -> tuple[Node, list[tuple[Node, str | None]]]:
    """The page's own wrapper, and its texts with their elements; None marks a block's border.

    Repeated siblings, alone or in a group, are one node already. Elements that are left open
    are closed where their parent ends; closing tags without an element are passed over. Only
    elements of raw text (script and the like) reach to the end of the page when left open.
    """
    root = here = Node("", None)
    texts: list[tuple[Node, str | None]] = []
    linked, go_on = False, 0
    closings: dict[str, list[tuple[int, int]]] = {}
    for m in _TOKEN.finditer(page or ""):
        if m.start() < go_on:
            continue
        text = m[5]
        if text is not None:
            texts.append((here, text))
            if not text.isspace():
                here.chars += len(text)
                here.links += len(text) if linked else 0
                here.code = zlib.crc32(text.strip().encode("utf-8", "replace"), here.code)
            continue
        name = m[3]
        if name is None:
            continue
        name = name.lower()
        if name in PASSED_OVER:
            if not m[2] and not m[4].endswith("/"):
                if name not in closings:
                    closings[name] = [c.span() for c in re.finditer(rf"</{name}\s*>", page, re.IGNORECASE)]
                at = bisect_left(closings[name], (m.end(), 0))
                if at < len(closings[name]):
                    go_on = closings[name][at][1]
            continue
        if name == "br":
            texts.append((here, " "))
            continue
        if name in INLINE:
            if name == "a":
                linked = not m[2]
            continue
        texts.append((here, None))
        linked = False
        if m[2]:
            up = here
            while up is not root and up.sym.partition(" ")[0] != name:
                up = up.parent
            if up is not root:
                here = up.parent
            continue
        if name in VOID:
            continue
        closes = _CLOSES.get(name)
        if closes:
            if name != "body" and here.sym.partition(" ")[0] == "p":
                here = here.parent
            while here is not root and here.sym.partition(" ")[0] in closes:
                here = here.parent
        elif here.sym == "p" or here.sym.startswith("p "):
            here = here.parent
        sym = _symbol(name, m[4])
        back = len(here.children)
        for k in range(back - 1, max(-1, back - 1 - LOOK_BACK), -1):
            if here.children[k].sym == sym:
                for child in here.children[k:]:
                    child.repeated = True
                here = here.children[k]
                break
        else:
            child = Node(sym, here)
            here.children.append(child)
            here = child
    return root, texts


def align(wrapper: Node, page: Node, learn: bool) -> list[tuple[Node, Node]]:
    """Pairs of wrapper nodes and page nodes that lie upon each other.

    With `learn` the wrapper takes up the page: mismatches become optional or repeated groups,
    slots gather what their texts were like. Without it nodes that the wrapper lacks are left out.
    """
    pairs, todo = [], [(wrapper, page)]
    while todo:
        w, p = todo.pop()
        pairs.append((w, p))
        if learn:
            w.pages += p.pages
            w.chars += p.chars
            w.links += p.links
            w.same = w.same and p.same and w.code == p.code
            if not w.same:
                w.seen = ()
            elif w.seen != p.seen:
                w.seen = tuple(sorted({*w.seen, *p.seen})[:TEMPLATE_PAGES])
            w.optional = w.optional or p.optional
            w.repeated = w.repeated or p.repeated
        at, children = 0, w.children
        for child in p.children:
            sym = child.sym
            k = next((i for i in range(at, len(children)) if children[i].sym == sym), -1)
            if k >= 0:
                if learn:
                    for skipped in children[at:k]:
                        skipped.optional = True
                todo.append((children[k], child))
                at = k + 1
                continue
            k = next((i for i in range(at - 1, -1, -1) if children[i].sym == sym), -1)
            if k >= 0:  # it comes again after others: a repeated group
                if learn:
                    for again in children[k:at]:
                        again.repeated = True
                todo.append((children[k], child))
                at = max(at, k + 1)
            elif learn:
                child.parent, child.optional = w, True
                children.insert(at, child)
                at += 1
        if learn:
            for skipped in children[at:]:
                skipped.optional = True
    return pairs


def flat(root: Node) -> str:
    """A wrapper as text: a row for each node, parents first."""
    rows, todo = [], [(root, -1)]
    while todo:
        n, parent = todo.pop()
        n.index = len(rows)
        rows.append([n.sym, parent, int(n.optional), int(n.repeated), n.pages, n.chars, n.links, n.code, int(n.same), n.seen])
        todo += [(c, n.index) for c in reversed(n.children)]
    return json.dumps(rows, separators=(",", ":"))


def unflat(text: str) -> Node:
    nodes: list[Node] = []
    for sym, parent, optional, repeated, pages, chars, links, code, same, seen in json.loads(text):
        n = Node(sym, nodes[parent] if parent >= 0 else None)
        n.optional, n.repeated, n.pages, n.chars, n.links = bool(optional), bool(repeated), pages, chars, links
        n.code, n.same, n.seen, n.index = code, bool(same), tuple(seen), len(nodes)
        if n.parent is not None:
            n.parent.children.append(n)
        nodes.append(n)
    return nodes[0]


def expression(root: Node) -> str:
    """The wrapper as a regular expression: `( )?` optional, `( )+` repeated, `#` a text slot."""
    out: list[str] = []
    todo: list[Node | str] = [root]
    while todo:
        n = todo.pop()
        if isinstance(n, str):
            out.append(n)
            continue
        mark = ("*" if n.optional else "+") if n.repeated else "?" if n.optional else ""
        name = n.sym.partition(" ")[0]
        out.append(("(" if mark else "") + (f"<{n.sym}>" if name else "") + ("#" if n.chars else ""))
        todo.append((f"</{name}>" if name else "") + (f"){mark}" if mark else ""))
        todo += reversed(n.children)
    return "".join(out)


def _nodes(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append(n)
        todo += reversed(n.children)
    return out


def _boilerplate(n: Node, inside_article: bool) -> bool:
    name, _, marks = n.sym.partition(" ")
    if name in AROUND or name in DROPPED:
        return True
    if name == "header" and not inside_article:
        return True
    return bool(marks) and name not in ("html", "body") and bool(_MARKS.search(marks))


def _alternatives(root: Node) -> tuple[list[list[Node]], set[int], dict[int, int]]:
    """What may be the article, best first; the nodes outside of boilerplate; and their unlinked text.

    The article is what stands in `article` elements, else in `main`, else in an element whose
    class or id says so, else where most text without links is.
    """
    clean: list[Node] = []
    todo = [(root, False)]
    while todo:
        n, inside = todo.pop()
        if _boilerplate(n, inside):
            continue
        clean.append(n)
        here = inside or n.sym.partition(" ")[0] in ("article", "main")
        todo += [(c, here) for c in reversed(n.children)]
    kept = {id(n) for n in clean}
    weight: dict[int, int] = {}
    for n in reversed(clean):
        weight[id(n)] = max(0, n.chars - n.links) + sum(weight.get(id(c), 0) for c in n.children)

    def named(test) -> list[Node]:
        return [n for n in clean if weight[id(n)] and test(*n.sym.partition(" ")[::2])]

    found = [
        named(lambda name, marks: name == "article"),
        named(lambda name, marks: name == "main" or marks.startswith("main")),
        named(lambda name, marks: name in ("div", "section", "td") and bool(_CONTENT.search(marks))),
        [_heaviest(root, weight)],
    ]
    return found, kept, weight


def _heaviest(root: Node, weight: dict[int, int]) -> Node:
    """The innermost element that holds most of the unlinked text."""
    top = root
    while True:
        heavy = [c for c in top.children if weight.get(id(c), 0) >= 0.8 * weight.get(id(top), 0) > 0]
        if not heavy or heavy[0].sym.partition(" ")[0] in ("p", "li", "pre"):
            return top
        top = heavy[0]


def main_slots(root: Node) -> list[list[int]]:
    """Per alternative the indexes, in the order of `flat`, of the nodes whose text is part of it.

    The alternatives are those of `_alternatives`, and last all that is no boilerplate; a page is
    read by the first in which it has text. Menus, notices and the like, told by element and
    class, are no part of any, nor are texts outside paragraphs and headings that
    are the same on pages of many different articles.
    """
    found, kept, _ = _alternatives(root)
    out = []
    for tops in [*found, [root]]:
        # Elements nested in a dropped one are dropped with it, as they are not in `kept`.
        slots = {id(n): n for t in tops for n in _nodes(t) if id(n) in kept}.values()
        changing = any(not n.same for n in slots)
        out.append(sorted(n.index for n in slots if not (changing and _template(n))))
    return out


def _template(n: Node) -> bool:
    name = n.sym.partition(" ")[0]
    reading = name in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "pre", "blockquote", "article", "main", "body", "")
    return not reading and n.same and len(n.seen) >= TEMPLATE_PAGES and n.chars > 0


def _learned(page: str | None) -> Node:
    """The page's own wrapper, with a hash of its article at each node that has text.

    Copies of a page have one hash, so that what stands in all of them is not taken for a template.
    """
    root = parse(page)[0]
    found, kept, _ = _alternatives(root)
    tops = next(t for t in found if t)
    codes = {id(n): n.code for t in tops for n in _nodes(t) if id(n) in kept}
    seen = (zlib.crc32(repr(list(codes.values())).encode()),)
    for n in _nodes(root):
        if n.chars:
            n.seen = seen
    return root


def extract(page: str | None, wrapper: Node, slots: tuple[frozenset[int], ...]) -> str:
    """The page's main text: blocks in order, joined by a space, white space as one space.

    It is read from the first alternative in which this page has text.
    """
    root, texts = parse(page)
    pairs = align(wrapper, root, learn=False)
    for chosen in slots:
        keep = {id(p): p for w, p in pairs if w.index in chosen}
        if any(p.chars for p in keep.values()):
            break
    else:
        chosen = slots[-1]
    if chosen is slots[-1]:  # nothing that its host has in common: where most text of the page itself is
        weight: dict[int, int] = {}
        for n in reversed(_nodes(root)):
            own = max(0, n.chars - n.links) if id(n) in keep else 0
            weight[id(n)] = own + sum(weight[id(c)] for c in n.children)
        inside = {id(n) for n in _nodes(_heaviest(root, weight))}
        keep = {k: p for k, p in keep.items() if k in inside}
    parts = [" " if text is None else text for node, text in texts if text is None or id(node) in keep]
    return " ".join(_html.unescape("".join(parts)).split())


def _host(url: str) -> Column:
    """After `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without."""
    return lower_ascii(F.regexp_extract(F.coalesce(F.col(f"`{url}`"), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def _combined(rows: pd.Series) -> str:
    """One wrapper out of several, aligned in a fixed order."""
    texts = sorted(rows)
    first = unflat(texts[0])
    for text in texts[1:]:
        align(first, unflat(text), learn=True)
    return flat(first)


def wrappers(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, wrapper): one wrapper for each host, as `flat` writes it."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Node] = {}

        def sent() -> pa.RecordBatch:
            made = [[*held], [flat(n) for n in held.values()]]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in made], names=["host", "wrapper"])

        for batch in batches:
            for start in range(0, batch.num_rows, _SLICE):
                hosts, texts = (c.to_pylist() for c in batch.slice(start, _SLICE).columns)
                for host, text in zip(hosts, texts):
                    page = _learned(text)
                    if host in held:
                        align(held[host], page, learn=True)
                    else:
                        held[host] = page
                if len(held) >= HELD:
                    yield sent()
        if held:
            yield sent()

    def combine(by: list[str]):
        def run(group: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"host": [group["host"].iloc[0]], "wrapper": [_combined(group["wrapper"])]})

        return lambda df: df.groupBy(*by).applyInPandas(run, "host string, wrapper string")

    made = pages.select(_host(url).alias("host"), F.col(f"`{html}`")).mapInArrow(learn, "host string, wrapper string")
    parts = combine(["host", "part"])(made.withColumn("part", F.pmod(F.xxhash64("wrapper"), F.lit(PARTS))))
    return combine(["host"])(parts)


def _roles(made: DataFrame) -> DataFrame:
    """`made` with `slots`, the main slots of each wrapper by alternative."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, texts = (c.to_pylist() for c in batch.columns)
            slots = [main_slots(unflat(t)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(texts, pa.string()), pa.array(slots, pa.list_(pa.list_(pa.int32())))],
                names=["host", "wrapper", "slots"],
            )

    return made.mapInArrow(run, "host string, wrapper string, slots array<array<int>>")


def main_text(
    pages: DataFrame, url: str = "url", html: str = "html", out: str = "text"
) -> DataFrame:
    """`pages` with the main text of each page in `out`; a column of that name is replaced.

    A null or empty page has an empty text. Pages whose URL is null or has no `://` are a host of
    their own. Character references are decoded; nothing is cut off.
    """
    known = cut_lineage(_roles(cut_lineage(wrappers(pages, url, html))))

    @F.pandas_udf("string")
    def read(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        ready: dict[str, tuple[Node, tuple[frozenset[int], ...]]] = {}
        for texts, made, slots in batches:
            found = []
            for text, wrapper, s in zip(texts, made, slots):
                if wrapper not in ready:
                    if len(ready) > HELD:
                        ready.clear()
                    ready[wrapper] = (unflat(wrapper), tuple(frozenset(map(int, x)) for x in s))
                found.append(extract(text, *ready[wrapper]))
            yield pd.Series(found, dtype="object")

    host, wrapper, slots = fresh(pages, "_host", "_wrapper", "_slots")
    named = known.select(F.col("host").alias(host), F.col("wrapper").alias(wrapper), F.col("slots").alias(slots))
    joined = checked_join(pages.withColumn(host, _host(url)), named, [host], [html, url], "left")
    return joined.withColumn(out, read(F.col(f"`{html}`"), wrapper, slots)).drop(host, wrapper, slots)
