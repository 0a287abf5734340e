"""Main text of web pages by wrapper inference.

Pages of a host come from the same templates. Their token streams are aligned one after the other into a
union-free regular expression: equal parts stay, texts that differ become slots, parts that only some pages
have become optional groups, neighbours of the same kind become repeated groups. All pages of the host are
aligned, in blocks whose expressions are aligned in turn, and then matched against the expression to see how
much text each of its parts takes in: the group whose slots gather most text that is no link is the article,
groups of links and texts that are the same on nearly all pages belong to the template. Every page is matched
in the same way, and what its slots and groups take in below the article's group is its main text.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import stored, table

#: Pages of a host that its wrapper is inferred from: all of them.
SAMPLES = None
#: Blocks of a host's pages that are aligned apart from each other before their expressions are.
BLOCKS = 128
#: An element of the wrapper with more parts than this is no sequence any more: one part a tag, in any order.
WIDE = 200
#: Texts of more characters are told apart by a digest.
LONG = 40
#: Bytes of wrappers that may be broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 32_000_000
#: Elements deeper than this count as children of the last one above it.
DEPTH = 60

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*>"
    r"|<(?P<raw>script|style|noscript|template|iframe|svg|textarea|select|button|title|object)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|$)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][\w:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_ATTR = re.compile(r"([\w:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var br wbr img".split())
_CLOSES_P = frozenset("address article aside blockquote center dl dir div fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_HOLDS = frozenset("ul ol dl table tbody thead tfoot div section article main body html".split())
#: Elements that are never the article; words in class, id or role of containers that say the same; and words that
#: say so only where they are a whole class or role, or outside an article element.
_FURNITURE = frozenset("head nav footer aside form menu dialog fieldset".split())
_STRONG = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo sidebar navbar breadcrumb breadcrumbs masthead comment comments disqus cookie cookies consent gdpr newsletter "
    "subscribe subscription signup pagination pager complementary contentinfo".split()
)
_WEAK = frozenset(
    "banner menu nav navigation footer header reply replies discussion notice notices alert popup modal overlay login share sharing social related recommended recommendations widget toolbar search form dialog promotion".split()
)
#: Containers, whose names count; a paragraph or heading is never furniture by its name.
_BOXES = frozenset("div section ul ol dl table tr td header span center iframe figure article main address details".split())
#: Blocks of text, which a region never ends in.
_TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl li dt dd blockquote pre table figure figcaption hr address".split())


class Element:
    __slots__ = ("children", "kind", "furniture", "tag", "block")

    def __init__(self, tag: str, kind: str, furniture: bool) -> None:
        self.tag, self.kind, self.furniture = tag, kind, furniture
        self.children: list[Element | str] = []
        #: An inline element with a block below it is a block too.
        self.block = tag not in _INLINE


def _opened(tag: str, attrs: str, inside: bool) -> Element:
    """inside: an article or main element stands above."""
    found = {a.lower(): b or c or d for a, b, c, d in _ATTR.findall(attrs)} if attrs else {}
    classes = found.get("class", "").lower().split()
    furniture = tag in _FURNITURE or (tag == "header" and not inside)
    if tag in _BOXES and tag not in ("article", "main"):
        whole = {*classes, found.get("role", "").lower()}
        words = set(re.findall("[a-z]+", " ".join([*whole, "" if inside else found.get("id", "").lower()])))
        furniture |= not _STRONG.isdisjoint(words) or not _WEAK.isdisjoint(whole if inside else words)
    return Element(tag, ".".join([tag, *sorted(set(found.get("class", "").split()))]), furniture)


def parsed(page: str) -> Element:
    """The page's elements; unclosed ones end where their successors say so."""
    root = Element("", "", False)
    stack = [root]
    for m in _TOKEN.finditer(page):
        if (text := m["text"]) is not None:
            stack[-1].children.append(html.unescape(text))
        elif (tag := m["tag"]) is not None:
            tag = tag.lower()
            if m["end"]:
                for at in range(len(stack) - 1, 0, -1):
                    if stack[at].tag == tag:
                        del stack[at:]
                        break
                    if tag in _INLINE and stack[at].tag not in _INLINE:
                        break
            elif tag in _VOID:
                stack[-1].children.append(" " if tag in ("br", "wbr") else Element(tag, tag, False))
            else:
                ends = {"p"} if tag in _CLOSES_P else _SAME.get(tag, ())
                for at in range(len(stack) - 1, 0, -1) if ends else ():
                    if stack[at].tag in ends:
                        del stack[at:]
                        break
                    if stack[at].tag in _HOLDS:
                        break
                new = _opened(tag, m["attrs"], any(e.tag in ("article", "main") for e in stack))
                stack[-1].children.append(new)
                if new.block:
                    for e in reversed(stack):
                        if e.block:
                            break
                        e.block = True
                if len(stack) < DEPTH and not m["attrs"].endswith("/"):
                    stack.append(new)
    return root


def inline(node: Element | str, linked: bool = False) -> tuple[str, int]:
    """Text of an inline node, and its characters in links."""
    if isinstance(node, str):
        return node, len(node) * linked
    found = [inline(c, linked or node.tag == "a") for c in node.children]
    return "".join(t for t, _ in found), sum(n for _, n in found)


# The content of an element is a list of groups: (kind, text, characters in links) for a run of inline nodes that has a
# text, and (kind, neighbours of that kind) for elements.

#: Elements whose neighbours of the same kind are one repeated group, whatever is in them.
_REPEATED = frozenset("p li dt dd tr td th option h1 h2 h3 h4 h5 h6 blockquote pre figure".split())


def _alike(a: Element, b: Element) -> bool:
    """Neighbours of one kind are one group; bare boxes only where they hold the same kinds."""
    if a.kind != b.kind or a.furniture != b.furniture:
        return False
    if a.tag in _REPEATED or "." in a.kind:
        return True
    x, y = ({c.kind for c in e.children if isinstance(c, Element) and c.block} for e in (a, b))
    return 2 * len(x & y) >= len(x | y)


def groups(node: Element) -> list[tuple]:
    out: list[tuple] = []
    held: list[Element | str] = []

    def told() -> None:
        if held:
            found = [inline(x) for x in held]
            if text := " ".join("".join(t for t, _ in found).split()):
                out.append(("#text", text, sum(n for _, n in found)))
            held.clear()

    for c in node.children:
        if isinstance(c, str) or not c.block:
            held.append(c)
            continue
        told()
        if out and out[-1][0] != "#text" and _alike(out[-1][1][-1], c):
            out[-1][1].append(c)
        else:
            out.append((c.kind, [c]))
    told()
    return out


def mark(text: str) -> str:
    """The text where it is short, else its beginning and a digest."""
    return text if len(text) <= LONG else f"{text[:24]}... {xxhash.xxh3_128_hexdigest(text.encode('utf-8', 'surrogatepass'))}"


def form(node: Element) -> list:
    """What inference needs of an element: [kind, furniture, groups], with texts as [#text, mark, characters, of them in links]."""
    return [node.kind, bool(node.furniture), [["#text", mark(g[1]), len(g[1]), min(g[2], len(g[1]))] if g[0] == "#text" else [g[0], [form(e) for e in g[1]]] for g in groups(node)]]


# A wrapper is a nested list: ("text", words), ("slot",), ("tag", kind, parts), ("wide", kind, parts) for one part a tag
# in any order, ("maybe", part), ("many", part).
_TAGS = ("tag", "wide")
_KNOWN = _BOXES | _TEXTUAL | _FURNITURE | _HOLDS | _INLINE | _VOID | {"#text"}


def _plain(kind: str) -> str:
    """The tag of a kind, for parts in any order; tags that HTML doesn't know are boxes."""
    tag = kind.split(".")[0]
    return tag if tag in _KNOWN else "div"


def lifted(node: Element) -> tuple:
    """One page as a wrapper of itself: neighbours of a kind become repeated groups."""
    return _lifted(form(node))


def _lifted(shape: list) -> tuple:
    parts: list[tuple] = []
    for g in shape[2]:
        if g[0] == "#text":
            parts.append(("text", g[1]))
        else:
            whole = _lifted(g[1][0])
            for other in g[1][1:]:
                whole = merged(whole, _lifted(other))
            parts.append(("many", whole) if len(g[1]) > 1 else whole)
    return ("wide", shape[0], _widened(parts)) if len(parts) > WIDE else ("tag", shape[0], parts)


def _widened(parts: list[tuple]) -> list[tuple]:
    """One part a tag, whatever the order: what bounds the parts where sequences or names never repeat."""
    held: dict[str, tuple] = {}
    for p in map(_bare, parts):
        kind = _plain(_kind(p))
        own = (p[0], kind, p[2]) if p[0] in _TAGS else p
        held[kind] = merged(held[kind], own) if kind in held else own
    return [("maybe", ("many", held[k])) for k in sorted(held)]


def _bare(p: tuple) -> tuple:
    while p[0] in ("maybe", "many"):
        p = p[1]
    return p


def _kind(p: tuple) -> str:
    p = _bare(p)
    return p[1] if p[0] in _TAGS else "#text"


def merged(a: tuple, b: tuple) -> tuple:
    """The smallest wrapper of this form that covers both; both are of one kind."""
    wraps = [w for w in ("maybe", "many") if any(p[0] == w or (p[0] in ("maybe", "many") and p[1][0] == w) for p in (a, b))]
    a, b = _bare(a), _bare(b)
    if a[0] not in _TAGS:
        out = a if a == b else ("slot",)
    elif "wide" in (a[0], b[0]) or len(parts := aligned(a[2], b[2])) > WIDE:
        out = ("wide", a[1], _widened([*a[2], *b[2]]))
    else:
        out = ("tag", a[1], parts)
    for w in reversed(wraps):
        out = (w, out)
    return out


def common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of the longest common order of two lists of kinds."""
    if a == b:
        return [(i, i) for i in range(len(a))]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out = []
    i = j = 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def aligned(a: list[tuple], b: list[tuple]) -> list[tuple]:
    """Two streams of parts as one: the longest common order of kinds is merged, the rest is optional."""
    out: list[tuple] = []
    i = j = 0
    for x, y in [*common([_kind(p) for p in a], [_kind(p) for p in b]), (len(a), len(b))]:
        out += [p if p[0] == "maybe" else ("maybe", p) for p in [*a[i:x], *b[j:y]]]
        if x < len(a):
            out.append(merged(a[x], b[y]))
        i, j = x + 1, y + 1
    return out


def written(w: tuple) -> str:
    """The wrapper as a regular expression over tokens."""
    if w[0] == "text":
        return w[1]
    if w[0] == "slot":
        return "#TEXT"
    if w[0] in ("maybe", "many"):
        return f"({written(w[1])}){'?' if w[0] == 'maybe' else '+'}"
    if w[0] == "wide":
        return f"<{w[1]}>({'|'.join(written(_bare(p)) for p in w[2])})*</{w[1].split('.')[0]}>"
    return f"<{w[1]}>{' '.join(map(written, w[2]))}</{w[1].split('.')[0]}>"


def frozen(found: list) -> tuple:
    """A wrapper as it was before it was written as JSON."""
    return tuple(frozen(x) if isinstance(x, list) else x for x in found)


class Part:
    """A tag of the wrapper as pages are matched against it, with what the host's pages have there."""

    __slots__ = ("heading", "kinds", "below", "wide", "role", "many", "texts", "same", "weight", "links", "chars", "furniture", "pages", "number")

    def __init__(self, w: tuple, many: bool = False) -> None:
        self.heading = bool(re.match(r"h[1-6](\.|$)", w[1]))
        self.kinds = [_kind(p) for p in w[2]]
        self.below = [Part(_bare(p), "many" in (p[0], p[1][0])) if _bare(p)[0] in _TAGS else None for p in w[2]]
        self.wide = w[0] == "wide"
        #: main: the article; drop: a group of the template. texts: texts of the template that stand right here.
        self.role, self.many, self.texts = "", many, []
        #: same: texts right here that nearly all pages have, with their characters. weight and links: characters of
        #: the other texts, out of links and in them; chars: of all texts.
        self.same: list[tuple[str, int]] = []
        self.weight, self.links, self.chars, self.furniture, self.pages, self.number = 0, 0, 0, False, 0, 0

    def listed(self) -> list[Part]:
        """This part and all below it; a part's number is its place in the list of the whole."""
        out = [self]
        for n, p in enumerate(out):
            p.number = n
            out += [q for q in p.below if q]
        return out

    def shown(self) -> list:
        """What matching needs: all that lies below a part without a role or a role below it is left out."""
        below = [p.shown() if p else None for p in self.below]
        if not self.texts and not any(b and (b[0] or b[1] or b[2]) for b in below):
            return [self.role, [], [], [], 0]
        return [self.role, sorted(self.texts), self.kinds, below, int(self.wide)]


def placed(found: list, kinds: list[str], wide: bool | int) -> list[int]:
    """For each group of an element the place of its part in the wrapper, -1 where the wrapper has none."""
    if wide:
        places = {k: j for j, k in enumerate(kinds)}
        return [places.get(_plain(g[0]), -1) for g in found]
    at = [-1] * len(found)
    for i, j in common([g[0] for g in found], kinds):
        at[i] = j
    return at


def _tallied(shape: list, part: Part | None, seen: dict, met: dict) -> None:
    """A page's texts by the part of the wrapper that takes them in into ``seen``, its parts into ``met``."""
    found = shape[2]
    for g, j in zip(found, placed(found, part.kinds, part.wide) if part else [-1] * len(found), strict=True):
        if g[0] == "#text":
            if part:
                seen.setdefault((part.number, g[1]), (g[2], g[3]))
            continue
        sub = part.below[j] if part and j >= 0 else None
        for e in g[1]:
            if sub:
                met[sub.number] = met.get(sub.number, False) or e[1]
            if not e[1]:
                _tallied(e, sub, seen, met)


def counted(shape: list, top: Part, counts: dict[tuple, list[int]]) -> None:
    """Adds a page to ``counts``: (part, mark) -> [pages, characters of the text, characters in links]; for a part
    itself the mark is None and the last number counts the pages where it is furniture."""
    seen: dict[tuple[int, str], tuple[int, int]] = {}
    met: dict[int, bool] = {}
    _tallied(shape, top, seen, met)
    for key, (chars, links) in [*seen.items(), *(((p, None), (0, int(f))) for p, f in met.items())]:
        c = counts.setdefault(key, [0, chars, 0])
        c[0] += 1
        c[2] += links


def common_to_pages(n: int, pages: int) -> bool:
    """A text is the template's if nine in ten pages have it; with fewer than ten pages, all of them."""
    return pages > 1 and 10 * n >= 9 * pages


def judged(whole: tuple, pages: int, told_of: list[tuple]) -> dict:
    """The wrapper of a host: its expression, and its parts with their roles for matching.

    told_of: for each part (number, pages, pages where it is furniture, weight, links, chars, same), as Part has them
    but of the texts right in the part.
    """
    top = Part(whole)
    parts = top.listed()
    for number, n, furniture, weight, links, chars, same in told_of:
        p = parts[number]
        p.pages, p.weight, p.links, p.chars, p.same = n, weight, links, chars, [tuple(x) for x in same]
        # As with texts, one page in ten may differ.
        p.furniture = furniture > 0 and 10 * furniture >= n
    for p in reversed(parts):
        for q in p.below:
            if q:
                p.weight, p.links, p.chars = p.weight + q.weight, p.links + q.links, p.chars + q.chars
    region, tag, told = top, "", False
    while True:
        boxes = [(p.weight, -i, p, k.split(".")[0]) for i, (p, k) in enumerate(zip(region.below, region.kinds, strict=True)) if p and not p.furniture and k.split(".")[0] not in _TEXTUAL]
        best = max(boxes, default=None, key=lambda b: b[:2])
        if best is None or not region.weight or best[0] < 0.5 * region.weight or best[2].many and best[3] not in ("article", "main"):
            break
        # A region with headings or paragraphs of its own is the article; a box of its text alone is not.
        own = [p for p, k in zip(region.below, region.kinds, strict=True) if p and k.split(".")[0] in _TEXTUAL and not p.furniture and p.weight > p.links and 2 * p.pages >= pages]
        if own and best[3] not in ("article", "main") or tag == "article":
            break
        region, tag = best[2], best[3]
        told |= tag in ("article", "main")
    if not region.weight:
        # Nothing differs between the pages, so nothing tells the article.
        return {"expression": written(whole), "parts": top.shown()}
    region.role = "main"
    if tag not in ("article", "main"):
        todo = [region]
        while todo:
            for p, k in zip((p := todo.pop()).below, p.kinds, strict=True):
                if p and k.split(".")[0] in _HOLDS:
                    if p.links > p.weight and p.pages > 1:
                        p.role = "drop"
                    else:
                        todo.append(p)
    # Texts of the template, in a box that only the wrapper tells: what an article or main element holds is all the
    # article's. Headings stay, and so does everything where most of the article is the same on all pages.
    same: list[tuple[str, int, Part]] = []
    todo = [region]
    while todo:
        if not (p := todo.pop()).heading:
            same += [(text, chars, p) for text, chars in p.same]
            todo += [q for q in p.below if q]
    if not told and pages >= 4 and 2 * pages * sum(chars for _, chars, _ in same) < region.chars:
        for text, _, p in same:
            p.texts.append(text)
    return {"expression": written(whole), "parts": top.shown()}


def inferred(pages: list[str]) -> dict:
    """The wrapper of pages at hand, in one place and one sequence; ``wrappers`` is for hosts of any size."""
    # Copies of a page say nothing about what differs between pages.
    shapes = [json.loads(x) for x in sorted({json.dumps(form(parsed(p))) for p in pages})]
    whole = _lifted(shapes[0])
    for shape in shapes[1:]:
        whole = merged(whole, _lifted(shape))
    top, counts = Part(whole), {}
    top.listed()
    for shape in shapes:
        counted(shape, top, counts)
    found: dict[int, list] = {}
    for (number, text), (n, chars, links) in counts.items():
        p = found.setdefault(number, [number, 0, 0, 0, 0, 0, []])
        if text is None:
            p[1:3] = [n, links]
            continue
        p[5] += n * chars
        if common_to_pages(n, len(shapes)):
            p[6].append((text, chars))
        else:
            p[3], p[4] = p[3] + n * chars - links, p[4] + links
    return judged(whole, len(shapes), [tuple(p) for p in found.values()])


def _taken(node: Element, part: list | None, inside: bool) -> tuple[list[str], bool]:
    """Texts that the slots and groups below the article's group take in, and whether the page has that group."""
    out: list[str] = []
    met = inside
    found = groups(node)
    for g, j in zip(found, placed(found, part[2], part[4]) if part and part[2] else [-1] * len(found), strict=True):
        if g[0] == "#text":
            if inside and not (part and part[1] and mark(g[1]) in part[1]):
                out.append(g[1])
            continue
        sub = part[3][j] if part and j >= 0 else None
        if sub and sub[0] == "drop":
            continue
        for e in g[1]:
            if not e.furniture and (inside or sub):
                texts, here = _taken(e, sub, inside or sub[0] == "main")
                out += texts
                met |= here
    return out, met


def _outermost(node: Element, tag: str) -> list[Element]:
    if node.tag == tag:
        return [node]
    return [x for c in node.children if isinstance(c, Element) and not c.furniture for x in _outermost(c, tag)]


def main_text(page: str | None, wrapper: dict | None) -> str:
    """Blocks of the article, in page order, as the wrapper takes them in. Without a wrapper (or where the page has
    no group of the article) article and main elements do, or else the whole page without its furniture."""
    if not page:
        return ""
    root = parsed(page)
    if wrapper:
        texts, met = _taken(root, wrapper["parts"], wrapper["parts"][0] == "main")
        if met:
            return "\n\n".join(texts)
    tops = _outermost(root, "article") or _outermost(root, "main") or [root]
    return "\n\n".join(t for e in tops for t in _taken(e, None, True)[0])


def hosted(pages: DataFrame, url: str = "url") -> DataFrame:
    return pages.withColumn("_host", F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)))


def _shapes(pages: DataFrame, url: str, page: str) -> DataFrame:
    """(_host, block, code, body, n): the form of each different page of a host with its digest, and at the end of
    each block of pages a row without a digest, with the wrapper of the block and its number of pages.

    Blocks are read in the order of digests, so wrappers don't depend on how the pages are stored.
    """
    rows = hosted(pages, url).select("_host", F.col(page).alias("html")).where("html is not null and _host <> ''")

    def formed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[tuple[str, bytes]] = set()
        for batch in batches:
            out: list[tuple] = []
            for host, raw in zip(batch.column("_host").to_pylist(), batch.column("html"), strict=True):
                text = json.dumps(form(parsed(raw.as_py())), ensure_ascii=False, separators=(",", ":"))
                code = xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))
                if (host, code) not in met:
                    if len(met) > 200_000:
                        met.clear()
                    met.add((host, code))
                    out.append((host, code[-1] % BLOCKS, code, text))
            yield _rows(out, ("_host", pa.string()), ("block", pa.int32()), ("code", pa.binary()), ("body", pa.string()))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, last, whole, n = None, None, None, 0
        columns = ("_host", pa.string()), ("block", pa.int32()), ("code", pa.binary()), ("body", pa.string()), ("n", pa.int64())
        for batch in batches:
            out: list[tuple] = []
            for host, block, code, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != (host, block):
                    if at:
                        out.append((*at, None, json.dumps(whole), n))
                    at, last, whole, n = (host, block), None, None, 0
                if code != last:
                    own = _lifted(json.loads(body))
                    last, whole, n = code, merged(whole, own) if whole else own, n + 1
                    out.append((host, block, code, body, 1))
            yield _rows(out, *columns)
        if at:
            yield _rows([(*at, None, json.dumps(whole), n)], *columns)

    found = rows.mapInArrow(formed, "_host string, block int, code binary, body string").repartition("_host", "block").sortWithinPartitions("_host", "block", "code")
    return found.mapInArrow(blocks, "_host string, block int, code binary, body string, n bigint")


def _rows(rows: list[tuple], *columns: tuple[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(list(zip(*rows, strict=True)) or [()] * len(columns), columns, strict=True)], [n for n, _ in columns])


def _small(df: DataFrame, *columns: str) -> bool:
    return (df.agg(F.sum(sum(F.length(c) for c in columns))).first()[0] or 0) <= BROADCAST_BYTES


def wrappers(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(host, wrapper as JSON, different pages it was inferred from), from all pages of a host.

    Pages of a host are dealt over BLOCKS groups, so that a host of any size is shared by many tasks; what meets
    in one task are the wrappers of its blocks, and the sums for each part. Pages without html are left out.
    """
    shapes = stored(_shapes(pages, url, page), "shapes")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, whole, n = None, None, 0
        columns = ("_host", pa.string()), ("_whole", pa.string()), ("n_pages", pa.int64())
        for batch in batches:
            out: list[tuple] = []
            for host, _, body, of in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != host:
                    if at is not None:
                        out.append((at, json.dumps(whole), n))
                    at, whole, n = host, None, 0
                own = frozen(json.loads(body))
                whole, n = merged(whole, own) if whole else own, n + of
            yield _rows(out, *columns)
        if at is not None:
            yield _rows([(at, json.dumps(whole), n)], *columns)

    blocks = shapes.where("code is null").select("_host", "block", "body", "n").repartition("_host").sortWithinPartitions("_host", "block")
    wholes = stored(blocks.mapInArrow(joined, "_host string, _whole string, n_pages bigint"), "wholes")
    near = F.broadcast if _small(wholes, "_whole", "_host") else lambda df: df

    def tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, Part] = {}
        counts: dict[str, dict[tuple, list[int]]] = {}
        held = 0

        def told() -> pa.RecordBatch:
            out = [(host, number, text, *c) for host, own in counts.items() for (number, text), c in own.items()]
            counts.clear()
            return _rows(out, ("_host", pa.string()), ("part", pa.int32()), ("text", pa.string()), ("n", pa.int64()), ("chars", pa.int64()), ("links", pa.int64()))

        for batch in batches:
            for host, body, w in zip(batch.column("_host").to_pylist(), batch.column("body"), batch.column("_whole"), strict=True):
                if host not in memory:
                    if len(memory) > 1000:
                        memory.clear()
                    memory[host] = Part(frozen(json.loads(w.as_py())))
                    memory[host].listed()
                own = counts.setdefault(host, {})
                before = len(own)
                counted(json.loads(body.as_py()), memory[host], own)
                held += len(own) - before
                if held > 50_000:
                    yield told()
                    held = 0
        yield told()

    texts = shapes.where("code is not null").select("_host", "body").join(near(wholes.select("_host", "_whole")), "_host")
    texts = texts.mapInArrow(tallied, "_host string, part int, text string, n bigint, chars bigint, links bigint")
    texts = texts.groupBy("_host", "part", "text").agg(F.sum("n").alias("n"), F.max("chars").alias("chars"), F.sum("links").alias("links"))
    all_over = (F.col("n_pages") > 1) & (F.lit(10) * F.col("n") >= F.lit(9) * F.col("n_pages"))  # As in common_to_pages.
    other, itself = F.col("text").isNotNull() & ~all_over, F.col("text").isNull()
    parts = texts.join(near(wholes.select("_host", "n_pages")), "_host").groupBy("_host", "part").agg(
        F.coalesce(F.sum(F.when(itself, F.col("n"))), F.lit(0)).alias("pages"),
        F.coalesce(F.sum(F.when(itself, F.col("links"))), F.lit(0)).alias("furniture"),
        F.coalesce(F.sum(F.when(other, F.col("n") * F.col("chars") - F.col("links"))), F.lit(0)).alias("weight"),
        F.coalesce(F.sum(F.when(other, F.col("links"))), F.lit(0)).alias("links"),
        F.coalesce(F.sum(F.when(~itself, F.col("n") * F.col("chars"))), F.lit(0)).alias("chars"),
        F.collect_list(F.when(~itself & all_over, F.struct("text", "chars"))).alias("same"),
    )
    numbers = ("part", "pages", "furniture", "weight", "links", "chars")
    parts = parts.groupBy("_host").agg(F.collect_list(F.struct(*numbers, "same")).alias("_parts"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for host, whole, n, found in zip(*(batch.column(c).to_pylist() for c in ("_host", "_whole", "n_pages", "_parts")), strict=True):
                own = [(*(p[c] for c in numbers), [(t["text"], t["chars"]) for t in p["same"]]) for p in found or []]
                out.append((host, json.dumps(judged(frozen(json.loads(whole)), n, own)), n))
            yield _rows(out, ("host", pa.string()), ("wrapper", pa.string()), ("n_pages", pa.int64()))

    return wholes.join(parts, "_host", "left").mapInArrow(judge, "host string, wrapper string, n_pages bigint")


def extracted(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """key, url, text (main text, empty if none) and n_chars of every row of ``pages``.

    Null html is empty. A page without a host is judged by its elements alone. Repeated rows are extracted each.
    """
    # What matching needs of a wrapper.
    known = wrappers(pages, url, page)
    slim = stored(known.select(F.col("host").alias("_host"), F.get_json_object("wrapper", "$.parts").alias("_wrapper")), "wrappers")
    rows = hosted(pages, url).select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"), "_host")
    rows = rows.join(F.broadcast(slim) if _small(slim, "_wrapper", "_host") else slim, "_host", "left").drop("_host")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, dict] = {}
        for batch in batches:
            texts = []
            for raw, w in zip(batch.column("html"), batch.column("_wrapper").to_pylist(), strict=True):
                if w is not None and w not in memory:
                    if len(memory) > 10_000:
                        memory.clear()
                    memory[w] = {"parts": json.loads(w)}
                texts.append(main_text(raw.as_py(), memory[w] if w is not None else None))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, f"page_id {dict(rows.dtypes)['page_id']}, url string, text string, n_chars bigint")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extracted(table(spark, sf_dir, "pages"))


QUERIES = {"op7_html_extraction": op7_html_extraction}
ORACLES: dict[str, str] = {}
