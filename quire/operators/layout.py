"""Layout HTML of scanned pages: blocks, page heads, margin notes, outlines."""

from __future__ import annotations

import html as H
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from quire import schemas
from quire.functions import text as X

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Blocks(HTMLParser):
    """Labelled blocks in document order; a nested one is also part of the one around it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[dict] = []
        self.open: list[tuple[str, dict | None, dict | None, dict | None]] = []

    def _each(self) -> list[dict]:
        return [b for _, b, _, _ in self.open if b is not None]

    def _write(self, markup: str) -> None:
        for _, b, p, _ in self.open:
            for part in (b, p):
                if part is not None:
                    part["html"].append(markup)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        found = {k: v or "" for k, v in attrs}
        if tag == "p" and any(t == "p" for t, *_ in self.open):
            self.handle_endtag("p")
        markup = f"<{tag}{''.join(f' {k}="{H.escape(v)}"' for k, v in found.items())}>"
        block = para = head = None
        if tag == "div" and found.get("data-label"):
            block = {"pos": len(self.blocks), "label": found["data-label"], "bbox": found.get("data-bbox", ""), "text": [], "html": [], "paras": [], "heads": []}
            self.blocks.append(block)
        elif tag == "p":
            para = {"text": [], "html": [], "bold": None, "bold_tail": "", "lead": "", "_kids": 0, "_bold": 0}
            for b in self._each():
                b["paras"].append(para)
        elif len(tag) == 2 and tag[0] == "h" and tag[1] in "123456":
            head = {"level": int(tag[1]), "text": []}
            for b in self._each():
                b["heads"].append(head)
        else:
            for i, (_, _, p, _) in enumerate(self.open):
                if p is not None and not any(q is not None for _, _, q, _ in self.open[i + 1 :]) and i == len(self.open) - 1:
                    p["_kids"] += 1
                    if tag == "b" and p["_kids"] == 1:
                        p["bold"], p["_bold"] = "", len(self.open)
        if tag not in _VOID:
            self.open.append((tag, block, para, head))
        self._write(markup)

    def handle_endtag(self, tag: str) -> None:
        if tag in _VOID or not any(t == tag for t, *_ in self.open):
            return
        while self.open:
            name, _, _, _ = self.open[-1]
            self._write(f"</{name}>")
            self.open.pop()
            if name == tag:
                break

    def handle_data(self, data: str) -> None:
        for depth, (_, b, p, h) in enumerate(self.open):
            for part in (b, p, h):
                if part is not None:
                    part["text"].append(data)
            if p is not None:
                inside = len(self.open) - 1 - depth
                if p["bold"] is not None and p["_kids"] == 1 and inside >= 1:
                    p["bold"] += data
                elif inside == 0 and p["_kids"] == 0:
                    p["lead"] += data
                elif inside == 0 and p["_kids"] == 1 and p["bold"] is not None:
                    p["bold_tail"] += data
        self._write(H.escape(data, quote=False))


# Width of a margin note, how near it is to the page's left and right edges, and letters of a banner in capitals.
NOTE_WIDTH, NOTE_LEFT, NOTE_RIGHT, BANNER_LETTERS = 110, 100, 60, 8


#: Characters of pages that are parsed before their blocks are handed on; a longer page is parsed alone.
SLICE = 1 << 18

_PARA = pa.struct([(k, pa.string()) for k in ("text", "html", "bold", "bold_tail", "lead")])
_HEAD = pa.struct([("level", pa.int32()), ("text", pa.string())])
_BLOCK = pa.struct([("pos", pa.int32()), *[(k, pa.string()) for k in ("label", "bbox", "text", "html")], ("paras", pa.list_(_PARA)), ("heads", pa.list_(_HEAD))])


def _parsed(raw: str | None) -> list[dict]:
    if not raw:
        return []
    parser = _Blocks()
    parser.feed(raw)
    parser.close()
    # A paragraph or heading of nested blocks is one object: its pieces are joined once.
    whole = {id(x): {k: "".join(v) if isinstance(v, list) else v for k, v in x.items() if k[0] != "_"} for b in parser.blocks for x in (*b["paras"], *b["heads"])}
    told = lambda found: [whole[id(x)] for x in found]
    return [b | {"text": "".join(b["text"]), "html": "".join(b["html"]), "paras": told(b["paras"]), "heads": told(b["heads"])} for b in parser.blocks]


def _all_parsed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Blocks of pages, some pages at a time: blocks are many times as large as their pages, and a batch has any number of these."""
    for raw in batches:
        held, size = [], 0
        for page in raw:
            held.append(_parsed(text := page.as_py()))
            size += len(text or "")
            if size >= SLICE:
                yield pa.array(held, pa.list_(_BLOCK))
                held, size = [], 0
        if held:
            yield pa.array(held, pa.list_(_BLOCK))


def blocks(raw: Column | str) -> Column:
    """Labelled blocks of a page's layout HTML, however broken; null and empty pages have none."""
    return F.arrow_udf(_all_parsed, schemas.BLOCKS)(raw)


def boxed(c: Column) -> Column:
    """The blocks with their boxes read."""
    return F.transform(c, lambda b: b.withField("box", X.box(b["bbox"])))


def without_margin_notes(c: Column) -> Column:
    """Boxed blocks but narrow texts at the page's outer margins."""
    right = F.coalesce(F.array_max(F.transform(c, lambda b: b["box"]["x2"])), F.lit(0))
    note = lambda b: F.coalesce((b["label"] == "Text") & (b["box"]["x2"] - b["box"]["x1"] < NOTE_WIDTH) & ((b["box"]["x1"] < NOTE_LEFT) | (b["box"]["x2"] > right - NOTE_RIGHT)), F.lit(False))
    return F.filter(c, lambda b: ~note(b))


def page_head(c: Column, whole_words: Column) -> Column:
    """Struct of a page's number, mode (dict, treatise, plate, unknown), running head and trigram."""
    heads = F.filter(F.transform(F.filter(c, lambda b: b["label"] == "Page-Header"), lambda b: F.trim(b["text"])), lambda t: t != "")
    is_number = lambda t: t.rlike(r"^[\[(]?\s*\d{1,4}\s*[\])]?\.?$")
    volume = lambda a: X.key(a).rlike("^VOL[IVXLC]+$")
    texts, images = F.size(F.filter(c, lambda b: b["label"] == "Text")), F.size(F.filter(c, lambda b: b["label"].isin("Image", "Figure", "Diagram")))

    def read(numbers: Column, names: Column) -> Column:
        first = lambda p: F.get(F.filter(names, p), F.lit(0))
        number = F.nullif(F.regexp_extract(F.element_at(F.concat(F.array(F.lit("")), numbers), -1), r"(\d+)", 1), F.lit(""))
        vol_like, plate_like = F.exists(names, volume), F.exists(names, lambda a: a.rlike("(?i)^PLATE"))

        def judged(word: Column) -> Column:
            trigram = F.coalesce(first(lambda a: a.rlike("^[A-Z]{3}$")), F.when(whole_words & word.isNotNull() & ~vol_like, F.left(X.key(word), F.lit(3))))
            mode = lambda t: F.when(vol_like, "plate").when(t.isNotNull(), "dict").when(plate_like | ((images > 0) & (texts <= 1)), "plate").when(word.isNotNull(), "treatise").otherwise("unknown")
            return X.let(trigram, lambda t: F.struct(number.cast("int").alias("page_no"), mode(t).alias("mode"), F.coalesce(t, word, F.get(names, F.lit(0)), F.lit("")).alias("running"), t.alias("trigram")))

        return X.let(first(lambda a: (F.length(X.key(a)) >= 4) & ~volume(a)), judged)

    named = lambda h: F.transform(F.filter(h, lambda t: ~is_number(t) & t.rlike("[A-Za-z]")), X.unspaced)
    return X.let(heads, lambda h: X.let(named(h), lambda names: read(F.filter(h, is_number), names)))


def _names(b: Column) -> Column:
    """What a section head calls itself: its h1 to h3, then its whole text."""
    return F.concat(F.transform(F.filter(b["heads"], lambda h: h["level"] <= 3), lambda h: h["text"]), F.array(b["text"]))


def is_banner(b: Column, title_key: Column) -> Column:
    """True for a section head whose key is ``title_key``."""
    return (b["label"] == "Section-Header") & F.exists(_names(b), lambda t: X.key(t) == title_key)


def banner(c: Column, title_key: Column) -> Column:
    """The display form of the section head whose key is ``title_key``, else null."""
    heads = F.flatten(F.transform(F.filter(c, lambda b: b["label"] == "Section-Header"), _names))
    return F.nullif(X.title(F.get(F.filter(heads, lambda t: X.key(t) == title_key), F.lit(0))), F.lit(""))


def capital_banner(c: Column) -> Column:
    """The first h1 or h2 of eight letters or more, four fifths of them capitals."""
    heads = F.flatten(F.transform(F.filter(c, lambda b: b["label"] == "Section-Header"), lambda b: F.transform(F.filter(b["heads"], lambda h: h["level"] <= 2), lambda h: h["text"])))
    shown = F.transform(heads, lambda t: X.unspaced(X.trimmed(F.regexp_replace(t, r"\s+", " "))))
    letters, upper = (lambda t: F.length(F.regexp_replace(t, r"[^\p{L}]", ""))), (lambda t: F.length(F.regexp_replace(t, r"[^\p{Lu}]", "")))
    return F.get(F.filter(shown, lambda t: (letters(t) >= BANNER_LETTERS) & (upper(t) * 5 >= letters(t) * 4)), F.lit(0))


def outline(c: Column, page_no: Column, image_page: Column) -> Column:
    """h3 to h6 of a page as outline entries."""
    heads = F.flatten(F.transform(c, lambda b: F.filter(b["heads"], lambda h: h["level"] >= 3)))
    kept = F.filter(F.transform(heads, lambda h: F.struct(h["level"].alias("level"), X.unspaced(X.clean(h["text"])).alias("label"), page_no.alias("printed_page"), image_page.alias("image_page"))), lambda h: h["label"] != "")
    return kept
