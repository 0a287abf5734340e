"""Whole volumes with all kinds of blocks, treatises that begin inside a page, and plates, against a plain fold."""

import random

from quire.operators import articles as A

PARAGRAPHS, APPENDED = ("Text", "List-Group", "Complex-Block"), ("Table", "Equation-Block", "Caption", "Footnote")
VOLUMES = "identifier string, eb_code string, volume_num int, alpha_range string, volume_label string, title string"
PAGES = "identifier string, idx int, image string, raw string"
NAMES = ["ALGEBRA", "OPTICS", "SURGERY", "FARRIERY", "HYDROSTATICS"]


def html(label, inner):
    return f'<div data-label="{label}" data-bbox="100 40 500 90">{inner}</div>'


class Volume:
    """An invented volume: pages as (number, trigram, running head, blocks), and the spans that lie in it."""

    def __init__(self, seed):
        self.rng, self.pages, self.spans, self.made = random.Random(seed), [], [], 0
        self.dictionary_page(opening=True)
        names = iter(NAMES)
        for _ in range(4):
            for _ in range(self.rng.randint(1, 2)):
                self.dictionary_page()
            if self.rng.random() < 0.5:
                self.pages.append((None, "PLATE IV", [("Caption", self.said("caption"), None), ("Text", self.said("plate"), None)]))
                self.dictionary_page()
            self.treatise(next(names))
        self.dictionary_page()

    def said(self, what):
        self.made += 1
        return f"the {what} number {self.made} says this."

    def entry(self):
        self.made += 1
        word = "AB" + "".join(self.rng.choice("EFGKNOPRSTUW") for _ in range(6))
        return ("Text", f"{word}, {self.said('entry')}", word)

    def mixed(self, n):
        kinds = [*PARAGRAPHS, *APPENDED, "Image", "Page-Footer", "Section-Header"]
        return [self.entry() if self.rng.random() < 0.4 else (k := self.rng.choice(kinds), self.said(k.lower()), None) for _ in range(n)]

    def dictionary_page(self, opening=False):
        blocks = self.mixed(self.rng.randint(2, 6))
        self.pages.append(("ABA", "ABA", [self.entry(), *blocks] if opening else blocks))

    def treatise(self, name):
        banner = ("Section-Header", " ".join(name) + ".", None)
        where = self.rng.choice(["before", "first", "none"])
        start = len(self.pages)
        if where == "before":
            trigram, head, blocks = self.pages[-1]
            at = self.rng.randint(0, len(blocks))
            self.pages[-1] = (trigram, head, [*blocks[:at], banner, *blocks[at:]])
            start -= 1
        for k in range(self.rng.randint(2, 4)):
            blocks = self.mixed(self.rng.randint(1, 4))
            self.pages.append((None, name, [blocks[0], banner, *blocks[1:]] if where == "first" and k == 0 else blocks))
        if self.rng.random() < 0.5:
            self.pages.append((None, "PLATE IX", [("Caption", self.said("plate"), None)]))
        self.spans.append((start, len(self.pages) - 1, name))

    def rows(self, identifier):
        for idx, (_, head, blocks) in enumerate(self.pages):
            inner = html("Page-Header", head) + html("Page-Header", f"( {idx + 1} )")
            for label, text, word in blocks:
                shown = f"<b>{word}</b>{text[len(word):]}" if word else text
                inner += html(label, f"<h2>{text}</h2>" if label == "Section-Header" else f"<p>{shown}</p>" if label in PARAGRAPHS else shown)
            yield identifier, idx, f"{identifier}-{idx}.jpg", inner

    def records(self):
        """(name, type, texts, first and last page, pages with text), by folding one list of pieces."""
        owner = {i: s for s in self.spans for i in range(s[0], s[1] + 1)}
        pieces = []
        for i, (trigram, head, blocks) in enumerate(self.pages):
            span = owner.get(i)
            if span is None and head.startswith("PLATE"):
                continue
            cut = len(blocks) if span is None else 0
            if span and i == span[0] and trigram:
                cut = next((k for k, (label, text, _) in enumerate(blocks) if label == "Section-Header" and "".join(c for c in text if c.isupper()) == span[2]), len(blocks))
            for k, (label, text, word) in enumerate(blocks):
                if k >= cut and label != "Page-Footer":
                    pieces.append((i, span, None, text))
                elif k < cut and label in PARAGRAPHS + APPENDED:
                    pieces.append((i, None, word, text))
        out = []
        for i, span, word, text in pieces:
            if span:
                if not out or out[-1][0] != span:
                    out.append([span, "treatise", [], []])
            elif word:
                out.append([word, "article", [], []])
            elif out and out[-1][1] == "treatise":
                out.append([None, "", [], []])
            if out:
                out[-1][2].append(text)
                out[-1][3].append(i)
        named = [r for r in out if r[0]]
        return [(r[0][2] if r[1] == "treatise" else r[0], r[1], " ".join(r[2]), *((r[0][0], r[0][1]) if r[1] == "treatise" else (min(r[3]), max(r[3]))), sorted(set(r[3]))) for r in named]


def test_volumes_equal_a_fold(spark):
    volumes = {f"v{k}": Volume(k) for k in range(6)}
    pages = spark.createDataFrame([r for name, v in volumes.items() for r in v.rows(name)], PAGES)
    listed = spark.createDataFrame([(name, "EB.1", 1, "A-B", None, "t") for name in volumes], VOLUMES)
    got = A.volume_articles(pages, listed).orderBy("identifier", "seq").collect()
    for name, volume in volumes.items():
        # Titles of a banner keep no blanks between letters; bodies are cleaned.
        wanted = [(h, kind, text.replace(" .", "."), lo, hi, [f"{name}-{i}.jpg" for i in own], own[0] + 1 if kind == "treatise" else lo + 1, own[-1] + 1) for h, kind, text, lo, hi, own in volume.records()]
        found = [(r.headword, r.type, r.body_text, r.image_page_start, r.image_page_end, list(r.image_files), r.printed_page_start, r.printed_page_end) for r in got if r.identifier == name]
        assert found == wanted


def test_volume_that_opens_in_a_treatise(spark):
    def page(head, *blocks):
        return html("Page-Header", head) + "".join(blocks)

    raw = [
        page("PREFACE", html("Text", "<p>To the reader.</p>")),
        page("PREFACE", html("Text", "<p>More for the reader.</p>")),
        page("CON", html("Text", "<p>continued from before</p>")),
        page("ASTRONOMY", html("Text", "<p>Stars go on.</p>")),
        page("ASTRONOMY", html("Table", "<table><tr><td>Mars</td></tr></table>")),
        page("BAA", html("Text", "<p><b>BAAL</b>, an idol of the east and of other lands.</p>")),
    ]
    pages = spark.createDataFrame([(v, i, f"{i}.jpg", r) for v in ("named", "letters", "unknown") for i, r in enumerate(raw)], PAGES)
    listed = spark.createDataFrame([("named", "EB.4", 2, "Part 2, Astronomy-BZO", None, "t"), ("letters", "EB.4", 2, "B-BZO", None, "t"), ("unknown", "EB.4", 2, None, None, "t")], VOLUMES)
    # The range of the first begins with A: its opening headword must do so too, so its body is its first page.
    got = A.volume_articles(pages.where("identifier <> 'named'"), listed).orderBy("identifier", "seq").collect()
    assert [(r.identifier, r.headword) for r in got if r.identifier == "letters"] == [("letters", "BAAL")]
    spans = A.treatise_spans(A.page_table(pages, listed), spark.createDataFrame([(v, 0) for v in ("named", "letters", "unknown")], "identifier string, body_start int"))
    bodies = spark.createDataFrame([("named", 5, "ASTRONOMY", True), ("letters", 5, "B", True), ("unknown", 5, None, True), ("alone", 3, None, False)], "identifier string, body_start int, opener string, multivol boolean")
    assert {r.identifier: r.body_start for r in A.read_from(bodies, spans).collect()} == {"named": 3, "letters": 5, "unknown": 0, "alone": 3}


def test_titles_of_banners_stay_as_they_are_shown(spark):
    from pyspark.sql import functions as F

    from quire.functions import text as X

    shown = [("PRINCIPLES OF THE LAW OF SCOTLAND", "PRINCIPLES OF THE LAW OF SCOTLAND"), ("LAW OF SCOTLAND.", "LAW OF SCOTLAND"), ("SHIPBUILDING", "SHIP-BUILDING"), ("", ""), (None, None)]
    rows = spark.createDataFrame([(t,) for t, _ in shown], "t string").select(X.display_title(F.col("t")).alias("d")).collect()
    assert [r.d for r in rows] == [d for _, d in shown]
