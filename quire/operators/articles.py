"""Pages of volumes into article records: spans of treatises, segments of entries, and their clean-up.

A volume is a partition; its pages, blocks, paragraphs and lines are its total order. A record opens at a
headword, a treatise runs over a gap of trigrams, and everything else follows from windows over that order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import layout as L
from quire.operators import sequences as S
from quire.operators.vocabulary import settled

# Labels of blocks that carry a record's text.
BODY_LABELS = ["Text", "List-Group", "Complex-Block", "Table", "Equation-Block", "Caption", "Footnote", "Section-Header"]
PARAGRAPH_LABELS = ["Text", "List-Group", "Complex-Block"]
# Whole blocks that are added to the entry that is open, and what no record takes in.
APPENDED_LABELS = ["Table", "Equation-Block", "Caption", "Footnote"]
MARGINAL_LABELS = ["Page-Header", "Page-Footer"]
# What sets editions apart; others have neither margin notes nor heads of whole words, and one volume.
EDITIONS = [
    # code, margin notes, several volumes, heads are whole words
    ("EB.4", True, True, False),
    ("EB.5", True, True, False),
    ("EB.7", True, True, False),
    ("EB.9", True, True, False),
    ("EB.10", True, True, False),
    ("EB.11", True, True, False),
    ("EB.12", True, True, True),
    ("EB.15", True, True, True),
    ("EB.16", True, True, True),
]

_V = ["identifier"]


def profiled(volumes: DataFrame) -> DataFrame:
    """Volumes with the switches of their editions; unknown editions have none."""
    known = volumes.sparkSession.createDataFrame(EDITIONS, "eb_code string, margin_notes boolean, multivol boolean, word_heads boolean")
    switches = ["margin_notes", "multivol", "word_heads"]
    return volumes.join(F.broadcast(known), "eb_code", "left").withColumns({k: F.coalesce(k, F.lit(False)) for k in switches})


def is_index(volume_num: Column, label: Column, title: Column) -> Column:
    return volume_num.isNull() & F.lower(F.concat_ws(" ", label, title)).contains("index")


def is_dissertation(alpha: Column, label: Column) -> Column:
    return F.concat_ws(" ", alpha, label).rlike("(?i)dissertation")


def page_table(pages: DataFrame, volumes: DataFrame, whole_words: bool = True) -> DataFrame:
    """Pages with their boxed blocks and heads; margin notes are gone where the edition has them, but a page's
    head is read before. Unless ``whole_words``, heads are never shortened to trigrams."""
    rows = pages.join(profiled(volumes).select("identifier", "margin_notes", "multivol", "word_heads", "alpha_range", "volume_label"), "identifier")
    rows = rows.withColumn("blocks", L.boxed(L.blocks(F.coalesce("raw", F.lit("")))))
    rows = rows.withColumn("head", L.page_head(F.col("blocks"), F.col("word_heads") & F.lit(whole_words)))
    return rows.withColumn("blocks", F.when(F.col("margin_notes"), L.without_margin_notes(F.col("blocks"))).otherwise(F.col("blocks")))


def opening_letters(pages: DataFrame) -> DataFrame:
    """(identifier, alpha0): from the volume's range without its part, or from its trigrams, or A."""
    trigrams = pages.where("head.trigram is not null").select("identifier", "idx", F.col("head.trigram").alias("t")).where(~F.col("t").rlike(X.ROMAN_NUMERAL))
    found = S.opening(trigrams.withColumn("v", F.left("t", F.lit(1))), _V, ["idx"], "v")
    own = F.left(X.key(F.regexp_replace("alpha_range", r"(?i)^Part\s*\w+\s*,\s*", "")), F.lit(1))
    volumes = pages.groupBy("identifier").agg(F.max("alpha_range").alias("alpha_range"))
    return volumes.join(found, "identifier", "left").select("identifier", F.coalesce(F.nullif(own, F.lit("")), "opening", F.lit("A")).alias("alpha0"))


def _pieces(b: Column) -> Column:
    """A block's paragraphs as (para, line, n_lines, text, html, p); run-on paragraphs are one piece a line."""

    def of_one(p: Column, i: Column) -> Column:
        lines = F.coalesce(X.run_on_lines(p["text"]), F.array(p["text"]))
        made = lambda t, j, n: F.struct(i.cast("int").alias("para"), j.cast("int").alias("line"), n.alias("n_lines"), t.alias("text"), F.when(n > 1, F.lit("")).otherwise(p["html"]).alias("html"), p.alias("p"))
        return X.let(lines, lambda held: F.transform(held, lambda t, j: made(t, j, F.size(held))))

    return F.flatten(F.transform(b["paras"], of_one))


def stream(pages: DataFrame) -> DataFrame:
    """The ordered stream of pages' pieces: (identifier, idx, block, para, line) with text, html, and hw where one opens.

    Paragraphs, which may open a record, come from blocks of PARAGRAPH_LABELS; a block of APPENDED_LABELS is one piece
    that only adds to what is open. Pages may carry a span (``start``, ``title_key``): in it every block but heads and
    feet of pages is one piece (``in_span``). A span begins at its banner where its first page has a trigram, which is
    what comes before belongs to the dictionary; without the banner, all of that page does.
    """
    if "start" not in pages.columns:
        pages = pages.withColumns({"start": F.lit(None).cast("int"), "title_key": F.lit(None).cast("string")})
    carried = ["identifier", "idx", "image", "head", "start", "title_key", *[c for c in ("end", "title") if c in pages.columns]]
    found = F.filter(F.transform("blocks", lambda b, i: F.when(L.is_banner(b, F.col("title_key")), i)), lambda i: i.isNotNull())
    first = F.when(F.col("head.trigram").isNull(), F.lit(0)).otherwise(F.coalesce(F.get(found, F.lit(0)), F.size("blocks")))
    pages = pages.withColumn("span_block", F.when(F.col("start").isNull(), F.size("blocks")).when(F.col("idx") > F.col("start"), F.lit(0)).otherwise(first))
    rows = pages.select(*carried, "span_block", F.posexplode("blocks").alias("block", "b")).withColumn("in_span", F.col("block") >= F.col("span_block"))
    b = F.col("b")
    whole = F.array(F.struct(F.lit(-1).alias("para"), F.lit(-1).alias("line"), F.lit(1).alias("n_lines"), b["text"].alias("text"), b["html"].alias("html"), F.get(F.slice(b["paras"], 1, 0), F.lit(0)).alias("p")))
    taken = (F.col("in_span") & ~b["label"].isin(MARGINAL_LABELS)) | (~F.col("in_span") & b["label"].isin(APPENDED_LABELS))
    rows = rows.withColumn("piece", F.explode(F.when(taken, whole).when(~F.col("in_span") & b["label"].isin(PARAGRAPH_LABELS), _pieces(b))))
    rows = rows.select(*carried, "block", "in_span", b["label"].alias("label"), b["box"].alias("box"), "piece.*")
    own = X.headword(F.col("p.text"), F.col("p.bold"), F.col("p.bold_tail"), F.col("p.lead"), F.col("head.trigram"))
    hw = F.when(F.col("para") >= 0, F.when(F.col("n_lines") > 1, X.run_on_headword(F.col("text"), F.col("head.trigram"))).otherwise(own))
    # A line that opens a record is a paragraph of its own.
    return rows.withColumn("hw", hw).withColumn("html", F.when((F.col("n_lines") > 1) & F.col("hw").isNotNull(), F.concat(F.lit("<p>"), "text", F.lit("</p>"))).otherwise(F.col("html")))


def body_starts(pages: DataFrame) -> DataFrame:
    """(identifier, body_start, opener, multivol): where a volume's entries begin, which is the first page with a
    headword of its opening letter in a text block, else its first page; and the key of what its range begins with."""
    heads = paragraphs(pages).where((F.col("label") == "Text") & F.col("hw").isNotNull()).join(opening_letters(pages), "identifier")
    first = heads.where(F.left("hw.base", F.lit(1)) == F.col("alpha0")).groupBy("identifier").agg(F.min("idx").alias("first"))
    span = F.regexp_replace("alpha_range", r"(?i)^\s*Part\s+[\dIVXLC]+\s*,\s*", "")
    opener = F.when(F.col("alpha_range").isNotNull(), X.key(F.get(F.split(span, "-"), F.lit(0))))
    volumes = pages.withColumn("opener", opener).groupBy("identifier").agg(F.min("idx").alias("least"), F.max("opener").alias("opener"), F.bool_or("multivol").alias("multivol"))
    return volumes.join(first, "identifier", "left").select("identifier", F.coalesce("first", "least").alias("body_start"), "opener", "multivol")


def read_from(bodies: DataFrame, spans: DataFrame) -> DataFrame:
    """(identifier, body_start): where reading begins. A volume of a set may open in the middle of a treatise, which its
    range then names; one without a range opens with its first treatise before the body."""
    early = bodies.where("multivol").join(spans.select("identifier", "start", "title_key"), "identifier").where(F.col("start") < F.col("body_start"))
    named = (F.length("opener") >= 4) & (F.left("title_key", F.lit(5)) == F.left("opener", F.lit(5)))
    lead = early.where(F.col("opener").isNull() | named).groupBy("identifier").agg(F.min("start").alias("lead"))
    return bodies.join(lead, "identifier", "left").select("identifier", F.coalesce("lead", "body_start").alias("body_start"))


def paragraphs(pages: DataFrame) -> DataFrame:
    """One row a paragraph: its place, page, block and text; run-on paragraphs one row a line."""
    return stream(pages).where("para >= 0")


def treatise_spans(pages: DataFrame, starts: DataFrame) -> DataFrame:
    """(identifier, start, end, title_key, title): gaps of two trigrams or more whose pages have a running head or banner.

    ``starts`` has the page (idx) where a volume's body begins; gaps are cut there. Spans of one title that
    follow within three pages are one.
    """
    body = pages.join(starts, "identifier").where(F.col("idx") >= F.col("body_start"))
    w = Window.partitionBy(*_V).orderBy("idx")
    island = F.sum(F.col("head.trigram").isNotNull().cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    name = X.key(F.col("head.running"))
    counts = (F.length(name) >= 4) & ~name.rlike("^(?:PLATE|FIG|PART|CHAP|SECT)")
    gaps = body.withColumn("island", island).where("head.trigram is null").withColumn("name", F.when(counts, name))
    spans = gaps.groupBy("identifier", "island").agg(F.min("idx").alias("lo"), F.max("idx").alias("hi")).where(F.col("hi") > F.col("lo"))
    tally = gaps.where("name is not null").groupBy("identifier", "island", "name").agg(F.count("*").alias("n"), F.min("idx").alias("first"))
    best = tally.groupBy("identifier", "island").agg(F.max(F.struct("n", (-F.col("first")).alias("f"), "name")).alias("m")).select("identifier", "island", F.col("m.name").alias("name"), F.col("m.n").alias("n"))
    spans = spans.join(best, ["identifier", "island"], "left")
    near = pages.select("identifier", "idx", "blocks")
    for suffix, at in (("0", F.col("lo") - 1), ("1", F.col("lo"))):
        page = near.select("identifier", F.col("idx").alias(f"idx{suffix}"), F.col("blocks").alias(f"blocks{suffix}"))
        spans = spans.withColumn(f"idx{suffix}", at).join(page, ["identifier", f"idx{suffix}"], "left")
    before, here = _banner("blocks0"), _banner("blocks1")
    named = F.coalesce(F.col("n") >= 2, F.lit(False))
    found = before.isNotNull() | here.isNotNull()
    first = named & ((F.length("name") >= 5) | found)
    second = ~named & (F.col("hi") - F.col("lo") >= 3)
    large1, large0 = _capital("blocks1"), _capital("blocks0")
    title = F.when(first, F.coalesce(before, here, F.col("name"))).when(second, F.coalesce(large1, large0))
    title_key = F.when(first, F.col("name")).otherwise(X.key(title))
    start = F.when(first & before.isNotNull(), F.col("lo") - 1).when(second & large1.isNull() & large0.isNotNull(), F.col("lo") - 1).otherwise(F.col("lo"))
    out = spans.select("identifier", start.alias("start"), F.col("hi").alias("end"), title_key.alias("title_key"), X.display_title(title).alias("title")).where("title is not null")
    merged = S.merged_spans(out.select("identifier", "start", "end", "title_key"), _V, "title_key")
    return merged.join(out.select("identifier", "start", "title"), ["identifier", "start"]).select("identifier", "start", "end", "title_key", "title")


def _banner(blocks: str) -> Column:
    return F.when(F.col(blocks).isNotNull(), L.banner(F.col(blocks), F.col("name")))


def _capital(blocks: str) -> Column:
    return F.when(F.col(blocks).isNotNull(), L.capital_banner(F.col(blocks)))


def in_spans(pages: DataFrame, spans: DataFrame) -> DataFrame:
    """Pages with the span they lie in (start, end, title_key, title; nulls outside): the last one that began, if it
    hasn't ended. One look-up by the first page and a running value; no join of ranges."""
    begun = pages.join(spans.select("identifier", F.col("start").alias("idx"), F.struct("start", "end", "title_key", "title").alias("span")), ["identifier", "idx"], "left")
    last = F.last("span", ignorenulls=True).over(Window.partitionBy(*_V).orderBy("idx"))
    begun = begun.withColumn("span", last).withColumn("span", F.when(F.col("span.end") >= F.col("idx"), F.col("span")))
    return begun.select("*", "span.*").drop("span")


def records(pages: DataFrame, spans: DataFrame, starts: DataFrame) -> DataFrame:
    """Raw records in order: (identifier, seq, headword fields, first and last pages, body, images).

    Plates are left out unless they lie in a treatise. A treatise holds all its blocks; an entry its paragraphs and
    the tables, equations, captions and notes after them. What follows a treatise before a headword is nobody's.
    """
    placed = in_spans(pages.join(starts, "identifier").where(F.col("idx") >= F.col("body_start")), spans)
    lines = stream(placed.where((F.col("head.mode") != "plate") | F.col("start").isNotNull()))
    order = ["idx", "block", "para", "line"]
    w = Window.partitionBy(*_V).orderBy(*order)
    lines = lines.withColumn("before", F.lag(F.when(F.col("in_span"), F.col("start")).otherwise(F.lit(-1))).over(w))
    new_span = F.col("in_span") & ~F.col("before").eqNullSafe(F.col("start"))
    leaves = ~F.col("in_span") & F.coalesce(F.col("before") >= 0, F.lit(False)) & F.col("hw").isNull()
    opens = new_span | (~F.col("in_span") & F.col("hw").isNotNull()) | leaves
    found = S.segments(lines.withColumns({"opens": opens, "closed": leaves}), _V, order, F.col("opens"))
    place = F.struct(*order)
    first = lambda c: F.min_by(c, place)
    page_no = F.col("head.page_no")
    head_place = F.when(~F.col("in_span") | (F.col("label") == "Section-Header"), place)
    out = found.groupBy("identifier", F.col("segment").alias("seq")).agg(
        first("hw").alias("hw"),
        first("title").alias("title"),
        first("image").alias("first_image"),
        F.min_by("box", head_place).alias("box"),
        first("in_span").alias("treatise"),
        F.bool_or("closed").alias("closed"),
        first("start").alias("span_start"),
        first("end").alias("span_end"),
        first(page_no).alias("opening_page"),
        F.min_by(page_no, F.when(page_no.isNotNull(), place)).alias("first_page"),
        F.max_by(page_no, F.when(page_no.isNotNull(), place)).alias("printed_page_end"),
        F.min("idx").alias("lo"),
        F.max("idx").alias("hi"),
        F.array_sort(F.collect_list(F.struct(place.alias("o"), X.clean(F.col("text")).alias("t"), F.col("html").alias("h")))).alias("parts"),
        F.transform(F.array_sort(F.collect_set(F.struct("idx", "image"))), lambda x: x["image"]).alias("image_files"),
    )
    # A treatise is headed by its first page, even where its text begins on the next.
    images = pages.select("identifier", F.col("idx").alias("span_start"), F.col("image").alias("span_image"))
    out = out.join(images, ["identifier", "span_start"], "left")
    out = out.withColumns({
        "headword_image": F.when(F.col("treatise"), F.col("span_image")).otherwise(F.col("first_image")),
        "image_page_start": F.when(F.col("treatise"), F.col("span_start")).otherwise(F.col("lo")),
        "image_page_end": F.when(F.col("treatise"), F.col("span_end")).otherwise(F.col("hi")),
    })
    # Text after a treatise that no headword opens belongs to nothing.
    out = out.where("not closed")
    name = F.when(F.col("treatise"), F.col("title")).otherwise(F.col("hw.full"))
    text = F.array_join(F.filter(F.transform("parts", lambda x: x["t"]), lambda t: t != ""), " ")
    return out.select(
        "identifier",
        "seq",
        name.alias("headword"),
        F.when(F.col("treatise"), F.col("title")).otherwise(F.col("hw.base")).alias("base_headword"),
        F.when(~F.col("treatise"), F.col("hw.qualifier")).alias("qualifier"),
        F.when(F.col("treatise"), "treatise").otherwise(F.col("hw.type")).alias("type"),
        F.when(F.col("treatise"), "treatise").otherwise(F.col("hw.detected_by")).alias("detected_by"),
        F.when(F.col("treatise"), F.col("first_page")).otherwise(F.col("opening_page")).alias("printed_page_start"),
        "printed_page_end",
        "image_page_start",
        "image_page_end",
        X.clean(text).alias("body_text"),
        F.array_join(F.filter(F.transform("parts", lambda x: x["h"]), lambda h: h != ""), "\n").alias("body_html"),
        F.array_distinct(F.filter("image_files", lambda i: i.isNotNull())).alias("image_files"),
        F.when(F.col("box").isNotNull(), F.array(*[F.col(f"box.{k}") for k in ("x1", "y1", "x2", "y2")])).alias("headword_bbox"),
        "headword_image",
    )


def outlines(pages: DataFrame, spans: DataFrame) -> DataFrame:
    """(identifier, start, outline): the lower headings of a span's pages in order."""
    own = pages.join(spans.select("identifier", "start", "end"), "identifier").where((F.col("idx") >= F.col("start")) & (F.col("idx") <= F.col("end")))
    own = own.select("identifier", "start", F.struct("idx", L.outline(F.col("blocks"), F.col("head.page_no"), F.col("idx")).alias("o")).alias("e"))
    listed = own.groupBy("identifier", "start").agg(F.array_sort(F.collect_list("e")).alias("l"))
    return listed.select("identifier", "start", F.flatten(F.transform("l", lambda x: x["o"])).alias("outline"))


def cleaned(rows: DataFrame) -> DataFrame:
    """Records without repeats, catchwords and stubs; errata lists become records of their own."""
    rows = rows.withColumns({"is_cross_reference": X.is_redirect(F.col("headword"), F.col("body_text")) & (F.col("type") != "treatise"), "cross_refs": F.slice(X.cross_references(F.col("body_text")), 1, 50)})
    rows = S.without_repeats(rows, _V, ["seq"], ["headword", "body_text"])
    rows = rows.withColumn("body_text", X.without_catchword(F.col("body_text")))
    at = F.regexp_instr("body_text", F.lit(X.ERRATA))
    many = (F.regexp_count("body_text", F.lit(X.ERRATA)) >= 3) & (at > 31)
    own = F.struct(F.lit(0).alias("sub_seq"), F.when(many, F.trim(F.regexp_replace(F.left("body_text", at - 1), r"\s+\d?\s*[A-Z]\s*$", ""))).otherwise(F.col("body_text")).alias("body_text"), "headword", "base_headword", "type", "detected_by")
    errata = F.when(many, F.struct(F.lit(1).alias("sub_seq"), F.substr("body_text", at).alias("body_text"), F.lit("ERRATA").alias("headword"), F.lit("ERRATA").alias("base_headword"), F.lit("errata").alias("type"), F.lit("errata").alias("detected_by")))
    rows = rows.withColumn("r", F.explode(F.array_compact(F.array(own, errata)))).drop("body_text", "headword", "base_headword", "type", "detected_by").select("*", "r.*").drop("r")
    stub = F.btrim("body_text", F.lit(" .,")) == F.btrim("headword", F.lit(" .,"))
    rows = S.without_stubs(rows, _V, ["seq", "sub_seq"], "base_headword", stub, F.col("type").isin("treatise", "errata"))
    return rows.withColumn("char_count", F.length("body_text"))


def volume_articles(pages: DataFrame, volumes: DataFrame) -> DataFrame:
    """Articles of dictionary volumes: pages and the volumes' manifest in, clean records out."""
    wanted = volumes.where(~is_index(F.col("volume_num"), F.col("volume_label"), F.col("title")) & ~is_dissertation(F.col("alpha_range"), F.col("volume_label")))
    # Pages are asked for by bodies, spans, records and outlines: they are parsed once.
    table = settled(page_table(pages, wanted))
    bodies = body_starts(table)
    spans = treatise_spans(table, bodies.select("identifier", F.when(F.col("multivol"), F.lit(0)).otherwise(F.col("body_start")).alias("body_start")))
    out = cleaned(records(table, spans, read_from(bodies, spans)))
    told = outlines(table, spans).select("identifier", F.col("start").alias("image_page_start"), F.lit("treatise").alias("type"), "outline")
    out = out.join(told, ["identifier", "image_page_start", "type"], "left")
    return out.join(wanted.select("identifier", "eb_code", "volume_num", "alpha_range"), "identifier")


def volume_dissertations(pages: DataFrame, volumes: DataFrame) -> DataFrame:
    """One treatise for each dissertation of the volumes of dissertations, with the columns of volume_articles.

    Everything but page heads and feet belongs to it; nothing is cleaned up after, as such volumes have no entries.
    """
    wanted = volumes.where(is_dissertation(F.col("alpha_range"), F.col("volume_label")) & ~is_index(F.col("volume_num"), F.col("volume_label"), F.col("title")))
    # A dissertation is known by its whole head, which a trigram would hide.
    table = page_table(pages, wanted, whole_words=False)
    bounds = dissertations(table)
    own = table.join(bounds, "identifier").where((F.col("idx") >= F.col("start")) & (F.col("idx") <= F.col("end")))
    held = F.filter("blocks", lambda b: ~b["label"].isin("Page-Header", "Page-Footer"))
    page = F.struct("idx", F.col("head.page_no").alias("page_no"), "image", held.alias("blocks"))
    told = own.groupBy("identifier", "ordinal", "start", "end").agg(F.array_sort(F.collect_list(page)).alias("pages"))
    told = told.join(outlines(table, bounds), ["identifier", "start"], "left")
    blocks = F.flatten(F.transform("pages", lambda p: p["blocks"]))
    numbers = F.filter(F.transform("pages", lambda p: p["page_no"]), lambda n: n.isNotNull())
    box = F.get(blocks, F.lit(0))["box"]
    name = F.concat(F.lit("DISSERTATION "), F.get(F.array(*[F.lit(o.upper()) for o in X.ORDINALS]), F.col("ordinal") - 1))
    body = X.clean(F.array_join(F.transform(blocks, lambda b: b["text"]), " "))
    told = told.select(
        "identifier", F.col("ordinal").cast("bigint").alias("seq"), F.lit(0).alias("sub_seq"), name.alias("headword"), name.alias("base_headword"), F.lit(None).cast("string").alias("qualifier"),
        F.lit("treatise").alias("type"), F.lit("treatise").alias("detected_by"), F.get(numbers, F.lit(0)).alias("printed_page_start"), F.element_at(F.concat(F.array(F.lit(None).cast("int")), numbers), -1).alias("printed_page_end"),
        F.col("start").alias("image_page_start"), F.col("end").alias("image_page_end"), body.alias("body_text"), F.array_join(F.transform(blocks, lambda b: b["html"]), "\n").alias("body_html"),
        F.array_distinct(F.filter(F.transform("pages", lambda p: p["image"]), lambda i: i.isNotNull())).alias("image_files"), F.when(box.isNotNull(), F.array(*[box[k] for k in ("x1", "y1", "x2", "y2")])).alias("headword_bbox"),
        F.get(F.transform("pages", lambda p: p["image"]), F.lit(0)).alias("headword_image"), "outline", F.lit(False).alias("is_cross_reference"),
    )
    told = told.withColumns({"cross_refs": F.slice(X.cross_references(F.col("body_text")), 1, 50), "char_count": F.length("body_text")})
    return told.join(wanted.select("identifier", "eb_code", "volume_num", "alpha_range"), "identifier")


def volume_records(pages: DataFrame, volumes: DataFrame) -> DataFrame:
    """Records of all volumes but indexes: articles of dictionaries, treatises of volumes of dissertations."""
    articles, essays = volume_articles(pages, volumes), volume_dissertations(pages, volumes)
    return articles.unionByName(essays.select(*[F.col(c).cast(t).alias(c) for c, t in articles.dtypes]))


def dissertations(pages: DataFrame) -> DataFrame:
    """(identifier, ordinal, start, end) of volumes of dissertations: bounds open on ever higher ordinals only,
    the first one right after the front matter."""
    ranked = pages.withColumn("rank", X.dissertation_ordinal(F.col("head.running")))
    bounds = S.rising(ranked, _V, ["idx"], "rank").select("identifier", "rank", F.col("idx").alias("start"))
    first = bounds.groupBy("identifier").agg(F.min("start").alias("first"))
    running = X.key(F.col("head.running"))
    front = pages.join(first, "identifier").where((F.col("idx") < F.col("first")) & (running.rlike("^(?:INDEX|TABLE|CONTENTS|OMISSION|ERRAT|BRITANNIA|EB)") | running.rlike("^[IVXLCDM]+$")))
    front = front.groupBy("identifier").agg(F.max("idx").alias("front"))
    has_body = F.exists("blocks", lambda b: b["label"].isin(BODY_LABELS))
    last = pages.groupBy("identifier").agg(F.coalesce(F.max(F.when(has_body, F.col("idx"))), F.max("idx")).alias("last"))
    out = bounds.join(first, "identifier").join(front, "identifier", "left").join(last, "identifier")
    start = F.when((F.col("start") == F.col("first")) & F.col("front").isNotNull() & (F.col("front") < F.col("first") - 1), F.col("front") + 1).otherwise(F.col("start"))
    after = F.lead("start").over(Window.partitionBy(*_V).orderBy("start"))
    return out.select("identifier", F.col("rank").alias("ordinal"), start.alias("start"), F.coalesce(after - 1, "last").alias("end"))
