import random

import pytest
from pyspark.sql import functions as F

from quire.operators import articles as A
from quire.operators import layout as L
from quire.operators import repairs as P
from quire.operators import reports as Q
from quire.operators import vocabulary as V


def test_suggestions_equal_a_loop(spark):
    random.seed(4)
    words = sorted({"AB" + "".join(random.choice("ABC") for _ in range(random.randint(2, 4))) for _ in range(90)})
    vocab = {w: sorted(random.sample(["e1", "e2", "e3"], random.choice([1, 1, 2, 3]))) for w in words}

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    wanted = set()
    for i, w in enumerate(words):
        if len(vocab[w]) > 1:
            continue
        found = []
        for c in words[max(0, i - 30) : i + 30]:
            lead = max(2, -(-min(len(w), len(c)) // 2))
            if len(vocab[c]) > 1 and abs(len(w) - len(c)) <= 2 and distance(w, c) <= 2 and w[:lead] == c[:lead] and vocab[w][0] not in vocab[c]:
                found.append((distance(w, c), -len(vocab[c]), c))
        wanted |= {(w, c, d) for d, _, c in sorted(found)[:4]}
    table = spark.createDataFrame([(w, e, len(e)) for w, e in vocab.items()], "key string, editions array<string>, n_editions bigint")
    assert {(r.variant, r.canonical, r.edit_distance) for r in V.suggestions(table).collect()} == wanted


def test_fixes_are_idempotent_and_reversible(spark):
    rows = spark.createDataFrame([(1, "OLD MAN"), (2, "OTHER"), (3, None)], "k int, v string")
    fixes = spark.createDataFrame([(1, "OLD", "NEW")], "k int, old string, new string")
    once = P.fixed(rows, fixes, ["k"], "v")
    twice = P.fixed(once, fixes, ["k"], "v")
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {r.k: r.v for r in twice.collect()} == {1: "NEW MAN", 2: "OTHER", 3: None}
    assert {r.k: r.v for r in P.reverted(twice, "v").collect()} == {1: "OLD MAN", 2: "OTHER", 3: None}


def test_split_conserves_the_text(spark):
    body = "p" * 200 + " FIRST " + "a" * 60 + " SECOND " + "b" * 60 + " THIRD x"
    rows = spark.createDataFrame([(1, body), (2, "short FIRST rest of it"), (3, "whole")], "id int, body string")
    points = spark.createDataFrame([(1, "F", "FIRST"), (1, "S", "SECOND"), (1, "T", "THIRD"), (1, "X", "absent"), (2, "F", "FIRST")], "id int, name string, start_text string")
    got = P.split(rows, points).orderBy("id", "part").collect()
    one = [r for r in got if r.id == 1]
    assert "".join(r.body for r in one) == body
    assert [r.name for r in one] == [None, "F", "S", "T"]
    # A point before the tenth character is no split; the row stays whole.
    assert [(r.name, r.body) for r in got if r.id == 2] == [(None, "short FIRST rest of it")]
    assert [(r.name, r.body) for r in got if r.id == 3] == [(None, "whole")]


def test_small_parent_is_relabelled_and_keeps_what_it_said(spark):
    rows = spark.createDataFrame([(1, "tiny parent. FIRST rest")], "id int, body string")
    points = spark.createDataFrame([(1, "F", "FIRST")], "id int, name string, start_text string")
    (got,) = P.split(rows, points).collect()
    assert (got.name, got.body, got.relabelled, got.discarded) == ("F", "FIRST rest", True, "tiny parent. ")


def test_decisions(spark):
    candidates = spark.createDataFrame([(0, [("A",)]), (1, [("B",)])], "i int, suggestions array<struct<norm:string>>")
    decisions = spark.createDataFrame([(0, 1, "keep", None), (0, 2, "correct", "A"), (1, 1, "correct", "Z")], "i int, seq int, decision string, canonical string")
    assert [(r.i, r.canonical) for r in P.decided(candidates, decisions, ["i"]).collect()] == [(0, "A")]


@pytest.mark.parametrize(
    ("args", "wanted"),
    [
        (("HARE", "HARE.", "article", False, 1, 2, 5), ["empty-body"]),
        (("HARE", "HARE, a b", "article", False, 5, 3, 9), ["fragment", "page-end<start"]),
        (("A", "one two three four five", "article", False, 0, 90, 30000), ["long-maybe-bleed"]),
        (("A", "one two three four five", "treatise", False, 1, 90, 30000), []),
        (("A", "one two three four five", "article", False, 1, 90, None), ["page-span-large"]),
    ],
)
def test_problem_flags(spark, args, wanted):
    kinds = ["string", "string", "string", "boolean", "int", "int", "int"]
    columns = [F.lit(a).cast(k) for a, k in zip(args, kinds, strict=True)]
    assert spark.range(1).select(Q.problems(*columns).alias("v")).first().v == wanted


def block(label, box, inner):
    return f'<div data-label="{label}" data-bbox="{box}">{inner}</div>'


def page(number, head, *paras):
    return block("Page-Header", "0 0 500 20", f"{head}") + block("Page-Header", "500 0 600 20", f"( {number} )") + "".join(block("Text", "120 30 520 90", f"<p>{p}</p>") for p in paras)


def test_blocks(spark):
    raw = '<div data-label="Text" data-bbox="1 2 3 x"><p><b>ABACUS</b>, a <i>table</i><br>more<div data-label="Table"><p>in</div></div>'
    got = spark.createDataFrame([(raw,), (None,), ("",)], "raw string").select(L.boxed(L.blocks("raw")).alias("b")).collect()
    first = got[0].b
    assert [b.label for b in first] == ["Text", "Table"]
    assert first[0].box is None
    assert (first[0].paras[0].bold, first[0].paras[0].text.startswith("ABACUS, a table")) == ("ABACUS", True)
    assert got[1].b == [] and got[2].b == []


def test_margin_notes_and_heads(spark):
    raw = page(7, "A B A", "ABACUS, a table") + block("Text", "20 30 90 60", "<p>gloss</p>") + block("Text", "300 30 330 60", "<p>T</p>")
    df = spark.createDataFrame([(raw,)], "raw string").select(L.boxed(L.blocks("raw")).alias("b"))
    row = df.select(L.page_head(F.col("b"), F.lit(False)).alias("h"), F.size(L.without_margin_notes(F.col("b"))).alias("n"), F.size("b").alias("m")).first()
    assert (row.h.page_no, row.h.mode, row.h.trigram) == (7, "dict", "ABA")
    assert row.m - row.n == 1


def test_articles_of_a_volume(spark):
    pages = [
        ("v", 0, "0.jpg", page(1, "ABA", "stray text", "<b>ABACUS</b>, a table for counting with stones and beads of many kinds.")),
        ("v", 1, "1.jpg", page(2, "ABA", "It goes on here.", "ABADDON, a place. See HELL.")),
        ("v", 2, "2.jpg", page(3, "ALGEBRA", "A science.") + block("Section-Header", "1 1 2 2", "<h2>ALGEBRA</h2>")),
        ("v", 3, "3.jpg", page(4, "ALGEBRA", "More of it.")),
        ("v", 4, "4.jpg", page(5, "AMB", "<b>AMBER</b>, a resin that is found upon the shore of the sea.", "AMBLE, in riding. See PACE.") + block("Section-Header", "1 1 2 2", "<h3>Not of a span</h3>")),
    ]
    table = spark.createDataFrame(pages, "identifier string, idx int, image string, raw string")
    volumes = spark.createDataFrame([("v", "EB.1", 1, "A-B", None, "t")], "identifier string, eb_code string, volume_num int, alpha_range string, volume_label string, title string")
    got = {r.headword: r for r in A.volume_articles(table, volumes).collect()}
    assert set(got) == {"ABACUS", "ABADDON", "ALGEBRA", "AMBER", "AMBLE"}
    assert got["ABACUS"].body_text.endswith("It goes on here.")
    assert (got["ABACUS"].printed_page_start, got["ABACUS"].printed_page_end) == (1, 2)
    # "a place" is a definition, so ABADDON is more than a reference; AMBLE is not.
    assert not got["ABADDON"].is_cross_reference and got["ABADDON"].cross_refs == ["HELL"]
    assert got["AMBLE"].is_cross_reference and got["AMBLE"].cross_refs == ["PACE"] and got["AMBLE"].outline is None
    assert got["AMBER"].headword_image == "4.jpg" and len(got["AMBER"].headword_bbox) == 4
    assert (got["ALGEBRA"].type, got["ALGEBRA"].image_page_start, got["ALGEBRA"].image_page_end) == ("treatise", 2, 3)
    assert got["AMBER"].type == "article" and got["ALGEBRA"].outline == []


def test_dissertations_of_a_volume(spark):
    pages = [
        ("d", 0, "0.jpg", page(1, "INDEX", "of matters")),
        ("d", 1, "1.jpg", page(2, "PRELIMINARY DISSERTATIONS", "Half title.")),
        ("d", 2, "2.jpg", page(3, "DISSERTATION FIRST", "One begins.") + block("Section-Header", "1 1 2 2", "<h3>O F M I N D</h3>")),
        ("d", 3, "3.jpg", page(4, "DISSERTATION SECOND", "Two begins. See MORALS.")),
        ("d", 4, "4.jpg", page(5, "DISSERTATION FIRST", "Two goes on.")),
    ]
    table = spark.createDataFrame(pages, "identifier string, idx int, image string, raw string")
    volumes = spark.createDataFrame([("d", "EB.15", 1, "Preliminary dissertations", None, "t")], "identifier string, eb_code string, volume_num int, alpha_range string, volume_label string, title string")
    got = A.volume_records(table, volumes).orderBy("seq").collect()
    assert [(r.headword, r.type, r.printed_page_start, r.printed_page_end, r.image_page_start, r.image_page_end) for r in got] == [("DISSERTATION FIRST", "treatise", 2, 3, 1, 2), ("DISSERTATION SECOND", "treatise", 4, 5, 3, 4)]
    assert got[0].body_text.startswith("Half title. One begins.") and got[1].body_text == "Two begins. See MORALS. Two goes on." and got[1].cross_refs == ["MORALS"]
    assert [(o.level, o.label, o.printed_page, o.image_page) for o in got[0].outline] == [(3, "OFMIND", 3, 2)] and got[0].image_files == ["1.jpg", "2.jpg"]


def test_dissertation_bounds(spark):
    heads = ["INDEX", "PRELIMINARY", "DISSERTATION FIRST", "x", "DISSERTATION SECOND", "DISSERTATION FIRST"]
    rows = [("v", i, (h,), [("Text",)]) for i, h in enumerate(heads)]
    pages = spark.createDataFrame(rows, "identifier string, idx int, head struct<running:string>, blocks array<struct<label:string>>")
    got = A.dissertations(pages).orderBy("ordinal").collect()
    assert [(r.ordinal, r.start, r.end) for r in got] == [(1, 1, 3), (2, 4, 5)]
