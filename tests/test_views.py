import pytest

from quire import schemas
from quire.operators import provenance as N
from quire.operators import reports as Q
from quire.sources import sinks

PAGES = "printed_page_start int, printed_page_end int, image_page_start int, image_page_end int"


def test_records_are_completed_once(spark):
    rows = [
        # k, headword, base, qualifier, pages, expected qualifier, end page and the page it replaced
        (1, " PEAR (in botany) ", "PEAR", None, 10, 11, 4, 5, "in botany", 11, None),
        (2, "Pear (Tree) (a fruit)", "PEAR", "", 10, 61, 4, 5, "a fruit", 61, None),
        (3, "PEAR (a fruit)", "PEAR", "kept", 10, 62, 4, 5, "kept", 11, 62),
        (4, "PEAR (a fruit)", "Pear", None, 10, 9, 4, 4, None, 10, 9),
        (5, "PEAR (a fruit)", "APPLE", None, 10, 9, None, 4, None, 9, None),
        (6, "PEAR (a fruit) tree", "PEAR", None, None, 9, 4, 4, None, 9, None),
        (7, None, None, None, 10, None, 4, 4, None, None, None),
        (8, "(a fruit)", "PEAR", None, 10, 60, 0, 0, None, 60, None),
        (9, "P (letter)", "P", None, 10, 10, 0, 0, None, 10, None),
    ]
    records = spark.createDataFrame([r[:8] for r in rows], f"k int, headword string, base_headword string, qualifier string, {PAGES}")
    once = N.completed(records)
    got = {r.k: (r.qualifier, r.printed_page_end, r.provenance.raw_printed_page_end) for r in once.collect()}
    assert got == {r[0]: r[8:] for r in rows}
    twice = N.completed(once)
    assert sorted(map(str, twice.select(*once.columns).collect())) == sorted(map(str, once.collect()))
    assert N.completed(records.limit(0)).count() == 0


@pytest.fixture
def shown(spark):
    long = "y" * (Q.TREATISE_SHOWN + 5)
    base = dict.fromkeys(("qualifier", "detected_by", "volume_num", "eb_code", "identifier", "alpha_range", "image_page_start", "image_page_end", "body_html", "outline", "provenance"))
    made = [
        ("A", "treatise", None, 1, 90, long, len(long)),
        ("B", "article", True, 1, 2, "See A.", 6),
        ("C", "article", False, 5, 3, "C is told of in five words or more, Part of it.", 47),
        ("D", "article", None, 5, 50, "D is told of in five words or more.", 30_000),
        ("E", "xref", False, 0, 3, "E.", 2),
        (None, "article", False, None, None, None, None),
        ("G", "article", False, 1, 1, "G has nothing wrong with it, being short and PART of this.", 57),
    ]
    rows = [base | dict(headword=h, base_headword=h, type=t, is_cross_reference=x, printed_page_start=a, printed_page_end=b, body_text=body, char_count=n, cross_refs=None) for h, t, x, a, b, body, n in made]
    return Q.viewer_rows(spark.createDataFrame(rows, schemas.ARTICLES))


def test_viewer_rows_say_what_is_wrong_and_what_is_cut(shown):
    got = {r.headword: r for r in shown.collect()}
    assert {h: r.flags for h, r in got.items()} == {
        "A": [], "B": [], "C": ["page-end<start"], "D": ["page-span-large", "long-maybe-bleed"], "E": ["empty-body"], None: ["empty-body"], "G": [],
    }
    whole = Q.TREATISE_SHOWN + 5
    assert got["A"].body == "y" * Q.TREATISE_SHOWN + f" …[treatise body truncated in viewer — full {whole} chars in JSONL]"
    assert (got["B"].xref, got["C"].xref, got["D"].xref, got[None].body, got["A"].refs, got["A"].outline, got["A"].img) == (True, False, False, "", [], 0, None)


def test_viewer_leaves_out_references_and_sound_records_where_asked(shown):
    seen = lambda **k: {r.headword for r in Q.viewed(shown, "headword", "body", **k).collect()}
    assert seen() == {"A", "B", "C", "D", "E", None, "G"}
    assert seen(redirect="xref") == {"A", "C", "D", "E", None, "G"}
    assert seen(flags="flags") == {"C", "D", "E", None}
    assert seen(text=" part ") == {"C", "G"}
    assert seen(kinds=["article"], kind="type", redirect="xref", flags="flags", text="PART") == {"C"}


def test_volumes_are_planned_in_the_order_of_the_manifest(spark):
    rows = [("v9", "EB.10", 1, 5), ("v1", "EB.2", 2, 7), ("v2", "EB.2", None, 8), ("v0", None, 1, 1), ("v3", "EB.2", 2, None), ("v5", "EB.4", 1, 2)]
    volumes = spark.createDataFrame(rows, "identifier string, eb_code string, volume_num int, n_images bigint")
    plan = sinks.planned(volumes, 2)
    assert {r.identifier: r.chunk for r in plan.collect()} == {"v2": 0, "v1": 0, "v3": 1, "v5": 1, "v9": 2, "v0": 2}
    assert sorted(map(tuple, sinks.plan_report(plan).collect())) == [(0, 2, 15, "EB.2"), (1, 2, 2, "EB.2,EB.4"), (2, 2, 6, "?,EB.10")]
    assert {r.identifier: r.chunk for r in sinks.planned(volumes, 3, ["EB.10", "EB.2"]).collect()} == {"v2": 0, "v1": 0, "v3": 0, "v9": 1}
    assert sinks.plan_report(sinks.planned(volumes.limit(0))).count() == 0
