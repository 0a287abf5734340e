import random

import pytest
from pyspark.sql import functions as F

from quire.functions import text as X


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("function", "given", "wanted"),
    [
        (X.key, "Botan y, &c.", "BOTANYC"),
        (X.key, "ÆGIS", "GIS"),
        (X.key, None, ""),
        (X.title, "  A 1 , ", "A1"),
        (X.title, "\t;.:,", ""),
        (X.title, ".Q\u00a0Q-\nQ", "QQ-Q"),
        (X.title, None, None),
        (X.display_title, None, None),
        (X.unspaced, "x y", "xy"),
        (X.unspaced, "   ", ""),
        (X.unspaced, "x 1 y", "x 1 y"),
        (X.unspaced, "p q; r s", "pq; rs"),
        (X.unspaced, "ab c  d e.f", "ab cd e.f"),
        (X.unspaced, None, ""),
        (X.unspaced, "", ""),
        (X.clean, "a  hyphen- \n ated word , and", "a hyphenated word, and"),
        (X.clean, "café- bar", "cafébar"),
        (X.cross_references, "Lime. See  CHALK, or See CHALK; See IRON WORKS.", ["CHALK", "IRON WORKS"]),
        (X.slug, " A, B  C ", "A-B-C"),
        (X.range_slug, "Part IV, Q-R", "Part4_Q-R"),
        (X.range_slug, "LOM-NEB", "LOM-NEB"),
        (X.qualifier, "BROWN (Anne)", "Anne"),
        (X.qualifier, "BROWN", None),
        (X.word_count, "one, two-three é4", 4),
        (X.dissertation_ordinal, "DISSETATION THIRD", 3),
        (X.dissertation_ordinal, "FIRST DISSERTATION", 1),
        (X.display_title, "no such title", "no such title"),
        *[(X.display_title, " ".join(k) + ".", shown) for k, shown in X.DISPLAY_TITLES.items()],
        (X.without_catchword, "so it ends. BALA-", "so it ends."),
        (X.images_named, '<img src="x" alt="a map">', '<span class="image">a map</span>'),
        (X.paragraphs, "a & b\n\nc", "<p>a &amp; b</p>\n<p>c</p>"),
    ],
)
def test_one_argument(spark, function, given, wanted):
    assert value(spark, function(F.lit(given).cast("string"))) == wanted


def test_boxes(spark):
    assert value(spark, X.box(F.lit("1 2 30 4")))["x2"] == 30
    assert value(spark, X.box(F.lit("1 2 x 4"))) is None
    assert value(spark, X.box(F.lit(""))) is None


@pytest.mark.parametrize(
    ("headword", "body", "wanted"),
    [
        # The rule's parts one by one: headword, a parenthesis, one domain clause, then the reference.
        ("", "See Z", True),
        ("Q7", "q7. See Z", True),
        ("Q7", "Q8. See Z", False),
        ("Q7", "Q7 () See Z", True),
        ("Q7", "Q7 (one) (two) See Z", False),
        ("Q7", "Q7 (one), in 2 trades. See Z", True),
        ("Q7", "Q7, in trades, of old. See Z", False),
        ("Q7", "Q7, in what See Z calls so. See Z", True),
        ("Q7", "Q7, under trades. See Z", False),
        ("Q7", "Q7, in. See Z", False),
        ("Q7", "Q7", False),
        ("Q7", "  ", False),
        (None, "See NAVY", True),
        ("Q7", None, False),
        ("Q7", "Q7: Seen, and See", False),
    ],
)
def test_redirects(spark, headword, body, wanted):
    assert value(spark, X.is_redirect(F.lit(headword).cast("string"), F.lit(body).cast("string"))) is wanted


def test_replaces_the_first_whole_token_only(spark):
    f = lambda a, b, c: value(spark, X.replaced_once(F.lit(a), F.lit(b), F.lit(c)))
    assert f("OLD MAN, OLD", "OLD", "NEW") == "NEW MAN, OLD"
    assert f("GOLDEN OLD", "OLD", "N$1\\") == "GOLDEN N$1\\"
    assert f("nothing", "OLD", "NEW") == "NEW"


def test_offsets(spark):
    f = lambda b, s: value(spark, X.offset_of(F.lit(b), F.lit(s)))
    assert f("abc def", "def") == 4
    assert f("abc\n  def ghi", "abc def") == 0
    assert f("xx the quick brown fox jumps high", "the quick brown fox jumps over") == 3
    assert f("abc", "zzz") is None


def paragraph(spark, text, bold=None, tail="", trigram=None):
    args = [F.lit(x).cast("string") for x in (text, bold, tail, "", trigram)]
    return value(spark, X.headword(*args))


def test_headwords(spark):
    assert paragraph(spark, "ANATHEMA, in church history").base == "ANATHEMA"
    assert paragraph(spark, "BAROMETER (from Baros weight)").detected_by == "allcaps"
    assert paragraph(spark, "PLATE IV, of ships") is None
    assert paragraph(spark, "Academy. ACADEMY. An enumeration").base == "ACADEMY"
    mod = paragraph(spark, "CANINE teeth, in anatomy", trigram="CAN")
    assert (mod.type, mod.detected_by) == ("sub_entry", "allcaps_mod")
    assert paragraph(spark, "THIS fever, so named", trigram="THI") is None
    inverted = paragraph(spark, "Sea-GAGE, an instrument", trigram="GAG")
    assert (inverted.base, inverted.qualifier, inverted.detected_by) == ("GAGE", "Sea-", "inverted")
    assert paragraph(spark, "ROYAL AID, a tax", bold="ROYAL AID", tail=", a tax", trigram="AID").base == "AID"
    drop = paragraph(spark, "ABACUS, a table", bold="A", tail="BACUS, a table")
    assert (drop.full, drop.detected_by) == ("ABACUS", "bold")
    assert paragraph(spark, "TI- x", bold="TI-", tail=" x") is None
    assert paragraph(spark, "RULE. Let x", bold="RULE", tail=". Let x", trigram="ALG") is None
    assert paragraph(spark, "prose without any") is None


def test_spelling_distance_equals_a_plain_loop(spark):
    random.seed(1)
    words = ["".join(random.choice("AB") for _ in range(random.randint(1, 6))) for _ in range(60)]

    def slow(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1] if row[-1] <= 2 else None

    pairs = list(zip(words[::2], words[1::2], strict=True))
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", X.near(F.col("a"), F.col("b"), 2).alias("d")).collect()
    assert [r.d for r in got] == [slow(a, b) for a, b in pairs]


def test_whole_texts_are_cleaned(spark, tmp_path):
    import re

    from quire.plans.repairs import clean_text

    texts = {1: "one  two-\n three , " * 500, 2: "short  text .", 3: "x" * 1999 + "  y-\n z", 4: ""}
    spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))

    def brute(t):
        t = re.sub(r"(\w)[\u00ad-]\s+([a-z])", r"\1\2", re.sub(r"\s+", " ", t).strip())
        return re.sub(r"\s+([,.;:)])", r"\1", t).strip()

    assert {r.doc_id: r.cleaned for r in clean_text(spark, str(tmp_path)).collect()} == {k: brute(t) for k, t in texts.items()}


def test_short_words_are_matched_in_bodies(spark, tmp_path):
    import re

    from quire.plans.words import body_token_match

    docs = {1: "The Catalogue of cats, an abacus", 2: "concatenated abaci", 3: "", 4: "Encyclopaedias ABACUS"}
    words = ["cat abacus", "encyclopaedia of it", "the"]
    spark.createDataFrame([(k, "web", t) for k, t in docs.items()], "doc_id bigint, source string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(words)), "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    keys = {w.upper() for t in words for w in t.split() if len(w) >= 3}
    want = {(k, w) for k, t in docs.items() for w in keys if re.search(r"\b" + w[: max(5, len(w) - 1)], t.upper())}
    got = [tuple(r) for r in body_token_match(spark, str(tmp_path)).collect()]
    assert set(got) == want and len(got) == len(want)


def test_bodies_are_matched_without_an_exchange_of_their_words(spark, monkeypatch):
    from quire.operators import vocabulary as V

    docs = [(1, "Straße, straßen: ÉTUDE étude"), (1, "STRASSENBAHN"), (2, "Études of it, tude"), (2, None), (None, "abacus abaci"), (None, "abacus"), (3, "ab")]
    bodies = spark.createDataFrame(docs, "doc_id bigint, text string")
    words = spark.createDataFrame([("STRASSE",), ("TUDE",), ("ABACUS",), ("ABA",), ("STRASSENBAHNEN",)], "key string")
    want = {(1, "STRASSE"), (1, "TUDE"), (2, "TUDE"), (None, "ABACUS"), (None, "ABA")}
    found = V.contained(bodies, words)
    # Ids are counted and joined; words are met by no join.
    assert "word#" not in found._jdf.queryExecution().toString()
    for heads in (V.HEADS, 2):
        monkeypatch.setattr(V, "HEADS", heads)
        got = [tuple(r) for r in V.contained(bodies, words).collect()]
        assert set(got) == want and len(got) == len(want), heads
