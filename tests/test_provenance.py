from quire.operators import provenance as N

FIXES = "eb_code string, variant string, canonical string, n_editions int, edit_distance int"


def plain(df, *order):
    return [r.asDict(recursive=True) for r in df.orderBy(*order).collect()]


def test_corrections_note_themselves_and_run_once(spark):
    rows = [
        (1, "e1", "article", "OLD MAN, the", "OLD"),
        (2, "e1", "article", "SNOW-Drop", "SNOW-D"),
        (3, "e1", "treatise", "OLD", "OLD"),
        (4, "e2", "article", "OLD", "OLD"),
        (5, "e1", "article", None, None),
        (6, "e1", None, "BOLD and OLD-FOLD", "OLD"),
    ]
    records = spark.createDataFrame(rows, "k int, eb_code string, type string, headword string, base_headword string")
    fixes = spark.createDataFrame([("e1", "OLD", "AULD", 4, 1), ("e1", "OLD", "ODD", 2, 1), ("e1", "SNOWD", "SNOWDON", 3, 2)], FIXES)
    once = N.corrected(records, fixes)
    assert plain(N.corrected(once, fixes), "k") == plain(once, "k")
    got = {r["k"]: r for r in plain(once, "k")}
    assert [(got[k]["headword"], got[k]["base_headword"]) for k in range(1, 7)] == [("AULD MAN, the", "AULD"), ("SNOWDON", "SNOWDON"), ("OLD", "OLD"), ("OLD", "OLD"), (None, None), ("AULD", "AULD")]
    note = got[1]["provenance"]
    assert (note["raw_headword"], note["raw_base_headword"], note["headword_correction"]["from"], note["headword_correction"]["to"], note["headword_correction"]["n_editions"]) == ("OLD MAN, the", "OLD", "OLD", "AULD", 4)
    assert got[3]["provenance"]["headword_correction"] is None and got[5]["provenance"]["raw_headword"] is None
    undone = N.uncorrected(once, spark.createDataFrame([("OLD", "AULD"), ("OLD", "AULD")], "old string, new string"))
    back = {r["k"]: r for r in plain(undone, "k")}
    assert (back[1]["headword"], back[1]["base_headword"], back[1]["provenance"]["headword_correction"], back[1]["provenance"]["raw_headword"]) == ("OLD MAN, the", "OLD", None, None)
    assert back[2]["headword"] == "SNOWDON"


def test_splits_note_themselves_and_run_once(spark):
    own, first, second = "Own text of the absorber. " * 8, "PERSIA, a land. See ASIA. " * 4, "PERTH, a town of Scotland. " * 4
    rows = [
        ("f", 0, own + first + second, "PEAR", "PEAR", "sub_entry", "q", 7, 9),
        ("f", 1, "1 Extent. " + "PERSIA is all of this. " * 9, "PERSEUS", "PERSEUS", "article", None, 9, 9),
        ("f", 2, "Left alone.", "PET", "PET", "article", None, 9, 10),
        ("f", 3, own + "nothing is found here", "PETER", "PETER", "article", None, 9, 10),
    ]
    records = spark.createDataFrame(rows, "file string, line int, body_text string, headword string, base_headword string, type string, qualifier string, printed_page_start int, printed_page_end int")
    candidates = spark.createDataFrame([("f", 0, [("PERSIA", "PERSIA, Land of"), ("PERTH", "PERTH")]), ("f", 1, [("PERSIA", "PERSIA")])], "file string, line int, absorbed array<struct<norm:string,headword:string>>")
    splits = "file string, line int, seq int, splits array<struct<norm:string,found:boolean,start_text:string>>"
    answers = spark.createDataFrame(
        [
            ("f", 0, 1, [("WRONG", True, "Own text of the absorber. Own")]),
            ("f", 0, 2, [("PERTH", True, "PERTH, a  town"), ("PERSIA", True, "PERSIA, a land."), ("NONE", False, "Own")]),
            ("f", 1, 1, [("PERSIA", True, "PERSIA is all")]),
            ("f", 3, 1, [("X", True, "absent words"), ("Y", True, None)]),
        ],
        splits,
    )
    once = N.absorbed_split(records, candidates, answers)
    got = plain(once, "line", "sub")
    assert [(r["line"], r["sub"], r["headword"], r["type"]) for r in got] == [(0, 0, "PEAR", "sub_entry"), (0, 1, "PERSIA, Land of", "article"), (0, 2, "PERTH", "article"), (1, 0, "PERSIA", "article"), (2, 0, "PET", "article"), (3, 0, "PETER", "article")]
    parent, child, _, moved, alone, missed = got
    assert parent["body_text"] == own.strip() and child["body_text"] == first.strip() and parent["qualifier"] == "q" and child["qualifier"] is None
    assert parent["provenance"]["absorbed_split"] == {"recovered": ["PERSIA, Land of", "PERTH"], "original_char_count": len(own + first + second), "source": N.SPLIT_SOURCE}
    assert (child["provenance"]["split_from"], child["provenance"]["absorbed_split"], child["cross_refs"]) == ("PEAR", None, ["ASIA"])
    assert (child["printed_page_start"], child["printed_page_end"], child["char_count"], child["body_html"].startswith("<p>PERSIA")) == (7, 9, len(first.strip()), True)
    assert (moved["provenance"]["relabeled_from"], moved["detected_by"], moved["provenance"]["absorbed_split"]["recovered"]) == ("PERSEUS", N.SPLIT_BY, [])
    assert alone["provenance"]["absorbed_split"] is None and missed["body_text"] == rows[3][2] and missed["provenance"]["absorbed_split"] is None
    again = N.absorbed_split(once.where("sub = 0").drop("sub"), candidates, answers)
    assert plain(again, "line", "sub") == [r for r in got if r["sub"] == 0]
