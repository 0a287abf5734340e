import json

import pytest

from quire import schemas
from quire.sources import scans, sinks
from quire.streaming import resume


def test_inventory_and_manifest(spark, tmp_path):
    titles = ["Encyclopaedia; or, A dictionary - First edition, 1771, Volume 2, M-Z - EB.1", "Encyclopaedia; or, A dictionary - First edition, 1771, Volume 1, A-L - EB.1", "Encyclopaedia; or, A dictionary - Second edition, Volume 1, A-B - EB.2"]
    (tmp_path / "inventory.csv").write_text("﻿" + "".join(f'{i},"{t}"\n' for i, t in zip(("222", "111", "333"), titles, strict=True)), encoding="utf-8")
    assert [tuple(r) for r in scans.inventory(spark, str(tmp_path / "inventory.csv")).collect()] == list(zip(("222", "111", "333"), titles, strict=True))
    counts = spark.createDataFrame([("111", 3), ("222", 5)], "identifier string, n_images bigint")
    mets = spark.createDataFrame([("111", 3, "1771", None, None), ("222", 4, None, None, None)], "identifier string, n_pages_mets bigint, date_issued string, rights string, mets_error string")
    rows = scans.manifest(spark, str(tmp_path / "inventory.csv"), counts, mets)
    assert [(r.identifier, r.n_images, r.n_pages_mets, r.pages_match, r.date_issued) for r in rows.collect()] == [("111", 3, 3, True, "1771"), ("222", 5, 4, False, None), ("333", 0, None, False, None)]
    told = {(r.eb_code, r.level): (r.n_volumes, r.n_pages, r.mismatches) for r in scans.manifest_summary(rows).collect()}
    assert told == {("EB.1", 0): (2, 8, ["222"]), ("EB.2", 0): (1, 0, ["333"]), (None, 3): (3, 8, ["222", "333"])}
    assert scans.volume(rows, "222").first().n_images == 5
    with pytest.raises(ValueError):
        scans.volume(rows, "999")


METS = """<?xml version="1.0"?><mets:mets xmlns:mets="http://www.loc.gov/METS/" xmlns:xlink="http://www.w3.org/1999/xlink">
<mets:dmdSec><mods><originInfo><dateIssued> 1771 </dateIssued></originInfo><accessCondition>Public  domain</accessCondition></mods></mets:dmdSec>
<mets:fileSec><mets:fileGrp><mets:file ID="f1"><mets:FLocat xlink:href="file://./image/30.jpg"/></mets:file><mets:file ID="f2"><mets:FLocat xlink:href="file://./image/20.jpg"/></mets:file>
<mets:file ID="f3"><mets:FLocat xlink:href="file://./alto/20.xml"/></mets:file></mets:fileGrp></mets:fileSec>
<mets:structMap><mets:div><mets:div ORDER="2"><mets:fptr FILEID="f1"/></mets:div><mets:div ORDER="1"><mets:fptr FILEID="f2"/><mets:fptr FILEID="f3"/></mets:div></mets:div></mets:structMap></mets:mets>"""


def test_mets(spark, tmp_path):
    (tmp_path / "1-mets.xml").write_text(METS)
    (tmp_path / "2-mets.xml").write_text("<mets:mets xmlns:mets='x'><mets:file ID='f1'>")
    pages = scans.mets_pages(spark, str(tmp_path))
    assert [(r.order, r.image) for r in pages.collect()] == [(1, "20.jpg"), (2, "30.jpg")]
    facts = {r.identifier: r for r in scans.mets_facts(spark, str(tmp_path)).collect()}
    assert (facts["1"].date_issued, facts["1"].rights, facts["1"].mets_error) == ("1771", "Public domain", None)
    assert facts["2"].mets_error and facts["2"].date_issued is None


def test_mets_that_is_odd_or_broken(spark, tmp_path):
    odd = METS.replace("<mets:dmdSec>", "<!-- <a> & <b --><mets:dmdSec><note><![CDATA[<open>]]></note>").replace('<mets:div ORDER="2">', '<mets:div ORDER="x"/><mets:div><mets:div ORDER="2">').replace('<mets:div ORDER="1">', '</mets:div><mets:div ORDER="1">')
    for name, text in {"1": odd, "2": "<mets><a><b>x</a></b></mets>", "3": " ", "4": "<mets a='1' a='2'/>", "5": "<mets/>"}.items():
        (tmp_path / f"{name}-mets.xml").write_text(text)
    facts = {r.identifier: r for r in scans.mets_facts(spark, str(tmp_path)).collect()}
    assert (facts["1"].date_issued, facts["1"].rights, facts["1"].n_pages_mets, facts["1"].mets_error) == ("1771", "Public domain", 2, None)
    assert all(facts[k].mets_error and facts[k].n_pages_mets is None and facts[k].date_issued is None for k in "234")
    assert "mismatched tag" in facts["2"].mets_error and (facts["5"].n_pages_mets, facts["5"].mets_error) == (0, None)
    assert [(r.order, r.image) for r in scans.mets_pages(spark, str(tmp_path)).collect()] == [(1, "20.jpg"), (2, "30.jpg")]


def test_images(spark, tmp_path):
    for name in ("a/image/100.jpg", "a/image/20.jpg", "a/image/x.txt", "b/3.jpg"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"12345")
    assert sorted(tuple(r) for r in scans.image_counts(spark, str(tmp_path)).collect()) == [("a", 2), ("b", 1)]
    assert scans.image_counts(spark, str(tmp_path / "none")).collect() == []
    found = scans.images(spark, str(tmp_path))
    assert sorted((r.identifier, r.image, bytes(r.content), r.size) for r in found.collect())[0] == ("a", "100.jpg", b"12345", 5)
    assert [r.image for r in scans.page_order(found.where("identifier = 'a'")).orderBy("ord").collect()] == ["20.jpg", "100.jpg"]


def test_jsonl(spark, tmp_path):
    (tmp_path / "v1").mkdir()
    page = lambda image, **more: json.dumps({"image": image, "raw": "r", **more})
    lines = [page("1.jpg", error=True), "", page("2.jpg", token_count=5), page("1.jpg", raw="again"), '{"image": "3.jp']
    (tmp_path / "v1" / "pages.jsonl").write_text("\n".join(lines))
    rows = scans.pages(spark, str(tmp_path / "v1" / "pages.jsonl"))
    assert sorted((r.identifier, r.idx, r.image) for r in rows.collect()) == [("v1", 0, "1.jpg"), ("v1", 2, "2.jpg"), ("v1", 3, "1.jpg")]
    done = scans.finished_pages(scans.tolerant_jsonl(spark, str(tmp_path / "v1"), schemas.PAGE_LINE))
    assert sorted((r.image, r.raw) for r in done.collect()) == [("1.jpg", "again"), ("2.jpg", "r")]
    (tmp_path / "good.jsonl").write_text('{"a": 1}\n{"a": null}\n')
    assert [r.a for r in scans.strict_jsonl(spark, str(tmp_path / "good.jsonl"), "a int").collect()] == [1, None]
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        scans.strict_jsonl(spark, str(tmp_path / "v1" / "pages.jsonl"), "image string").collect()
    (tmp_path / "ids.txt").write_text(" 1 \n\n2\n")
    assert [r.identifier for r in scans.ids(spark, str(tmp_path / "ids.txt")).collect()] == ["1", "2"]
    (tmp_path / "metadata.json").write_text(json.dumps({"identifier": "9", "n_pages": 3}, indent=1))
    assert scans.volume_metadata(spark, str(tmp_path / "metadata.json")).first().n_pages == 3


@pytest.mark.parametrize("split", ["64", "1000", "128m"])
def test_line_numbers_over_splits(spark, tmp_path, split):
    """Files of many splits, of one, of none; splits end inside lines, at their ends and inside characters."""
    texts = {"a": [f"{i} " + "é" * (i % 40) for i in range(300)], "b": ["", "x", "", "", "last"], "c": ["one"], "d": []}
    for name, lines in texts.items():
        (tmp_path / f"{name}.txt").write_text("\n".join(lines) + ("\n" if name != "b" else ""), encoding="utf-8")
    (tmp_path / "d.txt").write_text("")
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = scans.numbered_lines(spark, str(tmp_path))
        got = {(r.file[-5], r.line, r.text) for r in rows.collect()}
        assert rows.count() == len(got)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert got == {(name, i, line) for name, lines in texts.items() for i, line in enumerate(lines)}


def test_array_or_object(spark):
    rows = spark.createDataFrame([('{"results": [{"i": 1}]}',), ('[{"i": 2}, {"i": 3}]',), ("nothing",), (None,)], "j string")
    got = [r.v for r in rows.select(scans.array_or_object(rows.j, "results", "struct<i:int>").alias("v")).collect()]
    assert [[x.i for x in v] if v else v for v in got] == [[1], [2, 3], None, None]


def test_snapshots_and_editions(spark, tmp_path):
    rows = spark.createDataFrame([("EB.1", "A", None), ("EB.10", "B", 2)], "eb_code string, headword string, n int")
    root = str(tmp_path / "snapshots")
    sinks.snapshot(rows, root, "one")
    before = scans.snapshot(spark, root, "one", "eb_code string, headword string, n int")
    assert not sinks.changed_snapshot(rows, before, root, "two")
    more = rows.union(rows.limit(1))
    assert sinks.changed_snapshot(more, before, root, "two", dry_run=True) and not (tmp_path / "snapshots" / "snapshot=two").exists()
    assert sinks.changed_snapshot(more, before, root, "two") and scans.snapshot(spark, root, "two", "headword string").count() == 3
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.snapshot(rows, root, "two")
    sinks.edition_records(rows, str(tmp_path / "editions"))
    read = scans.edition_records(spark, str(tmp_path / "editions"), "headword string, n int", ["EB.1"])
    assert [(r.headword, r.eb_code) for r in read.collect()] == [("A", "EB.1")]
    fixed = spark.createDataFrame([("E", (("A", "B", 3, 1),)), ("E", (None,))], "edition string, provenance struct<headword_correction:struct<`from`:string,`to`:string,n_editions:int,edit_distance:int>>")
    assert [tuple(r) for r in scans.archived_fixes(fixed).collect()] == [("E", "A", "B", 3, 1)]


def test_sinks(spark, tmp_path):
    order = spark.createDataFrame([("v", 0, "a.jpg"), ("v", 1, "b.jpg"), ("w", 0, "c.jpg")], "identifier string, ord int, image string")
    done = spark.createDataFrame([("v", "b.jpg", "text b", 7, False), ("w", "c.jpg", "text c", None, True)], "identifier string, image string, markdown string, token_count bigint, error boolean")
    sinks.merged_pages(order, done, str(tmp_path / "merged"))
    merged = {r.identifier: r.value for r in spark.read.text(str(tmp_path / "merged"), wholetext=True).collect()}
    assert merged["v"].strip() == "<!-- a.jpg -->\n[OCR FAILED]\n\n<!-- b.jpg -->\ntext b"
    assert [r.image for r in sinks.incomplete(order, done).collect()] == ["a.jpg"]
    assert sinks.marked_complete(order, done, str(tmp_path / "complete")) == ["v"] and [r.identifier for r in spark.read.parquet(str(tmp_path / "complete")).collect()] == ["w"]
    told = {r.identifier: (r.n_pages, r.n_ocr_ok, r.failed_pages, r.total_tokens, r.elapsed_s) for r in sinks.run_summary(done, 1.0, 3.5).collect()}
    assert told == {"v": (1, 1, [], 7, 2.5), "w": (1, 0, ["c.jpg"], 0, 2.5)}
    sinks.jsonl(done.select("image", "token_count"), str(tmp_path / "lines"))
    assert '{"image":"c.jpg","token_count":null}' in {r.value for r in spark.read.text(str(tmp_path / "lines")).collect()}
    sinks.csv_manifest(order, str(tmp_path / "csv"), ["identifier", "image"])
    assert spark.read.csv(str(tmp_path / "csv"), header=True).columns == ["identifier", "image"]
    sinks.chunks(order.withColumnRenamed("ord", "chunk"), str(tmp_path / "chunks"), "chunk", "identifier")
    assert sorted((r.chunk, r.value) for r in spark.read.text(str(tmp_path / "chunks")).collect()) == [(0, "v"), (0, "w"), (1, "v")]
    sinks.batches(order, str(tmp_path / "batches"), "ord")
    sinks.appended(order, str(tmp_path / "appended"))
    sinks.appended(order, str(tmp_path / "appended"))
    assert spark.read.parquet(str(tmp_path / "appended")).count() == 6 and spark.read.json(str(tmp_path / "batches")).count() == 3


def test_views(spark, tmp_path):
    volumes = spark.createDataFrame([("1", "EB.1", 1, False, 1, "A-B", None, "T1"), ("2", "EB.1", 1, False, 2, "C-Z", None, "T2")], "identifier string, eb_code string, edition_num int, is_supplement boolean, volume_num int, alpha_range string, volume_label string, title string")
    html = sinks.volume_pages(spark.createDataFrame([("1", 1, "<p>b</p>"), ("1", 0, "<p>a</p>"), ("2", 0, None)], "identifier string, idx int, raw string"))
    assert "<p>a</p></section>\n<section><p>b</p>" in {r.identifier: r.html for r in html.collect()}["1"]
    index = sinks.named_copies(volumes, html, str(tmp_path / "flat")).collect()
    assert [r.identifier for r in index] == ["1", "2"] and len({r.name for r in index}) == 2
    same = volumes.withColumns({"volume_num": volumes.edition_num, "alpha_range": volumes.eb_code, "identifier": volumes.eb_code})
    with pytest.raises(Exception, match="two volumes"):
        sinks.flat_names(same).collect()
    rows = spark.createDataFrame([("E", i, f"H<{i}>", "body", ["long"] if i == 2 else []) for i in range(5)], "edition string, ord int, headword string, body_text string, problems array<string>")
    pages = sinks.review_pages(rows, 2).orderBy("page").collect()
    assert len(pages) == 3 and "H&lt;4&gt;" in pages[2].html and [tuple(r) for r in sinks.review_index(rows, 2).collect()] == [("E", 5, 1, 3)]


def test_resumable_stream_and_retries(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write = lambda name, images: (source / name).write_text("".join(json.dumps({"image": i, "raw": "r"}) + "\n" for i in images))
    write("1.jsonl", ["a", "b"])
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    resume.ingest(resume.page_stream(spark, str(source)), out, check)
    write("2.jsonl", ["c"])
    resume.ingest(resume.page_stream(spark, str(source)), out, check)
    assert sorted(r.image for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]
    wanted = spark.createDataFrame([("a",), ("b",), ("z",)], "image string")
    assert [r.image for r in resume.todo(wanted, spark.read.parquet(out), ["image"]).collect()] == ["z"]
    calls = []

    def model(rows):
        calls.append(rows.count())
        return rows.selectExpr("image", f"image = 'b' and {len(calls)} = 1 or image = 'z' as error")

    got = resume.processed(wanted, model, ["image"])
    assert sorted((r.image, r.error) for r in got.collect()) == [("a", False), ("b", False), ("z", True)] and calls == [3, 2]
