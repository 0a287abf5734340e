import re

import duckdb
import pytest

from quire.llm import licenses, quality
from quire.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, source string, n_words string, words string"
LONG = " ".join(f"w{i % 4999}" for i in range(20_000))
ODD = [None, "", " \n\t\r", "one", "a b c d e " * 4, "line one\nline one\n\n \nline two\r\nline one", LONG, "#*$%&|<> ünïcode 東京 😀 text", "x" * 50_000, "same words again same words again same words again same"]


def frame(spark, texts, sources=("h1", None, "h2")):
    return spark.createDataFrame([(i if i % 4 else None, t, sources[i % len(sources)], "x", "y") for i, t in enumerate(texts)], SCHEMA)


def base(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_measures_equal_brute_force(spark):
    rows = quality.judged(frame(spark, [*ODD, ODD[4]])).collect()
    got = sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    assert got == sorted(base(t) for t in [*ODD, ODD[4]])
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.base_failed and r.kept) for r in rows)


def test_a_bad_host_takes_its_documents_down(spark):
    good, bad = LONG[:2000], "# $ % & * | " * 20 + LONG[:2000]
    rows = [(i, bad if i < 30 else good, "bad" if i < 40 else f"good{i % 3}", "", "") for i in range(100)]
    kept = {r.doc_id: r.kept for r in quality.judged(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not any(kept[i] for i in range(40)) and all(kept[i] for i in range(40, 100))


def test_empty_tables(spark):
    assert quality.judged(frame(spark, [])).collect() == []
    assert licenses.scan(frame(spark, [])).collect() == []


def test_phrases_equal_brute_force(spark):
    texts = [*ODD, "CC-BY, cc by\ncc by", "All rights\treserved. ALL RIGHTS RESERVED", "the GNU General Public License", "general publik license", "cc éby cc by é", "Kcc by", LONG + " all rights reserved"]
    rows = licenses.scan(frame(spark, texts)).collect()
    got = sorted((r.n_words, r.n_base, r.first_word if r.first_word is not None else -1, r.last_word if r.last_word is not None else -1, r.base_labels) for r in rows)
    want = []
    for t in texts:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        found = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        want.append((len(words), len(found), min((i for i, _ in found), default=-1), max((i for i, _ in found), default=-1), ",".join(sorted({x for _, x in found}))))
    assert got == sorted(want)


def test_notices_with_words_put_in_or_left_out(spark):
    texts = ["Licensed under the Apache License, Version 2.0 (the licence)", "permission is hereby granted, absolutely free of charge, to any person obtaining a copy of this software", "a license to drive", "the apache people"]
    rows = {r.n_words: r for r in licenses.scan(frame(spark, texts)).collect()}
    assert [rows[len(licenses.re.findall("[A-Za-z0-9]+", t))].labels for t in texts] == ["apache-2.0", "mit", "", ""]


@pytest.mark.parametrize("name", ["op5_quality_rules", "op10_license_scan", "op3_ngram_jaccard_join"])
def test_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(ORACLES[name]).df()
    got = QUERIES[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    norm = lambda df: sorted(map(str, df[sorted(df.columns)].astype(object).where(df.notna(), None).map(lambda v: float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v).itertuples(index=False, name=None)))
    assert norm(got) == norm(want)


def test_whole_licence_texts_are_found_with_changes(spark):
    words = licenses.WHOLE["mit"].split()
    changed = " ".join([*LONG.split()[:50], *words[:60], "put", "in", *words[60:100], *words[103:], "after it"])
    part = " ".join(licenses.WHOLE["zlib"].split()[:30])
    n = len(licenses.re.findall("[A-Za-z0-9]+", " ".join(LONG.split()[:50])))
    rows = {r.doc_id: r for r in licenses.scan(frame(spark, [changed, part, licenses.WHOLE["bsd"] + " " + licenses.WHOLE["isc"]])).collect()}
    assert rows[None].labels == "mit" and max(s.n_words for s in rows[None].spans) > 150 and min(s.first_word for s in rows[None].spans) == n
    assert rows[1].labels == "" and rows[2].labels == "bsd,isc"
