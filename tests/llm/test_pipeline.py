import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), "test-stage")
        after = docs.count()
        assert docs.columns == columns and 0 < after <= before, name
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert docs.groupBy("text").count().where("count > 1 and text is not null and trim(text) <> ''").isEmpty()


CLASHING = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, class string, _row string, _masks string, matches string, score string, lang_pred string, h string, word string, component string"
EN = "the dog and the cat are not in the house because they play on the street with the others and with number"
DE = "der hund und die katze sind nicht in dem haus weil sie auf der strasse mit den anderen spielen und mit nummer"


def test_odd_rows_and_clashing_columns(spark, tmp_path):
    some = ["own"] * 10
    rows = [(i, f"{DE if i % 2 else EN} {' '.join(f'w{i}x{k}' for k in range(9))}", "de" if i % 2 else "en", "s", 0, *some) for i in range(80)]
    item = " ".join(f"question{k}" for k in range(30))
    rows += [(100, None, "en", "s", None, *some), (101, "", None, None, 0, *some), (102, "12 34", "en", "s", 5, *some), (None, EN + " without an id at all here", None, "s", 9, *some), (103, f"{EN} {item}", "en", "s", 9, *some)]
    key = "ghp_aB3dE5fG7hJ9kL1mN3pQ5rS7tU9vW1xY3zA5"
    rows += [rows[0], rows[0], (104, f"{EN} and the token {key} that was left here by somebody", "en", "s", 9, *some)]
    spark.createDataFrame(rows, CLASHING).repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item), (2, None)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)), "odd")
        assert docs.columns == before.columns and docs.where("score <> 'own' or matches <> 'own' or _row <> 'own' or _masks <> 'own' or lang_pred <> 'own'").isEmpty(), name
    left = {r.doc_id: r for r in docs.collect()}
    assert docs.count() == len(left) and not {100, 101, 102, 103} & set(left) and {None, 104} <= set(left) and len(left) > 75
    assert key not in left[104].text and left[104].n_chars == len(left[104].text)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], CLASHING).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
