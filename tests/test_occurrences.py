from quire.operators import vocabulary as V


def test_a_word_is_exchanged_once_a_batch(spark):
    rows = [("a Straße straße, ÿes naïve naïve", "one"), (None, "one"), ("", None), ("yes Œuvre éé abc", None), ("STRASSE ×÷ø NAVE", "two"), ("ab c", "two")]
    docs = spark.createDataFrame(rows, "text string, source string")
    want = [("one", "ES"), ("one", "NAVE"), ("one", "STRASSE"), (None, "ABC"), (None, "UVRE"), (None, "YES"), ("two", "NAVE"), ("two", "STRASSE")]
    assert sorted(map(str, map(tuple, V.occurrences(docs).collect()))) == sorted(str(w) for w in want if len(w[1]) >= 3)
    batch = docs.toArrow().combine_chunks().to_batches()[0]
    told = [r for b in V._edition_keys(iter([batch])) for r in b.to_pylist()]
    assert len(told) == len({tuple(r.values()) for r in told}) == 7
    assert V.occurrences(docs.limit(0)).count() == 0
