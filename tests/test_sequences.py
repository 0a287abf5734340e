import random

from pyspark.sql import functions as F

from quire.operators import sequences as S


def rows(spark, values, kind="string"):
    return spark.createDataFrame([(1, i, v) for i, v in enumerate(values)], f"p int, i int, v {kind}")


def test_segments_drop_what_comes_before_the_first(spark):
    got = S.segments(rows(spark, ["x", "A", "b", "C"]), ["p"], ["i"], F.col("v").rlike("^[A-Z]")).orderBy("i").collect()
    assert [(r.v, r.segment) for r in got] == [("A", 1), ("b", 1), ("C", 2)]


def test_runs(spark):
    got = S.runs(rows(spark, [None, "a", None, None, None, "b", None]), ["p"], ["i"], F.col("v").isNull()).collect()
    assert [(r.start, r.end, r.length) for r in got] == [(2, 4, 3)]


def test_most_frequent_prefers_the_first_seen(spark):
    assert S.most_frequent(rows(spark, ["b", "a", "a", "b", None]), ["p"], "v", "i").first().v == "b"


def test_merged_spans_equal_a_loop(spark):
    random.seed(2)
    for _ in range(5):
        spans, at = [], 0
        for _ in range(25):
            at += random.randint(1, 6)
            spans.append((1, random.choice("ab"), at, at := at + random.randint(0, 2)))
        wanted = []
        for _, name, start, end in spans:
            if wanted and wanted[-1][0] == name and start - wanted[-1][2] <= 3:
                wanted[-1] = (name, wanted[-1][1], end)
            else:
                wanted.append((name, start, end))
        got = S.merged_spans(spark.createDataFrame(spans, "p int, n string, start int, end int"), ["p"], "n").orderBy("start").collect()
        assert [(r.n, r.start, r.end) for r in got] == wanted


def test_repeats_and_stubs(spark):
    got = S.without_repeats(rows(spark, ["a", "a", None, None, "a"]), ["p"], ["i"], ["v"]).orderBy("i").collect()
    assert [r.v for r in got] == ["a", None, "a"]
    got = S.without_stubs(rows(spark, ["a", "a", "b"]), ["p"], ["i"], "v", F.lit(True)).orderBy("i").collect()
    assert [r.i for r in got] == [1, 2]


def test_rising_and_opening(spark):
    assert [r.v for r in S.rising(rows(spark, [2, 1, None, 3, 3, 5], "int"), ["p"], ["i"], "v").orderBy("i").collect()] == [2, 3, 5]
    assert S.opening(rows(spark, ["x", "a", "a", "b", "b"]), ["p"], ["i"], "v").first().opening == "a"
    assert S.opening(rows(spark, ["z"]), ["p"], ["i"], "v").first().opening == "z"


def test_spaced_points_equal_a_loop(spark):
    random.seed(3)
    for _ in range(10):
        points = sorted(random.randint(0, 400) for _ in range(12))
        kept = []
        for p in points:
            if not kept or p - kept[-1] >= 40:
                kept.append(p)
        array = F.array(*[F.lit(p).cast("bigint") for p in points])
        assert spark.range(1).select(S.spaced_points(array).alias("v")).first().v == kept


def test_chunks_and_fills(spark):
    got = S.chunked(rows(spark, "abcde").withColumn("o", F.col("i") + 1), "o", 2).orderBy("i").collect()
    assert [r.chunk for r in got] == [0, 0, 1, 1, 2]
    got = S.filled(rows(spark, ["a", None, "b", None]), ["p"], ["i"], F.col("v"), "f").orderBy("i").collect()
    assert [r.f for r in got] == ["a", "a", "b", "b"]
