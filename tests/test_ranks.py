"""Places in an order that no task holds whole: even blocks, and all that is numbered by them."""

import random

import pytest

from quire.operators import vocabulary as V


@pytest.fixture(scope="module")
def words():
    """Words of which nine tenths begin alike, so blocks by letters would part little."""
    pick = random.Random(5)
    some = {"PRE" + "".join(pick.choices("ABCDE", k=6)) for _ in range(1500)} | {"".join(pick.choices("QRSTUVW", k=5)) for _ in range(150)}
    return sorted(some)


def test_blocks_are_even_and_ordered(spark, words):
    rows = spark.createDataFrame([(w,) for w in words], "key string").repartition(3)
    got = V.blocked(rows, "key", size=100, sampled=16).collect()
    places = {r.key: r.block for r in got}
    assert sorted(places) == words
    assert [places[w] for w in words] == sorted(places.values())
    sizes = [sum(b == k for b in places.values()) for k in set(places.values())]
    assert len(sizes) > len(words) / 200 and max(sizes) < 300


def test_few_rows_nulls_and_none(spark, words):
    rows = spark.createDataFrame([(w,) for w in words[:40]] + [(None,)], "key string")
    assert {r.block for r in V.blocked(rows, "key").collect()} == {0}
    got = V.blocked(rows, "key", size=4, sampled=2)
    assert got.where("key is null").first().block == 0 and got.agg({"block": "max"}).first()[0] > 2
    assert V.blocked(rows.where("false"), "key").collect() == []


def test_a_key_of_most_rows_is_one_block(spark, words):
    rows = spark.createDataFrame([(w,) for w in words[:200]] + [(words[100],)] * 600, "key string")
    places = [tuple(r) for r in V.blocked(rows, "key", size=20, sampled=4).distinct().collect()]
    assert len(places) == 200 and [b for _, b in sorted(places)] == sorted(b for _, b in places)


def test_most_blocks_hold_even_where_rows_are_many(spark, words):
    rows = spark.createDataFrame([(w,) for w in words], "key string")
    assert V.blocked(rows, "key", size=2, most=8, sampled=8).agg({"block": "max"}).first()[0] < 16


def test_orders_of_several_columns(spark):
    rows = spark.range(500).selectExpr("struct(id % 7 as a, if(id % 5 = 0, null, -id) as b) as o", "id")
    got = V.ordinal(V.blocked(rows, "o", size=30, sampled=8), "block", ["o"], "at").orderBy("at").collect()
    assert [r["at"] for r in got] == list(range(1, 501))
    # Those without b tie; they come first of their a.
    wanted = sorted(range(500), key=lambda i: (i % 7, i % 5 != 0, -i))
    assert [(r.o.a, r.o.b) for r in got] == [(i % 7, None if i % 5 == 0 else -i) for i in wanted]


def test_neighbours_and_successors_across_blocks(spark, words, monkeypatch):
    # Small blocks, so that most neighbours stand in another one.
    defaults = (20, 2_048, 4)
    monkeypatch.setattr(V.blocked, "__defaults__", defaults)
    some = words[::3]
    rows = spark.createDataFrame([(w,) for w in some], "key string")
    got = {r.key: tuple(r)[1:] for r in V.neighbours(rows).select("key", "before2", "before1", "after1", "after2").collect()}
    at = lambda i: some[i] if 0 <= i < len(some) else None
    assert got == {w: (at(i - 2), at(i - 1), at(i + 1), at(i + 2)) for i, w in enumerate(some)}

    held = {e: [w for i, w in enumerate(some) if i % (e + 2) != 1] for e in range(4)}
    found = spark.createDataFrame([(str(e), w) for e, ws in held.items() for w in ws], "edition string, key string")
    after = {(r.edition, r.key): r.successor for r in V.successors(found).collect()}
    assert after == {(str(e), w): (ws[i + 1] if i + 1 < len(ws) else None) for e, ws in held.items() for i, w in enumerate(ws)}

    wanted = set()
    for e, ws in held.items():
        for w in set(some) - set(ws):
            behind = [x for x in ws if x < w]
            if sum(w in other for other in held.values()) >= 3 and behind:
                wanted.add((str(e), behind[-1], w))
    assert {tuple(r) for r in V.absent_between(found, 3).select("edition", "absorber", "key").collect()} == wanted
