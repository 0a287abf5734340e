import random
import tempfile

import pytest

from quire.llm import jaccard as J

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def brute(docs):
    sets = []
    for _, text in docs:
        w = [x for x in (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()]
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    out = []
    for i, (key, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if root(j) == root(i) and docs[j][0] is not None]
        out.append((key, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def families(seed, n, size, words=60):
    random.seed(seed)
    word = lambda: "".join(random.choice("abcdefghij") for _ in range(random.randint(2, 6)))
    out = []
    for _ in range(n):
        base = [word() for _ in range(words)]
        for _ in range(size):
            copy = list(base)
            for _ in range(random.choice([0, 1, 1, 2, 3])):
                copy[random.randrange(words)] = word()
            out.append(" ".join(copy))
    random.shuffle(out)
    return [(i, t) for i, t in enumerate(out)]


def run(spark, docs):
    path = tempfile.mkdtemp(prefix="spark-") + "/docs"
    spark.createDataFrame([(k, t, "en", "s", 0) for k, t in docs], SCHEMA).repartition(3).write.parquet(path)
    df = spark.read.parquet(path)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.joined(df).collect()), key=str)


def test_odd_texts_and_ties(spark):
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    docs = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE two"), (6, "one two three four five"), (7, "one two three four five"), (7, "one two three four five"), (None, "one two"), (None, "alone here"), (8, long), (9, long + " end"), (10, "a b c d e f")]
    assert run(spark, docs) == brute(docs)


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force_with_pivots(spark, monkeypatch, seed):
    monkeypatch.setattr(J, "SMALL", 4)
    monkeypatch.setattr(J, "TILE", 5)
    docs = families(seed, 3, 25) + [(1000 + i, t) for i, t in families(seed + 10, 20, 2)]
    assert run(spark, docs) == brute(docs)


def test_equals_brute_force_in_small_regions(spark):
    docs = families(5, 12, 6)
    assert run(spark, docs) == brute(docs)


def test_one_of_each_keeps_columns_and_one_row_a_component(spark, tmp_path):
    docs = [(k, t) for k, t in families(7, 6, 4)] + [(None, None), (50, "x y z"), (50, "x y z"), (51, None)]
    rows = [(k, t, "en", "s", 0) for k, t in docs]
    spark.createDataFrame(rows, SCHEMA + "").write.parquet(str(tmp_path / "d"))
    stored = spark.read.parquet(str(tmp_path / "d"))
    kept = J.one_of_each(spark, stored, "").collect()
    wanted = {c for k, n, c in brute(docs) if n} | {51, None}
    assert kept[0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted((r.doc_id for r in kept), key=str) == sorted(wanted, key=str)


def test_hot_shingles_are_salted_and_meet_their_leader(spark, monkeypatch):
    monkeypatch.setattr(J, "HOT", 3)
    monkeypatch.setattr(J, "SMALL", 6)
    monkeypatch.setattr(J, "TILE", 4)
    docs = families(21, 2, 30) + [(500 + i, t) for i, t in families(22, 8, 2)]
    assert run(spark, docs) == brute(docs)


def test_regions_without_inner_structure_are_joined_by_tiles(spark, monkeypatch):
    # Chains: each text links with the next alone, so no pivot parts them well.
    monkeypatch.setattr(J, "SMALL", 3)
    monkeypatch.setattr(J, "TILE", 3)
    monkeypatch.setattr(J, "DEPTH", 1)
    random.seed(5)
    words = ["".join(random.choice("abcdefghij") for _ in range(5)) for _ in range(100)]
    docs = [(i, " ".join([*words[i * 2 :], *(f"x{k}" for k in range(i * 2))])) for i in range(30)]
    assert run(spark, docs) == brute(docs)


def test_rows_may_come_in_another_order(spark):
    docs = families(31, 5, 4)
    df = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in docs], SCHEMA).repartition(3)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.joined(df.orderBy(J.F.rand())).collect()), key=str) == brute(docs)


@pytest.mark.parametrize("signed", [512, 5])
def test_texts_that_share_a_shingle_by_chance_do_not_move(spark, monkeypatch, signed):
    random.seed(7)
    monkeypatch.setattr(J, "SIGNED", signed)
    words = [f"w{k}" for k in range(4000)]
    # One passage in all of them; two are near copies.
    texts = [" ".join([*random.sample(words, 40), *words[:12], *random.sample(words, 40)]) for _ in range(30)]
    docs = [*enumerate(texts), (30, texts[3] + " more words here")]
    moved = []
    links = J.region_links
    monkeypatch.setattr(J, "region_links", lambda regions, texts: moved.append((texts.count(), regions.count())) or links(regions, texts))
    got = J.joined(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == brute(docs)
    assert moved[0][0] == 2


@pytest.mark.parametrize("seed", range(3))
def test_signatures_leave_no_link_out(seed):
    import numpy as np

    rng = np.random.default_rng(seed)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (3, 4, 30, 33, 40, 64, 65, 500)]
    sets += [np.unique(np.concatenate([s[: int(len(s) * share)], rng.integers(0, 1 << 63, more).astype(np.uint64)])) for s in sets for share in (0.82, 0.9, 1.0) for more in (0, 1, len(s) // 9, len(s) // 4)]
    near = J._signed_pairs(np.array(list(map(len, sets)), np.float64), [J.signature(s) for s in sets])
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            shared = len(np.intersect1d(a, b))
            assert near[i, j] or i == j or 100 * shared < 80 * (len(a) + len(b) - shared)
