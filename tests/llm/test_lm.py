import math
from collections import Counter

import numpy as np

from quire.llm import lm as L

SCHEMA = "doc_id bigint, text string, row string, w string"


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def test_base_scores_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(L, "FREQUENT", 6)
    monkeypatch.setattr(L, "KNOWN", 5)
    train = [(1, "the cat sat on the mat"), (2, "The dog\tsat"), (3, None), (4, ""), (5, "rare words here the the end"), (5, "rare words here the the end")]
    docs = [*train, (6, "unseen words sat here"), (None, "the Ünseen"), (7, "x y z " * 300), (8, "sat sat sat")]
    frame = lambda rows: spark.createDataFrame([(k, t, "a", "b") for k, t in rows], SCHEMA)
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in L.scored(frame(docs), frame(train)).collect())
    counts = Counter(w for _, t in train for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(k), len(tokens(t)), sum(w in counts for w in tokens(t)), n, round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)), 6)) for k, t in docs)
    assert got == want


def test_probabilities_sum_to_one_and_training_helps():
    model = L.Bilinear([50, 40, 30, 5])
    rng = np.random.default_rng(0)
    goal = rng.integers(0, 3, 4096)
    one = (goal + 1) % 3
    before = model.tables()
    for at in range(0, 4096, 64):
        model.step(one[at : at + 64], one[at : at + 64], goal[at : at + 64], rng.integers(0, 4, 32))
    after = model.tables()
    for t1, t2, norm in (before, after):
        p = np.exp(t1[:, None, :] + t2[None, :, :] - norm[:, :, None])
        assert np.allclose(p.sum(2), 1, atol=1e-4)
    score = lambda t: float((t[0][one, goal] + t[1][one, goal] - t[2][one, one]).mean())
    assert score(after) > score(before) + 0.3


def test_no_training_texts(spark):
    docs = spark.createDataFrame([(1, "a b", "x", "y"), (2, None, "x", "y")], SCHEMA)
    rows = {r.doc_id: r for r in L.scored(docs, docs.limit(0)).collect()}
    assert rows[1].n_tokens == 3 and rows[2].n_tokens == 1 and rows[1].n_known == 0 and rows[1].train_tokens == 0
    assert math.isclose(rows[1].base_score, 0.0, abs_tol=1e-9) and math.isfinite(rows[1].score)
    assert L.scored(docs.limit(0), docs).collect() == []


def test_every_position_is_trained_on(spark):
    # A position moves the vectors of the words before it, however short its text.
    texts = spark.createDataFrame([(b"a b c",), (b"d",), (b"e f",), (None,)], "raw binary")
    _, counts = L.counted(texts)
    model, ids = L.fitted(texts, counts)
    fresh = L.Bilinear(counts.class_sizes())
    moved = {w for w, i in ids.items() if not np.allclose(model.Q[i], fresh.Q[i], atol=1e-7)}
    # Every token is the word before some position; the end stands before the first.
    assert moved == set(ids)
