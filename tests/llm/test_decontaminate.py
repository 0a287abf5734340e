import math
import random

from quire.llm import decontaminate as D

SCHEMA = "doc_id bigint, text string, matches string"


def brute(docs, items):
    """(doc_id, item_id) of every window of an item's length that holds enough weighted shingles of the item."""
    sets = {k: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for k, t in items if len(w := D.plain_words((t or "").encode())) >= 5}
    df = {}
    for s in sets.values():
        for g in s:
            df[g] = df.get(g, 0) + 1
    weight = {g: math.log1p(len(sets) / n) for g, n in df.items()}
    length = {k: len(D.plain_words(t.encode())) for k, t in items if k in sets}
    out = set()
    for key, text in docs:
        words = D.plain_words((text or "").encode())
        for k, s in sets.items():
            n = min(length[k], len(words))
            for at in range(max(0, len(words) - n + 1)):
                held = {tuple(words[i : i + 5]) for i in range(at, at + n - 4)} & s
                if sum(weight[g] for g in held) >= D.LEAST * sum(weight[g] for g in s) - 1e-6:
                    out.add((key, k))
                    break
    return out


def test_finds_exact_and_near_passages_and_no_others(spark):
    random.seed(3)
    word = lambda: "".join(random.choice("abcdefghijklm") for _ in range(random.randint(2, 7)))
    items = [(k, " ".join(word() for _ in range(random.choice([30, 45, 60])))) for k in range(20)] + [(90, None), (91, "too short"), (92, "")]
    docs = [(1, None), (2, ""), (3, "one"), (None, items[4][1])]
    for k in range(10, 40):
        passage = items[k % 20][1].split()
        for _ in range(k % 4):
            passage[random.randrange(len(passage))] = word()
        body = [word() for _ in range(random.choice([0, 5, 400]))]
        docs.append((k, " ".join([*body, *passage, *body]).upper() if k % 3 else ", ".join([*body, *passage])))
    docs += [(k, " ".join(word() for _ in range(200))) for k in range(50, 60)] + [(10, docs[4][1])]
    frame = spark.createDataFrame([(k, t, "old") for k, t in docs], SCHEMA)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = D.annotated(frame, bench).collect()
    assert len(rows) == len(docs)
    found = {(r.doc_id, m.item_id) for r in rows for m in r.matches}
    want = brute(docs, items)
    exact = {(k, i) for k, t in docs for i, own in items if t and own and len(own) > 20 and own in t.lower().replace(",", "")}
    assert exact <= found <= want
    assert len(want - found) <= 1, "fingerprints of windows at the threshold itself may differ in more bits"


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    bench = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "a b c d e f", "x")], SCHEMA)
    assert D.annotated(docs, bench).collect() == []
    assert [r.matches for r in D.annotated(some, bench).collect()] == [[]]


def test_copies_of_repetitive_items_are_found():
    random.seed(8)
    word = lambda: "".join(random.choice("abcdefghijklm") for _ in range(random.randint(3, 8)))
    items = [(k, " ".join([" ".join(word() for _ in range(9)) + " "] * 20 + [word() for _ in range(44)]).encode()) for k in range(12)]
    index = D.ItemIndex(items)
    assert [[m["item_id"] for m in index.matches(b"before it " + t + b" after it")] for _, t in items] == [[k] for k, _ in items]


def test_weights_count_items_of_all_blocks(spark, monkeypatch):
    random.seed(9)
    word = lambda: "".join(random.choice("abcdefghijklm") for _ in range(random.randint(3, 8)))
    shared = " ".join(word() for _ in range(30))
    items = [(k, f"{shared} " + " ".join(word() for _ in range(20))) for k in range(12)] + [(20, "too short"), (21, None)]
    docs = [(k, f"{shared} " + " ".join([*t.split()[30 : 30 + n], *(word() for _ in range(20 - n))]), "x") for k, t in items[:12] for n in (15, 17, 20)]
    frame, bench = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id bigint, text string")
    found = lambda: sorted((r.doc_id, r.text, m.item_id, m.similarity) for r in D.annotated(frame, bench).collect() for m in r.matches)
    whole = found()
    monkeypatch.setattr(D, "BLOCK_CHARS", 1000)
    assert found() == whole and len(whole) >= 12
