"""Fingerprints, conversation repair and phrase mining against brute force."""

import hashlib
import itertools
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quire.llm import conversations as C
from quire.llm import fingerprints as P
from quire.llm import phrases as K

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, path, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


# Fingerprints


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_of_documents_and_their_edits(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(P, "STRETCH", 7)
    rng = np.random.default_rng(3)
    prose = lambda n: " ".join(f"w{v}" for v in rng.integers(0, 400, n))
    texts = [prose(int(n)) for n in rng.integers(1, 700, 60)] + [None, "", " \n", "One", "one two three", "É" * 9, prose(20_000), "same text here " * 40, "same text here " * 40]
    ids = [int(i) for i in rng.permutation(len(texts)) * 3]
    rows = [(i, t, "en", "s", 0) for i, t in zip(ids, texts, strict=True)]
    found = P.op11_document_fingerprints(spark, table(spark, tmp_path, "documents", rows, DOCS)).toPandas().set_index("doc_id")
    by_id = dict(zip(ids, (t or "" for t in texts), strict=True))
    order = sorted(by_id)
    assert sorted(found.index) == order
    misses = []
    for k, i in enumerate(order):
        own, after = by_id[i], by_id[order[(k + 1) % len(order)]]
        q = len(own) // 4
        changed = own[: len(own) - q] + after[:q]
        r = found.loc[i]
        assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(changed.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        misses += [r.near_edited - jaccard(shingles(own), shingles(changed)), r.near_next - jaccard(shingles(own), shingles(after))]
    assert np.sqrt(np.mean(np.square(misses))) < 0.04 and max(map(abs, misses)) < 0.2
    prints = pd.Series({i: found.loc[i].fingerprint for i in order})
    assert all((prints[a] == prints[b]) for a, b in itertools.combinations(order, 2) if by_id[a] == by_id[b])
    assert len(prints[ids[0]]) == P.BINS and found.loc[ids[texts.index("")]].fingerprint == ""


def test_next_rows_with_ties_nulls_and_no_rows(spark, monkeypatch):
    monkeypatch.setattr(P, "STRETCH", 2)
    rows = [(5, "e"), (1, "b"), (1, "a"), (9, "z"), (None, "n"), (None, "n"), (7, "g"), (7, "g"), (3, "c")]
    docs = spark.createDataFrame(rows, "id long, body string")
    found = sorted(P.with_next(docs, "body").select("body", "next_body").collect())
    assert [tuple(r) for r in found] == [("a", "b"), ("b", "c"), ("c", "e"), ("e", "g"), ("g", "g"), ("g", "z"), ("n", "n"), ("n", "n"), ("z", "a")]
    assert P.with_next(docs.limit(0), "body").count() == 0
    assert [r.next_body for r in P.with_next(docs.where("id = 9"), "body").collect()] == ["z"]


def test_fingerprints_keep_other_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "x")], "doc_id long, text string, hash string")
    assert P.fingerprints(docs).columns == ["doc_id", "text", "hash", "fingerprint"]


def test_empty_bins_ask_in_independent_full_orders():
    orders = P.probes()
    assert all(sorted(o) == list(range(P.BINS)) for o in orders) and len({tuple(o) for o in orders}) == P.BINS


# Conversations


def least_repair(turns):
    """All edits of a few turns tried: (cost, audit, repaired) that is least."""
    sound = re.compile(r"(s?(ua)+)?")
    best = None
    for inserts in itertools.product(range(3), repeat=len(turns) + 1):
        if sum(inserts) > len(turns) + 2:
            continue
        for edits in itertools.product("KRD", repeat=len(turns)):
            if any(e != "D" and f in "bd" for e, (_, _, f) in zip(edits, turns, strict=True) if f):
                continue
            letters = "I" * inserts[0] + "".join(e + "I" * n for e, n in zip(edits, inserts[1:], strict=True))
            cost = 2 * sum(inserts) + sum({"K": 0, "R": 2, "D": 3}[e] + (e != "D" and f == "t") for e, (_, _, f) in zip(edits, turns, strict=True))
            if best is not None and (cost, letters) >= best[:2]:
                continue
            own, roles = iter(turns), []
            for e in letters:
                role, text, _ = ("", "", "") if e == "I" else next(own)
                if e != "D":
                    roles.append((role[:1] if e == "K" else None, role, text))
            # A given role is what its neighbours ask for: all of u and a are tried.
            for choice in itertools.product("ua", repeat=sum(r[0] is None for r in roles)):
                given = iter(choice)
                initials = [r[0] if r[0] is not None else next(given) for r in roles]
                if sound.fullmatch("".join(i or "?" for i in initials)):
                    names = {"u": "user", "a": "assistant"}
                    said = "\n".join(f"{role if i0 is not None else names[i]}:{text}" for (i0, role, text), i in zip(roles, initials, strict=True))
                    best = (cost, letters, said)
                    break
    return best


def faults(rows):
    """(role, text, fault) by turn, nulls first, ties by role and text."""
    out, seen = [], set()
    for _, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])):
        body = text.strip(" \t\n\x0b\x0c\r")
        out.append((role, text, "b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else ""))
        seen.add((role, text))
    return out


def test_repairs_are_the_least_of_all(spark):
    rng = np.random.default_rng(8)
    rows = []
    for conv in range(60):
        for _ in range(int(rng.integers(1, 5))):
            turn = None if rng.random() < 0.1 else int(rng.integers(0, 6))
            rows.append((conv, turn, str(rng.choice(["user", "assistant", "system", "tool", "user"])), str(rng.choice(["Yes.", "No", "", "So!", "Yes."]))))
    found = C.summary(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).toPandas().set_index("conv_id")
    for conv in range(60):
        own = [r[1:] for r in rows if r[0] == conv]
        turns, r = faults(own), found.loc[conv]
        cost, audit, said = least_repair(turns)
        assert (r.cost, r.audit) == (cost, audit)
        assert r.repaired_sha256 == hashlib.sha256(said.encode()).hexdigest()
        known = [t for t, _, _ in own if t is not None]
        assert r.gaps == (max(known) - min(known) + 1 - len(set(known)) if known else 0)
        assert [r.blank, r.duplicate, r.truncated] == [sum(f == k for _, _, f in turns) for k in "bdt"]
        initials = [role[:1] for role, _, _ in turns]
        assert r.illegal == sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))


def test_long_conversations_hold_little(spark):
    held = []
    repair = C.Repair(lambda *_: None)
    for k in range(20_000):
        repair.take(k, ("user", "assistant", "user", "tool")[k % 4], f"Text {k}.", "b" if k % 7 == 0 else "")
        held.append(len(repair.held))
    cost, audit = repair.end()
    assert max(held) < 100 and len(audit) >= 20_000 and cost > 0


def test_damage_edits_and_odd_rows(spark, tmp_path):
    schema = "conv_id long, turn long, role string, text string, fault string, gone string"
    rows = [(c, t, ("user", "assistant")[t % 2], f"Said {c} {t}.", "x", "y") for c in range(40) for t in range(6)]
    rows += [(None, None, None, None, "x", "y"), (None, None, None, None, "x", "y"), (77, None, "user", "Well. " * 20_000, "x", "y")]
    path = table(spark, tmp_path, "conversations", rows, schema)
    found = C.op12_conversation_repair(spark, path).toPandas()
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{path}/conversations.parquet/*.parquet'")
    wanted = con.execute(C.ORACLES["op12_conversation_repair"]).df()
    as_rows = lambda df: sorted(df[sorted(df.columns)].astype(str).replace({"<NA>": "nan", "None": "nan"}).itertuples(index=False, name=None))
    assert [tuple(v.replace(".0", "") for v in r) for r in as_rows(found)] == [tuple(v.replace(".0", "") for v in r) for r in as_rows(wanted)]
    assert len(found) == 42
    dropped = {(c, t) for c, t, *_ in rows if c is not None and t is not None and zlib.crc32(f"{c}:{t}".encode()) % 20 == 0}
    assert C.damaged(spark.read.parquet(f"{path}/conversations.parquet")).where("gone and turn is not null").count() == len(dropped)
    edits = C.repaired(spark.read.parquet(f"{path}/conversations.parquet").where("conv_id = 3")).orderBy("place").collect()
    assert [(e.edit, e.role, e.turn) for e in edits] == [("K", ("user", "assistant")[t % 2], t) for t in range(6)]
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.summary(empty).count() == 0 and C.repaired(empty).count() == 0


def test_conversation_with_all_rows_dropped(spark):
    gone = spark.createDataFrame([(1, 0, "user", "A.")], "conv_id long, turn long, role string, text string").withColumn("gone", F.lit(True))
    r = C.summary(gone, gone="gone").first()
    assert (r.audit, r.cost, r.gaps, r.repaired_sha256) == ("", 0, 0, hashlib.sha256(b"").hexdigest())


# Phrases


def mined(rows, least, share, most):
    counts, totals = {}, {}
    for lang, text in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] = totals.get(lang, 0) + len(w)
            for n in range(1, 5):
                for i in range(len(w) - n + 1):
                    g = (lang, *w[i : i + n])
                    counts[g] = counts.get(g, 0) + 1
    cands = {g: a for g, a in counts.items() if len(g) > 2 and a >= least}
    out = {}
    for g, a in cands.items():
        lang, w = g[0], g[1:]
        inside = any(h[0] == lang and len(h) > len(g) and 100 * f >= share * a and any(h[1 + i : 1 + i + len(w)] == w for i in range(len(h) - len(w))) for h, f in cands.items())
        if inside:
            continue
        score, _, left, right = min((2_000_000 * a // (counts[(lang, *w[:k])] + counts[(lang, *w[k:])]), k, counts[(lang, *w[:k])], counts[(lang, *w[k:])]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, rank, p.decode(), -a, left, right, totals[lang], -s) for lang, own in out.items() for rank, (s, a, p, left, right) in enumerate(sorted(own)[:most], 1))


@pytest.mark.parametrize("tiny", [False, True])
def test_phrases_against_brute_force(spark, monkeypatch, tiny):
    if tiny:  # Many shards, salts, slices and flushes.
        for name, value in {"GATHERED": 50, "SHARD_KEYS": 4, "FAN": 2, "_BYTES": 40, "_SLICE": 100, "ASKED": 3}.items():
            monkeypatch.setattr(K, name, value)
    rng = np.random.default_rng(5)
    words = ["The", "red", "fox", "ran", "É", "x\ty", "far", "a b"]
    texts = [" ".join(rng.choice(words, int(n))) + str(rng.choice([".", ",", "\n", "\x0b", " ", ";"])) for n in rng.integers(0, 30, 80)]
    rows = [(str(rng.choice(["en", "de"])) if rng.random() < 0.9 else None, "".join(texts[int(k) : int(k) + 4])) for k in rng.integers(0, 76, 40)]
    rows += [("en", None), ("en", ""), (None, "red fox " * 60), ("en", "hit hit " * 40), ("en", "y" * 300 + " red fox"), ("en", "red fox"), ("en", "red fox"), ("once", "only this")]
    docs = spark.createDataFrame(rows, "lang string, text string").withColumn("code", F.lit("clash")).repartition(3)
    found = K.best(K.collocations(docs, least=6, share=80), most=25).collect()
    assert sorted(tuple(r) for r in found) == mined(rows, 6, 80, 25)


def test_no_phrases(spark):
    docs = spark.createDataFrame([("en", "too few words")], "lang string, text string")
    assert K.collocations(docs).count() == 0 and K.collocations(docs.limit(0)).count() == 0


def test_only_phrases_that_may_be_frequent_are_counted_by_whole_codes(spark, monkeypatch):
    rng = np.random.default_rng(3)
    # Every pair is frequent, longer phrases are rare but for one.
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 12, 60)) + ". red fox ran far" for _ in range(120)]
    docs = spark.createDataFrame([("en", t) for t in texts], "lang string, text string").repartition(3)
    seen = []
    counts = K.counts_of
    monkeypatch.setattr(K, "counts_of", lambda *a: seen.append(counts(*a)) or seen[0])
    found = K.best(K.collocations(docs, least=30, share=80), most=500).collect()
    assert sorted(tuple(r) for r in found) == mined([("en", t) for t in texts], 30, 80, 500)
    keys = sum(len(r["keys"]) // 8 for r in seen[0].collect())
    # 16 words, 147 pairs, two triples and one phrase of four; some others may pass for frequent.
    assert 166 <= keys < 1_000


def test_short_codes_come_back():
    short = np.array([0, 1, 5, 1 << 20, (1 << 36) - 1], np.uint64)
    times = np.array([1, 300, 1, 70_000, 2], np.int64)
    for shards in (1, 3):
        rows = list(K._short(short, times, shards))
        assert np.concatenate([np.cumsum(K._unplaned(s, "<u8")) for _, s, _ in rows]).tolist() == short.tolist()
        assert np.concatenate([K._unplaned(n, "<u4") for *_, n in rows]).tolist() == times.tolist()


def test_perfect_hash_knows_its_keys_only():
    rng = np.random.default_rng(1)
    codes = np.unique(rng.integers(0, 1 << 63, 50_000).astype(np.uint64))
    keys, others = codes[::2], codes[1::2]
    hashed = K.PerfectHash(keys)
    assert sorted(hashed(keys)) == list(range(len(keys))) and (hashed(others) == -1).all()
