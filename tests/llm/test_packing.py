import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from quire.llm import packing as P

SCHEMA = "doc_id bigint, text string, start string"


def test_every_id_lies_in_one_piece_and_sequences_have_no_padding(spark):
    long = " ".join(f"word{i % 700} {i}" for i in range(4000))
    docs = [(1, None), (2, ""), (3, " "), (4, "naïve café, 東京 and\r\n\ttabs  don't"), (5, long), (6, long), (7, "x" * 5000), (None, "no id"), (8, "ends <|endoftext|> inside"), *[(100 + i, "short text " * (i % 40)) for i in range(200)]]
    rows = P.pack(spark.createDataFrame([(k, t, "x") for k, t in docs], SCHEMA).repartition(3)).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted(([k, *tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for k, t in docs), key=str)
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        assert r.length > 0 and len(r.ids) == 4 * r.length
    got = []
    for key, own in pieces.items():
        own.sort(key=lambda r: r.start)
        assert [r.start for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
        assert all(r.doc_tokens == sum(x.length for x in own) for r in own)
        got.append([key, *np.frombuffer(b"".join(r.ids for r in own), "<u4").tolist()])
    assert sorted(got, key=str) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
        total = sum(n for _, n in own)
        assert total <= P.LENGTH and total & (total - 1) == 0


def test_digest_and_empty_table(spark):
    rows = P.packed_digest(spark.createDataFrame([(1, "", "x")], SCHEMA)).collect()
    assert [(r.length, r.ids_crc32, r.doc_tokens) for r in rows] == [(1, zlib.crc32(b"\x01\0\0\0"), 1)]
    assert P.packed_digest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_longest_first_to_the_cheapest_sequence():
    out = list(P.balance([(5, 0, 0), (9, 1, 0), (6, 2, 0)], length=8))
    assert out[0][:3] == (1, 0, 8) and sum(n for _, _, n, _, _ in out) == 20
    assert P.capacities(20, 8) == [8, 8, 4]


def test_ascii_texts_are_cut_alike_by_both_patterns():
    words, rng = P.word_tokens(public_tokenizers.path("byte_bpe_50k.json")), random.Random(1)
    signs = [chr(i) for i in range(128)] + [" "] * 20 + ["'"] * 10 + list("stremvdll ") * 3
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 30))) for _ in range(20_000)]
    assert all(words.find(t) == words.find_ascii(t) for t in texts)


def test_latin_texts_are_cut_like_any_other():
    words = P.WordTokens(public_tokenizers.path("byte_bpe_50k.json"), limit=50)
    signs, rng = [c for c in map(chr, range(0x2060)) if words.latin(c)], random.Random(4)
    for _ in range(400):
        text = "".join(rng.choice(signs) if rng.random() < 0.4 else rng.choice(" \n'stedé1²") for _ in range(80))
        assert words.latin(text) is None or words.find_latin(text) == words.find(text)
        assert words.encode(text)[:-1].tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids
