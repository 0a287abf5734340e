"""Cost-balanced packing of tokenised documents into sequences of a fixed length.

The cost of a sequence is estimated as linear in its tokens plus quadratic in the length of each piece
(attention inside documents). Documents, longest first, go to the sequence of the lowest cost that has
room; a document that does not fit is cut there. Each Spark partition packs its own documents, in pools of
a bounded number of tokens, so nothing is shuffled and no task holds more than a pool.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quire.llm.common import released, table

LENGTH = 2048
END_ID = 1
#: Tokens that a pool holds before it is packed.
POOL_TOKENS = 1 << 20
#: Cost of a token, and of the square of a piece's tokens.
LINEAR, QUADRATIC = 1.0, 1.0 / LENGTH
#: How a byte-level vocabulary writes bytes: printable ones as they are, the others from U+0100 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTES = {b: b if b in _PRINTED else 256 + sum(o not in _PRINTED for o in range(b)) for b in range(256)}
_BLANK = chr(BYTES[32])
#: Latin letters, all in U+00C0 to U+024F but two signs, and characters of Latin texts: those and ASCII, and signs and
#: marks that are neither letters, numbers nor white space.
_LATIN_LETTERS = r"A-Za-z\xB5\xC0-\xD6\xD8-\xF6\xF8-\u024F"
LATIN = r"\x00-\x7F\xA1-\xA9\xAB-\xB1\xB4\xB6-\xB8\xBB\xBF-\u024F\u2010-\u2027\u2030-\u205E"
SCHEMA = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def _listed(letters: str) -> str:
    """The pattern of pre-tokens for texts whose only letters are ``letters``."""
    plain = public_tokenizers.PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"[^\t-\r {letters}0-9]")
    return plain.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", "[0-9]").replace(r"\s", r"[\t-\r ]").replace(r"\S", r"[^\t-\r ]")


class WordTokens:
    """Ids of texts by their pre-tokens, remembered: a byte-level BPE merges inside pre-tokens only.

    About ``limit`` pre-tokens of ``LONG`` characters at most are remembered; longer ones are worked out each time. When
    they are too many, those that most texts had stay, half of ``limit`` at most. Texts that hold a special token are
    encoded whole.
    """

    LONG, PIECE = 64, 20_000

    def __init__(self, path: str, limit: int = 500_000) -> None:
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.model = self.tokenizer.model
        # What it is asked for is new; remembering it there again would only take time.
        self.model._resize_cache(0)
        self.find = regex.compile(public_tokenizers.PATTERN).findall
        # The same for Latin texts, where letters, digits and white space can be listed; the standard module is quicker.
        self.latin = re.compile(f"[{LATIN}]*").fullmatch
        self.find_latin = re.compile(_listed(_LATIN_LETTERS)).findall
        self.find_ascii = re.compile(_listed("A-Za-z")).findall
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.place: dict[str, int] = {}
        self.start, self.length, self.ids = array("i"), array("i"), array("I")
        self.texts = np.zeros(limit, np.uint32)

    def forget(self) -> None:
        """Keeps the pre-tokens that most texts had, and only such as two texts had."""
        texts = self.texts[: len(self.start)]
        least = 2 if len(texts) <= self.limit // 2 else max(2, int(np.partition(texts, -(self.limit // 2) - 1)[-(self.limit // 2) - 1]) + 1)
        kept = {w: at for w, at in self.place.items() if texts[at] >= least}
        at = np.fromiter(kept.values(), np.int64, len(kept))
        start, length, ids = (np.frombuffer(a, k).copy() for a, k in ((self.start, np.int32), (self.length, np.int32), (self.ids, np.uint32)))
        n = length[at]
        ends = np.cumsum(n, dtype=np.int32)
        index = np.repeat(start[at] - (ends - n), n) + np.arange(n.sum())
        self.place = dict(zip(kept, range(len(kept)), strict=True))
        self.start, self.length, self.ids = (array(k, a.tobytes()) for k, a in (("i", ends - n), ("i", n), ("I", ids[index].astype(np.uint32))))
        self.texts = np.concatenate([texts[at], np.zeros(max(0, self.limit - len(at)), np.uint32)])

    def learn(self, words: list[str]) -> list[int]:
        """The places of pre-tokens: the model's ids of their bytes as the vocabulary writes them."""
        place, tokenize, ids, start, length = self.place, self.model.tokenize, self.ids, self.start, self.length
        out = []
        for word in words:
            at = place.get(word)
            if at is None:
                at = len(start)
                if len(word) <= self.LONG:
                    place[word] = at
                # Most are a blank and printable signs, which the vocabulary writes as they are.
                own = [t.id for t in tokenize(_BLANK + word[1:] if word[0] == " " and word.isascii() and word[1:].isalnum() else word.encode().decode("latin-1").translate(BYTES))]
                start.append(len(ids))
                length.append(len(own))
                ids.extend(own)
            out.append(at)
        return out

    def encode(self, text: str) -> np.ndarray:
        if not text or any(s in text for s in self.special):
            return np.array([*self.tokenizer.encode(text, add_special_tokens=False).ids, END_ID], dtype="<u4")
        words = (self.find_ascii if text.isascii() else self.find_latin if self.latin(text) else self.find)(text)
        if len(words) > self.PIECE:
            # A very long text, piece by piece: pre-tokens don't reach over its ends.
            parts = [self._ids(words[at : at + self.PIECE]) for at in range(0, len(words), self.PIECE)]
        else:
            parts = [self._ids(words)]
        return np.concatenate([*parts, np.array([END_ID], np.uint32)]).astype("<u4")

    def _ids(self, words: list[str]) -> np.ndarray:
        if len(self.start) > self.limit:
            self.forget()
        at = np.fromiter(map(self.place.get, words, itertools.repeat(-1)), np.int32, len(words))
        new = np.flatnonzero(at < 0).tolist()
        if new:
            at[new] = self.learn([words[i] for i in new])
        if len(self.texts) < len(self.start):
            self.texts = np.concatenate([self.texts, np.zeros(len(self.start), np.uint32)])
        self.texts[at] += 1
        n = np.frombuffer(self.length, np.int32)[at]
        ends = np.cumsum(n, dtype=np.int32)
        index = np.repeat(np.frombuffer(self.start, np.int32)[at] - (ends - n), n)
        index += np.arange(len(index), dtype=np.int32)
        # A copy, which lets the arrays grow again.
        return np.frombuffer(self.ids, np.uint32)[index]


@functools.cache
def word_tokens(path: str) -> WordTokens:
    """One for each worker process, which tasks share one after the other."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return WordTokens(path)


def capacities(total: int, length: int = LENGTH) -> list[int]:
    """Sequences that ``total`` tokens fill without padding: full ones, and the rest in powers of two."""
    full, rest = divmod(total, length)
    return [length] * full + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def balance(pieces: list[tuple[int, int, int]], length: int = LENGTH) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, tokens, sequence, offset) of ``pieces`` (tokens, document, start), longest first.

    The heap holds sequences with room by cost; the cheapest takes as much of the piece as it has room for.
    Ties go to the lower sequence number.
    """
    room = capacities(sum(n for n, _, _ in pieces), length)
    used = [0] * len(room)
    heap = [(0.0, s) for s in range(len(room))]
    for n, doc, start in sorted(pieces, key=lambda p: (-p[0], p[1], p[2])):
        while n:
            cost, s = heapq.heappop(heap)
            take = min(n, room[s] - used[s])
            yield doc, start, take, s, used[s]
            used[s] += take
            n, start = n - take, start + take
            if used[s] < room[s]:
                heapq.heappush(heap, (cost + LINEAR * take + QUADRATIC * take * take, s))


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, length: int = LENGTH) -> DataFrame:
    """Pieces of all documents: whole texts, null as empty; each id (the end id included) in one piece.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers. Repeated rows and null keys are
    documents of their own. sequence_id is unique: the Spark partition in the high bits, a counter below.
    ``path`` is the tokenizer's file on the executors; by default the public byte-level one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokens(path or public_tokenizers.path("byte_bpe_50k.json"))
        first = TaskContext.get().partitionId() << 33
        made = 0

        def flush(pool: list[tuple[int | None, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            nonlocal made
            rows, pieces, sequences = [], [], 0
            for i, (_, ids) in enumerate(pool):
                whole = len(ids) // length * length
                for start in range(0, whole, length):
                    rows.append((i, start, length, sequences, 0))
                    sequences += 1
                if len(ids) > whole:
                    pieces.append((len(ids) - whole, i, whole))
            last = sequences - 1
            for i, start, n, s, offset in balance(pieces, length):
                rows.append((i, start, n, sequences + s, offset))
                last = max(last, sequences + s)
            for at in range(0, len(rows), 4096):
                part = rows[at : at + 4096]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([pool[i][0] for i, *_ in part], pa.int64()),
                        pa.array([r[1] for r in part], pa.int64()),
                        pa.array([r[2] for r in part], pa.int64()),
                        pa.array([pool[i][1][start : start + n].tobytes() for i, start, n, _, _ in part], pa.binary()),
                        pa.array([len(pool[i][1]) for i, *_ in part], pa.int64()),
                        pa.array([first + made + r[3] for r in part], pa.int64()),
                        pa.array([r[4] for r in part], pa.int64()),
                    ],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )
            made += last + 1

        pool: list[tuple[int | None, np.ndarray]] = []
        held = 0
        for batch in batches:
            for doc, raw in zip(batch.column(0), batch.column(1), strict=True):
                ids = words.encode(raw.as_py() or "")
                pool.append((doc.as_py(), ids))
                held += len(ids)
                if held >= POOL_TOKENS:
                    yield from flush(pool)
                    pool, held = [], 0
        if pool:
            yield from flush(pool)

    return docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(released(run), SCHEMA)


def packed_digest(docs: DataFrame) -> DataFrame:
    return pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of LENGTH tokens."""
    return packed_digest(table(spark, sf_dir, "documents"))


QUERIES = {"op9_packing": op9_packing}
ORACLES: dict[str, str] = {}
