"""Collocations: phrases of two to four words that stand together more often than their parts suggest.

Phrases are known by 64-bit codes of language and words. Pairs of words that are frequent enough make longer phrases
possible (a phrase can't be more frequent than any part of it). Shorter codes, counted first, tell which words and pairs,
and then which longer phrases, may be frequent at all; only these candidates are the keys of minimal perfect hashes. Keys are dealt into shards by their codes, each small enough for one task; the texts' phrases, counted within
each task first, are dealt the same way, tasks add them up in numpy arrays by slot, and these are summed in a tree. Parts of a cut are read from these arrays by slot.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm import common
from quire.llm.common import bounded, give_back, mixed, released, rolled, stored, table

LONGEST = 4
LEAST = 30
#: A phrase goes when a longer one around it has this share of its occurrences.
SHARE = 80
MOST_PHRASES = 2000
SCALE = 2_000_000
#: Codes that a task gathers before it counts them.
GATHERED = 1 << 21
#: Frequent words and pairs that a shard has, about: it holds their phrases' keys too.
SHARD_KEYS = 1 << 13
#: Pieces that one task adds up; more pieces make more tasks and a deeper tree.
FAN = 64
#: Bits of the sets that tell tasks which pairs may be frequent, and which phrases to write out: 32 a member, 2**30
#: (128 MB) at most. Beyond that more candidates pass, and results stay the same.
MEMBER_BITS, MOST_BITS = 32, 1 << 30
SPREAD = 64
#: Bits of the codes that tell what may be frequent, and bytes of texts whose codes meet in a task: about two million.
#: A shorter code only lets more pass, which is then counted by whole codes.
SHORT, SHORT_BYTES = 36, 8 << 20
_SHORT = np.uint64((1 << SHORT) - 1)
#: Parts that one task reads. Their sizes are one row a shard, of at most some ten thousand shards.
ASKED = 1 << 20

_PIECE = np.zeros(256, bool)
_PIECE[list(b".,;:!?\n\x0b\x0c\r")] = True
_GAP = _PIECE.copy()
_GAP[list(b" \t")] = True
_GAPS = [bytes([b]) for b in np.flatnonzero(_GAP)]
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_BYTES = (1 << 20) - 64
_TEXT = np.uint64(xxhash.xxh3_64_intdigest(b"text") | 1)
#: Bytes of texts that are looked at together; a longer text is taken whole.
_SLICE = 2 << 20


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(ends):
            before = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + _SLICE, "right")))
            yield batch.slice(at, end - at)
            at = end


class Words:
    """Words of a batch of texts: code (of language and word), piece, place in ``raw`` and checksum of the text of each."""

    def __init__(self, texts: pa.Array, langs: pa.Array) -> None:
        texts = pc.fill_null(texts.cast(pa.binary()), b"")
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        # One text after the other, with a line break between them: no phrase crosses it.
        whole = pa.LargeListArray.from_arrays(pa.array([0, len(texts)], pa.int64()), texts.cast(pa.large_binary()))
        self.raw = _LOW[np.frombuffer(pc.binary_join(whole, pa.scalar(b"\n", pa.large_binary()))[0].as_py(), np.uint8)] if len(texts) else np.zeros(0, np.uint8)
        self.langs = pc.fill_null(langs, "und").dictionary_encode()
        prints = np.array([zlib.crc32(t.as_buffer()) for t in texts], np.uint32)
        ends = np.cumsum(sizes + 1)
        codes, starts, stops, pieces = [], [], [], []
        at, n_pieces, raw = 0, 0, self.raw
        while at < len(raw):
            end = self._cut(at)
            b = np.concatenate([[32], raw[at:end], [32]]).astype(np.uint8)
            power, inverse = common._powers(1 << max(12, (len(b) - 1).bit_length()))
            word = ~_GAP[b]
            edges = np.flatnonzero(word[1:] != word[:-1]) + 1
            start, stop = edges[::2], edges[1::2]
            total = np.cumsum(common._BYTE[b] * power[: len(b)])
            codes.append(mixed((total[stop - 1] - total[start - 1]) * inverse[start] + (stop - start).astype(np.uint64)))
            breaks = np.cumsum(_PIECE[b])
            pieces.append(breaks[start] + n_pieces)
            n_pieces += int(breaks[-1]) if len(b) else 0
            starts.append(start + at - 1)
            stops.append(stop + at - 1)
            at = end
        none = np.zeros(0, np.int64)
        self.start, self.stop, self.piece = (np.concatenate(x) if x else none for x in (starts, stops, pieces))
        text = np.searchsorted(ends, self.start, "right")
        self.lang = self.langs.indices.to_numpy(zero_copy_only=False)[text] if len(text) else none
        self.text = prints[text] if len(text) else np.zeros(0, np.uint32)
        names = np.array([xxhash.xxh3_64_intdigest(b"lang " + v.encode()) for v in self.langs.dictionary.to_pylist()], np.uint64)
        self.code = mixed(np.concatenate(codes) + names[self.lang]) if len(text) else np.zeros(0, np.uint64)

    def _cut(self, at: int) -> int:
        """End of the next stretch of about _BYTES, between words; a longer word is taken whole."""
        end = at + _BYTES
        if end >= len(self.raw):
            return len(self.raw)
        gaps = np.flatnonzero(_GAP[self.raw[at:end]])
        if len(gaps) and gaps[-1]:
            return at + int(gaps[-1])
        while end < len(self.raw) and not _GAP[self.raw[end]]:
            end += 1
        return end

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Codes of all runs of n words by their first word, and which of them lie within a piece."""
        m = len(self.code) - n + 1
        if m <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        return (rolled(self.code, n) if n > 1 else self.code), self.piece[:m] == self.piece[n - 1 :]


class Members:
    """A set of codes in bits: true for all members, and rarely for others."""

    def __init__(self, bits: np.ndarray) -> None:
        self.bits, self.mask = bits, np.uint64(len(bits) * 8 - 1)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        at = codes & self.mask
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _members(codes: DataFrame, n: int) -> np.ndarray:
    """Bits of the codes, gathered in blocks; their size is bounded by MOST_BITS, whatever n is."""
    size = min(max(1 << (MEMBER_BITS * max(n, 1) - 1).bit_length(), 1 << 16), MOST_BITS)
    block = min(size, 1 << 20)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) & np.uint64(size - 1)
            which = (at // np.uint64(block)).astype(np.int64)
            for k in np.unique(which).tolist():
                own = blocks.setdefault(k, np.zeros(block, bool))
                own[(at[which == k] % np.uint64(block)).astype(np.int64)] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(blocks), pa.int64()), pa.array([np.packbits(v, bitorder="little").tobytes() for v in blocks.values()], pa.binary())], ["block", "bits"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                new = np.frombuffer(bits, np.uint8)
                blocks[k] = blocks[k] | new if k in blocks else new
        yield pa.RecordBatch.from_arrays([pa.array(list(blocks), pa.int64()), pa.array([v.tobytes() for v in blocks.values()], pa.binary())], ["block", "bits"])

    parts = codes.select("code").mapInArrow(released(run), "block bigint, bits binary").repartition("block").mapInArrow(released(merge), "block bigint, bits binary")
    out = np.zeros(size // 8, np.uint8)
    for k, bits in parts.collect():
        out[k * block // 8 : (k + 1) * block // 8] = np.frombuffer(bits, np.uint8)
    return out


class PerfectHash:
    """Minimal perfect hash of different 64-bit keys, by levels of bits: at each level the keys that are alone in
    their place have it, the others go on. A slot is the number of taken places before it."""

    def __init__(self, keys: np.ndarray) -> None:
        self.levels: list[tuple[np.uint64, np.ndarray, np.ndarray]] = []
        left, base = keys, 0
        while len(left):
            size = np.uint64(2 * len(left) + 64)
            at = self._place(left, len(self.levels), size)
            alone = np.bincount(at, minlength=int(size)) == 1
            rank = np.cumsum(alone) - alone + base
            self.levels.append((size, alone, rank))
            base += int(alone.sum())
            left = left[~alone[at]]
        self.keys = np.zeros(len(keys), np.uint64)
        self.keys[self._slots(keys)] = keys

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: np.uint64) -> np.ndarray:
        return (mixed(keys + np.uint64(xxhash.xxh3_64_intdigest(b"level %d" % level))) % size).astype(np.int64)

    def _slots(self, codes: np.ndarray) -> np.ndarray:
        out = np.full(len(codes), -1, np.int64)
        left = np.arange(len(codes))
        for k, (size, alone, rank) in enumerate(self.levels):
            at = self._place(codes[left], k, size)
            here = alone[at]
            out[left[here]] = rank[at[here]]
            left = left[~here]
        return out

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        """Slots, -1 for codes whose slot's stored key is another."""
        at = self._slots(codes)
        known = at >= 0
        known[known] = self.keys[at[known]] == codes[known]
        return np.where(known, at, -1)


def _witnessed(codes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """A code for each pair of a phrase and a text that holds it."""
    return mixed(codes + text.astype(np.uint64) * _TEXT)


def _added(codes: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different codes in order, the sums of their times, and of each code a place where it stands."""
    code, n = np.concatenate(codes), np.concatenate(times)
    order = code.argsort(kind="stable")
    code = code[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
    return code[first], np.add.reduceat(n[order], first) if len(code) else n, order[first]


class Gathered:
    """Codes of a task with their counts, and the checksum of a text with each: made different whenever GATHERED have
    come, handed on when as many different ones are held (or so many in all that a count might need more than 32 bits)."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.codes, self.times, self.texts, self.fresh, self.known, self.total = [], [], [], 0, 0, 0

    def add(self, codes: np.ndarray, texts: np.ndarray | None = None) -> None:
        self.codes.append(codes)
        self.times.append(np.ones(len(codes), np.int64))
        self.texts.append(np.zeros(len(codes), np.uint32) if texts is None else texts)
        self.fresh += len(codes)
        self.total += len(codes)

    def full(self) -> bool:
        if self.fresh >= GATHERED:
            self.settle()
        return self.known >= GATHERED or self.total >= 1 << 31

    def settle(self) -> None:
        codes, times, at = _added(self.codes, self.times)
        self.codes, self.times, self.texts = [codes], [times], [np.concatenate(self.texts)[at]]
        self.fresh, self.known = 0, len(codes)

    def taken(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.codes:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
        self.settle()
        out = self.codes[0], self.times[0], self.texts[0]
        self.clear()
        return out


def _planed(values: np.ndarray) -> bytes:
    """Numbers byte by byte, each of these planes compressed by itself: the low bytes of steps are random, the others not."""
    codec = pa.Codec("zstd")
    planes = [codec.compress(np.ascontiguousarray(plane), asbytes=True) for plane in values.view(np.uint8).reshape(-1, values.itemsize).T]
    return np.array([len(values), *map(len, planes)], "<u4").tobytes() + b"".join(planes)


def _unplaned(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    n, *sizes = np.frombuffer(data, "<u4", width + 1).tolist()
    ends = np.cumsum([4 * (width + 1), *sizes]).tolist()
    planes = [np.frombuffer(pa.Codec("zstd").decompress(data[i:j], n, asbytes=True), np.uint8) for i, j in zip(ends, ends[1:], strict=False)]
    return np.stack(planes, 1).view(kind).ravel()


def _short(short: np.ndarray, times: np.ndarray, shards: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Steps between codes of SHORT bits, in order, and their counts, by shard."""
    edges = np.searchsorted(short, (np.arange(shards + 1, dtype=np.uint64) * np.uint64(-(-(1 << SHORT) // shards))))
    for shard in np.flatnonzero(np.diff(edges)).tolist():
        own = slice(edges[shard], edges[shard + 1])
        yield shard, _planed(np.diff(short[own], prepend=np.uint64(0)).astype("<u8")), _planed(times[own].astype("<u4"))


def _perhaps_frequent(texts: DataFrame, found: Callable[[Words], list[np.ndarray]], least: int, shards: int) -> DataFrame:
    """code of what ``found`` gives ``least`` times or more in all texts, cut to SHORT bits, and (lang, n) of all words of
    each language where code is null. Counts of codes that are cut alike are added up, so none is missed, and what
    passes is counted anew by whole codes. A code with its count takes about three bytes where a row takes eleven."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, totals = Gathered(), {}
        names = ["shard", "lang", "times", "steps", "counts"]

        def out() -> Iterator[pa.RecordBatch]:
            rows = list(_short(*held.taken()[:2], shards))
            for at in range(0, len(rows), 64):
                own, *data = zip(*rows[at : at + 64], strict=True)
                none = [pa.nulls(len(own), kind) for kind in (pa.string(), pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), *none, *[pa.array(d, pa.binary()) for d in data]], names)

        for batch in _sliced(batches):
            words = Words(batch.column(0), batch.column(1))
            for lang, n in zip(words.langs.dictionary.to_pylist(), np.bincount(words.lang, minlength=len(words.langs.dictionary)).tolist(), strict=True):
                totals[lang] = totals.get(lang, 0) + n
            for codes in found(words):
                held.add(codes & _SHORT)
            if held.full():
                yield from out()
        yield from out()
        none = [pa.nulls(len(totals), pa.binary())] * 2
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(totals), -1, np.int32)), pa.array(list(totals), pa.string()), pa.array(list(totals.values()), pa.int64()), *none], names)

    def add(group: pa.Table) -> pa.Table:
        if group.column("shard")[0].as_py() < 0:
            sums = group.group_by("lang").aggregate([("times", "sum")])
            return pa.table([pa.nulls(len(sums), pa.int64()), sums.column("lang"), sums.column("times_sum")], ["code", "lang", "n"])
        codes, times, _ = _added([np.cumsum(_unplaned(d.as_py(), "<u8")) for d in group.column("steps")], [_unplaned(d.as_py(), "<u4").astype(np.int64) for d in group.column("counts")])
        codes = codes[times >= least]
        give_back()
        return pa.table([pa.array(codes.view(np.int64)), pa.nulls(len(codes), pa.string()), pa.nulls(len(codes), pa.int64())], ["code", "lang", "n"])

    runs = texts.mapInArrow(released(run), "shard int, lang string, times bigint, steps binary, counts binary")
    return stored(runs.groupBy("shard").applyInArrow(add, "code bigint, lang string, n bigint"), "phrase-perhaps")


def _pairs(words: Words) -> list[np.ndarray]:
    pairs, within = words.grams(2)
    return [words.code, pairs[within]]


def _possible(words: Words, member: Members, longer: Members | None = None) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: codes, and which of them are words or phrases all of whose words and pairs (and where ``longer`` is given
    all longer parts too) may be frequent."""
    ones, _ = words.grams(1)
    out = {1: (ones, member(ones))}
    pairs, within = words.grams(2)
    good = within & member(pairs)
    out[2] = pairs, good
    for n in range(3, LONGEST + 1):
        codes, _ = words.grams(n)
        held = good[: len(codes)] & good[1 : 1 + len(codes)]
        at = np.flatnonzero(held)
        if longer is not None:
            held[at] = longer(codes[at])
        out[n] = codes, held
        good = held
    return out


def _longer(texts: DataFrame, bits: np.ndarray, least: int, shards: int) -> DataFrame:
    """Phrases of three words and more that may be frequent, as _perhaps_frequent gives them."""
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def found(words: Words) -> list[np.ndarray]:
        grams = _possible(words, Members(shared.value))
        return [codes[good] for codes, good in (grams[n] for n in range(3, LONGEST + 1))]

    return _perhaps_frequent(texts, found, least, shards).where("code is not null")


def _count_pass(texts: DataFrame, bits: np.ndarray, more: np.ndarray, shards: int) -> DataFrame:
    """shard, codes, times, texts: candidates in the texts, counted in each task first and packed by shard, each with
    the checksum of a text that holds it."""
    context = texts.sparkSession.sparkContext
    shared, longer = context.broadcast(bits), context.broadcast(more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        member, member_longer = Members(shared.value), Members(longer.value)
        held = Gathered()
        for batch in _sliced(batches):
            words = Words(batch.column(0), batch.column(1))
            for codes, good in _possible(words, member, member_longer).values():
                held.add(codes[good], words.text[: len(codes)][good])
            if held.full():
                yield _dealt(*held.taken(), shards)
        yield _dealt(*held.taken(), shards)

    return texts.mapInArrow(released(run), "shard int, codes binary, times binary, texts binary")


def _dealt(codes: np.ndarray, times: np.ndarray, texts: np.ndarray, shards: int) -> pa.RecordBatch:
    shard = (codes >> np.uint64(40)) % np.uint64(shards)
    order = np.argsort(shard, kind="stable")
    names, first = np.unique(shard[order], return_index=True)
    ends = np.append(first[1:], len(order))[: len(first)]
    pick = lambda a, kind: pa.array([a[order[i:j]].astype(kind).tobytes() for i, j in zip(first, ends, strict=True)], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(names.astype(np.int32), pa.int32()), pick(codes, "<u8"), pick(times, "<u4"), pick(texts, "<u4")], ["shard", "codes", "times", "texts"])


def _grouped(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """(key, rows) of a partition sorted by its first ``width`` columns; a row at a time is held."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    following = next(rows, None)
    while following is not None:
        key = following[:width]

        def own() -> Iterator[tuple]:
            nonlocal following
            while following is not None and following[:width] == key:
                yield following
                following = next(rows, None)

        left = own()
        yield key, left
        for _ in left:
            pass


_BLOBS = "shard int, salt int, keys binary, counts binary"

#: What a slot holds: how often its phrase was found, and the checksum of a text with it.
_SLOT = np.dtype([("count", "<i8"), ("text", "<u4")])


def _united(blobs: Iterator[bytes]) -> np.ndarray:
    """Different codes in order; sorted anew only when as many have come as are known."""
    total, held, size = np.zeros(0, "<u8"), [], 0
    for data in blobs:
        held.append(np.frombuffer(data, "<u8"))
        size += len(held[-1])
        if size > max(len(total), GATHERED):
            total, held, size = np.unique(np.concatenate([total, *held])), [], 0
    return np.unique(np.concatenate([total, *held])).astype("<u8")


def _by_slot(pieces: list[tuple[bytes, bytes]]) -> tuple[bytes, bytes]:
    """Keys of all pieces (keys, values of _SLOT) in order, and the sums of their values by the slots of the keys' hash."""
    hashed = PerfectHash(_united(k for k, _ in pieces))
    total = np.zeros(len(hashed.keys), _SLOT)
    total["text"] = 0xFFFFFFFF
    for keys, values in pieces:
        at, own = hashed(np.frombuffer(keys, "<u8")), np.frombuffer(values, _SLOT)
        # A piece has a key once.
        total["count"][at] += own["count"]
        total["text"][at] = np.minimum(total["text"][at], own["text"])
    return np.sort(hashed.keys).astype("<u8").tobytes(), total.tobytes()


def counts_of(found: DataFrame, salts: int) -> DataFrame:
    """shard, keys (64-bit numbers in order), counts (of _SLOT, in order of the slots): how often each key of a shard was found.

    ``found``: shard, codes (64 bits each), times and texts (32 bits). A shard's pieces are salted into ``salts`` tasks; each
    makes the perfect hash of its keys and adds its pieces up by slot; FAN of these meet in a task, level by level, by
    the slots of the hash of all their keys. Codes are shuffled once; only what was added up travels again.
    """
    piece = found.withColumn("salt", F.pmod(F.xxhash64("codes"), F.lit(salts)).cast("int")).select("shard", "salt", "codes", "times", "texts")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (shard, salt), rows in _grouped(batches, 2):
            pieces = []
            for r in rows:
                own = np.zeros(len(r[2]) // 8, _SLOT)
                own["count"], own["text"] = np.frombuffer(r[3], "<u4"), np.frombuffer(r[4], "<u4")
                pieces.append((r[2], own.tobytes()))
                if len(pieces) > FAN:
                    pieces = [_named(*_by_slot(pieces))]
            yield _blob(shard, salt, *_by_slot(pieces))

    def further(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (shard, salt), rows in _grouped(batches, 2):
            yield _blob(shard, salt, *_by_slot([_named(r[2], r[3]) for r in rows]))

    dealt = lambda df: df.repartition("shard", "salt").sortWithinPartitions("shard", "salt")
    sums = dealt(piece).mapInArrow(released(first), _BLOBS)
    while salts > 1:
        salts = -(-salts // FAN)
        sums = dealt(sums.withColumn("salt", F.floor(F.col("salt") / FAN).cast("int"))).mapInArrow(released(further), _BLOBS)
    return stored(sums.select("shard", "keys", "counts"), "phrase-counts")


def _named(keys: bytes, values: bytes) -> tuple[bytes, bytes]:
    """Keys in order of their slots, as their values are."""
    return PerfectHash(np.frombuffer(keys, "<u8")).keys.tobytes(), values


def _blob(shard: int, salt: int, keys: bytes, counts: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([salt], pa.int32()), pa.array([keys], pa.binary()), pa.array([counts], pa.binary())], ["shard", "salt", "keys", "counts"])


def _read(counts: DataFrame, asked: DataFrame, shards: int) -> DataFrame:
    """``asked`` (code, phrase, part) with f: the count in the code's slot, 0 where it has none."""
    own = asked.withColumn("shard", F.pmod(F.shiftrightunsigned("code", 40), F.lit(shards)).cast("int"))
    # A part that many phrases have makes its shard large, which is then read by several tasks.
    salts = F.floor(F.col("n") / ASKED).cast("int") + 1
    sizes = stored(own.groupBy("shard").agg(F.count("*").alias("n")).select("shard", salts.alias("salts")), "phrase-asked")
    none = F.lit(None).cast("bigint")
    blank = [F.lit(None).cast("binary").alias(c) for c in ("keys", "counts")]
    salted = own.join(F.broadcast(sizes), "shard").select("shard", F.pmod(F.xxhash64("phrase"), "salts").cast("int").alias("salt"), F.lit(1).alias("kind"), *blank, "code", "phrase", "part")
    held = counts.join(F.broadcast(sizes), "shard").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    held = held.select("shard", "salt", F.lit(0).alias("kind"), "keys", "counts", none.alias("code"), none.alias("phrase"), F.lit(None).cast("int").alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[pa.RecordBatch]:
            codes, phrases, parts = (np.array([r[k] for r in waiting], kind) for k, kind in ((5, np.int64), (6, np.int64), (7, np.int32)))
            at = hashed(codes.view(np.uint64))
            f = np.where(at >= 0, values[at], 0) if len(values) else np.zeros(len(at), np.int64)
            waiting.clear()
            yield pa.RecordBatch.from_arrays([pa.array(phrases), pa.array(parts), pa.array(f)], ["phrase", "part", "f"])

        for _, rows in _grouped(batches, 2):
            first = next(rows)
            hashed, values = PerfectHash(np.zeros(0, np.uint64)), np.zeros(0, np.int64)
            waiting: list[tuple] = []
            if first[2] == 0:
                hashed = PerfectHash(np.frombuffer(first[3], "<u8"))
                # Counts are in order of the slots.
                values = np.frombuffer(first[4], _SLOT)["count"]
            else:
                waiting.append(first)
            for r in rows:
                waiting.append(r)
                if len(waiting) >= 1 << 16:
                    yield from out()
            if waiting:
                yield from out()

    return held.union(salted).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind").mapInArrow(released(run), "phrase bigint, part int, f bigint")


#: Parts of a phrase by name: its first k words (l1 to l3), the rest (r1 to r3), and the middle pair of four words.
_PARTS = ("l1", "r1", "l2", "r2", "l3", "r3", "m")


def _last_pass(texts: DataFrame, bits: np.ndarray, more: np.ndarray, frequent: np.ndarray) -> DataFrame:
    """phrase (code), lang, words (joined by spaces), n, parts: frequent phrases, written out where they stand in the
    text that was noted for them, so not by every task (and rarely some others)."""
    context = texts.sparkSession.sparkContext
    pairs, longer, phrases = context.broadcast(bits), context.broadcast(more), context.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        member, member_longer, wanted = Members(pairs.value), Members(longer.value), Members(phrases.value)
        for batch in _sliced(batches):
            words = Words(batch.column(0), batch.column(1))
            grams = _possible(words, member, member_longer)
            raw = words.raw.tobytes()
            out = []
            for n in range(2, LONGEST + 1):
                codes, good = grams[n]
                at = np.flatnonzero(good)
                at = at[wanted(_witnessed(codes[at], words.text[at]))]
                at = at[np.unique(codes[at], return_index=True)[1]]
                signed = lambda length, shift: pa.array(grams[length][0][at + shift].view(np.int64))  # noqa: E731, B023
                cuts = {f"l{k}": signed(k, 0) for k in range(1, n)} | {f"r{k}": signed(n - k, k) for k in range(1, n)} | ({"m": signed(2, 1)} if n == 4 else {})
                spans = [(words.start[at + k].tolist(), words.stop[at + k].tolist()) for k in range(n)]
                written = pa.array([" ".join(p) for p in zip(*[[raw[i:j].decode("utf-8", "replace") for i, j in zip(a, b, strict=True)] for a, b in spans], strict=True)], pa.string())
                named = words.langs.dictionary.take(pa.array(words.lang[at]))
                nulls = pa.nulls(len(at), pa.int64())
                out.append(pa.RecordBatch.from_arrays([pa.array(codes[at].view(np.int64)), named, written, pa.array(np.full(len(at), n, np.int32)), *[cuts.get(p, nulls) for p in _PARTS]], ["phrase", "lang", "words", "n", *_PARTS]))
            yield from out

    return texts.mapInArrow(released(run), f"phrase bigint, lang string, words string, n int, {', '.join(f'{p} bigint' for p in _PARTS)}")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, share: int = SHARE) -> DataFrame:
    """All phrases that stay: lang, phrase, a, l, r, n, score (numbers long).

    A-Z are lower-cased; phrases lie within pieces between ``[.,;:!?\\x0A-\\x0D]``, of words between spaces and tabs.
    Null texts count as empty, null languages as ``und``; repeated rows count each. A phrase has ``least`` occurrences
    at least, and no longer one with ``share`` percent of its own around it. An empty table gives no phrases. Whole
    texts are read four times; no text is shuffled, only codes counted within a task.
    """
    spark = docs.sparkSession
    bounded(spark)
    texts = docs.select(F.col(text).cast("binary").alias("raw"), F.col(lang).cast("string").alias("lang"))
    size = texts.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    pieces = size // SHORT_BYTES + 1
    first = _perhaps_frequent(texts, _pairs, least, pieces)
    short = first.where("code is not null")
    n_frequent = short.count()
    bits = _members(short, n_frequent)
    longer = _longer(texts, bits, least, pieces)
    more = _members(longer, longer.count())
    shards = -(-max(1, n_frequent) // SHARD_KEYS)
    counts = counts_of(_count_pass(texts, bits, more, shards), size // (FAN * _SLICE) + 1)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                slots, held = PerfectHash(np.frombuffer(keys, "<u8")).keys, np.frombuffer(values, _SLOT)
                enough = held["count"] >= least
                yield pa.RecordBatch.from_arrays([pa.array(_witnessed(slots[enough], held["text"][enough]).view(np.int64))], ["code"])

    codes = stored(counts.select("keys", "counts").mapInArrow(released(frequent), "code bigint"), "phrase-frequent")
    written = stored(_last_pass(texts, bits, more, _members(codes, codes.count())).dropDuplicates(["phrase"]), "phrases")
    ask = F.array(*[F.struct(F.col(p).alias("code"), F.lit(k).alias("part")) for k, p in enumerate(("phrase", *_PARTS[:6]))])
    asked = written.select("phrase", F.explode(ask).alias("q")).select("q.code", "phrase", "q.part").where("code is not null")
    part = lambda k: F.max(F.when(F.col("part") == k, F.col("f"))).alias(("a", *_PARTS)[k])
    read = _read(counts, asked, shards).groupBy("phrase").agg(*[part(k) for k in range(7)]).where(F.col("a") >= least)
    known = stored(written.select("phrase", "lang", "words", "n", F.struct(*_PARTS).alias("codes")).join(read, "phrase"), "phrase-parts")
    inside = known.where("n > 2").select(F.explode(F.array(*[f"codes.{p}" for p in _PARTS])).alias("phrase"), F.col("a").alias("around"))
    inside = inside.where("phrase is not null").groupBy("phrase").agg(F.max("around").alias("around"))
    kept = known.join(inside, "phrase", "left").where(f"around is null or 100 * cast(around as decimal(38,0)) < {share} * cast(a as decimal(38,0))")
    # Integer division of decimals: products may pass 64 bits.
    floor = lambda k: F.expr(f"cast(cast({SCALE} as decimal(20,0)) * cast(a as decimal(18,0)) div (cast(l{k} as decimal(18,0)) + cast(r{k} as decimal(18,0))) as bigint)")
    cut = lambda k: F.when(F.col(f"l{k}").isNotNull(), F.struct(floor(k).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
    scored = kept.withColumn("cut", F.least(*[cut(k) for k in range(1, LONGEST)]))
    totals = first.where("code is null").select("lang", "n")
    # One row a language; a language has any number of phrases.
    out = scored.select("lang", F.col("words").alias("phrase"), "a", "cut.l", "cut.r", "cut.score").join(totals, "lang")
    return out.select("lang", "phrase", "a", "l", "r", "n", "score")


def best(found: DataFrame, most: int = MOST_PHRASES) -> DataFrame:
    """The first ``most`` phrases of each language, with rank; a language's rows are cut down in SPREAD tasks first."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    some = found.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("rank") <= most)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= most)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of each language."""
    return best(collocations(table(spark, sf_dir, "documents").select("text", "lang")))


def _oracle() -> str:
    phrase = lambda n: f"select lang, {n} as n, ws[p:p+{n - 1}] as g from pieces, range(1, greatest(1, len(ws) - {n - 2})) r(p) where len(ws) >= {n}"
    grams = " union all ".join(phrase(n) for n in range(1, LONGEST + 1))
    return f"""
with docs as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
pieces as (select lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') as ws from (select lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) as piece from docs)),
f as (select lang, n, g, count(*) as f from ({grams}) group by lang, n, g),
totals as (select lang, sum(f)::bigint as n from f where n = 1 group by lang),
cand as (select lang, n, g, f as a from f where n > 1 and f >= {LEAST}),
cuts as (select c.lang, c.n, c.g, c.a, k, x.f as l, y.f as r, ({SCALE}::hugeint * c.a) // (x.f + y.f) as score
  from cand c, range(1, c.n) t(k) join f x on x.lang = c.lang and x.g = c.g[:k] join f y on y.lang = c.lang and y.g = c.g[k+1:]),
cut as (select * from cuts qualify row_number() over (partition by lang, g order by score, k) = 1),
inside as (select c.lang, c.g[i:i+m-1] as g, max(c.a) as around from cand c, range(2, c.n) t(m), range(1, c.n - m + 2) u(i) group by 1, 2),
kept as (select cut.* from cut left join inside using (lang, g) where around is null or 100 * around::hugeint < {SHARE} * a::hugeint)
select lang, row_number() over (partition by lang order by score desc, a desc, array_to_string(g, ' ')) as rank, array_to_string(g, ' ') as phrase, a, l, r, totals.n, score::bigint as score
from kept join totals using (lang) qualify rank <= {MOST_PHRASES}"""


QUERIES = {"op13_phrase_mining": op13_phrase_mining}
ORACLES = {"op13_phrase_mining": _oracle()}
