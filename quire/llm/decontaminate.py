"""Benchmark decontamination by SimHash windows.

Texts are cut into windows as long as each benchmark item. Windows and items get 64-bit SimHash
fingerprints of their weighted 5-word shingles; a multi-index over blocks of bits finds every fingerprint
within the radius (with more blocks than bits may differ, one block must be equal), and the weighted
shingles that a window shares with the item decide exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import distinct, raw_text, released, rolled, set_aside, stored, table, word_codes

SHINGLE, LEAST = 5, 0.8
#: Bits that may differ. A window of similarity LEAST differs in 13 of 64 on average, in more than these once in
#: a hundred; the windows beside it, and any closer one, seldom differ in so many.
RADIUS = 20
#: Characters of benchmark text that one pass over the documents looks for.
BLOCK_CHARS = 4_000_000
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_BITS = np.arange(64, dtype=np.uint64)
_EDGES = np.linspace(0, 64, RADIUS + 2).astype(int)


def plain_words(text: bytes) -> list[bytes]:
    """Runs of letters, digits and all beyond ASCII; A-Z lower-cased."""
    return text.translate(_PLAIN).split()


def signs(shingles: np.ndarray) -> np.ndarray:
    return ((shingles[:, None] >> _BITS) & np.uint64(1)).astype(np.float32) * 2 - 1


def packed(sums: np.ndarray) -> np.ndarray:
    return ((sums > 0).astype(np.uint64) << _BITS).sum(axis=1, dtype=np.uint64)


class ItemIndex:
    """Items by length, with fingerprints in one sorted list for each block of bits."""

    def __init__(self, items: list[tuple[int | None, bytes]], least: float = LEAST, whole: tuple[int, np.ndarray, np.ndarray] | None = None) -> None:
        """whole: items of the whole benchmark, its shingles in order (those of ``items`` at least) and in how
        many items each stands; by default ``items`` are the whole."""
        self.least = least
        self.ids, sets, runs, self.length = [], [], [], []
        #: Items of fewer words than a shingle, by their words: each is one shingle, which a text holds or not.
        self.short: dict[int, dict[int, list[int | None]]] = {}
        for key, text in items:
            words = word_codes(text.translate(_PLAIN))
            if 0 < len(words) < SHINGLE:
                self.short.setdefault(len(words), {}).setdefault(int(rolled(words, SHINGLE)[0]), []).append(key)
            elif len(words):
                self.ids.append(key)
                self.length.append(len(words))
                runs.append(rolled(words, SHINGLE))
                sets.append(distinct(runs[-1]))
        self.known, df = np.unique(np.concatenate(sets) if sets else np.zeros(0, np.uint64), return_counts=True)
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.known & np.uint64(0xFFFF)).astype(np.int64)] = True
        #: A shingle that many items share says less; one that no item has weighs most.
        n_items = len(sets)
        if whole:
            n_items, df = whole[0], whole[2][np.searchsorted(whole[1], self.known)]
        self.weight = np.log1p(n_items / df).astype(np.float32) if len(df) else np.zeros(0, np.float32)
        self.foreign = np.float32(np.log1p(n_items))
        self.sets = [np.searchsorted(self.known, s) for s in sets]
        self.total = np.array([self.weight[s].sum() for s in self.sets])
        # Fingerprints count repeats, as those of windows do.
        prints = np.array([packed((signs(r) * self.weight[np.searchsorted(self.known, r)][:, None]).sum(0, keepdims=True, dtype=np.float64))[0] for r in runs], np.uint64)
        lengths = sorted(set(self.length))
        #: Shingles that a window of so many words must share at least with one of its items.
        self.need = {n: min(self._fewest(i) for i, m in enumerate(self.length) if m == n) for n in lengths}
        self.order = {n: k for k, n in enumerate(lengths)}
        rank = np.array([self.order[n] for n in self.length], np.uint64)
        self.prints, self.blocks = prints, []
        for lo, hi in zip(_EDGES, _EDGES[1:], strict=False):
            keys = self._keys(rank, prints, lo, hi)
            order = np.argsort(keys, kind="stable")
            self.blocks.append((lo, hi, keys[order], order))

    @staticmethod
    def _keys(rank: np.ndarray, prints: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """Length and the bits of one block: a window meets items of its own length only."""
        return (rank << np.uint64(16)) | ((prints >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1))

    def _fewest(self, i: int) -> int:
        """Shingles that a window must share with item i at least to reach the similarity."""
        heavy = np.cumsum(np.sort(self.weight[self.sets[i]])[::-1])
        return int(np.searchsorted(heavy, self.least * self.total[i] - 1e-4) + 1)

    def near(self, rank: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (window, item of its length) whose fingerprints differ in RADIUS bits at most."""
        found = []
        for lo, hi, keys, items in self.blocks:
            part = self._keys(rank, prints, lo, hi)
            a, b = np.searchsorted(keys, part, "left"), np.searchsorted(keys, part, "right")
            w = np.repeat(np.arange(len(prints)), b - a)
            i = items[np.arange(len(w)) - np.repeat(np.cumsum(b - a) - b, b - a)]
            close = np.bitwise_count(prints[w] ^ self.prints[i]) <= RADIUS
            found.append(w[close] * np.int64(len(self.ids)) + i[close])
        pairs = np.unique(np.concatenate(found))
        return pairs // len(self.ids), pairs % len(self.ids)

    def matches(self, text: bytes) -> list[dict]:
        """The best window of each item that the text holds."""
        words = word_codes(text.translate(_PLAIN))
        return [*self._short(words), *self._long(words)] if len(words) else []

    def _short(self, words: np.ndarray) -> list[dict]:
        out = []
        for n, known in sorted(self.short.items()):
            if n <= len(words):
                codes = rolled(words, n)
                found, at = np.unique(codes, return_index=True)
                some = np.isin(found, np.fromiter(known, np.uint64, len(known)))
                for code, start in zip(found[some].tolist(), at[some].tolist(), strict=True):
                    out += [{"item_id": key, "similarity": 1.0, "start_word": start, "n_words": n} for key in known[code]]
        return out

    def _long(self, words: np.ndarray) -> list[dict]:
        if len(words) < SHINGLE or not len(self.known):
            return []
        shingles = rolled(words, SHINGLE)
        # Most texts share no shingle with any item, so no window of theirs can be similar.
        spots = shingles[self.maybe[(shingles & np.uint64(0xFFFF)).astype(np.int64)]]
        if not (self.known[np.minimum(np.searchsorted(self.known, spots), len(self.known) - 1)] == spots).any():
            return []
        at = np.minimum(np.searchsorted(self.known, shingles), len(self.known) - 1)
        hit = self.known[at] == shingles
        held = np.concatenate([[0], np.cumsum(hit)])
        sums = np.concatenate([np.zeros((1, 64), np.float32), np.cumsum(signs(shingles) * np.where(hit, self.weight[at], self.foreign)[:, None], axis=0, dtype=np.float64)])
        starts, sizes, ranks = [], [], []
        for n, need in self.need.items():
            m = min(n, len(words)) - SHINGLE + 1
            own = np.flatnonzero(held[m:] - held[:-m] >= need)
            starts.append(own)
            sizes.append(np.full(len(own), m))
            ranks.append(np.full(len(own), self.order[n], np.uint64))
        start, size = np.concatenate(starts), np.concatenate(sizes)
        best: dict[int, tuple[float, int, int]] = {}
        if len(start):
            for w, i in zip(*self.near(np.concatenate(ranks), packed(sums[start + size] - sums[start])), strict=True):
                s, m = int(start[w]), int(size[w])
                shared = np.intersect1d(at[s : s + m][hit[s : s + m]], self.sets[i])
                similar = float(self.weight[shared].sum() / self.total[i])
                if similar >= self.least - 1e-6 and (i not in best or (-similar, s) < (-best[i][0], best[i][1])):
                    best[i] = (similar, s, m + SHINGLE - 1)
        return [{"item_id": self.ids[i], "similarity": round(min(1.0, v[0]), 6), "start_word": v[1], "n_words": v[2]} for i, v in sorted(best.items())]


_MATCHES = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("start_word", pa.int64()), ("n_words", pa.int64())]))


def item_blocks(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> Iterator[tuple[list[tuple[int | None, bytes]], tuple[int, np.ndarray, np.ndarray] | None]]:
    """The benchmark in blocks of about BLOCK_CHARS characters, each with the numbers of items that hold its
    shingles in the whole benchmark (None where one block is the whole); the driver holds one at a time."""
    items = benchmark.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t is not null").distinct()
    size = items.agg(F.sum(F.length("t"))).first()[0] or 0
    n = int(size // BLOCK_CHARS) + 1
    items = items.select("k", F.col("t").cast("binary").alias("t"), F.pmod(F.xxhash64("k", "t"), F.lit(n)).alias("b"))

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, b in zip(batch.column("t"), batch.column("b").to_pylist(), strict=True):
                words = word_codes(raw.as_py().translate(_PLAIN))
                # Shorter items have no part in the weights.
                own = distinct(rolled(words, SHINGLE)) if len(words) >= SHINGLE else np.zeros(0, np.uint64)
                first = np.arange(len(own)) == 0
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(np.full(len(own), b, np.int64)), pa.array(first.astype(np.int64))], ["s", "b", "first"])

    if n > 1:
        held = items.select("t", "b").mapInArrow(shingles, "s bigint, b bigint, first bigint")
        whole = stored(held.groupBy("s").agg(F.count("*").alias("df"), F.collect_set("b").alias("blocks"), F.sum("first").alias("first")), "shingles")
        n_items = whole.agg(F.sum("first")).first()[0] or 0
    for b in range(n):
        rows = items.where(F.col("b") == b).select("k", "t").collect()
        counts = None
        if n > 1:
            own = whole.where(F.array_contains("blocks", F.lit(b).cast("bigint"))).select("s", "df").toArrow()
            known, df = own.column("s").to_numpy().view(np.uint64), own.column("df").to_numpy()
            order = np.argsort(known)
            counts = (n_items, known[order], df[order])
        yield sorted(((r.k, bytes(r.t)) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1])), counts


def annotated(docs: DataFrame, benchmark: DataFrame, text: str = "text", least: float = LEAST) -> DataFrame:
    """``docs`` with ``matches``: for each benchmark item found in the whole text its id, similarity (the
    weighted share of the item's shingles in the window), first word and words of the best window.

    Null and empty texts match nothing, null and empty items nothing either; an item of fewer than five words is
    one shingle, found wherever its words stand one after the other. Repeated rows are matched each. A column named matches is replaced. The
    benchmark is looked for in blocks of bounded size, one narrow pass for each.
    """
    docs = docs.drop("matches")
    columns = docs.columns
    out = docs
    for part, (items, whole) in enumerate(item_blocks(benchmark)):
        index = ItemIndex(items, least, whole)

        def run(batches: Iterator[pa.RecordBatch], index: ItemIndex = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [index.matches(raw.as_py()) if raw.is_valid else [] for raw in raw_text(batch, text)]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, _MATCHES)], [*batch.schema.names, "_found"])

        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema]
        kind = "array<struct<item_id:bigint,similarity:double,start_word:bigint,n_words:bigint>>"
        got = out.mapInArrow(released(run), ", ".join([*fields, f"_found {kind}"]))
        out = got.withColumn("matches", F.concat("matches", "_found") if part else F.col("_found")).select(*columns, "matches")
    return out


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = annotated(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold no benchmark item stay.

    Null and empty texts hold none; repeated rows share their fate; with an empty benchmark all stay. A column
    matches of ``docs`` is kept as it is.
    """
    columns = docs.columns
    renamed, back = set_aside(docs, "matches", "_found")
    return back(annotated(renamed, table(spark, sf_dir, "benchmark")).where(F.size("matches") == 0)).select(*columns)


QUERIES = {"op1_decontamination": op1_decontamination}
ORACLES: dict[str, str] = {}
