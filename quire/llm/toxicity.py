"""Toxicity by the nearest labelled examples.

Examples and texts are TF-IDF vectors over all words of the examples, each word weighted by how much it tells
the labels apart (its phi coefficient, and a floor that keeps every word in). The nearest examples by cosine
come from an inverted index with the maximum weight of each block of examples, which bounds what a block can
still add, so that blocks are skipped without losing a neighbour. Votes are weighted by distance and
calibrated on examples left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import raw_text, released, remainder, stored, table, word_codes
from quire.llm.decontaminate import _PLAIN

#: Bound of the fitted classifier: labelled examples (smallest hash of the key).
MAX_EXAMPLES = 4_096
#: Weight of a word that tells nothing, beside the phi coefficient of others.
FLOOR = 0.02
NEIGHBOURS, BLOCK = 16, 128
#: Blocks that are looked into first, those of the best bounds; texts that are scored together.
GROUP, BATCH = 8, 32
#: A list that more than this share of the examples are in is stored as a row of all of them.
WIDE = 1 / 16


def codes_of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Codes of a text's different words in order, and how often each stands."""
    s = np.sort(word_codes(text.translate(_PLAIN)))
    if not len(s):
        return s, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    return s[first], np.diff(np.append(first, len(s)))


def known_counts(text: bytes, codes: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of a text's words among ``codes`` (in order), sorted, and their counts; other words are passed over."""
    own, n = codes_of(text)
    if not len(own) or not len(codes):
        return np.zeros(0, np.int64), np.zeros(0)
    at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
    hit = codes[at] == own
    terms, n = place[at[hit]], n[hit]
    order = np.argsort(terms)
    return terms[order], n[order].astype(float)


class Index:
    """Block-max inverted index over unit vectors of examples, with the calibration of its votes."""

    def __init__(self, words: list[bytes] | np.ndarray, weight: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, keys: list[int]) -> None:
        """words: as they are, or their codes. weight: of each, its inverse document frequency times how much it tells."""
        codes = words if isinstance(words, np.ndarray) else np.concatenate([*[word_codes(w) for w in words], np.zeros(0, np.uint64)])
        self.place = np.argsort(codes)
        self.codes = codes[self.place]
        self.weight, self.toxic, self.keys = weight.astype(np.float64), toxic.astype(np.float64), keys
        self.n = len(vectors)
        self.blocks = -(-self.n // BLOCK)
        owner = np.repeat(np.arange(self.n), [len(t) for t, _ in vectors]).astype(np.int32)
        term = np.concatenate([t for t, _ in vectors] or [np.zeros(0, np.int64)]).astype(np.int64)
        value = np.concatenate([v for _, v in vectors] or [np.zeros(0)])
        order = np.lexsort((owner, term))
        owner, value, term = owner[order], value[order], term[order]
        # Rounded up, so that a bound is never too low.
        self.most = np.zeros((len(words), self.blocks), np.float32)
        np.maximum.at(self.most, (term, owner // BLOCK), np.nextafter(value.astype(np.float32), np.float32(2)))
        wide = np.bincount(term, minlength=len(words)) > max(4, WIDE * self.n)
        self.row = np.where(wide, np.cumsum(wide) - 1, -1)
        self.rows = np.zeros((int(wide.sum()), self.n))
        self.rows[self.row[term[wide[term]]], owner[wide[term]]] = value[wide[term]]
        narrow = ~wide[term]
        self.owner, self.value = owner[narrow], value[narrow]
        self.start = np.searchsorted(term[narrow], np.arange(len(words) + 1))
        empty = np.array([not len(t) for t, _ in vectors], bool)
        #: Share of toxic examples among all, and among those that have no word.
        self.base = float((self.toxic.sum() + 0.5) / (self.n + 1))
        self.blank = float((self.toxic[empty].sum() + self.base) / (empty.sum() + 1))
        self.slope, self.shift = 1.0, 0.0

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        terms = np.array(sorted(counts), np.int64)
        return self.weighted(terms, np.array([counts[t] for t in terms.tolist()], float))

    def weighted(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The unit vector of a text's words, by their places and counts."""
        values = (1 + np.log(counts)) * self.weight[terms]
        return terms, values / max(np.sqrt((values**2).sum()), 1e-12)

    def counts(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        return known_counts(text, self.codes, self.place)

    def nearest(self, terms: np.ndarray, values: np.ndarray, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The examples of the highest cosines over 0 (ties: the earlier), NEIGHBOURS at most, exactly."""
        return self.nearest_all([(terms, values)], [skip])[0]

    def nearest_all(self, queries: list[tuple[np.ndarray, np.ndarray]], skip: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of each of a batch. First its GROUP blocks of the best bounds are looked into; then those
        whose bound reaches what the last neighbour has so far."""
        m = len(queries)
        if not m or not self.n:
            return [(np.zeros(0, np.int64), np.zeros(0))] * m
        who = np.repeat(np.arange(m), [len(t) for t, _ in queries])
        terms, values = (np.concatenate([q[k] for q in queries]) for k in (0, 1))
        bound = np.stack([v.astype(np.float32) @ self.most[t] for t, v in queries]) if len(terms) else np.zeros((m, self.blocks), np.float32)
        row = self.row[terms]
        heavy = np.zeros((m, len(self.rows)))
        heavy[who[row >= 0], row[row >= 0]] = values[row >= 0]
        # The postings of all other words, in one pass.
        few, mine, own = terms[row < 0], who[row < 0], values[row < 0]
        lo = self.start[few]
        n = self.start[few + 1] - lo
        index = np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)
        sums = np.bincount(np.repeat(mine * self.n, n) + self.owner[index], np.repeat(own, n) * self.value[index], minlength=m * self.n).reshape(m, self.n)
        cosine = np.zeros((m, self.n))
        looked = np.zeros(bound.shape, bool)
        np.put_along_axis(looked, np.argsort(-bound, axis=1, kind="stable")[:, :GROUP], True, axis=1)
        todo = looked
        for _ in range(2):
            for b in np.flatnonzero(todo.any(axis=0)):
                at = slice(b * BLOCK, min((b + 1) * BLOCK, self.n))
                q = np.flatnonzero(todo[:, b])
                cosine[q, at] = np.round(sums[q, at] + heavy[q] @ self.rows[:, at], 9)
            if skip is not None:
                cosine[np.arange(m)[np.array(skip) >= 0], np.array(skip)[np.array(skip) >= 0]] = 0
            k = min(NEIGHBOURS, self.n)
            last = np.partition(cosine, self.n - k, axis=1)[:, self.n - k]
            todo = ~looked & (bound >= np.maximum(last[:, None] - 1e-5, 1e-12))
        out = []
        for i in range(m):
            at = np.flatnonzero(cosine[i] >= max(last[i], 1e-12))
            at = at[np.lexsort((at, -cosine[i, at]))][:NEIGHBOURS]
            out.append((at, cosine[i, at]))
        return out

    def vote(self, at: np.ndarray, cosine: np.ndarray) -> float:
        """Toxic share of the neighbours, each weighted by 1 / (0.05 + distance), with one vote of the base rate."""
        weight = 1 / (1.05 - np.minimum(cosine, 1.0))
        return float(((weight * self.toxic[at]).sum() + self.base) / (weight.sum() + 1))

    def calibrate(self, vectors: list[tuple[np.ndarray, np.ndarray]], most: int = 4096) -> None:
        """Platt scaling of the votes that examples get from the others, ``most`` of them at most, evenly picked."""
        x, y = [], []
        chosen = np.unique(np.linspace(0, self.n - 1, min(most, self.n)).astype(int)) if self.n else np.zeros(0, int)
        chosen = [int(i) for i in chosen if len(vectors[i][0])]
        for at in range(0, len(chosen), BATCH):
            part = chosen[at : at + BATCH]
            for i, found in zip(part, self.nearest_all([vectors[i] for i in part], part), strict=True):
                v = self.vote(*found)
                x.append(np.log(v / (1 - v)))
                y.append(self.toxic[i])
        if len(set(y)) < 2:
            return
        x, y = np.array(x), np.array(y)
        goal = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
        design, theta = np.stack([x, np.ones_like(x)], 1), np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
            hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
            theta = theta - np.linalg.solve(hessian, design.T @ (p - goal) + 1e-3 * (theta - [1, 0]))
        if theta[0] > 0:
            self.slope, self.shift = float(theta[0]), float(theta[1])

    def scores(self, texts: list[bytes]) -> list[tuple[float, list[dict]]]:
        """Score and evidence of each text, in batches."""
        out: list[tuple[float, list[dict]]] = []
        for first in range(0, len(texts), BATCH):
            counts = [self.counts(t) for t in texts[first : first + BATCH]]
            found = iter(self.nearest_all([self.weighted(*c) for c in counts if len(c[0])]))
            for c in counts:
                if not len(c[0]):
                    out.append((self.blank, []))
                    continue
                at, cosine = next(found)
                v = self.vote(at, cosine)
                p = float(1 / (1 + np.exp(-np.clip(self.slope * np.log(v / (1 - v)) + self.shift, -30, 30))))
                out.append((p, [{"doc_id": self.keys[i], "similarity": round(float(x), 6), "toxic": int(self.toxic[i])} for i, x in zip(at[:3], cosine[:3], strict=True)]))
        return out


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic") -> Index:
    """An index of labelled examples.

    ``labels`` are the rows to learn from; null keys and null labels teach nothing, of a repeated key the
    highest label counts. At most MAX_EXAMPLES examples are taken, by hash; all of their words are in the
    index (by 64-bit codes), and how many documents have each is counted over all of ``docs``. Without examples
    every text scores 0.5.
    """
    own = labels.select(F.col(key).alias("k"), F.col(label).alias("y")).where("k is not null and y is not null").groupBy("k").agg(F.max("y").alias("y"))
    own = own.orderBy(F.xxhash64("k"), "k").limit(MAX_EXAMPLES)
    rows = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))
    # Copies of a text are one example, with the highest of their labels.
    examples = stored(rows.join(F.broadcast(own), "k").groupBy("t").agg(F.min("k").alias("k"), F.max("y").alias("y")).select("k", "t", "y"), "examples")

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[list, list] = ([], [])
        for batch in batches:
            for raw, y in zip(batch.column("t"), batch.column("y").to_pylist(), strict=True):
                seen[y > 0].append(codes_of(raw.as_py())[0])
        every = np.unique(np.concatenate([*seen[0], *seen[1], np.zeros(0, np.uint64)]))
        clean, bad = (np.bincount(np.searchsorted(every, np.concatenate([*x, every])), minlength=len(every)) - 1 for x in seen)
        end = pa.nulls(1, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([pa.array(every.view(np.int64)), end]), pa.array(np.append(clean, len(seen[0])).astype(np.int64)), pa.array(np.append(bad, len(seen[1])).astype(np.int64))],
            ["w", "clean", "bad"],
        )

    told = examples.mapInArrow(released(tell), "w bigint, clean bigint, bad bigint").groupBy("w").agg(F.sum("clean").alias("c"), F.sum("bad").alias("b")).toArrow()
    ends = told.filter(told.column("w").is_null()).to_pylist()
    clean, bad = (float(sum(r[k] for r in ends)) for k in ("c", "b"))
    told = told.filter(told.column("w").is_valid())
    codes = told.column("w").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(codes)
    codes, c, b = codes[order], told.column("c").to_numpy()[order].astype(float), told.column("b").to_numpy()[order].astype(float)
    # How much a word tells: the phi coefficient of having it and being toxic.
    n, every = c + b, clean + bad
    phi = np.abs(b * clean - c * bad) / np.sqrt(np.maximum(n * (every - n + 1) * max(bad, 1) * max(clean, 1), 1.0))
    place = np.arange(len(codes))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, total = np.zeros(len(codes) + 1, np.int64), 0
        for batch in batches:
            for raw in batch.column("t"):
                df[known_counts(raw.as_py(), codes, place)[0]] += 1
            total += len(batch)
        df[-1] = total
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at], pa.int64())], ["i", "n"])

    # As many rows as words of the examples.
    counted = rows.select("t").mapInArrow(released(spread), "i bigint, n bigint").groupBy("i").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(len(codes) + 1)
    df[counted.column("i").to_numpy()] = counted.column("n").to_numpy()
    weight = (np.log((1 + df[-1]) / (1 + df[:-1])) + 1) * (FLOOR + phi)

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [known_counts(raw.as_py(), codes, place) for raw in batch.column("t")]
            lists = [pa.array([f[k] for f in found], pa.list_(kind)) for k, kind in ((0, pa.int64()), (1, pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("y"), *lists], ["k", "y", "terms", "tf"])

    kinds = dict(examples.dtypes)
    got = examples.mapInArrow(released(held), f"k {kinds['k']}, y {kinds['y']}, terms array<bigint>, tf array<double>").toArrow().combine_chunks().sort_by("k")
    index = Index(codes, weight, [], np.zeros(0), [])
    vectors = [index.weighted(t.values.to_numpy(), n.values.to_numpy()) for t, n in zip(got.column("terms"), got.column("tf"), strict=True)]
    index = Index(codes, weight, vectors, np.array([y > 0 for y in got.column("y").to_pylist()], float), got.column("k").to_pylist())
    index.calibrate(vectors)
    return index


def scored(docs: DataFrame, index: Index, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all by default) with score, predicted and evidence (nearest examples).

    Whole texts; null counts as empty. A text without any word of the examples gets the share of toxic ones
    among empty examples. Columns of these names are replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted", "evidence")]
    evidence = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = index.scores([raw.as_py() or b"" for raw in raw_text(batch, text)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array([p for p, _ in found], pa.float64()), pa.array([int(p >= 0.5) for p, _ in found], pa.int32()), pa.array([e for _, e in found], evidence)],
                [*keep, "score", "predicted", "evidence"],
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]
    schema = ", ".join([*fields, "score double, predicted int, evidence array<struct<doc_id:bigint,similarity:double,toxic:int>>"])
    return docs.select(*keep, *([] if text in keep else [text])).mapInArrow(released(run), schema)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from labels with another remainder than 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", remainder("doc_id", 5) == 0)
    index = fit(docs, table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0))
    return scored(docs, index, keep=["doc_id", "held_out"])


QUERIES = {"op4_toxicity": op4_toxicity}
ORACLES: dict[str, str] = {}
