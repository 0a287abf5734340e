"""Language-model scores of documents: smoothed unigrams, and a log-bilinear neural model.

Token counts cover all training documents. The neural model predicts the next token from the vectors of the
two before it. The most frequent tokens are classes of their own; every other token, however rare, belongs to
the class of its ending, inside which the smoothed counts decide, so the probabilities of all tokens sum to
one. It is trained with noise-contrastive estimation in numpy: each Spark task trains a copy on its own
documents and the copies are averaged by the tokens they saw, so scores depend a little on how the table is
cut into tasks. Scores use exact normalisers, made by batched matrix products for all contexts at once.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import ascii_words, most_frequent, released, remainder, stored, table

#: The end token; no word is empty.
END = b""
#: Counts of so many tokens travel to the tasks; the rest are joined.
FREQUENT = 100_000
#: Tokens with vectors of their own (the end among them), classes of the others by their last three bytes, and the
#: length of vectors.
KNOWN, ENDINGS, SIZE = 1_023, 512, 24
NOISE, BATCH, RATE = 128, 256, 0.08
#: Positions that are mixed before a task trains on them.
MIXED = 200_000


@dataclass
class Counts:
    """Of training tokens: all, different ones, the frequent with their counts, ids of tokens with vectors of their
    own, and tokens and different ones of each class of endings."""

    total: int
    distinct: int
    frequent: dict[bytes, int]
    ids: dict[bytes, int]
    ending_tokens: np.ndarray
    ending_words: np.ndarray

    def class_sizes(self) -> list[int]:
        return [*[self.frequent.get(w, 0) for w in self.ids], *self.ending_tokens.tolist()]


def ending(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % ENDINGS


def counted(texts: DataFrame) -> tuple[DataFrame, Counts]:
    """(w, c) of all tokens of ``texts`` (column raw, null as empty), stored; and their totals."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        out = lambda: pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["w", "c"])
        for batch in batches:
            for raw in batch.column(0):
                seen.update(ascii_words(raw.as_py() or b""))
                seen[END] += 1
                if len(seen) > 400_000:
                    yield out()
                    seen.clear()
        yield out()

    vocabulary = stored(texts.mapInArrow(released(count), "w binary, c bigint").groupBy("w").agg(F.sum("c").alias("c")), "vocabulary")
    total = vocabulary.agg(F.sum("c"), F.count("*"), F.max(F.when(F.col("w") == F.lit(END), F.col("c")))).first()
    frequent = {bytes(r.w): r.c for r in most_frequent(vocabulary, "c", FREQUENT)} | ({END: total[2]} if total[2] else {})
    top = sorted(frequent, key=lambda w: (-frequent[w], w))
    ids = {w: i for i, w in enumerate([END, *[w for w in top if w != END][: KNOWN - 1]])}

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, words = np.zeros(ENDINGS, np.int64), np.zeros(ENDINGS, np.int64)
        for batch in batches:
            at = np.array([-1 if w in ids else ending(w) for w in batch.column(0).to_pylist()], np.int64)
            np.add.at(n, at[at >= 0], batch.column(1).to_numpy()[at >= 0])
            np.add.at(words, at[at >= 0], 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(ENDINGS)), pa.array(n), pa.array(words)], ["k", "n", "words"])

    sums = vocabulary.mapInArrow(released(classes), "k bigint, n bigint, words bigint").groupBy("k").agg(F.sum("n").alias("n"), F.sum("words").alias("words")).collect()
    n, words = np.zeros(ENDINGS, np.int64), np.zeros(ENDINGS, np.int64)
    for r in sums:
        n[r.k], words[r.k] = r.n, r.words
    return vocabulary, Counts(total[0] or 0, total[1], frequent, ids, n, words)


def _sigmoid(x: np.ndarray, over: float = 1) -> np.ndarray:
    """``over`` times the sigmoid of -x, in x's place. Where the power is infinite the result is zero."""
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += np.float32(1)
    return np.divide(np.float32(over), x, out=x)


def _summed(places: list[np.ndarray], rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different places, and the sums of their rows."""
    at, row = np.concatenate(places), np.concatenate(rows)
    # Short numbers sort much faster; there are KNOWN and ENDINGS classes.
    order = at.astype(np.uint16 if KNOWN + ENDINGS < 1 << 16 else np.int64).argsort(kind="stable")
    s = at.take(order)
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    return s[first], np.add.reduceat(row.take(order, 0), first, axis=0)


class Bilinear:
    """Vectors of targets R and contexts Q, a transform for each of the two places, biases."""

    NAMES = ("R", "Q", "C1", "C2", "b")

    def __init__(self, classes: list[int], seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        k = len(classes)
        share = (np.array(classes, np.float64) + 0.1) / (sum(classes) + 0.1 * k)
        self.noise = share
        self.R = rng.normal(0, 0.05, (k, SIZE)).astype(np.float32)
        self.Q = rng.normal(0, 0.3, (k, SIZE)).astype(np.float32)
        self.C1 = np.eye(SIZE, dtype=np.float32)
        self.C2 = np.eye(SIZE, dtype=np.float32) * np.float32(0.5)
        self.b = np.log(share).astype(np.float32)
        self.log_noise = self.b.copy()
        self.squares = {n: np.full_like(getattr(self, n), 1e-2) for n in self.NAMES}

    def step(self, one: np.ndarray, two: np.ndarray, goal: np.ndarray, noise: np.ndarray) -> None:
        """A batch of contexts (the word before, the one before that) with their targets, against shared noise."""
        q1, q2 = self.Q.take(one, 0), self.Q.take(two, 0)
        r = q1 @ self.C1 + q2 @ self.C2
        against = self.log_noise + np.float32(np.log(len(noise))) - self.b
        rg, rn = self.R.take(goal, 0), self.R.take(noise, 0)
        up = _sigmoid((r * rg).sum(1) - against[goal])
        odds = r @ -rn.T
        odds += against[noise]
        down = _sigmoid(odds, -1)
        dr = up[:, None] * rg + down @ rn
        n = np.float32(len(goal))
        self._moved("R", *_summed([goal, noise], [up[:, None] * r, down.T @ r]), n)
        self._moved("Q", *_summed([one, two], [dr @ self.C1.T, dr @ self.C2.T]), n)
        self._moved("C1", slice(None), q1.T @ dr, n)
        self._moved("C2", slice(None), q2.T @ dr, n)
        self._moved("b", slice(None), (np.bincount(goal, up, len(self.b)) + np.bincount(noise, down.sum(0), len(self.b))).astype(np.float32), n)

    def _moved(self, name: str, at: np.ndarray | slice, g: np.ndarray, n: np.float32) -> None:
        """One step along the gradient. Rows that a batch doesn't touch have none, and stay as they are."""
        g /= n
        squares, values = self.squares[name], getattr(self, name)
        if isinstance(at, slice):
            squares += g * g
            values += np.float32(RATE) * g / np.sqrt(squares)
        else:
            some = squares.take(at, 0)
            some += g * g
            squares[at] = some
            g *= np.float32(RATE)
            g /= np.sqrt(some, out=some)
            g += values.take(at, 0)
            values[at] = g

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def load(self, flat: np.ndarray) -> Bilinear:
        at = 0
        for n in self.NAMES:
            shape = getattr(self, n).shape
            size = int(np.prod(shape))
            setattr(self, n, flat[at : at + size].reshape(shape).astype(np.float32))
            at += size
        return self

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores of (word before, target) with the bias, of (word before that, target), and the natural
        logarithm of the normaliser of each context; all in batched matrix products."""
        t1, t2 = self.Q @ self.C1 @ self.R.T + self.b, self.Q @ self.C2 @ self.R.T
        # In double precision no sum of products falls to zero.
        e1, e2 = (np.exp(t - t.max(1, keepdims=True), dtype=np.float64) for t in (t1, t2))
        norm = np.log(e1 @ e2.T)
        norm += t1.max(1)[:, None] + t2.max(1)[None]
        return t1, t2, norm.astype(np.float32)


class Lookup:
    """Places of the frequent tokens, and their classes."""

    def __init__(self, counts: Counts) -> None:
        self.place = {w: i for i, w in enumerate(counts.frequent)}
        self.ids = counts.ids
        known = len(self.ids)
        # The last one stands for what is not there.
        self.classes = np.array([*[self.ids[w] if w in self.ids else known + ending(w) for w in counts.frequent], 0], np.int64)

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each token its place (-1: not frequent) and class, and where the tokens are that aren't frequent."""
        at = np.fromiter(map(self.place.get, words, itertools.repeat(-1)), np.int64, len(words))
        classes = self.classes[at]
        rare = np.flatnonzero(at < 0)
        known, ids = len(self.ids), self.ids
        classes[rare] = [known + zlib.crc32(w[-3:]) % ENDINGS if (i := ids.get(w)) is None else i for w in map(words.__getitem__, rare.tolist())]
        return at, classes, rare


def fitted(texts: DataFrame, counts: Counts) -> tuple[Bilinear, dict[bytes, int]]:
    """The averaged model and the ids of its tokens. Each task returns its parameters once, in small blocks."""
    ids, sizes = counts.ids, counts.class_sizes()
    start, look = Bilinear(sizes), Lookup(counts)
    size, width = len(start.flat()), 512

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, rng, n = Bilinear(sizes), np.random.default_rng(5), 0
        noise = np.cumsum(model.noise)
        held: list[np.ndarray] = []
        waiting = 0

        def learn(stack: np.ndarray) -> None:
            stack = stack[:, rng.permutation(stack.shape[1])]
            for at in range(0, stack.shape[1], BATCH):
                drawn = np.minimum(np.searchsorted(noise, rng.random(NOISE)), len(noise) - 1)
                model.step(*stack[:, at : at + BATCH], drawn)

        for batch in batches:
            for raw in batch.column(0):
                a = np.concatenate([[0, 0], look(ascii_words(raw.as_py() or b""))[1], [0]])
                held.append(np.stack([a[1:-1], a[:-2], a[2:]]))
                n += len(a) - 2
                waiting += len(a) - 2
                if waiting >= MIXED:
                    learn(np.concatenate(held, axis=1))
                    held, waiting = [], 0
        if held:
            learn(np.concatenate(held, axis=1))
        if n:
            flat = model.flat() - start.flat()
            parts = [flat[i : i + width].astype("<f4").tobytes() for i in range(0, size, width)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([n] * len(parts), pa.int64()), pa.array(parts, pa.binary())], ["part", "n", "moved"])

    trained = texts.mapInArrow(released(train), "part int, n bigint, moved binary")

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Weighted sums within a task; each part's rows may come from any number of tasks."""
        sums: dict[int, list] = {}
        for batch in batches:
            for part, n, moved in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = sums.setdefault(part, [0, 0.0])
                own[0] += n
                own[1] = own[1] + n * np.frombuffer(moved, "<f4").astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v[0] for v in sums.values()], pa.int64()), pa.array([(v[1] / v[0]).astype("<f4").tobytes() for v in sums.values()], pa.binary())], ["part", "n", "moved"])

    merged = trained.repartition(F.col("part")).mapInArrow(released(average), "part int, n bigint, moved binary")
    rows = sorted((r.part, r.moved) for r in merged.collect())
    if rows:
        start.load(start.flat() + np.concatenate([np.frombuffer(m, "<f4") for _, m in rows]))
    return start, ids


def scored(docs: DataFrame, train: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row a row of ``docs``: key, columns ``keep``, n_tokens, n_known, train_tokens, base_score, score.

    Scores are sums of log10 probabilities of all tokens of the whole text and its end. Null texts count as
    empty (the end alone). Without training texts every token has the same probability. Repeated rows are
    scored each. Frequent tokens are looked up in the tasks; only the others are shuffled to their counts,
    so no token's rows gather in one task.
    """
    vocabulary, counts = counted(train.select(F.col(text).cast("binary").alias("raw")))
    model, ids = fitted(train.select(F.col(text).cast("binary").alias("raw")), counts)
    t1, t2, norm = model.tables()
    frequent, own_classes = counts.frequent, len(ids)
    all_log = float(np.log10(counts.total + 0.1 * (counts.distinct + 1)))
    # Inside a class of endings; its unseen words share one more place.
    class_log = np.concatenate([np.zeros(own_classes), np.log10(counts.ending_tokens + 0.1 * (counts.ending_words + 1))])
    look = Lookup(counts)
    logs = np.array([*[np.log10(c + 0.1) for c in frequent.values()], 0.0])
    columns = [key, *keep]
    kinds = dict(docs.select(*columns).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unseen_end = float(np.log10(0.1))
        for batch in batches:
            rows, n, known_n, base, lm = [], [], [], [], []
            rare_rows, rare_words, rare_n = [], [], []
            for row, raw in zip(batch.column(0).to_pylist(), batch.column(batch.num_columns - 1), strict=True):
                words = [*ascii_words(raw.as_py() or b""), END]
                place, classes, where = look(words)
                a = np.concatenate([[0, 0], classes])
                one, two, goal = a[1:-1], a[:-2], a[2:]
                model_log = float((t1[one, goal].astype(np.float64) + t2[two, goal] - norm[one, two]).sum() / np.log(10))
                own = logs[place]
                rare = Counter(w for w in map(words.__getitem__, where.tolist()) if w != END)
                rows.append(row)
                n.append(len(words))
                known_n.append(len(words) - len(where))
                # Tokens of the joined kind bring the logarithm of their counts later, to both scores.
                base.append(float(own.sum()) + (place[-1] < 0) * unseen_end - len(words) * all_log)
                lm.append(model_log + float(own[goal >= own_classes].sum()) - float(class_log[goal].sum()))
                rare_rows += [row] * len(rare)
                rare_words += rare.keys()
                rare_n += rare.values()
            k, m = len(rows), len(rare_rows)
            fields = [pa.concat_arrays([c, pa.nulls(m, c.type)]) for c in batch.columns[1:-1]]
            nulls = pa.nulls(m, pa.float64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*rows, *rare_rows], pa.int64()),
                    # A document's own row meets no token: the key holds a blank, which no token does.
                    pa.array([*[b" %d" % r for r in rows], *rare_words], pa.binary()),
                    pa.array([*[0] * k, *rare_n], pa.int64()),
                    *fields,
                    pa.array([*n, *[None] * m], pa.int64()),
                    pa.array([*known_n, *[0] * m], pa.int64()),
                    pa.concat_arrays([pa.array(base, pa.float64()), nulls]),
                    pa.concat_arrays([pa.array(lm, pa.float64()), nulls]),
                ],
                ["row", "w", "times", *columns, "n_tokens", "known", "base", "lm"],
            )

    schema = ", ".join(["row bigint, w binary, times bigint", *[f"`{c}` {kinds[c]}" for c in columns], "n_tokens bigint, known bigint, base double, lm double"])
    pieces = docs.select(F.monotonically_increasing_id().alias("row"), *columns, F.col(text).cast("binary").alias("_raw")).mapInArrow(released(run), schema)
    met = pieces.join(vocabulary, "w", "left")
    late = F.when(F.col("times") > 0, F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.1))).otherwise(F.lit(0.0))
    out = met.groupBy("row").agg(
        *[F.max(c).alias(c) for c in columns],
        F.max("n_tokens").alias("n_tokens"),
        F.sum(F.col("known") + F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("n_known"),
        F.lit(counts.total).cast("bigint").alias("train_tokens"),
        (F.max("base") + F.sum(late)).alias("base_score"),
        (F.max("lm") + F.sum(late)).alias("score"),
    )
    return out.drop("row")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned from those with another remainder than 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", remainder("doc_id", 10) == 0)
    return scored(docs, docs.where("not held_out"), keep=("held_out",))


QUERIES = {"op8_lm_scoring": op8_lm_scoring}
ORACLES: dict[str, str] = {}
