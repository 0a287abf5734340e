"""Language identification by a byte convolutional network.

Windows of a fixed number of bytes are embedded, convolved with filters of several widths, max-pooled and
classified by softmax. The network is trained in numpy on a bounded sample of labelled windows; every
window of every whole text is then classified inside Spark tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import raw_text, released, remainder, set_aside, stored, table

WINDOW = 256
#: Filters of each width.
FILTERS = {2: 8, 3: 16, 4: 16}
EMBED = 8
UNKNOWN = "und"
#: Chosen keys that may be broadcast; languages that a network may have, which bounds what reaches the driver.
BROADCAST_ROWS, MOST_LANGS = 200_000, 1_000


class ByteNet:
    """Parameters and forward pass; small enough to travel in a closure."""

    def __init__(self, langs: list[str], seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.langs = langs
        wide, total = max(FILTERS), sum(FILTERS.values())
        self.E = rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        self.E[0] = 0
        self.mask = np.zeros((wide, EMBED, total), np.float32)
        at = 0
        for width, n in FILTERS.items():
            self.mask[:width, :, at : at + n] = 1
            at += n
        self.mask = self.mask.reshape(wide * EMBED, total)
        self.W = rng.normal(0, 0.3, self.mask.shape).astype(np.float32) * self.mask
        self.b = np.zeros(total, np.float32)
        self.V = rng.normal(0, 0.1, (total, max(1, len(langs)))).astype(np.float32)
        self.c = np.zeros(max(1, len(langs)), np.float32)

    def columns(self, x: np.ndarray) -> np.ndarray:
        """For each position the embeddings of the bytes from it on: (windows, positions, width * EMBED)."""
        wide = max(FILTERS)
        e = self.E[np.pad(x, ((0, 0), (0, wide - 1)))]
        n = x.shape[1]
        return np.concatenate([e[:, k : k + n] for k in range(wide)], axis=2)

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = []
        for at in range(0, len(x), 64):
            cols = self.columns(x[at : at + 64])
            conv = cols.reshape(-1, cols.shape[2]) @ self.W
            top = conv.reshape(cols.shape[0], cols.shape[1], -1).max(axis=1)
            out.append(np.maximum(top + self.b, 0) @ self.V + self.c)
        return np.concatenate(out) if out else np.zeros((0, len(self.c)), np.float32)

    def step(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted cross entropy of one batch."""
        cols = self.columns(x)
        conv = (cols.reshape(-1, cols.shape[2]) @ self.W).reshape(cols.shape[0], cols.shape[1], -1)
        at = conv.argmax(axis=1)
        rows = np.arange(len(x))[:, None]
        top = np.take_along_axis(conv, at[:, None, :], 1)[:, 0] + self.b
        h = np.maximum(top, 0)
        z = h @ self.V + self.c
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        p *= (weight / weight.sum())[:, None]
        dh = (p @ self.V.T) * (top > 0)
        picked = cols[rows, at]  # (windows, filters, width * EMBED)
        dW = np.einsum("bf,bfk->kf", dh, picked) * self.mask
        dcols = dh[:, :, None] * self.W.T[None]
        dE = np.zeros_like(self.E)
        padded = np.pad(x, ((0, 0), (0, max(FILTERS) - 1)))
        for k in range(max(FILTERS)):
            np.add.at(dE, padded[rows, at + k].ravel(), dcols[:, :, k * EMBED : (k + 1) * EMBED].reshape(-1, EMBED))
        dE[0] = 0
        return {"E": dE, "W": dW, "b": dh.sum(0), "V": h.T @ p, "c": p.sum(0)}

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int, seed: int = 7) -> ByteNet:
        """Adam over shuffled batches; each language weighs the same."""
        rng, share = np.random.default_rng(seed), np.bincount(y, minlength=len(self.langs))
        weight = (1.0 / np.maximum(share, 1))[y].astype(np.float32)
        first = {k: np.zeros_like(getattr(self, k)) for k in "EWbVc"}
        second = {k: np.zeros_like(v) for k, v in first.items()}
        t = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(order), 64):
                pick = order[at : at + 64]
                t += 1
                for k, g in self.step(x[pick], y[pick], weight[pick]).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    rate = 0.01 * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
                    setattr(self, k, (getattr(self, k) - rate * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32))
        return self


def windows(text: bytes) -> np.ndarray:
    """All windows of a text, the last one padded with zero bytes."""
    n = -(-len(text) // WINDOW)
    out = np.zeros(n * WINDOW, np.uint8)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(n, WINDOW)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_lang: int = 512, per_text: int = 4, epochs: int = 6) -> ByteNet:
    """A network for the languages of ``labelled``.

    Bounds: at most ``per_lang`` texts of a language (the smallest hash of the key in each of ``per_lang``
    hash buckets, found by a map-side combined aggregate) with ``per_text`` windows each reach the driver; more
    than MOST_LANGS languages raise a ValueError.
    Rows with null text or null language teach nothing; without any row the network knows no language.
    """
    rows = labelled.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t"), F.col(lang).alias("l")).where("t is not null and l is not null and k is not null")
    h = F.xxhash64("k")
    chosen = rows.groupBy("l", F.pmod(h, F.lit(per_lang)).alias("bucket")).agg(F.min(F.struct(h.alias("h"), F.col("k"))).alias("m")).select("l", "m.k")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, out = [], []
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = windows(raw)
                for i in np.unique(np.linspace(0, len(found) - 1, per_text).astype(int)) if len(found) else ():
                    langs.append(name)
                    out.append(found[i].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.binary())], ["l", "w"])

    chosen = stored(chosen, "language-sample")
    few = chosen.count() <= BROADCAST_ROWS
    if chosen.select("l").distinct().count() > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")
    picked = rows.join(F.broadcast(chosen) if few else chosen, ["k", "l"], "left_semi").select("l", F.col("t").cast("binary").alias("t"))
    got = sorted((r.l, bytes(r.w)) for r in picked.mapInArrow(released(cut), "l string, w binary").collect())
    langs = sorted({name for name, _ in got})
    net = ByteNet(langs)
    if len(langs) > 1:
        x = np.stack([np.frombuffer(w, np.uint8) for _, w in got])
        net.fit(x, np.array([langs.index(name) for name, _ in got]), epochs)
    return net


def identify(docs: DataFrame, net: ByteNet, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` (columns ``keep``, all by default) with lang_pred and score.

    Every window of the whole text votes with its logits, weighted by its bytes that can be letters; the
    score is the softmax of the mean. A null text, a text without a letter (and any text, if no language
    was learned) is ``und`` with score 0. Ties go to the first language by name. Columns of ``docs`` named
    lang_pred or score are replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = raw_text(batch, text)
            pred: list[str] = []
            score: list[float] = []
            for at in range(0, len(raw), 64):
                texts = raw[at : at + 64].to_pylist()
                sound = [i for i, t in enumerate(texts) if t and net.langs and has_letter(t.decode("utf-8", "replace"))]
                names, sure = [UNKNOWN] * len(texts), [0.0] * len(texts)
                for i0 in range(0, len(sound), 16):
                    part = sound[i0 : i0 + 16]
                    cut = [windows(texts[i]) for i in part]
                    x = np.concatenate(cut)
                    z = net.logits(x).astype(np.float64)
                    w = (x >= 65).sum(1) + 1e-3
                    start = np.cumsum([0, *map(len, cut)])[:-1]
                    mean = np.add.reduceat(z * w[:, None], start) / np.add.reduceat(w, start)[:, None]
                    p = np.exp(mean - mean.max(1, keepdims=True))
                    p /= p.sum(1, keepdims=True)
                    best = p.argmax(1)
                    for j, i in enumerate(part):
                        names[i], sure[i] = net.langs[best[j]], float(p[j, best[j]])
                pred += names
                score += sure
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(pred, pa.string()), pa.array(score, pa.float64())], [*keep, "lang_pred", "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    ready = docs.select(*keep, *([] if text in keep else [text]))
    return ready.mapInArrow(released(classify), f"{fields}{', ' if keep else ''}lang_pred string, score double")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by a network that learned from those with another remainder than 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", remainder("doc_id", 4) == 2)
    net = train(docs.where("not held_out"))
    return identify(docs.select("doc_id", "held_out", "text"), net, keep=["doc_id", "held_out"])


def accepted(spark: SparkSession, docs: DataFrame, sf_dir: str, least: float = 0.5) -> DataFrame:
    """Pipeline stage: rows whose language is found with a score of ``least`` or more stay.

    Null texts and texts without a letter have no language and go; repeated rows share their fate. Where no row
    has both a text and a language nothing is learned, and nothing stays. Columns lang_pred and score of
    ``docs`` are kept as they are.
    """
    columns = docs.columns
    net = train(docs.where(remainder("doc_id", 4) != 2))
    renamed, back = set_aside(docs, "lang_pred", "score")
    return back(identify(renamed, net).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))).select(*columns)


QUERIES = {"op6_language_id": op6_language_id}
ORACLES: dict[str, str] = {}
