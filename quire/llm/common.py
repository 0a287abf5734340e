"""Small helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the separator of words in most contracts (Java and RE2 read it alike).
SPACE = r"[\x20\x09-\x0D]+"


#: Bytes of a batch that a Python worker is given: texts may be long, and a worker holds a batch several times.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded(spark: SparkSession) -> None:
    """Arrow batches of BATCH_BYTES at most from now on; a session that asks for smaller ones keeps its own."""
    now = int("".join(c for c in spark.conf.get(_BATCH) if c.isdigit()) or 0)
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(_BATCH, f"{BATCH_BYTES}b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, after which the worker gives freed memory back: workers live on for later stages."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # Not glibc: its own allocator decides.


def raw_text(batch: pa.RecordBatch, text: str) -> pa.Array:
    """The column ``text`` as bytes, without a copy."""
    return batch.column(batch.schema.get_field_index(text)).cast(pa.binary())


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.

    Where none is named a temporary one of this machine serves, in local mode only: on a cluster executors would
    not see it, so that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="quire-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again.

    Cuts lineage so that an expensive step runs once, and survives the loss of any executor. The files go
    when the application ends.
    """
    spark = df.sparkSession
    bounded(spark)
    path = f"{shared_dir(spark)}/quire/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)


def set_aside(df: DataFrame, *names: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with columns of these names under others, and the function that gives them their names back."""
    other = {n: f"_own_{n}" for n in names if n in df.columns}
    return df.withColumnsRenamed(other), lambda out: out.drop(*other).withColumnsRenamed({v: k for k, v in other.items()})


def once(df: DataFrame, *columns: Column) -> DataFrame:
    """``df`` with further columns, each evaluated once a row.

    A generator of one element stands between this projection and later ones, which keeps the optimizer
    from copying an expensive expression into each of its uses (and into lambdas, once an element).
    """
    packed = F.explode(F.array(F.struct(*columns))).alias("_once")
    return df.select("*", packed).select(*df.columns, "_once.*")


def most_frequent(counts: DataFrame, count: str, most: int) -> list[Row]:
    """Rows of ``counts`` with the highest counts, ``most`` of them at most, collected.

    A histogram in steps of a hundredth finds the least count that stays, so what reaches the driver is bounded
    by ``most`` in all, not for each task. Rows of the step that would go beyond stay out together.
    """
    step = F.floor(F.log2(count) * 64)
    bins = counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()
    kept, least = 0, None
    for r in sorted(bins, key=lambda r: -r.step):
        kept += r.n
        if kept > most:
            break
        least = r.step
    return counts.where(step >= least).collect() if least is not None else []


_SEED = [xxhash.xxh3_64_intdigest(b"byte %d" % b) for b in range(256)]
_BYTE = np.array(_SEED, np.uint64)
_BASE = xxhash.xxh3_64_intdigest(b"base") | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_WORD = np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)])
_CHUNK = 1 << 20


@functools.cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, x, np.uint64)])) for x in (_BASE, _INVERSE))


def word_codes(text: bytes) -> np.ndarray:
    """64-bit codes of the words between ASCII white space, in order; the text in pieces of bounded size.

    A code is the sum of a random number for each byte times a power of an odd base, taken for all words at
    once from running sums (modulo 2**64), and mixed with the length.
    """
    out = []
    at = 0
    while at < len(text):
        end = at + _CHUNK
        if end < len(text):
            cut = max(text.rfind(c, at, end) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            # A word longer than a piece is taken whole.
            end = cut if cut > at else min([len(text), *(p for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c") if (p := text.find(c, at + 1)) > 0)])
        b = np.frombuffer(b" " + text[at:end] + b" ", np.uint8)
        power, inverse = _powers(1 << max(12, (len(b) - 1).bit_length()))
        word = _WORD[b]
        edges = np.flatnonzero(word[1:] != word[:-1]) + 1
        start, stop = edges[::2], edges[1::2]
        total = np.cumsum(_BYTE[b] * power[: len(b)])
        out.append(mixed((total[stop - 1] - total[start - 1]) * inverse[start] + (stop - start).astype(np.uint64)))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


#: Unrelated odd multipliers, one for each place of a window.
_ODD = [np.uint64(xxhash.xxh3_64_intdigest(b"place %d" % k) | 1) for k in range(64)]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def rolled(codes: np.ndarray, size: int) -> np.ndarray:
    """64-bit codes of all windows of ``size`` words (order counts); of the whole where it is shorter."""
    n = len(codes)
    if not n:
        return codes
    size = min(size, n)
    h = np.full(n - size + 1, size, dtype=np.uint64)
    for k in range(size):
        h += codes[k : n - size + 1 + k] * _ODD[k]
    return mixed(h)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted and without repeats; quicker than np.unique on short arrays."""
    s = np.sort(values)
    return s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s


def ascii_words(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.lower().split()
