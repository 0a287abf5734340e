"""Fingerprints of documents by one-permutation MinHash, in DataFrame functions only.

Every shingle of five words is hashed once; the top bits of the hash name a bin and each bin keeps its least hash. A
bin that nothing falls into copies another by optimal densification: it asks the bins in an order of its own, drawn
independently of all other bins', until one is not empty. Four low-order bits of each bin are packed. The likeness of two
fingerprints is the share of equal bins, corrected for the sixteenth of them that are equal by chance.
"""

from __future__ import annotations

import itertools

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import SPACE, once, table

SHINGLE = 5
#: Bins (their number is the top byte of a hash) and bits kept of each: 128 bytes a document, packed.
BINS, BITS = 256, 4
#: An empty bin asks this many bins, then on to so many, up to all; only a matter of cost.
ASKED = (0, 2, 6, 22, 86, BINS)
#: Documents of a stretch of neighbouring ids, and stretches at most. Cost only: more rows make longer stretches.
STRETCH, MOST_STRETCHES = 2048, 1 << 16
_SHIFT = 56
_REST = (1 << _SHIFT) - 1


def probes() -> list[list[int]]:
    """For each bin the order in which it asks all bins when it is empty."""
    return [sorted(range(BINS), key=lambda b: xxhash.xxh3_64_intdigest(b"%d asks %d" % (j, b))) for j in range(BINS)]


def _numbers(values: list[int], kind: str) -> Column:
    """A constant array; the optimizer evaluates it once."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def fingerprints(df: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``df`` with a column ``name``: the packed fingerprint of the whole text, in hexadecimal (a digit is a bin).

    Words stand between ASCII white space, in lower case; a text of fewer than five words is one shingle. Texts
    without words (null, empty) have the empty fingerprint. Equal texts have equal fingerprints, and repeated rows too.
    Columns that start with ``_fp_`` are used inside.
    """
    none = F.array().cast("array<bigint>")
    words = F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), SPACE), "")
    out = once(df, F.transform(words, lambda w: F.xxhash64(w)).alias("_fp_words"))
    n, at = F.size("_fp_words"), lambda i: F.get("_fp_words", i)
    windows = F.slice(F.transform("_fp_words", lambda w, i: F.xxhash64(w, *[at(i + k) for k in range(1, SHINGLE)])), 1, F.greatest(n - SHINGLE + 1, F.lit(0)))
    hashes = F.when(n >= SHINGLE, windows).when(n > 0, F.array(F.xxhash64("_fp_words"))).otherwise(none)
    # One more value in each bin, its greatest: so every bin begins somewhere, and one that begins with it is empty.
    greatest = _numbers([((j - BINS // 2 + 1) << _SHIFT) - 1 for j in range(BINS)], "bigint")
    out = once(out, F.sort_array(F.concat(hashes, greatest)).alias("_fp_sorted"))
    bin_of = lambda x: F.shiftright(x, _SHIFT)
    least = F.filter("_fp_sorted", lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get("_fp_sorted", i - 1))))
    out = once(out, F.transform(least, lambda x: F.when(x.bitwiseAND(F.lit(_REST)) != F.lit(_REST), x)).alias("_fp_least"))
    order = _numbers([b for row in probes() for b in row], "int")
    turns = lambda first, end: F.sequence(F.lit(first), F.lit(end - 1))
    asked = lambda j, first, end: F.get(F.filter(F.transform(turns(first, end), lambda t: F.get("_fp_least", F.get(order, j * BINS + t))), lambda v: v.isNotNull()), F.lit(0))
    # A copy is hashed with the place that it fills, so that bins that copy the same one do not agree by chance together.
    copied = lambda j: F.xxhash64(F.coalesce(*[asked(j, a, b) for a, b in itertools.pairwise(ASKED)]), j)
    filled = F.transform("_fp_least", lambda v, j: F.hex(F.coalesce(v, copied(j)).bitwiseAND(F.lit((1 << BITS) - 1))))
    packed = F.when(F.size("_fp_words") > 0, F.lower(F.array_join(filled, ""))).otherwise(F.lit(""))
    return out.withColumn(name, packed).drop("_fp_words", "_fp_sorted", "_fp_least")


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity of the shingles of two fingerprints (0 to 1). Two empty ones are alike, an empty
    one is like no other."""
    digits = lambda c: F.slice(F.split(F.col(c), ""), 1, BINS)
    share = F.size(F.filter(F.zip_with(digits(a), digits(b), lambda x, y: x == y), lambda same: same)) / F.lit(float(BINS))
    chance = 1.0 / (1 << BITS)
    fair = F.greatest(F.lit(0.0), (share - F.lit(chance)) / F.lit(1.0 - chance))
    return F.when(F.col(a) == F.col(b), F.lit(1.0)).when((F.col(a) == "") | (F.col(b) == ""), F.lit(0.0)).otherwise(fair)


def _stretches(docs: DataFrame) -> list[int]:
    """First ids of stretches of about STRETCH documents; the ids alone are read."""
    n, least = docs.agg(F.count("id"), F.min("id")).first()
    parts = min(max(1, n // STRETCH), MOST_STRETCHES)
    if parts == 1:
        return [] if least is None else [least]
    shares = F.split(F.lit(",".join(f"{k / parts:.9f}" for k in range(1, parts))), ",").cast("array<double>")
    found = docs.agg(F.percentile_approx("id", shares, max(10_000, 4 * parts))).first()[0]
    return sorted({least, *found})


def with_next(docs: DataFrame, *fields: str, ids: DataFrame | None = None) -> DataFrame:
    """Rows (id, body, further columns) with ``next_<field>`` of the next row by id (ties by body); after the last comes the first.

    Ids are cut into stretches, and every stretch also takes in the row that begins the next one, so a window over one
    stretch knows all neighbours: one exchange, no sort of the whole, no join. A row without an id has no place in that
    order and is its own next. ``ids`` has the same ids, where they are cheaper to read than from ``docs``.
    """
    starts = _stretches(docs if ids is None else ids)
    if not starts:
        return docs.withColumns({f"next_{f}": F.col(f) for f in fields})
    last = len(starts) - 1
    bounds = _numbers(starts, "bigint")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, len(starts).bit_length())))])
    # Bisection: how many starts are not above the id.
    above = lambda p, s: F.when((p + s <= len(starts)) & (F.get(bounds, p + s - 1) <= F.col("id")), p + s).otherwise(p)
    own = F.when(F.col("id").isNull(), F.pmod(F.xxhash64("body"), F.lit(last + 1)).cast("int")).otherwise(F.aggregate(steps, F.lit(0), above) - 1)
    rows = once(docs, own.alias("_stretch"))
    begins = F.col("id") == F.get(bounds, F.col("_stretch"))
    before = F.when(F.col("_stretch") == 0, F.lit(last)).otherwise(F.col("_stretch") - 1)
    where = lambda stretch, guest: F.struct(stretch.alias("stretch"), F.lit(guest).alias("guest"))
    both = F.when(begins, F.array(where(F.col("_stretch"), False), where(before, True))).otherwise(F.array(where(F.col("_stretch"), False)))
    rows = rows.withColumn("_at", F.explode(both)).withColumn("_placed", F.col("id").isNotNull())
    order = Window.partitionBy("_at.stretch", "_placed").orderBy("_at.guest", "id", "body")
    rows = rows.withColumns({f"next_{f}": F.when(F.col("_placed"), F.lead(f).over(order)).otherwise(F.col(f)) for f in fields})
    return rows.where("not _at.guest").drop("_stretch", "_at", "_placed")


def edited(body: str, following: str) -> Column:
    """The text whose last quarter of code points (rounded down) is replaced by as many first ones of another."""
    n = F.char_length(body)
    quarter = F.floor(n / 4).cast("int")
    return F.concat(F.substring(F.col(body), F.lit(1), n - quarter), F.substring(F.col(following), F.lit(1), quarter))


def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and what they tell of both and of the next document."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint").alias("id"), F.coalesce("text", F.lit("")).alias("body"))
    rows = with_next(fingerprints(docs, "body"), "body", "fingerprint", ids=docs)
    rows = once(rows, edited("body", "next_body").alias("_edited"))
    rows = fingerprints(rows, "_edited", "edited_fingerprint")
    return rows.select(
        F.col("id").alias("doc_id"),
        F.char_length("body").cast("bigint").alias("n_chars"),
        F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )


QUERIES = {"op11_document_fingerprints": op11_document_fingerprints}
ORACLES: dict[str, str] = {}
