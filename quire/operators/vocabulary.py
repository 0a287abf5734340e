"""Vocabularies of several editions compared: singletons, likely corrections, absorbed entries."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as X

#: Positions before and after a word that are looked at (the word at the end is left out), and edit distance.
BAND, EDITS = 30, 2

#: Rows that a block of an order holds on average, blocks at most, and keys sampled for each.
BLOCK_ROWS, BLOCKS, SAMPLED = 100_000, 2_048, 32


#: Heads of words that travel to the tasks, and words that a task remembers.
HEADS = 200_000

_WORD = re.compile("[A-Za-zÀ-ÿ]+")


def _words(text: str) -> Column:
    """Different words of a text, an empty one perhaps among them."""
    return F.array_distinct(F.split(F.coalesce(F.col(text), F.lit("")), "[^A-Za-zÀ-ÿ]+"))


def words_of_documents(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(id, word): every different word of each document, as it is written."""
    return docs.select(F.col(id).alias("id"), F.explode(_words(text)).alias("word")).where("word <> ''")


def keyed(words: DataFrame) -> DataFrame:
    """(word, key) of every different word whose key has three letters or more."""
    return words.select("word").distinct().withColumn("key", X.key(F.col("word"))).where(F.length("key") >= 3)


def _edition_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different keys of (text, edition) rows, by edition: a word is read once a batch and edition. Words have no other signs than
    letters to ÿ, so what is left of their capitals in ASCII is what X.key leaves."""
    names = ["edition", "key"]
    for batch in batches:
        editions = batch.column(1).dictionary_encode(null_encoding="encode")
        words: dict[int, set[str]] = {}
        for text, e in zip(batch.column(0), editions.indices.to_pylist(), strict=True):
            words.setdefault(e, set()).update(_WORD.findall(text.as_py() or ""))
        for e, own in words.items():
            keys = {k for w in own if len(k := w.upper().encode("ascii", "ignore")) >= 3}
            named = pa.repeat(editions.dictionary[e], len(keys))
            yield pa.RecordBatch.from_arrays([named, pa.array(list(keys), pa.binary()).cast(pa.string())], names)


def occurrences(docs: DataFrame, text: str = "text", edition: str = "source") -> DataFrame:
    """(edition, key): every different word of three letters or more that an edition has.

    Tasks make words different before their keys are taken, so only the keys of a batch's editions are exchanged.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(edition).alias("edition"))
    return rows.mapInArrow(_edition_keys, f"edition {dict(rows.dtypes)['edition']}, key string").distinct()


def vocabulary(found: DataFrame) -> DataFrame:
    """(key, editions sorted, n_editions)."""
    return found.groupBy("key").agg(F.array_sort(F.collect_set("edition")).alias("editions")).withColumn("n_editions", F.size("editions").cast("bigint"))


def settled(rows: DataFrame) -> DataFrame:
    """``rows``, written once to the folder of spark.checkpoint.dir where the session names one: what asks for them
    several times, or loses an executor, does not make them from the start. Without a folder they stay as declared."""
    return rows.checkpoint() if rows.sparkSession.conf.get("spark.checkpoint.dir", "") else rows


def blocked(rows: DataFrame, key: str, size: int = BLOCK_ROWS, most: int = BLOCKS, sampled: int = SAMPLED) -> DataFrame:
    """``rows`` with ``block`` (from 0): blocks follow each other in the order of ``key`` and hold about ``size`` rows
    each (an equal share of all rows where these would be more than ``most`` blocks), whatever the keys begin with.

    The cuts between blocks are keys of a sample, chosen by their hashes, so all that ask see the same cuts; the
    sample holds ``sampled`` keys a block, 65,536 at most on average. Rows of one key share a block; a null key is in
    the first. Few rows are one block. Rows are asked for four times (number, sample, and twice by ``ordinal``), so they are settled.
    """
    rows = settled(rows)
    n = rows.agg(F.count("*")).scalar()
    blocks = F.least(F.ceil(n / size), F.lit(most))
    share = F.when(blocks > 1, blocks * sampled / n).otherwise(0.0)
    chosen = rows.select(F.col(key).alias("k")).where("k is not null").where(F.pmod(F.xxhash64("k"), F.lit(2**40)) < share * float(2**40))
    cuts = chosen.agg(F.filter(F.array_sort(F.collect_set("k")), lambda _, i: i % sampled == sampled - 1)).scalar()
    # How many cuts are not after the key, by halving: a cut outside the array is null and isn't taken.
    steps = F.array(*[F.lit(2**i) for i in range((2 * most).bit_length(), -1, -1)])
    place = F.aggregate("_steps", F.lit(0), lambda at, step: at + F.when(F.get("_cuts", at + step - 1) <= F.col(key), step).otherwise(0))
    return rows.withColumn("_cuts", cuts).withColumn("_steps", steps).withColumn("block", place).drop("_cuts", "_steps")


def ordinal(df: DataFrame, block: str, order: list[str], name: str = "ordinal", part: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with the place of each row (from 1, in each ``part``) in the order of ``order``, which the blocks follow.

    Rows are numbered inside blocks; only one row a block meets in a single task. ``blocked`` makes blocks of an even
    size of any order.
    """
    sizes = df.groupBy(*part, block).agg(F.count("*").alias("_n"))
    before = sizes.select(*part, F.col(block), (F.sum("_n").over(Window.partitionBy(*part).orderBy(block)) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*part, block).orderBy(*order))
    return df.withColumn("_inside", inside).join(before, [*part, block]).withColumn(name, F.col("_before") + F.col("_inside")).drop("_before", "_inside")


def suggestions(vocab: DataFrame, most: int = 4) -> DataFrame:
    """(variant, edition, rank, canonical, edit_distance, n_editions): for words that one edition has alone,
    the closest words that two or more have, in the band around it in the sorted vocabulary.

    The places of all words are cut into buckets of a band's width, and a singleton looks into three of them.
    """
    placed = ordinal(blocked(vocab, "key"), "block", ["key"], "at").withColumn("bucket", F.floor(F.col("at") / BAND))
    single = placed.where("n_editions = 1").select(F.col("key").alias("variant"), F.get("editions", F.lit(0)).alias("edition"), F.col("at").alias("at1"), F.explode(F.array(*[F.col("bucket") + d for d in (-1, 0, 1)])).alias("bucket"))
    known = placed.where("n_editions > 1").select(F.col("key").alias("canonical"), "editions", "n_editions", "at", "bucket")
    short = F.least(F.length("variant"), F.length("canonical"))
    lead = F.greatest(F.lit(2), F.ceil(short / 2)).cast("int")
    pairs = (
        single.join(known, "bucket")
        .where((F.col("at") - F.col("at1") >= -BAND) & (F.col("at") - F.col("at1") < BAND) & (F.abs(F.length("variant") - F.length("canonical")) <= EDITS))
        .where((F.left("variant", lead) == F.left("canonical", lead)) & ~F.array_contains("editions", F.col("edition")))
        .withColumn("edit_distance", X.near(F.col("variant"), F.col("canonical"), EDITS))
        .where("edit_distance is not null")
    )
    rank = F.row_number().over(Window.partitionBy("variant").orderBy("edit_distance", F.desc("n_editions"), "canonical"))
    return pairs.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= most).select("variant", "edition", "rank", "canonical", F.col("edit_distance").cast("bigint").alias("edit_distance"), "n_editions")


def summary(found: DataFrame) -> DataFrame:
    """One row: candidates, those at distance 1, with one best word, with a best word of four editions or more."""
    best = found.groupBy("variant").agg(F.min("edit_distance").alias("d"), F.min_by("n_editions", "rank").alias("n"), F.collect_list("edit_distance").alias("all"))
    alone = F.size(F.filter("all", lambda d: d == F.col("d"))) == 1
    return best.agg(F.count("*").alias("candidates"), F.count_if(F.col("d") == 1).alias("distance_one"), F.count_if(alone).alias("unique_best"), F.count_if(F.col("n") >= 4).alias("widely_confirmed"))


def neighbours(vocab: DataFrame) -> DataFrame:
    """(key, before2, before1, after1, after2) in the sorted vocabulary: numbered by blocks, then met by number."""
    placed = ordinal(blocked(vocab.select("key"), "key"), "block", ["key"], "at").select("key", "at")
    out = placed
    for name, d in (("before2", -2), ("before1", -1), ("after1", 1), ("after2", 2)):
        out = out.join(placed.select(F.col("key").alias(name), (F.col("at") - d).alias("at")), "at", "left")
    return out.drop("at")


def successors(found: DataFrame) -> DataFrame:
    """(edition, key, successor): the next word that the edition has.

    Words follow each other inside blocks of an even size; the first word of an edition's next block closes a
    block, so an edition's words never meet in one task.
    """
    have = blocked(found.select("edition", "key").distinct(), "key")
    first = have.groupBy("edition", "block").agg(F.min("key").alias("first"))
    after = first.select(F.col("edition").alias("_edition"), F.col("block").alias("_block"), F.lead("first").over(Window.partitionBy("edition").orderBy("block")).alias("_after"))
    inside = F.lead("key").over(Window.partitionBy("edition", "block").orderBy("key"))
    rows = have.withColumn("_inside", inside).join(after, F.col("edition").eqNullSafe(F.col("_edition")) & (F.col("block") == F.col("_block")))
    return rows.select("edition", "key", F.coalesce("_inside", "_after").alias("successor"))


def _ranked(found: DataFrame, least: int) -> DataFrame:
    """(key, upto, is_word): every key, how many words of ``least`` editions or more are not after it, and whether it is
    one. Places run inside blocks of an even size and start where the blocks before end, so no task has all words."""
    keys = found.select("edition", "key").distinct().groupBy("key").agg((F.count("*") >= least).alias("is_word"))
    keys = blocked(keys, "key")
    own = keys.groupBy("block").agg(F.count_if("is_word").alias("n"))
    # One row a block.
    before = own.select("block", F.coalesce(F.sum("n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.sum(F.col("is_word").cast("bigint")).over(Window.partitionBy("block").orderBy("key"))
    return keys.withColumn("inside", inside).join(before, "block").select("key", (F.col("before") + F.col("inside")).alias("upto"), "is_word")


def absent_between(found: DataFrame, least: int = 3, absorbers: DataFrame | None = None) -> DataFrame:
    """(edition, absorber, key): words that ``least`` other editions have and this one lacks, with the word of
    this edition that stands right before each; only behind ``absorbers`` (edition, absorber) where they are given.

    A join of intervals by ranks: between a word and its successor an edition has none, so what it lacks there are
    the ranks between theirs. Only these are written out, and meet their words by rank; no table of all words and
    editions is made, and any number of editions will do.
    """
    held = found.where(F.col("edition").isNotNull() & F.col("key").isNotNull())
    places = _ranked(held, least)
    spans = successors(held)
    if absorbers is not None:
        spans = spans.join(absorbers.select("edition", F.col("absorber").alias("key")).distinct(), ["edition", "key"], "left_semi")
    after = places.select(F.col("key").alias("successor"), (F.col("upto") - F.col("is_word").cast("bigint")).alias("hi"))
    most = places.agg(F.max("upto")).first()[0] or 0
    spans = spans.join(places.select("key", F.col("upto").alias("lo")), "key").join(after, "successor", "left")
    spans = spans.withColumn("hi", F.coalesce("hi", F.lit(most))).where("hi > lo")
    lacking = spans.select("edition", F.col("key").alias("absorber"), F.explode(F.sequence(F.col("lo") + 1, F.col("hi"))).alias("upto"))
    return lacking.join(places.where("is_word").select("upto", "key"), "upto").select("edition", "absorber", "key")


def oversized(sizes: DataFrame, word: str, edition: str, size: str, times: float = 3.0, more: float = 8000.0, least: int = 3) -> DataFrame:
    """``sizes`` (one row a word and edition) that exceed the median of the word's other editions.

    The sizes of a word come as one sorted array, as long as it has editions; without one of them the median
    is found by its place.
    """
    rows = sizes.where(F.col(size).isNotNull()).groupBy(word).agg(F.sort_array(F.collect_list(F.struct(F.col(size).alias("size"), F.col(edition).alias("edition")))).alias("_all"))
    rows = rows.where(F.size("_all") > least).select(word, "_all", F.posexplode("_all").alias("_at", "_own"))
    without = lambda k: F.get("_all", k + (k >= F.col("_at")).cast("int"))["size"].cast("double")
    others = F.size("_all") - 1
    half = F.floor(others / 2).cast("int")
    median = F.when(others % 2 == 1, without(half)).otherwise((without(half - 1) + without(half)) / 2)
    rows = rows.select(word, F.col("_own.edition").alias(edition), F.col("_own.size").alias(size), median.alias("median_elsewhere"), others.cast("bigint").alias("n_others"))
    return rows.where((F.col("median_elsewhere") > 0) & (F.col(size) > times * F.col("median_elsewhere")) & (F.col(size) - F.col("median_elsewhere") > more))


def _head(key: Column) -> Column:
    return F.left(key, F.greatest(F.lit(5), F.length(key) - 1))


def begun(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """(token, key): different tokens that begin with the head of a word: all of its letters but one, five at least.

    Tokens meet heads on their first five letters (heads that are shorter on three), so no frequent beginning
    is held against all words.
    """
    heads = words.select("key", _head(F.col("key")).alias("head"))
    out = None
    for n, some in ((5, F.length("head") >= 5), (3, F.length("head") < 5)):
        met = tokens.withColumn("block", F.left("token", F.lit(n))).join(heads.where(some).withColumn("block", F.left("head", F.lit(n))), "block")
        met = met.where(F.startswith("token", F.col("head"))).select("token", "key")
        out = met if out is None else out.union(met)
    return out


def contained(docs: DataFrame, words: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(id, key): words (``words``, different keys) whose head begins a word of the text.

    Up to HEADS heads travel to the tasks, which look the beginnings of each different word up; nothing but ids is
    exchanged then, and what ids of several rows have. With more heads, the different words of all texts meet them.
    """
    heads = words.select("key", _head(F.col("key")).alias("head")).limit(HEADS + 1).collect()
    if len(heads) > HEADS:
        bodies = words_of_documents(docs, text, id)
        different = keyed(bodies).withColumnRenamed("key", "token")
        met = begun(different.select("token").distinct(), words)
        return bodies.join(different.join(met, "token"), "word").select("id", "key").distinct()
    by_head: dict[str, list[str]] = {}
    for r in heads:
        by_head.setdefault(r.head, []).append(r.key)
    shared = docs.sparkSession.sparkContext.broadcast(by_head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys_of, lengths = shared.value, sorted(set(map(len, shared.value)))
        seen: dict[str, tuple[str, ...]] = {}
        for batch in batches:
            found, at = [], []
            for k, raw in enumerate(batch.column(0)):
                own: set[str] = set()
                for word in set(_WORD.findall(raw.as_py() or "")):
                    if (keys := seen.get(word)) is None:
                        token = word.upper().encode("ascii", "ignore").decode()
                        keys = tuple(key for n in lengths if n <= len(token) for key in keys_of.get(token[:n], ()))
                        if len(seen) >= HEADS:
                            seen.clear()
                        seen[word] = keys
                    own.update(keys)
                found += own
                at += [k] * len(own)
            yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(at, pa.int64())), pa.array(found, pa.string())], ["id", "key"])

    again = docs.groupBy(F.col(id).alias("_again")).agg(F.count("*").alias("_n")).where("_n > 1").select("_again")
    again = settled(again)
    again = F.broadcast(again) if again.limit(HEADS + 1).count() <= HEADS else again
    rows = docs.select(F.col(text).alias("text"), F.col(id).alias("id"))
    met = lambda some: some.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, key string")
    same = F.col("id").eqNullSafe(F.col("_again"))
    return met(rows.join(again, same, "left_anti")).union(met(rows.join(again, same, "left_semi")).distinct())
