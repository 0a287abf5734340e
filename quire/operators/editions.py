"""Work on the records of several editions: candidates for correction, absorbed entries, decisions, patches.

Records have edition, file, line (their place), headword, base_headword, type, char_count, body_text and
is_cross_reference; other columns are carried where a record is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import repairs as P
from quire.operators import vocabulary as V

# How much of a body is shown with a candidate and with an absorbed entry, how many records and
# suggestions a candidate lists, and from how many characters on a body can serve as reference.
SNIPPET, REFERENCE, SHOWN, SUGGESTED, LEAST_REFERENCE = 160, 140, 5, 4, 40


def entries(records: DataFrame, least: int = 3) -> DataFrame:
    """Records but treatises, with their keys, of ``least`` letters or more; a null type is no treatise."""
    rows = records.where(~F.col("type").eqNullSafe("treatise")).withColumn("key", X.key(F.col("base_headword")))
    return rows.where(F.length("key") >= least)


def first_records(rows: DataFrame, *values: str) -> DataFrame:
    """(edition, key, values) of the first record of a word in each edition."""
    place = F.struct("file", "line")
    return rows.groupBy("edition", "key").agg(*[F.min_by(v, place).alias(v) for v in values])


def headword_candidates(records: DataFrame) -> DataFrame:
    """Words that one edition has alone, with likely corrections, the safest first.

    variant, edition, n_records, records (the first SHOWN), suggestions (SUGGESTED at most: canonical as the
    least edition writes it, norm, edit_distance, n_editions, editions), neighbors in the vocabulary, snippet.
    In order of distance, editions that confirm, number of suggestions, edition and place.
    """
    rows = entries(records)
    vocab = V.vocabulary(rows.select("edition", "key"))
    shown = first_records(rows, "base_headword").select(F.col("edition").alias("_least"), F.col("key").alias("canonical"), F.col("base_headword").alias("_display"))
    listed = vocab.select(F.col("key").alias("canonical"), "editions", F.array_min("editions").alias("_least"))
    found = V.suggestions(vocab, SUGGESTED).join(listed, "canonical").join(shown, ["_least", "canonical"])
    one = F.struct(F.col("_display").alias("canonical"), F.col("canonical").alias("norm"), "edit_distance", "n_editions", "editions")
    found = found.groupBy("variant", "edition").agg(F.array_sort(F.collect_list(F.struct("rank", one.alias("s")))).alias("s"))
    found = found.select("variant", "edition", F.transform("s", lambda x: x["s"]).alias("suggestions"))
    own = rows.join(found.select(F.col("variant").alias("key"), "edition"), ["key", "edition"], "left_semi")
    each = Window.partitionBy("edition", "key")
    own = own.withColumns({"_n": F.row_number().over(each.orderBy("file", "line")), "n_records": F.count("*").over(each)}).where(F.col("_n") <= SHOWN)
    record = F.struct("file", "line", "headword", "base_headword", "char_count", F.left(F.coalesce("body_text", F.lit("")), F.lit(SNIPPET)).alias("snippet"), F.coalesce("is_cross_reference", F.lit(False)).alias("is_xref"))
    own = own.groupBy(F.col("key").alias("variant"), "edition").agg(F.max("n_records").alias("n_records"), F.array_sort(F.collect_list(record)).alias("records"))
    near = V.neighbours(vocab).select(F.col("key").alias("variant"), F.array_compact(F.array("before2", "before1", "after1", "after2")).alias("neighbors"))
    out = found.join(own, ["variant", "edition"]).join(near, "variant")
    best, first = F.get("suggestions", F.lit(0)), F.get("records", F.lit(0))
    out = out.select("variant", "edition", "n_records", "records", "suggestions", "neighbors", first["snippet"].alias("snippet"))
    return out.orderBy(best["edit_distance"], best["n_editions"].desc(), F.size("suggestions"), "edition", first["file"], first["line"], "variant")


def absorbed_entries(records: DataFrame, editions: list[str], times: float = 3.0, more: float = 8000.0, least: int = 3) -> DataFrame:
    """Records far longer than in other editions, with the entries they may have swallowed.

    A word is missing where ``least`` other editions have it and this one has not; it is put down to a record
    if it stands between the record and the edition's next word, or if its beginning stands in the record's
    body and it shares the record's first two letters. ``editions`` gives their order: the first record of
    more than LEAST_REFERENCE characters in that order is a word's reference.
    """
    rows = entries(records)
    found = rows.select("edition", "key").distinct()
    sizes = rows.groupBy("key", "edition").agg(F.max("char_count").cast("double").alias("size"))
    large = V.oversized(sizes, "key", "edition", "size", times, more, least).select("key", "edition", "median_elsewhere")
    large = rows.join(large, ["key", "edition"]).where((F.col("char_count") > times * F.col("median_elsewhere")) & (F.col("char_count") - F.col("median_elsewhere") > more))
    large = large.withColumnRenamed("key", "absorber")
    beside = large.select("edition", "file", "line", "absorber").join(V.absent_between(found, least, large), ["edition", "absorber"])

    words = found.groupBy("key").agg(F.count("*").alias("n_editions")).where(F.col("n_editions") >= least)
    tokens = large.select("edition", "file", "line", "absorber", F.explode(F.array_distinct(F.regexp_extract_all(F.upper(F.coalesce("body_text", F.lit(""))), F.lit(r"(?U)(\w+)"), F.lit(1)))).alias("token"))
    tokens = tokens.where(F.left("token", F.lit(2)) == F.left("absorber", F.lit(2)))
    inside = tokens.join(V.begun(tokens.select("token").distinct(), words.select("key")), "token").where((F.col("key") > F.col("absorber")) & (F.col("key") < F.concat(F.left("absorber", F.lit(2)), F.lit("ZZZZZZ"))))
    inside = inside.join(found, ["edition", "key"], "left_anti")
    columns = ["edition", "file", "line", "key"]
    missing = beside.select(*columns).union(inside.select(*columns)).distinct()

    rank = F.array_position(F.array(*[F.lit(e) for e in editions]), F.col("edition"))
    place = F.struct(rank.alias("rank"), "file", "line")
    reference = rows.where((F.col("char_count") > LEAST_REFERENCE) & (rank > 0)).groupBy("key").agg(F.min_by(F.struct(F.col("base_headword").alias("headword"), F.left(F.coalesce("body_text", F.lit("")), F.lit(REFERENCE)).alias("ref")), place).alias("r"))
    one = F.struct(F.coalesce("r.headword", "key").alias("headword"), F.col("key").alias("norm"), F.coalesce("r.ref", F.lit("")).alias("ref"), "n_editions")
    told = missing.join(words, "key").join(reference, "key", "left").groupBy("edition", "file", "line").agg(F.collect_list(F.struct("key", one.alias("e"))).alias("l"))
    told = told.select("edition", "file", "line", F.transform(F.array_sort("l"), lambda x: x["e"]).alias("absorbed"))
    return large.join(told, ["edition", "file", "line"]).select(
        "edition", "file", "line", F.col("headword").alias("absorber_headword"), F.col("base_headword").alias("absorber_base"), F.col("char_count").alias("absorber_cc"), F.col("median_elsewhere").cast("int").alias("median_elsewhere"), "absorbed", F.col("body_text").alias("body")
    )


def batch_items(candidates: DataFrame, size: int = 25) -> DataFrame:
    """(batch, i, v, ed, sug, snip): candidates numbered from 0 in their order, in compact form, ``size`` a batch.

    Numbers run inside blocks of an even size of that order and start where the blocks before end.
    """
    best, first = F.get("suggestions", F.lit(0)), F.get("records", F.lit(0))
    order = F.struct(best["edit_distance"], -best["n_editions"], F.size("suggestions"), F.col("edition"), first["file"], first["line"], F.col("variant"))
    short = F.transform("suggestions", lambda s: F.struct(s["norm"].alias("n"), s["edit_distance"].alias("d"), s["n_editions"].alias("ne")))
    rows = V.ordinal(V.blocked(candidates.withColumn("_order", order), "_order"), "block", ["_order"], "i").withColumn("i", F.col("i") - 1)
    return rows.select(F.floor(F.col("i") / size).alias("batch"), "i", F.col("variant").alias("v"), F.col("edition").alias("ed"), short.alias("sug"), F.col("snippet").alias("snip"))


def first_undone(progress: DataFrame, batch: str, most: int) -> DataFrame:
    """The first ``most`` batches that aren't complete."""
    return progress.where("not complete").orderBy(batch).limit(most)


def taken_in(inbox: DataFrame, done: DataFrame, keys: list[str], places: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """New decisions of an inbox, and one row of counts (added, skipped, unmapped).

    ``inbox`` has ``ord``, the order of its answers; the first of a key counts, and those of keys in ``done``
    are skipped. ``places`` (i, file, line) says where each number stands: what an answer says of that itself
    is replaced, and answers of unknown numbers are dropped and counted.
    """
    fresh = inbox.join(done.select(*keys).distinct(), keys, "left_anti")
    if places is not None:
        fresh = fresh.drop("file", "line").join(places.select("i", "file", "line").withColumn("_known", F.lit(True)), "i", "left").withColumn("_known", F.coalesce("_known", F.lit(False)))
    else:
        fresh = fresh.withColumn("_known", F.lit(True))
    new = P.first_wins(fresh.where("_known"), keys, ["ord"]).drop("_known", "ord")
    told = inbox.select(F.lit("all").alias("what")).union(new.select(F.lit("added"))).union(fresh.where("not _known").select(F.lit("unmapped")))
    n = lambda what: F.count_if(F.col("what") == what)
    return new, told.agg(n("added").alias("added"), (n("all") - n("added") - n("unmapped")).alias("skipped"), n("unmapped").alias("unmapped"))


def decision_counts(candidates: DataFrame, decisions: DataFrame, by: list[str]) -> DataFrame:
    """One row: decisions that correct, that keep, and that can't be used (unknown word, or none of the suggestions)."""
    last = decisions.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("seq")))).where("_n = 1")
    known = last.join(candidates.select(*by, "suggestions"), by, "left")
    sound = F.coalesce(F.exists("suggestions", lambda s: s["norm"] == F.col("canonical")), F.lit(False))
    correct = F.col("decision") == "correct"
    return known.agg(F.count_if(correct & sound).alias("correct"), F.count_if(~correct).alias("keep"), F.count_if(correct & ~sound).alias("unusable"))


def unsplit(records: DataFrame) -> DataFrame:
    """Records that no split has touched yet, so that splitting twice changes nothing."""
    return records.where("provenance.absorbed_split is null") if "provenance" in records.columns else records


# Patches: a table of single repairs (file, base_headword, kind, marker, new_headword, source).


def _remade(body: Column) -> dict[str, Column]:
    return {"body_text": body, "body_html": X.paragraphs(body), "char_count": F.length(body), "cross_refs": F.slice(X.cross_references(body), 1, 50)}


def split_out(records: DataFrame, patches: DataFrame, least: int = 10) -> DataFrame:
    """Records of ``patches`` of kind ``split`` cut at their marker; what follows is a record of its own, right behind.

    Only the first record of a headword in a file is cut, and only where the marker stands ``least``
    characters in. ``sub`` (0 for what was there) gives the order behind a record; ``patched_by`` the source.
    """
    own = patches.where("kind = 'split'").select("file", "base_headword", "marker", "new_headword", "source")
    first = records.groupBy("file", "base_headword").agg(F.min("line").alias("line"))
    rows = records.join(own.join(first, ["file", "base_headword"]), ["file", "base_headword", "line"], "left")
    at = F.instr("body_text", F.col("marker")) - 1
    rows = rows.withColumn("_at", F.when(F.col("marker").isNotNull() & (at >= least), at))
    kept = [c for c in records.columns if c not in ("headword", "base_headword", "body_text")]
    head = F.struct(F.lit(0).alias("sub"), "headword", "base_headword", F.when(F.col("_at").isNotNull(), F.trim(F.left("body_text", F.col("_at").cast("int")))).otherwise(F.col("body_text")).alias("body_text"))
    rest = F.when(F.col("_at").isNotNull(), F.struct(F.lit(1).alias("sub"), F.col("new_headword").alias("headword"), F.col("new_headword").alias("base_headword"), F.trim(F.substr("body_text", F.col("_at") + 1)).alias("body_text")))
    rows = rows.select(*kept, F.when(F.col("_at").isNotNull(), F.col("source")).alias("patched_by"), F.explode(F.array_compact(F.array(head, rest))).alias("p")).select(*kept, "p.*", "patched_by")
    changed = F.col("patched_by").isNotNull()
    remade = {k: F.when(changed, v).otherwise(F.col(k)) for k, v in _remade(F.col("body_text")).items() if k != "body_text" and k in records.columns}
    return rows.withColumns(remade)


def put_back(records: DataFrame, earlier: DataFrame, patches: DataFrame) -> DataFrame:
    """For patches of kind ``restore``: what an earlier snapshot's record said before the words that it was renamed
    to, as a record of its own right before the renamed one.

    The patch names the renamed record (base_headword) and the lost one (new_headword); what is put back must
    begin with the lost headword. ``sub`` is -1 for it; the record's mark relabeled_from goes.
    """
    own = patches.where("kind = 'restore'").select("file", "base_headword", F.col("new_headword").alias("_lost"), F.col("source").alias("_source"))
    old = earlier.groupBy("file", F.col("base_headword").alias("_lost")).agg(F.min_by("body_text", "line").alias("_old"))
    rows = records.join(own, ["file", "base_headword"], "left").join(old, ["file", "_lost"], "left")
    lost = F.trim(F.left("_old", F.length("_old") - F.length("body_text")))
    fits = F.col("relabeled_from").eqNullSafe(F.col("_lost")) & F.col("_lost").isNotNull() & F.coalesce(F.startswith(F.upper(lost), F.upper(F.col("_lost"))), F.lit(False))
    rows = rows.withColumn("_back", F.when(fits, lost))
    kept = [c for c in records.columns if c not in ("headword", "base_headword", "body_text", "relabeled_from")]
    back = F.when(F.col("_back").isNotNull(), F.struct(F.lit(-1).alias("sub"), F.col("_lost").alias("headword"), F.col("_lost").alias("base_headword"), F.col("_back").alias("body_text"), F.lit(None).cast("string").alias("relabeled_from")))
    stay = F.struct(F.lit(0).alias("sub"), "headword", "base_headword", "body_text", F.when(F.col("_back").isNull(), F.col("relabeled_from")).alias("relabeled_from"))
    rows = rows.select(*kept, F.explode(F.array_compact(F.array(back, stay))).alias("p"), F.when(F.col("_back").isNotNull(), F.col("_source")).alias("patched_by")).select(*kept, "p.*", "patched_by")
    remade = {k: F.when(F.col("sub") < 0, v).otherwise(F.col(k)) for k, v in _remade(F.col("body_text")).items() if k != "body_text" and k in records.columns}
    return rows.withColumns(remade)


def without_blank_leaves(records: DataFrame) -> DataFrame:
    """Records but treatises named like a volume whose text only says that the image shows a blank page."""
    # Fixed value: how the page model words it.
    blank = F.startswith(F.lower(F.left(F.ltrim(F.coalesce("body_text", F.lit(""))), F.lit(30))), F.lit("this image shows a blank"))
    return records.where(~((F.col("type").eqNullSafe("treatise")) & F.coalesce(F.col("base_headword").rlike("^VOL[IVXLC]+$"), F.lit(False)) & blank))


def counted(records: DataFrame, types: list[str], detectors: list[str]) -> tuple[DataFrame, Observation]:
    """``records`` as they are, and the counts that the next write of them leaves in the observation: no second job.

    ``count_of`` gives the count of a pair; pairs of other types or detectors are in ``total`` alone. Counts are those
    of tasks that succeeded; a stage that is run again for a lost executor may add its rows once more, so check
    ``total`` against the written table where executors were lost.
    """
    told = Observation()
    pairs = {_pair(t, d): F.count_if(F.col("type").eqNullSafe(t) & F.col("detected_by").eqNullSafe(d)) for t in types for d in detectors}
    return records.observe(told, F.count(F.lit(1)).alias("total"), *[n.alias(name) for name, n in pairs.items()]), told


def _pair(type_: str, detector: str) -> str:
    return f"{type_}|{detector}"


def count_of(told: Observation, type_: str, detector: str) -> int:
    """How many records of a type and detector the write behind an observation had."""
    return told.get[_pair(type_, detector)]


def tallies(records: DataFrame) -> DataFrame:
    """(type, detected_by, n) with totals (nulls) of each type and of all."""
    return records.rollup("type", "detected_by").agg(F.count("*").alias("n"), F.grouping_id().alias("level"))
