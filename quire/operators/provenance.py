"""Repairs of article records that note what they did in ``provenance``, and by that note do it once.

Each repair is one join and one projection that patches the nested struct in the same pass; run again it finds its own
note and leaves the record alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from quire import schemas
from quire.functions import text as X
from quire.operators import repairs as P

# What stands as the source of a split, and of the records that came of it.
SPLIT_SOURCE, SPLIT_BY = "cross-edition-absorption+llm", "absorption-split"
CORRECTION_SOURCE = "cross-edition"
#: Columns that a repair of articles reads or writes, with their types, where a table lacks them.
_MORE = {"qualifier": "string", "type": "string", "detected_by": "string", "is_cross_reference": "boolean", "cross_refs": "array<string>", "body_html": "string", "char_count": "int", "headword": "string", "base_headword": "string"}


def traced(records: DataFrame) -> DataFrame:
    """``records`` with a provenance that has all fields: its own where it has one, else from columns of the same names
    (image_files, headword_bbox, headword_image), which it takes in."""
    fields = {f.name: f.dataType.simpleString() for f in DataType.fromDDL(schemas.PROVENANCE).fields}
    if "provenance" in records.columns:
        own = set(records.select("provenance.*").columns)
        note = F.struct(*[(F.col(f"provenance.{n}") if n in own else F.lit(None)).cast(t).alias(n) for n, t in fields.items()])
        return records.withColumn("provenance", note)
    own = [n for n in fields if n in records.columns]
    return records.withColumn("provenance", F.struct(*[(F.col(n) if n in own else F.lit(None)).cast(t).alias(n) for n, t in fields.items()])).drop(*own)


def _filled(records: DataFrame) -> DataFrame:
    return traced(records.withColumns({c: F.lit(None).cast(t) for c, t in _MORE.items() if c not in records.columns}))


def _anchored(headword: Column, old: Column, new: Column) -> Column:
    """``headword`` with the first ``old`` that is no part of a longer or hyphened word as ``new``; else ``new`` alone."""
    pattern = F.concat(F.lit(r"(?s)^(.*?)(?<![A-Za-z])\Q"), F.replace(old, F.lit(r"\E"), F.lit("")), F.lit(r"\E(?![A-Za-z-])"))
    safe = F.replace(F.replace(new, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
    return F.when(F.regexp_like(headword, pattern), F.regexp_replace(headword, pattern, F.concat(F.lit("$1"), safe))).otherwise(new)


def corrected(records: DataFrame, fixes: DataFrame) -> DataFrame:
    """Records whose base headword's key is a known misreading in their edition, corrected and noted.

    ``fixes`` has eb_code, variant (a key), canonical, n_editions, edit_distance; of repeated ones that with most editions
    counts. Treatises, records without a fix, and those corrected before stay as they are.
    """
    best = fixes.groupBy("eb_code", "variant").agg(F.max(F.struct("n_editions", (-F.col("edit_distance")).alias("near"), "canonical")).alias("_fix"))
    rows = _filled(records)
    rows = rows.withColumn("variant", X.key(F.col("base_headword"))).join(best, ["eb_code", "variant"], "left")
    note, new = F.col("provenance"), F.col("_fix.canonical")
    todo = F.col("_fix").isNotNull() & note["headword_correction"].isNull() & ~F.col("type").eqNullSafe("treatise")
    meta = F.struct(F.col("variant").alias("from"), new.alias("to"), F.col("_fix.n_editions").cast("int").alias("n_editions"), (-F.col("_fix.near")).cast("int").alias("edit_distance"), F.lit(CORRECTION_SOURCE).alias("source"))
    patched = note.withField("raw_headword", F.col("headword")).withField("raw_base_headword", F.col("base_headword")).withField("headword_correction", meta)
    shown = _anchored(F.coalesce("headword", F.lit("")), F.col("base_headword"), new)
    out = rows.withColumns({"provenance": F.when(todo, patched).otherwise(note), "headword": F.when(todo, shown).otherwise(F.col("headword")), "base_headword": F.when(todo, new).otherwise(F.col("base_headword"))})
    return out.drop("variant", "_fix")


def uncorrected(records: DataFrame, wrong: DataFrame) -> DataFrame:
    """Records whose correction is one of ``wrong`` (old, new) as they were before it, without its notes."""
    rows = _filled(records)
    pairs = wrong.select(F.col("old").alias("_old"), F.col("new").alias("_new"), F.lit(True).alias("_wrong")).distinct()
    made = F.col("provenance.headword_correction")
    rows = rows.join(pairs, (made["from"] == F.col("_old")) & (made["to"] == F.col("_new")), "left")
    back, note = F.col("_wrong").isNotNull(), F.col("provenance")
    bare = note
    for field in ("raw_headword", "raw_base_headword", "headword_correction"):
        bare = bare.withField(field, F.lit(None).cast(dict((f.name, f.dataType.simpleString()) for f in DataType.fromDDL(schemas.PROVENANCE).fields)[field]))
    restored = {c: F.when(back, F.coalesce(F.col(f"provenance.raw_{c}"), F.col(c))).otherwise(F.col(c)) for c in ("headword", "base_headword")}
    return rows.withColumns({**restored, "provenance": F.when(back, bare).otherwise(note)}).drop("_old", "_new", "_wrong")


def completed(records: DataFrame) -> DataFrame:
    """Records with qualifiers and printed end pages that earlier steps left out or got wrong.

    Where there is no qualifier, what stands in the parentheses at the headword's end becomes it, if the base is in
    capitals and the headword begins as it does. A printed end page that the images contradict is replaced and kept in
    provenance. Run again it changes nothing, for both hold then.
    """
    rows = _filled(records)
    pattern = r"^\s*(.+?)\s*\(([^)]+)\)\s*$"
    base, named = F.coalesce("base_headword", F.lit("")), F.coalesce("headword", F.lit(""))
    capitals = base.rlike(r"\A[A-Z][A-Z'\-. ]+\z") & F.startswith(F.upper(F.trim(F.regexp_extract(named, pattern, 1))), F.left(base, F.lit(3)))
    missing = (F.coalesce("qualifier", F.lit("")) == "") & capitals & named.rlike(pattern)
    rows = rows.withColumn("qualifier", F.when(missing, F.trim(F.regexp_extract(named, pattern, 2))).otherwise(F.col("qualifier")))
    pages = [F.col(c) for c in ("printed_page_start", "printed_page_end", "image_page_start", "image_page_end")]
    told = P.page_end(*pages)
    moved = pages[1].isNotNull() & ~told.eqNullSafe(pages[1])
    note = F.when(moved, F.col("provenance").withField("raw_printed_page_end", pages[1].cast("int"))).otherwise(F.col("provenance"))
    return rows.withColumns({"provenance": note, "printed_page_end": told.cast(records.schema["printed_page_end"].dataType)})


def absorbed_split(records: DataFrame, candidates: DataFrame, answers: DataFrame) -> DataFrame:
    """Records (keys file, line) cut where answers say that other entries begin, children right behind (``sub`` from 1).

    ``answers`` has file, line, seq and splits (norm, found, start_text); the last answer for a record counts whole.
    ``candidates`` has file, line and absorbed (norm, headword), the names to show. A record whose own part is short
    becomes its first child and is noted as relabelled. Children take the pages and volume of their parent. Records that
    a split is noted for are not split again.
    """
    rows = _filled(records)
    keys = ["file", "line"]
    last = answers.groupBy(*keys).agg(F.max_by("splits", "seq").alias("splits")).join(candidates.groupBy(*keys).agg(F.max("absorbed").alias("absorbed")), keys, "left")
    todo = rows.where("provenance.absorbed_split is null").select(*keys, "body_text").join(last, keys).withColumn("id", F.struct(*keys))
    named = lambda s: F.coalesce(F.element_at(F.concat(F.array(F.lit(None).cast("string")), F.transform(F.filter("absorbed", lambda a: a["norm"] == s["norm"]), lambda a: a["headword"])), -1), s["norm"])
    found = F.filter("splits", lambda s: F.coalesce(s["found"], F.lit(False)))
    # Names are looked up before the texts are: a point is a name and how its text begins.
    points = todo.select("id", F.explode(F.transform(found, lambda s: F.struct(named(s).alias("name"), F.coalesce(s["start_text"], F.lit("")).alias("start_text")))).alias("s")).select("id", "s.*")
    pieces = P.split(todo.select("id", "body_text"), points, "id", "body_text")
    cut = pieces.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("part", "name", "body", "relabelled"))).alias("_pieces"))
    cut = cut.where((F.size("_pieces") > 1) | F.get("_pieces", F.lit(0))["relabelled"]).select("id.*", "_pieces")
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("part"), F.lit(None).cast("string").alias("name"), F.col("body_text").alias("body"), F.lit(False).alias("relabelled")))
    rows = rows.join(cut, keys, "left").withColumn("_cut", F.col("_pieces").isNotNull()).withColumn("_pieces", F.coalesce("_pieces", whole))
    rows = rows.select("*", F.explode("_pieces").alias("_p"))
    cut, child, part = F.col("_cut"), F.col("_p.part") > 0, F.col("_p")
    new_name = child | part["relabelled"]
    body = F.when(cut, F.trim(part["body"])).otherwise(F.col("body_text"))
    name = F.when(new_name, part["name"]).otherwise(F.col("headword"))
    note = F.col("provenance")
    empty = F.lit(None)
    recovered = F.transform(F.filter("_pieces", lambda p: p["part"] > 0), lambda p: p["name"])
    said = F.struct(recovered.alias("recovered"), F.coalesce(F.col("char_count"), F.length("body_text")).cast("int").alias("original_char_count"), F.lit(SPLIT_SOURCE).alias("source"))
    of_parent = note.withField("absorbed_split", said)
    of_parent = F.when(part["relabelled"], of_parent.withField("relabeled_from", F.col("headword"))).otherwise(of_parent)
    fields = {f.name: f.dataType.simpleString() for f in DataType.fromDDL(schemas.PROVENANCE).fields}
    fresh = {"split_from": F.col("headword"), "source": F.lit(SPLIT_SOURCE)}
    of_child = F.struct(*[fresh.get(n, empty).cast(t).alias(n) for n, t in fields.items()])
    made = {
        "sub": part["part"],
        "body_text": body,
        "body_html": F.when(cut, X.paragraphs(body)).otherwise(F.col("body_html")),
        "char_count": F.when(cut, F.length(body)).otherwise(F.col("char_count")),
        "headword": name,
        "base_headword": F.when(new_name, part["name"]).otherwise(F.col("base_headword")),
        "qualifier": F.when(~child, F.col("qualifier")),
        "type": F.when(child, "article").otherwise(F.col("type")),
        "detected_by": F.when(new_name, SPLIT_BY).otherwise(F.col("detected_by")),
        "is_cross_reference": F.when(new_name, X.is_redirect(part["name"], body)).otherwise(F.col("is_cross_reference")),
        "cross_refs": F.when(new_name, F.slice(X.cross_references(body), 1, 50)).otherwise(F.col("cross_refs")),
        "provenance": F.when(child, of_child).when(cut, of_parent).otherwise(note),
    }
    return rows.withColumns(made).drop("_pieces", "_p", "_cut")
