"""Idempotent, reversible repairs: fixes by key, first and last decisions, splits, progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as X


def first_wins(rows: DataFrame, keys: list[str], order: list[str], done: DataFrame | None = None) -> DataFrame:
    """The first row of each key, without keys that are in ``done`` already."""
    if done is not None:
        rows = rows.join(done.select(*keys).distinct(), keys, "left_anti")
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def last_good(rows: DataFrame, keys: list[str], order: str, good: Column) -> DataFrame:
    """The last good row of each key, by one aggregate that combines before the shuffle."""
    cols = [c for c in rows.columns if c not in keys]
    best = rows.where(good).groupBy(*keys).agg(F.max_by(F.struct(*cols), order).alias("_row"))
    return best.select(*keys, "_row.*")


def decided(candidates: DataFrame, decisions: DataFrame, by: list[str]) -> DataFrame:
    """Valid corrections: decisions to correct whose word is among the candidate's suggestions; the last of a
    repeated decision counts."""
    last = decisions.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("seq")))).where("_n = 1").drop("_n", "seq")
    return candidates.join(last, by).where((F.col("decision") == "correct") & F.exists("suggestions", lambda s: s["norm"] == F.col("canonical")))


def fixed(rows: DataFrame, fixes: DataFrame, on: list[str], value: str) -> DataFrame:
    """``rows`` with ``value`` corrected: the first whole token ``old`` becomes ``new``. What stood there is kept
    in raw_<value>; rows without a fix, and those fixed before, stay as they are."""
    raw = f"raw_{value}"
    if raw not in rows.columns:
        rows = rows.withColumn(raw, F.lit(None).cast("string"))
    out = rows.join(fixes, on, "left")
    todo = F.col("old").isNotNull() & F.col(raw).isNull()
    changed = F.when(todo, X.replaced_once(F.col(value), F.col("old"), F.col("new"))).otherwise(F.col(value))
    return out.withColumns({raw: F.when(todo, F.col(value)).otherwise(F.col(raw)), value: changed}).drop("old", "new")


def reverted(rows: DataFrame, value: str, wrong: DataFrame | None = None, on: list[str] | None = None) -> DataFrame:
    """``rows`` with raw_<value> put back, everywhere or for the keys in ``wrong`` alone."""
    raw = f"raw_{value}"
    if wrong is None:
        return rows.withColumn(value, F.coalesce(raw, value)).withColumn(raw, F.lit(None).cast("string"))
    marked = rows.join(wrong.select(*on).distinct().withColumn("_wrong", F.lit(True)), on, "left")
    back = F.col("_wrong").isNotNull() & F.col(raw).isNotNull()
    return marked.withColumn(value, F.when(back, F.col(raw)).otherwise(F.col(value))).withColumn(raw, F.when(~back, F.col(raw))).drop("_wrong")


def reapplied(rows: DataFrame, archived: DataFrame, wrong: DataFrame, on: list[str], value: str) -> DataFrame:
    """Corrections of an earlier snapshot, but the wrong ones, on new rows."""
    return fixed(rows, archived.join(wrong, ["old", "new"], "left_anti"), on, value)


def split(rows: DataFrame, points: DataFrame, id: str = "id", body: str = "body", small: int = 150, apart: int = 40, least: int = 10) -> DataFrame:
    """Rows cut at the points found in their bodies, children right after their parent.

    ``points`` has id, name and start_text. Points before ``least``, or not found, are left out, and those
    within ``apart`` of the last kept one. A parent whose own part is shorter than ``small`` becomes the first
    child; what it said is kept in ``discarded``. Returns id, part (0: the parent), name (null: the parent's
    own), body, relabelled and discarded. A row without points stays whole.
    """
    found = points.join(rows.select(id, body), id).withColumn("at", X.offset_of(F.col(body), F.col("start_text"))).where(F.col("at") >= least)
    sorted_points = found.groupBy(id).agg(F.array_sort(F.collect_list(F.struct(F.col("at").cast("bigint").alias("at"), "name"))).alias("points"))
    start = F.array().cast("array<struct<at:bigint,name:string>>")
    step = lambda kept, p: F.when((F.size(kept) == 0) | (p["at"] - F.element_at(kept, -1)["at"] >= apart), F.concat(kept, F.array(p))).otherwise(kept)
    cut = rows.select(id, body).join(sorted_points.withColumn("kept", F.aggregate("points", start, step)), id, "left")
    ends = F.transform("kept", lambda p, i: F.struct(p["name"].alias("name"), F.substr(F.col(body), p["at"] + 1, F.coalesce(F.get("kept", i + 1)["at"], F.length(body)) - p["at"]).alias("body")))
    n = F.coalesce(F.size("kept"), F.lit(0))
    own = F.when(n > 0, F.left(body, F.get("kept", F.lit(0))["at"].cast("int"))).otherwise(F.col(body))
    cut = cut.withColumn("own", own).withColumn("children", F.when(n > 0, ends).otherwise(F.array().cast("array<struct<name:string,body:string>>")))
    moved = (n > 0) & (F.length("own") < small)
    head = F.when(moved, F.struct(F.get("children", F.lit(0))["name"].alias("name"), F.get("children", F.lit(0))["body"].alias("body"), F.lit(True).alias("relabelled"), F.col("own").alias("discarded")))
    head = head.otherwise(F.struct(F.lit(None).cast("string").alias("name"), F.col("own").alias("body"), F.lit(False).alias("relabelled"), F.lit(None).cast("string").alias("discarded")))
    rest = F.transform(F.when(moved, F.slice("children", 2, 1_000_000)).otherwise(F.col("children")), lambda c: F.struct(c["name"].alias("name"), c["body"].alias("body"), F.lit(False).alias("relabelled"), F.lit(None).cast("string").alias("discarded")))
    return cut.select(id, F.posexplode(F.concat(F.array(head), rest)).alias("part", "p")).select(id, F.col("part").cast("bigint").alias("part"), "p.*")


def progress(items: DataFrame, done: DataFrame, key: str, batch: str) -> DataFrame:
    """(batch, items, done, complete): a batch is complete when each of its items is decided."""
    marked = items.join(done.select(key).distinct().withColumn("_done", F.lit(1)), key, "left")
    out = marked.groupBy(batch).agg(F.count("*").alias("items"), F.count("_done").alias("done"))
    return out.withColumn("complete", F.col("items") == F.col("done"))


#: Fixed value: how far a printed end page may be from what the images say.
PAGE_TOLERANCE = 50


def page_end(start: Column, end: Column, image_start: Column, image_end: Column) -> Column:
    """A printed end page before its start, or far from what the images say, becomes what they say; where one of the
    four is null nothing is known and it stays."""
    expected = start + (image_end - image_start)
    return F.when(expected.isNotNull() & ((end < start) | (F.abs(end - expected) > PAGE_TOLERANCE)), expected).otherwise(end)
