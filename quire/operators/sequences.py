"""Ordered streams: segments, runs, spans, forward fills, boundaries, chunks. Each needs a partition and a
total order, and becomes a window or a fold over a sorted array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _over(part: list[str], order: list[str]):
    return Window.partitionBy(*part).orderBy(*order)


def segments(rows: DataFrame, part: list[str], order: list[str], opens: Column) -> DataFrame:
    """``rows`` from the first that opens a segment on, with ``segment`` numbered from 1."""
    number = F.sum(opens.cast("int")).over(_over(part, order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("segment", number.cast("bigint")).where("segment > 0")


def runs(rows: DataFrame, part: list[str], order: list[str], missing: Column, least: int = 2) -> DataFrame:
    """(part, start, end, length) of runs of ``least`` rows or more where ``missing`` holds; places from 0."""
    w = _over(part, order)
    placed = rows.withColumn("_at", F.row_number().over(w) - 1).withColumn("_missing", missing)
    island = F.sum((~F.col("_missing")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    out = placed.withColumn("_island", island).where("_missing").groupBy(*part, "_island").agg(F.min("_at").cast("bigint").alias("start"), F.max("_at").cast("bigint").alias("end"))
    return out.withColumn("length", F.col("end") - F.col("start") + 1).where(F.col("length") >= least).drop("_island")


def most_frequent(rows: DataFrame, part: list[str], value: str, order: str) -> DataFrame:
    """(part, value): the value that most rows have; ties go to the one seen first."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(*part, value).agg(F.count("*").alias("_n"), F.min(order).alias("_first"))
    return counted.groupBy(*part).agg(F.max_by(value, F.struct("_n", -F.col("_first"))).alias(value))


def merged_spans(spans: DataFrame, part: list[str], name: str, gap: int = 3) -> DataFrame:
    """Spans (start, end) of one name that follow each other within ``gap`` as one."""
    w = _over(part, ["start", "end"])
    follows = F.lag(name).over(w).eqNullSafe(F.col(name)) & (F.col("start") - F.lag("end").over(w) <= gap)
    group = F.sum(F.coalesce(~follows, F.lit(True)).cast("int")).over(w)
    marked = spans.withColumn("_group", group)
    return marked.groupBy(*part, "_group", name).agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_spans")).drop("_group")


def without_repeats(rows: DataFrame, part: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Rows that differ from the one before in one of ``values``; null equals null."""
    w = _over(part, order)
    first = F.row_number().over(w) == 1
    same = F.lit(True)
    for v in values:
        same &= F.lag(v).over(w).eqNullSafe(F.col(v))
    return rows.withColumn("_stay", first | ~same).where("_stay").drop("_stay")


def without_stubs(rows: DataFrame, part: list[str], order: list[str], value: str, short: Column, exempt: Column | None = None) -> DataFrame:
    """Rows but those that are ``short`` and repeated by the next row (unless that one is exempt)."""
    w = _over(part, order)
    again = F.lead(value).over(w).eqNullSafe(F.col(value)) & F.lead(F.lit(1)).over(w).isNotNull()
    if exempt is not None:
        again &= ~F.coalesce(F.lead(exempt).over(w), F.lit(False))
    return rows.withColumn("_stub", short & again).where("not _stub").drop("_stub")


def rising(rows: DataFrame, part: list[str], order: list[str], rank: str) -> DataFrame:
    """Rows whose rank is higher than all before."""
    top = F.max(rank).over(_over(part, order).rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("_top", top).where(F.col(rank).isNotNull() & (F.col("_top").isNull() | (F.col(rank) > F.col("_top")))).drop("_top")


def opening(rows: DataFrame, part: list[str], order: list[str], value: str) -> DataFrame:
    """(part, opening): the first value that one of the next three reaches or that nothing follows, else the first."""
    w = _over(part, order)
    after = [F.lead(value, k).over(w) for k in (1, 2, 3)]
    sound = after[0].isNull()
    for a in after:
        sound |= F.coalesce(a >= F.col(value), F.lit(False))
    placed = rows.where(F.col(value).isNotNull()).withColumn("_at", F.row_number().over(w)).withColumn("_sound", sound)
    return placed.groupBy(*part).agg(F.coalesce(F.min_by(value, F.when(F.col("_sound"), F.col("_at"))), F.min_by(value, "_at")).alias("opening"))


def filled(rows: DataFrame, part: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """``rows`` with the last value so far that isn't null."""
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(_over(part, order).rowsBetween(Window.unboundedPreceding, 0)))


def spaced_points(points: Column, least: int = 40) -> Column:
    """Of a sorted array of offsets those that lie ``least`` or more after the last one kept: a fold, since
    what stays depends on what stayed."""
    start = F.array().cast("array<bigint>")
    step = lambda kept, p: F.when((F.size(kept) == 0) | (p - F.element_at(kept, -1) >= least), F.concat(kept, F.array(p))).otherwise(kept)
    return F.aggregate(points, start, step)


def chunked(rows: DataFrame, ordinal: str, size: int) -> DataFrame:
    """``rows`` with ``chunk`` from 0, ``size`` rows each in the order of ``ordinal`` (from 1)."""
    return rows.withColumn("chunk", F.floor((F.col(ordinal) - 1) / size).cast("bigint"))
