"""Quality flags, summaries and views of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as X


def problems(headword: Column, body: Column, kind: Column, redirect: Column, first: Column, last: Column, size: Column) -> Column:
    """Array of what looks wrong with a record. Page 0 counts as unknown."""
    b, h = F.trim(F.coalesce(body, F.lit(""))), F.trim(F.coalesce(headword, F.lit("")))
    treatise = F.coalesce(kind, F.lit("")) == "treatise"
    known = (F.coalesce(first, F.lit(0)) != 0) & (F.coalesce(last, F.lit(0)) != 0)
    empty = F.rtrim(b, F.lit(".,")) == F.rtrim(h, F.lit(".,"))
    return F.array_compact(
        F.array(
            F.when(empty, "empty-body").when((X.word_count(b) <= 4) & ~F.coalesce(redirect, F.lit(False)) & ~treatise, "fragment"),
            F.when(known & (last < first), "page-end<start"),
            F.when(known & ~treatise & (last - first > 30), "page-span-large"),
            F.when(~treatise & (F.coalesce(size, F.lit(0)) > 25000), "long-maybe-bleed"),
        )
    )


def totals(rows: DataFrame, keys: list[str], **sums: Column) -> DataFrame:
    """Aggregates by ``keys`` and over all, in one pass; the total's keys are null."""
    return rows.groupingSets([[F.col(k) for k in keys], []], *keys).agg(*[c.alias(n) for n, c in sums.items()])


#: Fixed value: characters of a treatise's body that the viewer shows.
TREATISE_SHOWN = 12_000


def viewer_rows(records: DataFrame) -> DataFrame:
    """Article records under the viewer's short names, with their flags; other columns go.

    Bodies of treatises are cut to TREATISE_SHOWN characters and say so, as the records keep them whole. The text is
    searched as it is shown.
    """
    body = F.coalesce("body_text", F.lit(""))
    note = F.concat(F.lit(" …[treatise body truncated in viewer — full "), F.coalesce(F.col("char_count").cast("string"), F.lit("None")), F.lit(" chars in JSONL]"))
    long = F.col("type").eqNullSafe("treatise") & (F.length(body) > TREATISE_SHOWN)
    redirect = F.coalesce("is_cross_reference", F.lit(False))
    return records.select(
        "headword", F.col("base_headword").alias("base"), "qualifier", "type", F.col("detected_by").alias("by"), redirect.alias("xref"),
        F.col("printed_page_start").alias("ps"), F.col("printed_page_end").alias("pe"), F.col("image_page_start").alias("is"), F.col("image_page_end").alias("ie"),
        F.col("char_count").alias("cc"), F.coalesce("cross_refs", F.array().cast("array<string>")).alias("refs"), F.coalesce(F.array_size("outline"), F.lit(0)).alias("outline"),
        F.col("provenance.headword_image").alias("img"), F.when(long, F.concat(F.left(body, F.lit(TREATISE_SHOWN)), note)).otherwise(body).alias("body"),
        problems(F.col("headword"), F.col("body_text"), F.col("type"), redirect, F.col("printed_page_start"), F.col("printed_page_end"), F.col("char_count")).alias("flags"),
    )


def viewed(rows: DataFrame, headword: str, body: str, kinds: list[str] | None = None, kind: str | None = None, text: str = "", redirect: str | None = None, flags: str | None = None) -> DataFrame:
    """Rows of the given kinds whose headword or body holds ``text``, whatever its case.

    With ``redirect`` (a column of booleans) references go; with ``flags`` (of arrays) rows without any go.
    """
    if kinds is not None:
        rows = rows.where(F.col(kind).isin(kinds))
    if redirect is not None:
        rows = rows.where(~F.coalesce(F.col(redirect), F.lit(False)))
    if flags is not None:
        rows = rows.where(F.size(F.coalesce(F.col(flags), F.array().cast("array<string>"))) > 0)
    wanted = F.lit(text.strip().lower())
    return rows.where(F.contains(F.lower(F.coalesce(F.col(headword), F.lit(""))), wanted) | F.contains(F.lower(F.coalesce(F.col(body), F.lit(""))), wanted))


def assembled(rows: DataFrame, part: list[str], order: str, text: Column, glue: str = "\n") -> DataFrame:
    """(part, text): the texts of a part joined in order. A part is one row, so it should be a volume at most."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), text.alias("t"))))
    return rows.groupBy(*part).agg(F.array_join(F.transform(listed, lambda x: x["t"]), glue).alias("text"))
