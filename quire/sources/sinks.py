"""Sinks: manifests, record files, chunks, batches, snapshots, views. No sink writes the path it reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators.reports import assembled
from quire.operators.sequences import chunked
from quire.operators.vocabulary import ordinal
from quire.sources import scans


def csv_manifest(rows: DataFrame, path: str, columns: list[str]) -> None:
    rows.select(*columns).write.mode("overwrite").csv(path, header=True)


def jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def edition_records(rows: DataFrame, root: str) -> None:
    """Records in a folder for each edition, which scans.edition_records reads one by one."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").partitionBy("eb_code").json(root)


def differs(rows: DataFrame, earlier: DataFrame) -> bool:
    """Whether the rows aren't the same, repeated ones included."""
    columns = sorted(rows.columns)
    if columns != sorted(earlier.columns):
        return True
    a, b = rows.select(*columns), earlier.select(*columns)
    return not (a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty())


def changed_snapshot(rows: DataFrame, earlier: DataFrame, root: str, name: str, dry_run: bool = False) -> bool:
    """A new snapshot, if the rows aren't those of the earlier one; returns whether they differ. A dry run only tells."""
    changed = differs(rows, earlier)
    if changed and not dry_run:
        snapshot(rows, root, name)
    return changed


def snapshot(rows: DataFrame, root: str, name: str) -> None:
    """A new snapshot; one that is there already is an error."""
    rows.write.mode("error").option("ignoreNullFields", "false").json(f"{root}/snapshot={name}")


def chunks(rows: DataFrame, path: str, chunk: str, value: str) -> None:
    """Text files of ids, a folder for each chunk; those of an earlier run go."""
    rows.select(chunk, F.col(value).cast("string").alias("value")).write.mode("overwrite").partitionBy(chunk).text(path)


def planned(volumes: DataFrame, size: int = 3, codes: list[str] | None = None) -> DataFrame:
    """The manifest's volumes, only those of editions ``codes`` where given, with ``chunk`` from 0: ``size`` volumes each in
    the manifest's order. They are numbered edition by edition."""
    kept = volumes if codes is None else volumes.where(F.col("eb_code").isin(codes))
    kept = kept.withColumn("_edition", scans.edition_number()).withColumn("_volume", F.coalesce("volume_num", F.lit(0)))
    return chunked(ordinal(kept, "_edition", ["_volume", "identifier"], "_at"), "_at", size).drop("_edition", "_volume", "_at")


def plan_report(plan: DataFrame) -> DataFrame:
    """(chunk, n_volumes, n_pages, codes) of planned volumes; an unknown code shows as a question mark."""
    codes = F.array_join(F.array_sort(F.collect_set(F.coalesce("eb_code", F.lit("?")))), ",")
    return plan.groupBy("chunk").agg(F.count("*").alias("n_volumes"), F.coalesce(F.sum("n_images"), F.lit(0)).cast("bigint").alias("n_pages"), codes.alias("codes"))


def batches(rows: DataFrame, path: str, batch: str) -> None:
    rows.write.mode("overwrite").partitionBy(batch).json(path)


def appended(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def merged_pages(order: DataFrame, done: DataFrame, path: str) -> None:
    """One text a volume: its pages in order, with a mark where one is missing."""
    rows = order.join(done.select("identifier", "image", "markdown"), ["identifier", "image"], "left")
    text = F.concat(F.lit("<!-- "), F.col("image"), F.lit(" -->\n"), F.coalesce("markdown", F.lit("[OCR FAILED]")))
    assembled(rows, ["identifier"], "ord", text, "\n\n").write.mode("overwrite").partitionBy("identifier").text(path)


def incomplete(order: DataFrame, done: DataFrame) -> DataFrame:
    """Pages without a result; a volume is complete when it has none."""
    return order.join(done, ["identifier", "image"], "left_anti")


def run_summary(pages: DataFrame, started: float, ended: float) -> DataFrame:
    """(identifier, n_pages, n_ocr_ok, failed_pages, total_tokens, elapsed_s) of processed pages; null tokens count as none."""
    bad = F.coalesce("error", F.lit(False))
    failed = F.array_sort(F.collect_list(F.when(bad, F.col("image"))))
    return pages.groupBy("identifier").agg(
        F.count("*").alias("n_pages"), F.count_if(~bad).alias("n_ocr_ok"), failed.alias("failed_pages"), F.coalesce(F.sum("token_count"), F.lit(0)).alias("total_tokens"), F.lit(round(ended - started, 1)).alias("elapsed_s")
    )


def summaries(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def completeness(order: DataFrame, done: DataFrame) -> DataFrame:
    """(identifier, n_pages, n_missing, complete) of every volume of ``order``."""
    marked = order.join(done.select("identifier", "image").distinct().withColumn("_done", F.lit(True)), ["identifier", "image"], "left")
    out = marked.groupBy("identifier").agg(F.count("*").alias("n_pages"), F.count_if(F.col("_done").isNull()).alias("n_missing"))
    return out.withColumn("complete", F.col("n_missing") == 0)


def marked_complete(order: DataFrame, done: DataFrame, path: str) -> list[str]:
    """Volumes that are complete get a row in the table at ``path``; returns those that aren't, whose run has failed."""
    told = completeness(order, done)
    told.where("complete").select("identifier", "n_pages").write.mode("overwrite").parquet(path)
    return [r.identifier for r in told.where("not complete").select("identifier").orderBy("identifier").collect()]


def volume_pages(pages: DataFrame) -> DataFrame:
    """(identifier, html) of self-contained pages: the layout HTML in order, images as their descriptions."""
    body = F.concat(F.lit("<section>"), X.images_named(F.coalesce("raw", F.lit(""))), F.lit("</section>"))
    out = assembled(pages, ["identifier"], "idx", body)
    return out.select("identifier", F.concat(F.lit("<!DOCTYPE html><html><head><meta charset=\"utf-8\"><title>"), X.escaped(F.col("identifier")), F.lit("</title></head><body>"), "text", F.lit("</body></html>")).alias("html"))


def flat_names(volumes: DataFrame) -> DataFrame:
    """(identifier, name): the file names of volumes; two of one name are an error, raised when the rows are made."""
    named = volumes.select("identifier", X.file_name(F.col("eb_code"), F.col("edition_num"), F.col("is_supplement"), F.col("volume_num"), F.col("alpha_range"), F.col("volume_label"), F.col("identifier")).alias("name"))
    counts = named.groupBy("name").agg(F.count("*").alias("n"))
    checked = named.join(counts, "name").withColumn("name", F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("two volumes are named "), "name"))).otherwise(F.col("name")))
    return checked.select("identifier", "name")


def named_copies(volumes: DataFrame, html: DataFrame, path: str) -> DataFrame:
    """The volumes' pages below their flat names, and index.csv beside them: returns its rows (name, identifier, title)."""
    named = flat_names(volumes).join(volumes.select("identifier", "title"), "identifier")
    index = named.select("name", "identifier", "title").orderBy("name")
    named.join(html, "identifier").select("name", "html").write.mode("overwrite").partitionBy("name").text(f"{path}/pages")
    index.coalesce(1).write.mode("overwrite").csv(f"{path}/index", header=True)
    return index


def review_pages(records: DataFrame, pages: int = 200) -> DataFrame:
    """(edition, page, html): records with their problems as tables for reviewers, ``pages`` records a page.

    ``records`` has edition, ord (the place in its edition, from 0), headword, body_text and problems.
    """
    row = F.concat(F.lit("<tr><td>"), X.escaped(F.coalesce("headword", F.lit(""))), F.lit("</td><td>"), X.escaped(F.array_join("problems", ", ")), F.lit("</td><td>"), X.escaped(F.left(F.coalesce("body_text", F.lit("")), F.lit(400))), F.lit("</td></tr>"))
    rows = records.withColumn("page", F.floor(F.col("ord") / pages))
    body = assembled(rows, ["edition", "page"], "ord", row)
    return body.select("edition", "page", F.concat(F.lit("<!DOCTYPE html><html><head><meta charset=\"utf-8\"><title>"), X.escaped(F.col("edition")), F.lit("</title></head><body><table>"), "text", F.lit("</table></body></html>")).alias("html"))


def review_index(records: DataFrame, pages: int = 200) -> DataFrame:
    """(edition, n_records, n_problems, n_pages) for the page that leads to the review pages."""
    return records.groupBy("edition").agg(F.count("*").alias("n_records"), F.count_if(F.size("problems") > 0).alias("n_problems"), (F.floor((F.count("*") - 1) / pages) + 1).alias("n_pages"))
