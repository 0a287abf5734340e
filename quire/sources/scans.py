"""Scans of manifests, pages and records, each bound to a schema."""

from __future__ import annotations

from xml.etree import ElementTree

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire import schemas
from quire.functions import text as X
from quire.operators.repairs import last_good


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """(identifier, title) of a CSV without a header; a byte order mark is dropped."""
    return spark.read.schema("identifier string, title string").csv(path, header=False, quote='"', escape='"')


def strict_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, text): the lines of text files with their numbers from 0 in their file, blank ones counted.

    A long file is read by many tasks. Within a split lines are numbered as they are read, and the counts of the splits
    before it, one row a split, are added: two passes over the files, and no line is shuffled. Lines end at \\n alone.
    """
    rows = spark.read.option("lineSep", "\n").text(path)
    rows = rows.select(F.input_file_name().alias("file"), F.col("_metadata.file_block_start").alias("_from"), F.monotonically_increasing_id().alias("_seq"), F.col("value").alias("text"))
    splits = rows.groupBy("file", "_from").agg(F.count("*").alias("_n"), F.min("_seq").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("file").orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.select("file", "_from", (before - F.col("_first")).alias("_shift"))
    return rows.join(splits, ["file", "_from"]).select("file", (F.col("_seq") + F.col("_shift")).cast("int").alias("line"), "text")


def tolerant_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows that parse, with the file and line (from 0) they stand at; blank and broken lines count as lines."""
    lines = numbered_lines(spark, path).where("trim(text) <> ''")
    parsed = lines.withColumn("r", F.from_json("text", f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    return parsed.where("r is not null and r._corrupt_record is null").select("file", "line", "r.*").drop("_corrupt_record")


def finished_pages(lines: DataFrame) -> DataFrame:
    """The last good row of each image."""
    return last_good(lines, ["file", "image"], "line", ~F.coalesce(F.col("error"), F.lit(False)))


def pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages in the order of their lines; ``identifier`` is the folder of the file."""
    lines = tolerant_jsonl(spark, path, schemas.PAGE_LINE)
    return lines.withColumn("identifier", F.regexp_extract("file", "([^/]+)/[^/]+$", 1)).withColumnRenamed("line", "idx").drop("file")


def volume_metadata(spark: SparkSession, glob: str) -> DataFrame:
    return spark.read.schema(f"{schemas.VOLUMES}, n_pages bigint, n_ocr_ok bigint, failed_pages array<string>, total_tokens bigint, elapsed_s double, page_image_order array<string>").json(glob, multiLine=True)


def array_or_object(c, key: str, element: str):
    """The array of a JSON text that is either an object with it under ``key``, or the array itself."""
    return F.coalesce(F.from_json(c, f"struct<{key}:array<{element}>>")[key], F.from_json(c, f"array<{element}>"))


_METS = "date_issued string, rights string, mets_error string, pages array<struct<order:int,image:string>>"


def _read_mets(xml: bytes | None) -> dict:
    """Facts and pages of one METS document, by the names of its elements without their prefixes."""
    out = {"date_issued": None, "rights": None, "mets_error": None, "pages": []}
    try:
        root = ElementTree.fromstring(xml or b"")
    except ElementTree.ParseError as e:
        return {**out, "mets_error": str(e)}
    images: dict[str, str] = {}
    places: list[tuple[int, str]] = []
    for el in root.iter():
        name, told = el.tag.rsplit("}", 1)[-1], " ".join("".join(el.itertext()).split())
        if name == "file":
            for link in el:
                href = next((v for k, v in link.attrib.items() if k.rsplit("}", 1)[-1] == "href"), "")
                if href.startswith("file://") and "image/" in href:
                    images[el.get("ID", "")] = href.rsplit("/", 1)[-1]
        elif name == "div" and (order := el.get("ORDER", "")).strip().isdecimal():
            places += [(int(order), f.get("FILEID", "")) for f in el if f.tag.rsplit("}", 1)[-1] == "fptr"]
        elif name == "dateIssued":
            out["date_issued"] = out["date_issued"] or told or None
        elif name == "accessCondition":
            out["rights"] = out["rights"] or told or None
    return {**out, "pages": [{"order": o, "image": images[f]} for o, f in sorted(places) if f in images]}


def mets(spark: SparkSession, path: str) -> DataFrame:
    """(identifier, file, date_issued, rights, n_pages_mets, pages, mets_error) of METS files, one row a file.

    A file that isn't well formed has its parser's message in mets_error, and no facts or pages; comments, CDATA and
    nested divisions are read as XML has them. Pages (order, image) are those of the structure map that point to images;
    a division whose order is no number is none. Files without a byte give no row. The files are small and are read whole, each by one task.
    """
    read = F.pandas_udf(lambda xml: pd.DataFrame([_read_mets(x) for x in xml]), f"struct<{', '.join(f.replace(' ', ':', 1) for f in _METS.split(', '))}>")
    files = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", "([^/]+?)(?:-mets)?[.]xml$", 1).alias("identifier"), F.col("path").alias("file"), read("content").alias("m"))
    files = files.select("identifier", "file", "m.*")
    return files.withColumn("n_pages_mets", F.when(F.col("mets_error").isNull(), F.size("pages")).cast("bigint"))


def mets_pages(spark: SparkSession, path: str) -> DataFrame:
    """(file, order, image) of METS files: the pages of their structure maps with the images' names.

    A page that points to no image is left out; a file that isn't well formed gives no rows (mets_facts names it).
    """
    return mets(spark, path).select("file", F.explode("pages").alias("p")).select("file", "p.order", "p.image").orderBy("file", "order", "image")


def mets_facts(spark: SparkSession, path: str) -> DataFrame:
    """(identifier, date_issued, rights, n_pages_mets, mets_error) of METS files, as ``manifest`` takes them."""
    return mets(spark, path).select("identifier", "date_issued", "rights", "n_pages_mets", "mets_error")


def image_counts(spark: SparkSession, glob: str) -> DataFrame:
    """(identifier, n_images) of folders of page images; only names are read. A folder that is missing counts nothing."""
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.jpg").option("recursiveFileLookup", "true")
    try:
        files = names.load(glob).select("path")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        files = spark.createDataFrame([], "path string")
    return files.groupBy(F.regexp_extract("path", "([^/]+)/(?:image/)?[^/]+$", 1).alias("identifier")).agg(F.count("*").alias("n_images"))


def images(spark: SparkSession, glob: str) -> DataFrame:
    """(identifier, image, content, size) of page images; the bytes are read only where they are asked for."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.jpg").option("recursiveFileLookup", "true").load(glob)
    return rows.select(F.regexp_extract("path", "([^/]+)/(?:image/)?[^/]+$", 1).alias("identifier"), F.regexp_extract("path", "([^/]+)$", 1).alias("image"), "content", F.col("length").alias("size"))


def page_order(images: DataFrame, mets: DataFrame | None = None) -> DataFrame:
    """(identifier, ord, image): the order of METS, then of the names; without METS that of the numbers in the names."""
    number = F.try_to_number(F.regexp_extract("image", r"^([0-9]+)", 1), F.lit("9" * 18)).cast("bigint")
    if mets is None:
        order = [number.asc_nulls_last(), F.col("image")]
        return images.select("identifier", "image", F.row_number().over(Window.partitionBy("identifier").orderBy(*order)).alias("ord"))
    return mets.select("identifier", "image", F.row_number().over(Window.partitionBy("identifier").orderBy("order", "image")).alias("ord"))


def manifest(spark: SparkSession, inventory_path: str, counts: DataFrame | None = None, mets: DataFrame | None = None) -> DataFrame:
    """Volumes: what their titles say, with image counts and METS facts where known, in order of code and volume.

    ``mets`` has identifier and any of n_pages_mets, date_issued, rights, mets_error. Unknown counts don't match.
    """
    rows = inventory(spark, inventory_path).select(F.trim("identifier").alias("identifier"), X.title_fields(F.trim("title")).alias("f")).select("identifier", "f.*")
    rows = rows.join(counts, "identifier", "left") if counts is not None else rows.withColumn("n_images", F.lit(None).cast("bigint"))
    if mets is not None:
        rows = rows.join(mets, "identifier", "left")
    for name, kind in (("n_pages_mets", "bigint"), ("date_issued", "string"), ("rights", "string"), ("mets_error", "string")):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    rows = rows.withColumn("n_images", F.coalesce("n_images", F.lit(0))).withColumn("pages_match", F.coalesce(F.col("n_images") == F.col("n_pages_mets"), F.lit(False)))
    return rows.orderBy(edition_number(), F.coalesce("volume_num", F.lit(0)), "identifier")


def edition_number() -> Column:
    """Number of the column eb_code; 999 where it has none."""
    return F.coalesce(F.try_to_number(F.split("eb_code", "[.]").getItem(1), F.lit("9999")).cast("int"), F.lit(999))


def manifest_summary(volumes: DataFrame) -> DataFrame:
    """(eb_code, edition_label, n_volumes, n_pages, mismatches) and the total over all, whose codes are null and level 3."""
    mismatch = F.array_sort(F.collect_list(F.when(~F.col("pages_match"), F.col("identifier"))))
    return volumes.groupingSets([[F.col("eb_code"), F.col("edition_label")], []], "eb_code", "edition_label").agg(F.grouping_id().alias("level"), F.count("*").alias("n_volumes"), F.sum("n_images").alias("n_pages"), mismatch.alias("mismatches"))


def volume(volumes: DataFrame, identifier: str) -> DataFrame:
    """The first volume of an identifier, one row; a ValueError where there is none."""
    found = volumes.where(F.col("identifier") == identifier).limit(1)
    if found.isEmpty():
        raise ValueError(f"no volume {identifier!r} in the manifest")
    return found


def edition_records(spark: SparkSession, root: str, schema: str, editions: list[str] | None = None) -> DataFrame:
    """Records below ``root``, a folder eb_code=<edition> for each edition: only those of ``editions`` are read.

    Whole codes are compared, so EB.1 is not EB.10.
    """
    rows = spark.read.schema(f"{schema}, eb_code string").json(root)
    return rows if editions is None else rows.where(F.col("eb_code").isin(editions))


def archived_fixes(archived: DataFrame) -> DataFrame:
    """(edition, old, new, n_editions, edit_distance): corrections that an earlier snapshot's records tell of."""
    fix = F.col("provenance.headword_correction")
    return archived.where(fix.isNotNull()).select("edition", fix["from"].alias("old"), fix["to"].alias("new"), fix["n_editions"].alias("n_editions"), fix["edit_distance"].alias("edit_distance")).distinct()


def snapshot(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """Records as of a named snapshot, one folder each below ``root``."""
    return spark.read.schema(schema).json(f"{root}/snapshot={name}")


def ids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("identifier")).where("identifier <> ''")
