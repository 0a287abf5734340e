"""Resumable work: new page files are taken up once each, and what is done is never done again."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import schemas
from quire.operators.reports import assembled
from quire.sources import sinks

#: What tells a page, and what a model answers about one.
PAGE = ["identifier", "image"]
ORDER = "identifier string, image string, ord int"


def page_stream(spark: SparkSession, path: str) -> DataFrame:
    """Page lines of JSONL files as they arrive; broken lines are passed over."""
    lines = spark.readStream.schema("value string").text(path).where("trim(value) <> ''")
    parsed = lines.select(F.from_json("value", schemas.PAGE_LINE).alias("r")).select("r.*")
    return parsed.where("image is not null and not coalesce(error, false)")


def ingest(stream: DataFrame, out: str, checkpoint: str) -> None:
    """All that has arrived since the last call is appended to ``out``; a failed call is taken up where it stopped."""
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def todo(wanted: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    return wanted.join(done, key, "left_anti")


def processed(wanted: DataFrame, model: Callable[[DataFrame], DataFrame], key: list[str], retries: int = 1) -> DataFrame:
    """Rows of ``wanted`` as ``model`` answers them; those that failed are asked again ``retries`` times.

    ``model`` takes and returns a DataFrame (a mapInPandas over an external reader, or a join to a table of
    ready answers) and marks failures in a column ``error``.
    """
    out = model(wanted)
    for _ in range(retries):
        bad = out.where("error")
        out = out.where("not error").unionByName(model(wanted.join(bad.select(*key), key, "left_semi")))
    return out


# The life of volumes. Below ``root`` stand tables: order (the pages of volumes, a folder for each batch), answers (all
# that a model has said, good or bad, never changed), states and texts (a folder for each batch; a volume's last counts).


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``; one without rows where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def answers(spark: SparkSession, root: str) -> DataFrame:
    return _stored(spark, f"{root}/answers", schemas.ANSWERS)


def good(told: DataFrame) -> DataFrame:
    """One good answer for each page that has any; of several the least in order of their text."""
    sound = told.where(~F.coalesce("error", F.lit(False)) & F.col("image").isNotNull() & F.col("identifier").isNotNull())
    others = [c for c in told.columns if c not in PAGE]
    return sound.groupBy(*PAGE).agg(F.min(F.struct(*sorted(others))).alias("_a")).select(*PAGE, *[F.col("_a")[c].alias(c) for c in others])


def attempted(wanted: DataFrame, model: Callable[[DataFrame], DataFrame], root: str, retries: int = 1) -> None:
    """Pages of ``wanted`` that have no good answer yet are asked of ``model``; those that fail are asked again.

    Every round is written before the next one begins, so the model sees a page once a round, and a run that was
    killed goes on behind its last round. Repeated pages of ``wanted`` are asked once.
    """
    spark, pages = wanted.sparkSession, _pages(wanted)
    for _ in range(retries + 1):
        left = todo(pages, good(answers(spark, root)).select(*PAGE), PAGE)
        if left.isEmpty():
            return
        sinks.appended(model(left).select(*spark.createDataFrame([], schemas.ANSWERS).columns), f"{root}/answers")


def _pages(order: DataFrame) -> DataFrame:
    """Every page once, at the first place that it has."""
    return order.groupBy(*PAGE).agg(F.min("ord").alias("ord"))


def volume_states(order: DataFrame, told: DataFrame) -> DataFrame:
    """(identifier, n_pages, n_ocr_ok, failed_pages, total_tokens, complete) of the volumes of ``order`` (identifier,
    image, ord): pages without a good answer have failed, named in their order. Answers about other pages do not count."""
    pages = _pages(order).join(good(told).select(*PAGE, "token_count", F.lit(True).alias("_good")), PAGE, "left")
    missing = F.array_sort(F.collect_list(F.when(F.col("_good").isNull(), F.struct("ord", "image"))))
    out = pages.groupBy("identifier").agg(F.count("*").alias("n_pages"), F.count("_good").alias("n_ocr_ok"), missing.alias("_missing"), F.coalesce(F.sum("token_count"), F.lit(0)).alias("total_tokens"))
    return out.select("identifier", "n_pages", "n_ocr_ok", F.transform("_missing", lambda m: m["image"]).alias("failed_pages"), "total_tokens", (F.size("_missing") == 0).alias("complete"))


def volume_texts(order: DataFrame, told: DataFrame) -> DataFrame:
    """(identifier, text): the pages of each volume in order, under their places, with a mark where one has failed."""
    pages = _pages(order).join(good(told).select(*PAGE, "markdown", F.lit(True).alias("_good")), PAGE, "left")
    # How a merged text marks its pages and those that failed.
    text = F.concat(F.lit("<!-- page "), F.col("ord").cast("string"), F.lit(" | image "), F.col("image"), F.lit(" -->\n\n"), F.coalesce(F.regexp_replace("markdown", r"^\s+|\s+$", ""), F.when(F.col("_good"), F.lit("")).otherwise(F.lit("[OCR FAILED]"))), F.lit("\n\n"))
    return assembled(pages, ["identifier"], "ord", text, "")


def closed(spark: SparkSession, root: str, batch: str, started: float, volumes: DataFrame, mode: str = "overwrite") -> None:
    """The states and texts of ``volumes`` (identifier) as their pages stand now, as those of ``batch``.

    States come last, and a text counts by its state, so what an interrupted run has left is never read.
    """
    own = volumes.select("identifier").distinct()
    order = _stored(spark, f"{root}/order", ORDER).join(own, "identifier", "left_semi")
    told = answers(spark, root).join(own, "identifier", "left_semi")
    volume_texts(order, told).write.mode(mode).parquet(f"{root}/texts/batch={batch}")
    elapsed = F.lit(round(time.time() - started, 1))
    volume_states(order, told).withColumns({"elapsed_s": elapsed, "closed_at": F.lit(time.time())}).write.mode(mode).parquet(f"{root}/states/batch={batch}")


def last_states(spark: SparkSession, root: str) -> DataFrame:
    """The state of each volume as it was closed last, with the ``batch`` that closed it."""
    rows = _stored(spark, f"{root}/states", f"{schemas.STATES}, batch string")
    return rows.join(rows.groupBy("identifier").agg(F.max_by("batch", "closed_at").alias("batch")), ["identifier", "batch"])


def last_texts(spark: SparkSession, root: str) -> DataFrame:
    """(identifier, batch, text): the text of each volume as it was closed last."""
    texts = _stored(spark, f"{root}/texts", "identifier string, text string, batch string")
    return texts.join(last_states(spark, root).select("identifier", "batch"), ["identifier", "batch"])


def run_volumes(order: DataFrame, model: Callable[[DataFrame], DataFrame], root: str, checkpoint: str, retries: int = 1) -> None:
    """Volumes as they arrive (a stream of identifier, image, ord): pages asked of ``model``, failed ones again, texts merged, states written.

    A batch that was interrupted comes again under its number: its order is written over, pages that have a
    good answer are left out, and its states and texts are written over, so every page is answered well once and
    counted once. Pages may come in several batches; a volume's state covers all that have come.
    """

    def batch(rows: DataFrame, number: int) -> None:
        spark, started = rows.sparkSession, time.time()
        own = f"{root}/order/batch={number}"
        rows.select("identifier", "image", F.col("ord").cast("int").alias("ord")).write.mode("overwrite").parquet(own)
        wanted = spark.read.schema(ORDER).parquet(own)
        attempted(wanted, model, root, retries)
        closed(spark, root, str(number), started, wanted)

    order.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def caught_up(spark: SparkSession, model: Callable[[DataFrame], DataFrame], root: str, name: str, retries: int = 1) -> DataFrame:
    """Volumes that are not complete are taken up once more; returns the states after it.

    ``name`` stands for this run beside the numbers of batches and is used once (a second use is an error).
    """
    started = time.time()
    open_ = last_states(spark, root).where("not complete").select("identifier")
    order = _stored(spark, f"{root}/order", ORDER).join(open_, "identifier", "left_semi")
    attempted(order, model, root, retries)
    closed(spark, root, name, started, open_, "error")
    return last_states(spark, root)
