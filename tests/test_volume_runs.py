"""Volumes from their first page to their state: interrupted, failing and repeated runs; counts of the same pass as the write."""

import pytest
from pyspark.sql import functions as F

from quire.operators import editions as E
from quire.streaming import resume

ORDER = [("v1", "a", 1), ("v1", "b", 2), ("v1", "c", 3), ("v2", "x", 1), ("v2", "y", 2)]


def _arrives(spark, folder, rows):
    spark.createDataFrame(rows, resume.ORDER).coalesce(1).write.mode("append").json(folder)


def _stream(spark, folder):
    return spark.readStream.schema(resume.ORDER).json(folder)


class Model:
    """Answers about all pages but those of ``fails``; ``breaks`` names the call that raises."""

    def __init__(self, fails=(), breaks=None):
        self.fails, self.breaks, self.asked = list(fails), breaks, []

    def __call__(self, rows):
        self.asked.append(sorted(r.image for r in rows.collect()))
        if len(self.asked) == self.breaks:
            raise RuntimeError("the model is gone")
        bad = F.col("image").isin(self.fails) if self.fails else F.lit(False)
        return rows.select("identifier", "image", F.when(~bad, F.concat(F.lit(" text of "), "image", F.lit("\n"))).alias("markdown"), F.lit(None).cast("string").alias("raw"),
            F.lit(10).cast("bigint").alias("token_count"), bad.alias("error"), F.lit(None).cast("string").alias("error_kind"), F.lit(None).cast("string").alias("msg"))


def _states(spark, root):
    return {r.identifier: (r.n_pages, r.n_ocr_ok, r.failed_pages, r.total_tokens, r.complete) for r in resume.last_states(spark, root).collect()}


def test_interrupted_runs_answer_every_page_once(spark, tmp_path):
    folder, root, check = (str(tmp_path / n) for n in ("in", "root", "check"))
    _arrives(spark, folder, ORDER)
    gone = Model(fails=["b", "y"], breaks=2)
    with pytest.raises(Exception, match="the model is gone"):
        resume.run_volumes(_stream(spark, folder), gone, root, check)
    # The first round stands, though the batch failed; the volumes have no state yet.
    assert gone.asked == [["a", "b", "c", "x", "y"], ["b", "y"]] and _states(spark, root) == {}
    sound = Model(fails=["y"])
    resume.run_volumes(_stream(spark, folder), sound, root, check)
    assert sound.asked == [["b", "y"], ["y"]]
    assert _states(spark, root) == {"v1": (3, 3, [], 30, True), "v2": (2, 1, ["y"], 10, False)}
    got = resume.good(resume.answers(spark, root))
    assert sorted(r.image for r in got.collect()) == ["a", "b", "c", "x"]
    texts = {r.identifier: r.text for r in resume.last_texts(spark, root).collect()}
    assert texts["v2"] == "<!-- page 1 | image x -->\n\ntext of x\n\n<!-- page 2 | image y -->\n\n[OCR FAILED]\n\n"

    # Nothing new: nothing is asked.
    idle = Model()
    resume.run_volumes(_stream(spark, folder), idle, root, check)
    assert idle.asked == []

    # What failed is taken up under a name of its own, only there.
    again = Model()
    after = resume.caught_up(spark, again, root, "again")
    assert again.asked == [["y"]] and {r.identifier: (r.batch, r.complete) for r in after.collect()} == {"v1": ("0", True), "v2": ("again", True)}
    assert resume.caught_up(spark, Model(), root, "later").where("not complete").isEmpty()
    with pytest.raises(Exception, match="(?i)already exists"):
        resume.caught_up(spark, Model(), root, "again")


def test_a_volume_in_several_batches(spark, tmp_path):
    folder, root, check = (str(tmp_path / n) for n in ("in", "root", "check"))
    _arrives(spark, folder, ORDER[:2])
    resume.run_volumes(_stream(spark, folder), Model(), root, check)
    assert _states(spark, root) == {"v1": (2, 2, [], 20, True)}
    # A page that comes again is neither asked nor counted again.
    _arrives(spark, folder, ORDER[1:])
    model = Model(fails=["c"])
    resume.run_volumes(_stream(spark, folder), model, root, check, retries=2)
    assert model.asked == [["c", "x", "y"], ["c"], ["c"]]
    assert _states(spark, root) == {"v1": (3, 2, ["c"], 20, False), "v2": (2, 2, [], 20, True)}
    assert sorted(r.text.count("<!-- page") for r in resume.last_texts(spark, root).collect()) == [2, 3]


def test_states_of_odd_answers(spark):
    order = spark.createDataFrame(ORDER, resume.ORDER)
    told = spark.createDataFrame([("v1", "a", None, 5, None), ("v1", "a", "later", 7, True), ("v1", "z", "other", 9, False), ("v1", "b", "two", None, False), ("v1", "b", "two", None, False), (None, "c", "t", 1, False)], "identifier string, image string, markdown string, token_count bigint, error boolean")
    got = {r.identifier: tuple(r)[1:] for r in resume.volume_states(order, told).collect()}
    assert got == {"v1": (3, 2, ["c"], 5, False), "v2": (2, 0, ["x", "y"], 0, False)}
    text = {r.identifier: r.text for r in resume.volume_texts(order, told).collect()}["v1"]
    # An answer without a text is a page without a text, not a failure.
    assert text == "<!-- page 1 | image a -->\n\n\n\n<!-- page 2 | image b -->\n\ntwo\n\n<!-- page 3 | image c -->\n\n[OCR FAILED]\n\n"
    assert resume.volume_states(order.where("false"), told).collect() == []


def test_counts_of_the_pass_that_writes(spark, tmp_path):
    rows = [("article", "bold")] * 5 + [("article", "caps")] * 2 + [("treatise", "banner"), ("plate", None), (None, "bold")]
    records = spark.createDataFrame(rows, "type string, detected_by string").repartition(3)
    noted, told = E.counted(records, ["article", "treatise"], ["bold", "caps", "banner"])
    noted.write.parquet(str(tmp_path / "records"))
    counts = {(t, d): n for t, d, n, level in (tuple(r) for r in E.tallies(spark.read.parquet(str(tmp_path / "records"))).collect()) if level == 0}
    for t in ("article", "treatise"):
        for d in ("bold", "caps", "banner"):
            assert E.count_of(told, t, d) == counts.get((t, d), 0)
    assert told.get["total"] == len(rows)
