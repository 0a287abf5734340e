"""The corpus pipeline: documents through five stages, each written as Parquet and read by the next.

    language ID -> n-gram Jaccard join -> benchmark decontamination -> secret scans -> packing

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm.common import stored, table
from quire.llm.decontaminate import clean
from quire.llm.jaccard import one_of_each
from quire.llm.language import accepted
from quire.llm.packing import packed_digest
from quire.llm.secrets import redacted


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last stage: pieces of sequences, as the packing query returns them. Null texts are their end id alone."""
    return packed_digest(docs)


STAGES = [
    ("language ID", accepted),
    ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", clean),
    ("secret scans", redacted),
    ("packing", packed),
]

#: SQL can't express the trained models and the packing; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. An empty table gives no pieces; further columns travel along to the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
