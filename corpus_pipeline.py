"""The corpus pipeline: quality, near-duplicates, decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stage before kept. Between stages the
documents are written as Parquet in the checkpoint folder that all executors share, and read again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from casegrid.llm import common, decontamination, packing, pii, quality, simhash
from casegrid.llm.queries import TOKENIZER


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones, doesn't reject.

    Null and empty texts are scored like any other. Without labels of both classes all documents stay. Repeated rows
    share a fate; other columns are kept as they are.
    """
    return quality.kept(docs, common.table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest doc_id.

    Texts without words are near-duplicates of each other; of rows that repeat the doc_id that stays, one stays. An
    empty table gives no rows; other columns are kept as they are.
    """
    common.prepare(spark)
    return simhash.kept(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item leaks.

    Null and empty texts leak nothing, and neither does an empty benchmark; repeated rows share a fate; other columns
    are kept as they are.
    """
    return decontamination.without(docs, common.table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked in their texts and n_chars brought up to date.

    A null text stays null and an empty one empty; repeated rows are masked alike; other columns are kept as they are.
    """
    common.prepare(spark)
    return pii.without(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its place in a training sequence.

    A null text is an empty document: its end mark alone. Rows that repeat are packed each for itself; other columns are
    left out; an empty table gives no rows.
    """
    return packing.packed(docs, TOKENIZER)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: Classifiers and fingerprints can't be said in SQL; the tests hold run() against a stage-by-stage check.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the table ``documents``. A stage's folder goes when the next one is written; the
    last one stays, as the result is read from it."""
    docs = common.table(spark, sf_dir, "documents")
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    before = None
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(at := f"{folder}/{k}-{name}")
        docs = spark.read.parquet(at)
        if before:
            common.removed(spark, before)
        before = at
    return docs
