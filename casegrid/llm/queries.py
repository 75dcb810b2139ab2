"""The registered queries of the corpus operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, decontamination, embeddings, html, langid, packing, pii, quality, secrets, simhash, toxicity

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    judged = toxicity.judged(docs, labels)
    return judged.select("doc_id", common.held_out("doc_id", toxicity.FOLDS, toxicity.HELD).alias("held_out"), "score", "predicted")


def op2_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(common.table(spark, sf_dir, "documents"), TOKENIZER)


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.near_duplicates(common.table(spark, sf_dir, "documents"))
    return classes.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    judged = quality.scored(docs.select("doc_id", "text"), quality.fit(docs, labels), ["doc_id"])
    return judged.select("doc_id", common.held_out("doc_id", quality.FOLDS, quality.HELD).alias("held_out"), "score", "predicted")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    labelled = langid.predicted(docs.select("doc_id", "text"), langid.fit(docs), ["doc_id"])
    return labelled.select("doc_id", common.held_out("doc_id", langid.FOLDS, langid.HELD).alias("held_out"), "lang_pred", "score")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(common.table(spark, sf_dir, "documents"), ["doc_id"])


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(common.table(spark, sf_dir, "embeddings"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scanned(common.table(spark, sf_dir, "documents"), ["doc_id"])


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(common.table(spark, sf_dir, "pages"), ["page_id", "url"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_best_two_fit": op2_best_two_fit,
        "op3_simhash_dedup": op3_simhash_dedup,
        "op4_quality_classifier": op4_quality_classifier,
        "op5_secrets": op5_secrets,
        "op6_language_id": op6_language_id,
        "op7_html_extraction": op7_html_extraction,
        "op8_embedding_dedup": op8_embedding_dedup,
        "op9_decontamination": op9_decontamination,
        "op10_pii": op10_pii,
    }


def oracle_sql() -> dict[str, str]:
    """None of these can be said in SQL; each is tested against brute force or on held-out rows."""
    return {}
