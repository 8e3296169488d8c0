"""Corpus pipeline: documents through five operators, each stage written and read again.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame.  All stages but the last return the columns of documents: the
quality classifier and decontamination drop rows, near-dedup keeps one document of each
group, the secret scan replaces secrets in ``text``; the last returns packed pieces.
Null texts, repeated rows, empty tables and further columns are handled as the stages'
operators state.  The rows of ``run`` can't be stated in SQL (trees, edit distances,
tokenizer); tests hold them against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viewer_insights.llm import decontamination, packing, quality_gbt, secret_scan, simhash
from viewer_insights.llm.common import read, stage_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_gbt.keep_good(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; each is written to the shared folder and read back."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
