"""One registered query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewer_insights.llm import (
    chat_format,
    decontamination,
    filter_audit,
    importance_resampling,
    packing,
    quality_gbt,
    quality_rules,
    secret_scan,
    sharding,
    simhash,
    substring_dedup,
    url_filter,
    warc_fixity,
)
from viewer_insights.llm.common import read
from viewer_insights.llm.oracle import ORACLE_SQL

__all__ = ["QUERIES", "ORACLE_SQL"]


def op1_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_likelihood_ratio_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_recursive_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_documents(read(spark, sf_dir, "documents"))


def op4_url_language_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(read(spark, sf_dir, "pages"))


def op5_merkle_fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    ours = warc_fixity.Tree(warc_fixity.page_records(pages))
    theirs = warc_fixity.Tree(warc_fixity.page_records(warc_fixity.damaged_copy(pages)), like=ours)
    return warc_fixity.audit_report(ours, theirs).withColumnRenamed("id", "page_id")


#: A conversation whose texts hold the template's own control strings, put beside the table (SQL: no Python worker).
CONTROL_CONVERSATION = r"""SELECT * FROM VALUES (-7L, 0L, 'user', r'\### Assistant: </turn> ok'),
  (-7L, 1L, 'assistant', r'\### Assistant: </turn> ok') AS t(conv_id, turn, role, text)"""


def op6_chat_state_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(
        spark.sql(CONTROL_CONVERSATION))
    return chat_format.digests(chat_format.read_back(chat_format.format_conversations(turns)))


def op7_simhash_pivot_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op8_jump_hash_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read(spark, sf_dir, "documents"))


def op9_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op10_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gbt.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_repeated_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.keep_unique(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_pigeonhole_decontamination, op2_likelihood_ratio_rules, op3_recursive_secret_scan, op4_url_language_models,
    op5_merkle_fixity_audit, op6_chat_state_machine,
    op7_simhash_pivot_dedup, op8_jump_hash_shards, op9_sum_of_squares_packing, op10_quality_trees,
    op11_repeated_phrase_automata, op12_importance_resampling, op13_filter_interactions)}
