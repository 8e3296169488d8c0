"""Batch jobs that write every stage output.

Each stage writes its result to the output folder (shared storage on a
cluster) and the next step reads it back: the hand-off cuts the lineage, so a
lost executor only costs the tasks of the running stage.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewer_insights import vocab
from viewer_insights.operators import enrich, insights, search
from viewer_insights.plans import customer360 as plan
from viewer_insights.session import scratch_tables, stage_table
from viewer_insights.sinks import contract, files, jdbc, serving
from viewer_insights.sinks.metrics import observed
from viewer_insights.sources import logs

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Outputs:
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def run_search_stage(spark: SparkSession, searches: DataFrame, s: plan.SearchSettings, out: Outputs,
                     manual: DataFrame | None = None) -> dict[str, int]:
    """users -> keyword categories -> rule dictionary + review queue -> search master -> matrix.

    Returns the numbers of users, mapped keywords, keywords to review and
    dictionary entries (rules and reviewed sheet together).
    """
    users, users_obs = observed(plan.search_users(searches, s), "users")
    files.write_parquet(users, out.path("users"))
    users = spark.read.parquet(out.path("users"))

    # the rules run here, once per distinct keyword; every later step reads the stored categories
    files.write_parquet(plan.keyword_categories(users, s), out.path("keyword_categories"))
    categories = spark.read.parquet(out.path("keyword_categories"))
    mapped, review = search.split_review_queue(categories)
    mapped, mapped_obs = observed(mapped, "mapped")
    files.write_parquet(mapped, out.path("rule_dictionary"))
    review, review_obs = observed(review, "review")
    files.export_review_queue(review, out.path("review_queue"))
    dictionary, dictionary_obs = observed(
        enrich.merge_dictionary(spark.read.parquet(out.path("rule_dictionary")), manual), "dictionary")
    files.write_parquet(dictionary, out.path("dictionary"))

    categorized = enrich.map_categories(users, spark.read.parquet(out.path("dictionary")), s.labels, s.salt_buckets)
    files.write_parquet(enrich.enrich_labels(categorized, s.labels), out.path("search_master"))
    master = spark.read.parquet(out.path("search_master"))
    files.export_table(enrich.transition_counts(master, s.labels), out.path("transition_counts"))
    export_matrix(master, s, out, manual)
    return {"users": users_obs.get["rows"], "mapped": mapped_obs.get["rows"], "review": review_obs.get["rows"],
            "dictionary": dictionary_obs.get["rows"]}


def export_matrix(master: DataFrame, s: plan.SearchSettings, out: Outputs, manual: DataFrame | None = None) -> bool:
    """The wide matrix, and the table of its column headers beside it.  With more categories than a
    table should have columns only the long form (``transition_counts``, complete) is there, and
    the job goes on."""
    try:
        categories = enrich.matrix_categories([c for c, _ in s.rules], manual)
    except enrich.TooManyCategories as e:
        log.warning("no wide transition matrix: %s; see transition_counts", e)
        return False
    key = enrich.cat_col(s.labels[0])
    names = enrich.matrix_names(master.sparkSession, categories, key)
    matrix = enrich.positional_matrix(master, categories, s.labels).toDF(key, *enrich.matrix_headers(categories, key))
    files.export_table(matrix, out.path("transition_matrix"))
    files.export_table(names, out.path("transition_matrix_names"))
    return True


def run_viewing_stage(spark: SparkSession, events: DataFrame, v: plan.ViewingSettings, out: Outputs) -> dict[str, int]:
    prof, obs = observed(plan.viewing_master(events, v), "viewers")
    files.write_parquet(prof, out.path("viewing_master"))
    return {"viewers": obs.get["rows"]}


def export_rejects(spark: SparkSession, viewing_glob: str, out: Outputs) -> int:
    """The lines of the viewing log that can't be read as declared, and their numbers per day and
    reason, as CSV; returns how many there are."""
    rejects, obs = observed(logs.read_viewing_rejects(spark, viewing_glob), "rejects")
    files.export_table(rejects, out.path("viewing_rejects"))
    stored = spark.read.schema("file STRING, date DATE, line STRING, reason STRING").options(**files.CSV_OPTIONS).option(
        "multiLine", True).csv(out.path("viewing_rejects"))
    files.export_table(logs.viewing_reject_counts(stored), out.path("viewing_reject_counts"))
    return obs.get["rows"]


def run_merge_stage(spark: SparkSession, out: Outputs, s: plan.SearchSettings, v: plan.ViewingSettings,
                    how: str = "full", target: jdbc.JdbcTarget | None = None) -> dict[str, int]:
    """Wide table -> contract -> merge with the stored table -> key check -> Parquet, CSV (+ JDBC).

    A table that breaks the key contract is refused before it is served: ``ContractError``,
    and ``customer_360`` stays as it was.  Users whose row did not change keep their
    ``updated_at``; ``serving_merge`` holds the numbers of new, changed, same and gone users
    and ``serving_gone`` the users that left."""
    wide = plan.customer_360(spark.read.parquet(out.path("search_master")),
                             spark.read.parquet(out.path("viewing_master")), how)
    schema = contract.serving_schema(s.labels, v.categories, v.column_names)
    served = out.path("customer_360")
    aligned = contract.align_to_schema(wide, schema)
    before = spark.read.parquet(served) if serving.exists(spark, served) else aligned.limit(0)
    with scratch_tables(spark):
        merged, obs = observed(serving.merge_serving(before, aligned), "wide", f"{serving.STATUS} <> '{serving.GONE}'")
        merged = stage_table(merged, "serving-merge")  # counted here: the sorted write below samples its input first
        files.export_table(serving.merge_counts(merged), out.path("serving_merge"))
        files.export_table(merged.where(F.col(serving.STATUS) == serving.GONE).select("user_id", "updated_at"), out.path("serving_gone"))
        aligned = serving.publish(merged.where(F.col(serving.STATUS) != serving.GONE).drop(serving.STATUS), served)
    files.export_table(aligned, out.path("customer_360_csv"))
    if target is not None:
        jdbc.publish(aligned, target)
    return {"wide": obs.get["rows"]}


def run_insights(spark: SparkSession, out: Outputs, s: plan.SearchSettings, v: plan.ViewingSettings,
                 vip_likes=None, vip_min_active=None) -> list[str]:
    """The business questions on the stored serving table, each written as CSV
    under ``insights/<name>``.  Each reads only its columns of the table."""
    wide = spark.read.parquet(out.path("customer_360"))
    totals = plan.total_columns(v)
    likes = vip_likes if vip_likes is not None else vocab.VIP_TASTES
    min_active = vip_min_active if vip_min_active is not None else vocab.VIP_MIN_ACTIVE
    reports = {
        "status_health": insights.status_health(wide, totals),
        "top_shifts": insights.top_shifts(wide, labels=s.labels),
        "top_shifts_10": insights.top_shifts(wide, 10, s.labels),
        "vip_users": insights.vip_users(wide, likes, min_active, column_names=v.column_names),
        "shift_rate": insights.shift_rate(wide),
        "category_retention": insights.category_retention(wide, s.labels),
        "taste_engagement": insights.taste_engagement(wide),
        "archetype_engagement": insights.archetype_engagement(wide, totals),
        "intent_vs_watch": insights.intent_vs_watch(wide, s.labels),
    }
    for name, df in reports.items():
        files.export_table(df, out.path(f"insights/{name}"))
    return list(reports)


def run_all(spark: SparkSession, searches: DataFrame, events: DataFrame, s: plan.SearchSettings,
            v: plan.ViewingSettings, out: Outputs, manual: DataFrame | None = None, how: str = "full",
            target: jdbc.JdbcTarget | None = None) -> dict[str, int]:
    counts = run_search_stage(spark, searches, s, out, manual)
    counts.update(run_viewing_stage(spark, events, v, out))
    counts.update(run_merge_stage(spark, out, s, v, how, target))
    return counts
