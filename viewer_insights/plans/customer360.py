"""End-to-end plans: search master, viewing master, the wide customer table.

Each function only composes operators into one lazy logical plan; nothing is
collected.  Writing the results (and cutting lineage between stages) is the
caller's choice, see ``viewer_insights.sinks``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from viewer_insights import vocab
from viewer_insights.operators import enrich, merge, search, viewing
from viewer_insights.operators.sizing import DEFAULT_SALT_BUCKETS
from viewer_insights.session import stage_table

# Up to so many phrases one CASE of patterns is faster than a lookup.
INDEX_PHRASES = 2_000


@dataclass(frozen=True)
class SearchSettings:
    labels: tuple[str, str] = search.DEFAULT_LABELS
    rules: Sequence = ()
    high_pattern: str = vocab.HIGH_INTENT_PATTERN
    genre_pattern: str = vocab.GENRE_INTENT_PATTERN
    # None keeps every user; an int keeps the top-n scored users (the
    # original cohort was 5,000).
    top_n: int | None = None
    # tasks over which one month keyword is spread in a dictionary lookup
    salt_buckets: int = DEFAULT_SALT_BUCKETS
    # tasks over which the log is dealt (sizing.partitions_for); None: the session's number of shuffle partitions
    partitions: int | None = None
    # match rules against the keyword with Latin accents removed
    fold_diacritics: bool = False


@dataclass(frozen=True)
class ViewingSettings:
    app_map: Mapping[str, str] = field(default_factory=lambda: dict(vocab.APP_CATEGORY_MAP))
    categories: Sequence[str] = vocab.VIEW_CATEGORIES
    column_names: Mapping[str, str] = field(default_factory=lambda: dict(vocab.VIEW_CATEGORY_COLUMNS))
    days: int = vocab.DAYS_PER_MONTH
    sample_n: int | None = None
    sample_seed: int = 0


def search_users(log: DataFrame, s: SearchSettings) -> DataFrame:
    """Cleaned log -> one row per user with both months' top keyword and count, without the
    users whose month-B keyword is junk."""
    users = search.drop_junk_users(search.monthly_top_keywords(search.clean_search_log(log), s.labels, partitions=s.partitions), s.labels)
    if s.top_n is not None:
        users = search.top_users(search.score_users(users, s.labels, s.high_pattern, s.genre_pattern), s.top_n, s.labels)
    return users


def keyword_categories(users: DataFrame, s: SearchSettings) -> DataFrame:
    """Rule category of every distinct keyword.  Store the result before filtering it
    (``staged_keyword_categories``): Spark moves a filter on the category below the distinct,
    and the rules would run on every user's keywords.  A rule table of more than ``INDEX_PHRASES``
    phrases is looked up by a phrase index, with the same result."""
    many = sum(len(phrases) for _, phrases in s.rules) > INDEX_PHRASES
    judge = search.categorize_by_index if many else search.categorize
    return judge(search.distinct_keywords(users, s.labels), s.rules, fold_diacritics=s.fold_diacritics)


def staged_keyword_categories(users: DataFrame, s: SearchSettings) -> DataFrame:
    """``keyword_categories`` written once to the shared folder: the rules run once per distinct
    keyword, and the mapped keywords, the review queue and the lookup all read the result."""
    return stage_table(keyword_categories(users, s), "keyword-categories")


def search_master(log: DataFrame, s: SearchSettings, manual: DataFrame | None = None) -> DataFrame:
    """Search master from a raw (cleaned or not) multi-month search log.

    One lazy plan: two partial aggregations, then per-row rules (and a salted
    lookup of the manual dictionary).  With a long rule table the dictionary
    form below is faster; jobs use it.
    """
    return search_master_from_users(search_users(log, s), s, manual)


def search_master_from_users(users: DataFrame, s: SearchSettings, manual: DataFrame | None = None) -> DataFrame:
    categorized = enrich.categorize_users(users, s.rules, manual, s.labels, fold_diacritics=s.fold_diacritics,
                                          salt_buckets=s.salt_buckets)
    return enrich.enrich_labels(categorized, s.labels)


def search_master_via_dictionary(log: DataFrame, s: SearchSettings, manual: DataFrame | None = None) -> DataFrame:
    """The original formulation: distinct keywords -> rule dictionary (+ manual)
    -> lookup join per month.  Same rows as ``search_master``.

    The user table and the categories of its distinct keywords are each
    written once as stage tables in the shared checkpoint folder.
    """
    users = stage_table(search_users(log, s), "search-users")
    return search_master_from_dictionary(users, staged_keyword_categories(users, s), s, manual)


def search_master_from_dictionary(users: DataFrame, categories: DataFrame, s: SearchSettings,
                                  manual: DataFrame | None = None) -> DataFrame:
    """Search master from a stored user table and the stored categories of its keywords."""
    mapped, _review = search.split_review_queue(categories)
    categorized = enrich.map_categories(users, enrich.merge_dictionary(mapped, manual), s.labels, s.salt_buckets)
    return enrich.enrich_labels(categorized, s.labels)


def cleaned_viewing(events: DataFrame, v: ViewingSettings) -> DataFrame:
    return viewing.clean_viewing_log(viewing.map_app_category(events, v.app_map))


def viewing_master(events: DataFrame, v: ViewingSettings) -> DataFrame:
    prof = viewing.viewing_profile(cleaned_viewing(events, v), v.categories, v.column_names, v.days)
    if v.sample_n is not None:
        prof = viewing.sample_users(prof, v.sample_n, v.sample_seed)
    return prof


def customer_360(search_master_df: DataFrame, viewing_master_df: DataFrame, how: str = "full") -> DataFrame:
    return merge.merge_profiles(search_master_df, viewing_master_df, how)


def total_columns(v: ViewingSettings) -> list[str]:
    return [viewing.total_col(c, v.column_names) for c in v.categories]
