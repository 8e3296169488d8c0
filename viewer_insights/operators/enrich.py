"""Enrichment: keyword dictionary, category per month, status, shift, journey, matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewer_insights import vocab
from viewer_insights.functions import labels as L
from viewer_insights.functions.diacritics import fold_diacritics_sql
from viewer_insights.functions.rules import rule_case_sql
from viewer_insights.functions.sqltext import ident, string
from viewer_insights.functions.text import is_present_sql, normalize_keyword_sql, strip_all_whitespace_sql
from viewer_insights.operators.search import DEFAULT_LABELS, cat_col, kw_col
from viewer_insights.operators.sizing import DEFAULT_SALT_BUCKETS, hot_salted_lookup

# Columns a transition matrix may have (a wide table with more is refused, the long form is not).
MAX_CATEGORIES = 5_000
MANUAL_PRIORITY = 0
RULE_PRIORITY = 1


def dictionary_key_sql(c: str) -> str:
    """Lookup key used on both sides of a dictionary join."""
    return normalize_keyword_sql(strip_all_whitespace_sql(ident(c)))


def merge_dictionary(rule_mapped: DataFrame | None, manual: DataFrame | None = None) -> DataFrame:
    """One category per normalised keyword: manual entries beat rule entries,
    then the smallest category wins (deterministic).  Blank categories and
    ``Unmapped`` rule rows are not entries.

    Inputs have ``keyword, category``; output ``keyword, category``.
    """
    parts = []
    if rule_mapped is not None:
        parts.append(rule_mapped.filter(F.expr(f"category <> {string(vocab.UNMAPPED)}")).selectExpr(
            "keyword", "category", f"{RULE_PRIORITY} AS priority"))
    if manual is not None:
        parts.append(manual.selectExpr("keyword", "category", f"{MANUAL_PRIORITY} AS priority"))
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    cleaned = merged.selectExpr(
        f"{dictionary_key_sql('keyword')} AS keyword",
        f"{strip_all_whitespace_sql('category')} AS category",
        "priority",
    ).filter(F.expr(f"{is_present_sql('keyword')} AND {is_present_sql('category')}"))
    # min(struct) is combined map-side; no window over a possibly hot key.
    return cleaned.groupBy("keyword").agg(F.expr("min(struct(priority, category)) AS _w")).selectExpr(
        "keyword", "_w.category AS category")


def map_categories(
    users: DataFrame,
    dictionary: DataFrame,
    labels: Sequence[str] = DEFAULT_LABELS,
    salt_buckets: int = DEFAULT_SALT_BUCKETS,
) -> DataFrame:
    """Look up ``category_<m>`` for each month's keyword.

    No keyword -> ``No_Search``; keyword not in the dictionary -> ``Other``.
    All months are looked up at once (``_lookup_months``), so the wide user rows are never
    shuffled by keyword, and a keyword that is the top keyword of a third of all users is
    spread over ``salt_buckets`` tasks.  Spark broadcasts the dictionary when its bytes
    allow it.
    """
    d = dictionary.select("keyword", "category")
    return _lookup_months(users, d, labels, "_cat_", lambda lab: f"_cat_{lab}", salt_buckets)


def _lookup_months(users: DataFrame, d: DataFrame, labels, prefix: str, looked_up,
                   salt_buckets: int = DEFAULT_SALT_BUCKETS) -> DataFrame:
    """Look up every month's keyword in ``d`` in one join, then label.

    The months become rows (user, key) without the other columns, are joined to ``d`` with
    the hot keys salted, and come back as one map key -> category per user: the users are
    shuffled by user once, whatever the number of months.  Users without any keyword take
    no part in the lookup.  The map answers by keyword, so users that repeat an id, and those
    without one, each get their own categories.
    """
    keys = [dictionary_key_sql(kw_col(lab)) for lab in labels]
    who = "coalesce(user_id, '')"
    rows = users.selectExpr(f"{who} AS _user", f"explode(array_distinct(array({', '.join(keys)}))) AS _key").where("_key IS NOT NULL")
    found = hot_salted_lookup(rows, d.selectExpr("keyword AS _found", "category AS _category"), "_key", "_found", "xxhash64(_user)", salt_buckets)
    per_user = found.groupBy("_user").agg(F.expr("map_from_entries(collect_set(struct(_key, _category))) AS _categories"))
    out = users.join(per_user, F.expr(f"{who} = _user"), "left")
    looked = {f"{prefix}{lab}": F.expr(f"element_at(_categories, {k})") for lab, k in zip(labels, keys)}
    return out.withColumns(looked).withColumns({
        cat_col(lab): F.expr(L.month_category_sql(kw_col(lab), looked_up(lab))) for lab in labels
    }).drop("_user", "_categories", *looked)


def categorize_users(
    users: DataFrame,
    rules,
    manual: DataFrame | None = None,
    labels: Sequence[str] = DEFAULT_LABELS,
    fold_diacritics: bool = False,
    salt_buckets: int = DEFAULT_SALT_BUCKETS,
) -> DataFrame:
    """``category_<m>`` for each month without a keyword-dictionary join.

    Same result as ``map_categories(users, merge_dictionary(rule hits, manual))``:
    a manual entry wins, else the first matching rule, else ``Other``; no
    keyword gives ``No_Search``.  The rules are evaluated on each user row, so
    the user table is read once and never shuffled by keyword (a keyword that
    a third of all users share cannot skew anything).  Only the manual
    dictionary is joined, with a salt (``map_categories``).
    ``fold_diacritics`` matches the rules against the keyword with Latin
    accents removed (the keyword itself is kept).
    """
    def looked_up(lab: str) -> str:
        subject = fold_diacritics_sql(ident(kw_col(lab))) if fold_diacritics else None
        hit = rule_case_sql(kw_col(lab), rules, default=None, subject_sql=subject)
        return f"coalesce(_man_{lab}, {hit})" if manual is not None else hit

    if manual is None:
        return users.withColumns({
            cat_col(lab): F.expr(L.month_category_sql(kw_col(lab), looked_up(lab))) for lab in labels
        })
    return _lookup_months(users, merge_dictionary(None, manual), labels, "_man_", looked_up, salt_buckets)


def with_user_status(df: DataFrame, labels: Sequence[str] = DEFAULT_LABELS) -> DataFrame:
    a, b = labels
    return df.withColumn("user_status", F.expr(L.user_status_sql(cat_col(a), cat_col(b))))


def with_preference_change(df: DataFrame, labels: Sequence[str] = DEFAULT_LABELS) -> DataFrame:
    a, b = labels
    return df.withColumn("trending_types", F.expr(L.preference_change_sql(cat_col(a), cat_col(b))))


def with_journey(df: DataFrame, labels: Sequence[str] = DEFAULT_LABELS) -> DataFrame:
    a, b = labels
    return df.withColumn("Previous", F.expr(L.journey_sql(cat_col(a), cat_col(b))))


def enrich_labels(categorized: DataFrame, labels: Sequence[str] = DEFAULT_LABELS) -> DataFrame:
    """Search master: user, keywords, categories, status, change, journey."""
    a, b = labels
    ca, cb = cat_col(a), cat_col(b)
    return categorized.selectExpr(
        "user_id", ident(kw_col(a)), ident(ca), ident(kw_col(b)), ident(cb),
        f"{L.user_status_sql(ca, cb)} AS user_status",
        f"{L.preference_change_sql(ca, cb)} AS trending_types",
        f"{L.journey_sql(ca, cb)} AS Previous",
    )


def transition_counts(master: DataFrame, labels: Sequence[str] = DEFAULT_LABELS) -> DataFrame:
    """Users per (month-A category, month-B category), whatever the categories: the complete
    long form ``category_<a>, category_<b>, users``."""
    a, b = labels
    return master.groupBy(cat_col(a), cat_col(b)).agg(F.expr("count(1) AS users"))


def positional_matrix(master: DataFrame, categories: Sequence[str], labels: Sequence[str] = DEFAULT_LABELS) -> DataFrame:
    """``transition_counts`` as a 0-filled pivot: ``category_<a>, c0, c1, ...``; column ``c<i>`` holds the
    users whose month-B category is ``categories[i]``.

    The pivot runs over places in the list, so a category is a value everywhere and never a
    column name: names that differ in case only, hold dots or backticks or equal the key
    column do not matter.  The list is passed explicitly: the schema is fixed and Spark does
    not run an extra job to discover the distinct values.  A month-B category outside the
    list raises an error instead of losing its users.
    """
    a, b = labels
    names = matrix_names(master.sparkSession, categories)  # one row per category of the list, MAX_CATEGORIES at most
    unknown = "raise_error(concat('category outside the transition matrix: ', coalesce(_to, 'NULL')))"
    counts = (
        transition_counts(master, labels).toDF("_from", "_to", "_users")
        .join(F.broadcast(names.select("position", F.col("category").alias("_name"))), F.expr("_to = _name"), "left")
        .selectExpr("_from", "_users", f"CASE WHEN position IS NULL THEN {unknown} ELSE position END AS _at")
    )
    cells = [f"c{i}" for i in range(len(categories))]
    wide = counts.groupBy("_from").pivot("_at", list(range(len(categories)))).agg(F.expr("sum(_users)")).toDF("_from", *cells)
    return wide.selectExpr(f"_from AS {ident(cat_col(a))}", *(f"coalesce({c}, 0) AS {c}" for c in cells))


def matrix_names(spark: SparkSession, categories: Sequence[str], key: str = "") -> DataFrame:
    """Name table of a matrix: ``position, header, category``."""
    rows = list(zip(range(len(categories)), matrix_headers(categories, key), categories))
    return spark.createDataFrame(rows, "position INT, header STRING, category STRING")


def matrix_headers(categories: Sequence[str], key: str = "") -> list[str]:
    """One column header per category for files: the category itself, with a number added where
    the same header (upper and lower case alike) or the key column's stands before it."""
    taken, out = {key.lower()}, []
    for c in categories:
        header, n = c, 1
        while header.lower() in taken:
            n += 1
            header = f"{c} ({n})"
        taken.add(header.lower())
        out.append(header)
    return out


def transition_matrix(master: DataFrame, categories: Sequence[str], labels: Sequence[str] = DEFAULT_LABELS) -> DataFrame:
    """``positional_matrix`` with one column named like each category."""
    return positional_matrix(master, categories, labels).toDF(cat_col(labels[0]), *categories)


class TooManyCategories(ValueError):
    """The reviewed dictionary has more categories than a matrix can have columns."""


def dictionary_categories(manual: DataFrame, max_categories: int = MAX_CATEGORIES) -> list[str]:
    """The distinct categories of the reviewed dictionary, in order."""
    found = (merge_dictionary(None, manual).select("category").distinct().limit(max_categories + 1).collect())
    if len(found) > max_categories:
        raise TooManyCategories(f"the dictionary has more than {max_categories} categories")
    return sorted(r["category"] for r in found)


def matrix_categories(rule_categories: Sequence[str], manual: DataFrame | None = None) -> list[str]:
    """All values a month category can take, in a stable order: rule categories, those that only
    the reviewed dictionary has, and the fixed labels."""
    extra = dictionary_categories(manual) if manual is not None else []
    return list(dict.fromkeys([*rule_categories, *extra, vocab.UNMAPPED, vocab.OTHER, vocab.NO_SEARCH]))
