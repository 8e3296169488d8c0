"""Viewing-log operators: category mapping, cleaning, active ratio, totals, profile.

A flattened viewing log has ``user_id STRING, app STRING, duration BIGINT,
date DATE``; after ``map_app_category`` it also has ``Type``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewer_insights import vocab
from viewer_insights.functions.sqltext import case, ident, in_list, string


def total_col(category: str, column_names: Mapping[str, str] | None = None) -> str:
    suffix = (column_names or {}).get(category, category.replace(" ", "_"))
    return f"Total_{suffix}"


def app_category_sql(app_col: str, mapping: Mapping[str, str] = vocab.APP_CATEGORY_MAP) -> str:
    """CASE on the (case-sensitive) application code; unknown -> ``Other``."""
    by_cat: dict[str, list[str]] = {}
    for code, cat in mapping.items():
        by_cat.setdefault(cat, []).append(code)
    return case(((in_list(ident(app_col), codes), string(cat)) for cat, codes in by_cat.items()),
                string(vocab.OTHER))


def app_category(app_col: str, mapping: Mapping[str, str] = vocab.APP_CATEGORY_MAP) -> Column:
    return F.expr(app_category_sql(app_col, mapping))


def map_app_category(df: DataFrame, mapping: Mapping[str, str] = vocab.APP_CATEGORY_MAP, app_col: str = "app") -> DataFrame:
    return df.withColumn("Type", app_category(app_col, mapping))


def clean_viewing_log(df: DataFrame) -> DataFrame:
    """Keep positive durations of a known category for valid account ids
    (NULL duration or id fails the test)."""
    return df.filter(F.expr(
        f"duration > 0 AND `Type` <> {string(vocab.OTHER)} AND user_id RLIKE {string(vocab.VALID_ACCOUNT_PATTERN)}"
    ))


def active_sql(days: int = vocab.DAYS_PER_MONTH) -> str:
    """Distinct non-NULL days over ``days``, in percent, 2 decimals."""
    return f"round(count(DISTINCT `date`) / {int(days)} * 100, 2)"


def active_ratio(df: DataFrame, days: int = vocab.DAYS_PER_MONTH) -> DataFrame:
    """``Active = round(distinct non-NULL days / days * 100, 2)`` per user."""
    return df.groupBy("user_id").agg(F.expr(f"{active_sql(days)} AS Active"))


def day_map_sql(date_sql: str = "`date`") -> str:
    """The day of the month as one bit of a 32-bit number; 0 without a date."""
    return f"coalesce(shiftleft(1, day({date_sql}) - 1), 0)"


def day_maps(df: DataFrame) -> DataFrame:
    """``user_id, month, days``: the days of each month on which a user watched, as bits.

    ``bit_or`` is combined map-side, and the maps of two logs (or of the days of a stream) are merged
    by ``bit_or`` again (``merge_day_maps``): unlike a distinct count, nothing is kept per day.
    """
    return df.groupBy("user_id", F.expr("CAST(date_trunc('MONTH', `date`) AS DATE) AS month")).agg(
        F.expr(f"bit_or({day_map_sql()}) AS days"))


def merge_day_maps(*maps: DataFrame) -> DataFrame:
    """Day maps of several logs as one; a day that two logs share counts once."""
    out = maps[0]
    for m in maps[1:]:
        out = out.unionByName(m)
    return out.groupBy("user_id", "month").agg(F.expr("bit_or(days) AS days"))


def active_ratio_from_maps(maps: DataFrame, days: int = vocab.DAYS_PER_MONTH) -> DataFrame:
    """``active_ratio`` from day maps: the set bits of all months of a user over ``days``."""
    return maps.groupBy("user_id").agg(F.expr(f"round(sum(bit_count(days)) / {int(days)} * 100, 2) AS Active"))


def _total_aggs(categories: Sequence[str], column_names) -> list[Column]:
    # Conditional sums = a pivot with a fixed value list, in one hash aggregate.
    return [
        F.expr(f"CAST(coalesce(sum(CASE WHEN `Type` = {string(c)} THEN duration END), 0) AS BIGINT) "
               f"AS {ident(total_col(c, column_names))}")
        for c in categories
    ]


def watch_totals(
    df: DataFrame, categories: Sequence[str] = vocab.VIEW_CATEGORIES, column_names=vocab.VIEW_CATEGORY_COLUMNS
) -> DataFrame:
    """Per user, watched duration per category (0 when none): ``Total_<cat>``."""
    return df.groupBy("user_id").agg(*_total_aggs(categories, column_names))


def most_watched_sql(totals: Sequence[str], categories: Sequence[str]) -> str:
    """Category with the greatest total; ties -> first in list order; all 0 -> None."""
    top = f"greatest({', '.join(ident(t) for t in totals)})"
    branches = [(f"{top} = 0", string(vocab.NO_VIEWING))]
    branches += [(f"{top} = {ident(t)}", string(c)) for t, c in zip(totals, categories)]
    return case(branches, string(vocab.MIXED))


def taste_sql(totals: Sequence[str], categories: Sequence[str]) -> str:
    """Categories with a positive total, in list order, joined by `` - ``."""
    parts = ", ".join(f"CASE WHEN {ident(t)} > 0 THEN {string(c)} END" for t, c in zip(totals, categories))
    return f"concat_ws({string(vocab.TASTE_SEPARATOR)}, {parts})"


def with_most_watched(df, categories=vocab.VIEW_CATEGORIES, column_names=vocab.VIEW_CATEGORY_COLUMNS) -> DataFrame:
    totals = [total_col(c, column_names) for c in categories]
    return df.withColumn("MostWatch", F.expr(most_watched_sql(totals, categories)))


def with_taste(df, categories=vocab.VIEW_CATEGORIES, column_names=vocab.VIEW_CATEGORY_COLUMNS) -> DataFrame:
    totals = [total_col(c, column_names) for c in categories]
    return df.withColumn("Taste", F.expr(taste_sql(totals, categories)))


def viewing_profile(
    df: DataFrame,
    categories: Sequence[str] = vocab.VIEW_CATEGORIES,
    column_names=vocab.VIEW_CATEGORY_COLUMNS,
    days: int = vocab.DAYS_PER_MONTH,
) -> DataFrame:
    """Viewing master: ``user_id, Total_<cat>..., MostWatch, Taste, Active``.

    Totals and distinct active days come from ONE aggregate per user, so the
    cleaned log is scanned and shuffled once and no join is needed.
    """
    prof = df.groupBy("user_id").agg(*_total_aggs(categories, column_names), F.expr(f"{active_sql(days)} AS Active"))
    totals = [total_col(c, column_names) for c in categories]
    return prof.selectExpr(
        "user_id",
        *[ident(t) for t in totals],
        f"{most_watched_sql(totals, categories)} AS MostWatch",
        f"{taste_sql(totals, categories)} AS Taste",
        "Active",
    )


def viewing_profile_by_join(
    df: DataFrame,
    categories: Sequence[str] = vocab.VIEW_CATEGORIES,
    column_names=vocab.VIEW_CATEGORY_COLUMNS,
    days: int = vocab.DAYS_PER_MONTH,
) -> DataFrame:
    """The same profile as totals JOIN active ratio (inner, on ``user_id``)."""
    totals = with_taste(with_most_watched(watch_totals(df, categories, column_names), categories, column_names),
                        categories, column_names)
    return totals.join(active_ratio(df, days), "user_id", "inner")


def sample_users(df: DataFrame, n: int = vocab.SAMPLE_USERS_N, seed: int = 0) -> DataFrame:
    """Reproducible fixed-size sample: the ``n`` users with the smallest
    ``md5(user_id || ':' || seed)`` (ties by user_id).  The same rows come out
    for any partitioning and on every re-run."""
    h = F.md5(F.concat(F.col("user_id").cast("string"), F.lit(f":{seed}")))
    return df.orderBy(h.asc(), F.col("user_id").asc()).limit(n)
