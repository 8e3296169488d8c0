"""Business questions answered on the wide table (one row per user).

Every operator aggregates first; orderings and limits act on the small
aggregated result, with full tie-break keys so results are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewer_insights import vocab
from viewer_insights.functions.sqltext import case, ident, string
from viewer_insights.operators.search import DEFAULT_LABELS, cat_col
from viewer_insights.operators.viewing import total_col


def _sum_sql(cols: Sequence[str]) -> str:
    return " + ".join(ident(c) for c in cols)


def status_health(wide: DataFrame, total_cols: Sequence[str]) -> DataFrame:
    """Per user status: users, average Active (2 dp), total watch time."""
    return (
        wide.groupBy("user_status")
        .agg(
            F.expr("count(user_id) AS User_Count"),
            F.expr("round(avg(Active), 2) AS Average_Active_Ratio"),
            F.expr(f"sum({_sum_sql(total_cols)}) AS Total_Platform_Watch_Time"),
        )
        .orderBy(F.col("User_Count").desc(), F.col("user_status").asc_nulls_last())
    )


def top_shifts(wide: DataFrame, k: int = vocab.TOP_SHIFTS_K, labels: Sequence[str] = DEFAULT_LABELS) -> DataFrame:
    """The ``k`` largest (month-A, month-B) category flows among changed users."""
    a, b = labels
    return (
        wide.filter(F.expr(f"trending_types = {string(vocab.CHANGED)}"))
        .groupBy(F.expr(f"{ident(cat_col(a))} AS Old_Taste"), F.expr(f"{ident(cat_col(b))} AS New_Taste"))
        .agg(F.expr("count(user_id) AS Shift_Volume"))
        .orderBy(F.col("Shift_Volume").desc(), "Old_Taste", "New_Taste")
        .limit(k)
    )


def vip_users(
    wide: DataFrame,
    likes: Sequence[str] = vocab.VIP_TASTES,
    min_active: float = vocab.VIP_MIN_ACTIVE,
    k: int = vocab.VIP_K,
    column_names=vocab.VIEW_CATEGORY_COLUMNS,
) -> DataFrame:
    """Top ``k`` users by watch time of the liked categories, among users with
    ``Active > min_active`` whose taste contains every liked category."""
    cond = " AND ".join([f"Active > {float(min_active)!r}D"] + [f"contains(Taste, {string(x)})" for x in likes])
    target = _sum_sql([total_col(c, column_names) for c in likes])
    return (
        wide.filter(F.expr(cond))
        .selectExpr("user_id", "user_status", "Taste", "Active", f"{target} AS Target_Watch_Time")
        .orderBy(F.col("Target_Watch_Time").desc(), "user_id")
        .limit(k)
    )


def shift_rate(wide: DataFrame, retained_only: bool = False) -> DataFrame:
    """Share of search users whose category changed between the months."""
    cond = "user_status IS NOT NULL"
    if retained_only:
        cond += f" AND user_status = {string(vocab.RETAINED_USER)}"
    return wide.filter(F.expr(cond)).agg(
        F.expr("count(user_id) AS users"),
        F.expr(f"count(CASE WHEN trending_types = {string(vocab.CHANGED)} THEN 1 END) AS changed_users"),
    ).withColumn("shift_rate", F.expr("changed_users / nullif(users, 0)"))


def category_retention(wide: DataFrame, labels: Sequence[str] = DEFAULT_LABELS) -> DataFrame:
    """Per month-A category and month-B target: users moving there, and their
    share of the month-A category (the A == B row is the retention rate)."""
    a, b = labels
    flows = (
        wide.filter("user_status IS NOT NULL")
        .groupBy(F.expr(f"{ident(cat_col(a))} AS from_category"), F.expr(f"{ident(cat_col(b))} AS to_category"))
        .agg(F.expr("count(user_id) AS users"))
    )
    # The window runs over the aggregated flows (categories squared rows).
    return flows.selectExpr(
        "from_category",
        "to_category",
        "users",
        "sum(users) OVER (PARTITION BY from_category) AS from_users",
        "users / sum(users) OVER (PARTITION BY from_category) AS share",
        "from_category = to_category AS retained",
    )


def taste_engagement(wide: DataFrame) -> DataFrame:
    """Average Active per taste combination."""
    return wide.filter("Taste IS NOT NULL").groupBy("Taste").agg(
        F.expr("count(user_id) AS users"), F.expr("round(avg(Active), 2) AS avg_active"))


def archetype_sql(total_cols: Sequence[str]) -> str:
    """Explorer (2+ categories watched), Loyalist (1) or Inactive (0)."""
    n = " + ".join(f"CASE WHEN {ident(c)} > 0 THEN 1 ELSE 0 END" for c in total_cols)
    return case([(f"({n}) >= 2", "'Explorer'"), (f"({n}) = 1", "'Loyalist'")], "'Inactive'")


def archetype_engagement(wide: DataFrame, total_cols: Sequence[str]) -> DataFrame:
    """Multi-taste explorers vs single-taste loyalists: users and average Active."""
    return (
        wide.filter("Taste IS NOT NULL")
        .groupBy(F.expr(f"{archetype_sql(total_cols)} AS archetype"))
        .agg(F.expr("count(user_id) AS users"), F.expr("round(avg(Active), 2) AS avg_active"))
    )


def intent_vs_watch(wide: DataFrame, labels: Sequence[str] = DEFAULT_LABELS) -> DataFrame:
    """Month-B search-category distribution beside the most-watched distribution."""
    cb = ident(cat_col(labels[1]))
    search = (wide.filter(f"{cb} IS NOT NULL").groupBy(F.expr(f"{cb} AS category"))
              .agg(F.expr("count(user_id) AS users")).withColumn("side", F.lit("search")))
    watch = (wide.filter("MostWatch IS NOT NULL").groupBy(F.expr("MostWatch AS category"))
             .agg(F.expr("count(user_id) AS users")).withColumn("side", F.lit("watch")))
    return search.unionByName(watch).selectExpr(
        "side", "category", "users", "users / sum(users) OVER (PARTITION BY side) AS share")
