"""Label expressions: category per month, user status, preference change, journey."""

from __future__ import annotations

from viewer_insights.functions.sqltext import case, ident, string
from viewer_insights.vocab import (
    CHANGED,
    CHURNED_USER,
    JOURNEY_ARROW,
    NEW_USER,
    NO_SEARCH,
    OTHER,
    RETAINED_USER,
    UNCHANGED,
)


def month_category_sql(keyword: str, looked_up_sql: str) -> str:
    """No keyword -> No_Search; keyword without a category -> Other."""
    return case([(f"{ident(keyword)} IS NULL", string(NO_SEARCH))], f"coalesce({looked_up_sql}, {string(OTHER)})")


def user_status_sql(cat_a: str, cat_b: str) -> str:
    """New if no month-A search, else Churned if no month-B search, else Retained."""
    return case(
        [(f"{ident(cat_a)} = {string(NO_SEARCH)}", string(NEW_USER)),
         (f"{ident(cat_b)} = {string(NO_SEARCH)}", string(CHURNED_USER))],
        string(RETAINED_USER),
    )


def preference_change_sql(cat_a: str, cat_b: str) -> str:
    return case([(f"{ident(cat_a)} = {ident(cat_b)}", string(UNCHANGED))], string(CHANGED))


def journey_sql(cat_a: str, cat_b: str) -> str:
    """``A`` when unchanged, else ``A -> B``."""
    a, b = ident(cat_a), ident(cat_b)
    return case([(f"{a} = {b}", a)], f"concat({a}, {string(JOURNEY_ARROW)}, {b})")
