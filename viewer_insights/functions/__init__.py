"""Expression building blocks.

``*_sql`` functions return Spark SQL expression text (composed into one
``F.expr`` per generated expression); the plain-named functions return the
same expression as a ``Column``.
"""

from viewer_insights.functions.diacritics import fold_diacritics, fold_diacritics_sql
from viewer_insights.functions.labels import journey_sql, month_category_sql, preference_change_sql, user_status_sql
from viewer_insights.functions.rules import SAMPLE_RULES, compile_rules, rule_case, rule_case_sql, rules_from_table
from viewer_insights.functions.timeparse import english_ampm, parse_log_time, parse_log_time_sql

__all__ = [
    "SAMPLE_RULES",
    "compile_rules",
    "english_ampm",
    "fold_diacritics",
    "fold_diacritics_sql",
    "journey_sql",
    "month_category_sql",
    "parse_log_time",
    "parse_log_time_sql",
    "preference_change_sql",
    "rule_case",
    "rule_case_sql",
    "rules_from_table",
    "user_status_sql",
]
