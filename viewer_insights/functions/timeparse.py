"""Tolerant parsing of search-log timestamp text (mixed 24 h / 12 h forms)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from viewer_insights.functions.sqltext import case, ident, string
from viewer_insights.vocab import AMPM_MARKERS, TIMESTAMP_FORMATS


def english_ampm_sql(text_sql: str) -> str:
    """Replace the Vietnamese AM/PM markers by their English form."""
    out = text_sql
    for marker, english in AMPM_MARKERS.items():
        out = f"regexp_replace({out}, {string(marker)}, {string(english)})"
    return out


# A pattern of plain fields, in which a text can match only with the same blanks, dots and day halves.
_PLAIN_FORMAT = re.compile(r"[yMdHhmsSa :./-]+")
# Patterns whose texts Spark's cast reads as the same time, many times faster.
_CAST_FORMAT = re.compile(r"yyyy-MM-dd HH:mm:ss(\.S{1,6})?")


def _fits(fmt: str | None, blank: bool, dot: bool, half: bool) -> bool:
    """Whether a text with or without a blank, a dot and a half of the day (AM, PM) can match ``fmt`` at all."""
    if fmt is None or not _PLAIN_FORMAT.fullmatch(fmt):
        return True
    return (" " in fmt, "." in fmt, "a" in fmt) == (blank, dot, half)


def parse_log_time_sql(text_col: str, formats=TIMESTAMP_FORMATS) -> str:
    """First successful parse among ``formats`` (in order); NULL if none.

    ``try_to_timestamp`` returns NULL instead of raising under ANSI mode, so
    a single bad row never fails the job.  ``None`` in ``formats`` means
    Spark's default cast rules (ISO forms, date only, fractions).  A failed
    attempt costs far more than a look at the text, so only the formats that
    texts of the same shape can match are tried, the cast before the patterns
    that it reads alike; the AM/PM rewrite runs only on texts with a half of the day.
    """
    text = ident(text_col)
    halves = "|".join(["[mM]", *AMPM_MARKERS])
    blank, dot, half = f"contains({text}, ' ')", f"contains({text}, '.')", f"{text} RLIKE {string(halves)}"

    def attempts(*shape: bool) -> str:
        s = english_ampm_sql(text) if shape[-1] else text
        order = [fmt for fmt in formats if _fits(fmt, *shape)]
        if None in order and all(_CAST_FORMAT.fullmatch(fmt) for fmt in order[:order.index(None)]):
            order.insert(0, order.pop(order.index(None)))
        tried = [f"try_to_timestamp({s})" if fmt is None else f"try_to_timestamp({s}, {string(fmt)})" for fmt in order]
        return f"coalesce({', '.join(tried)})" if tried else "CAST(NULL AS TIMESTAMP)"

    def by_shape(*known: bool) -> str:
        if len(known) == 3:
            return attempts(*known)
        return case([((blank, dot, half)[len(known)], by_shape(*known, True))], by_shape(*known, False))

    return by_shape()


def english_ampm(text_col: str) -> Column:
    return F.expr(english_ampm_sql(ident(text_col)))


def parse_log_time(text_col: str, formats=TIMESTAMP_FORMATS) -> Column:
    return F.expr(parse_log_time_sql(text_col, formats))
