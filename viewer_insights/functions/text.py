"""Keyword-text expressions (SQL text builders)."""

from __future__ import annotations

from viewer_insights.functions.sqltext import ident, string
from viewer_insights.vocab import JUNK_DIGITS_PATTERN, JUNK_MIN_LENGTH

WHITESPACE_EDGES = r"^\s+|\s+$"


def is_present_sql(c: str) -> str:
    """Not NULL and not blank (blank = only spaces, as Spark ``trim``)."""
    return f"({ident(c)} IS NOT NULL AND trim({ident(c)}) <> '')"


def normalize_keyword_sql(c_sql: str) -> str:
    """``trim(lower(c))`` - the key used for counting and dictionary lookup."""
    return f"trim(lower({c_sql}))"


def strip_all_whitespace_sql(c_sql: str) -> str:
    """Remove leading/trailing white space of any kind (tabs, newlines too)."""
    return f"regexp_replace({c_sql}, {string(WHITESPACE_EDGES)}, '')"


def not_junk_sql(c: str) -> str:
    """NULL-tolerant junk test: keep NULL, drop 1-char and long digit runs."""
    q = ident(c)
    return (f"({q} IS NULL OR (length({q}) >= {JUNK_MIN_LENGTH} "
            f"AND NOT {q} RLIKE {string(JUNK_DIGITS_PATTERN)}))")


def word_count_sql(c: str) -> str:
    """Words split on single blanks (``'a  b'`` counts 3); NULL for NULL."""
    q = ident(c)
    return f"CASE WHEN {q} IS NOT NULL THEN size(split({q}, ' ')) END"

