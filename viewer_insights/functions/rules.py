"""Ordered keyword rules: first matching category wins.

A rule set is data: an ordered list of ``(category, [phrase, ...])`` where each
phrase is a regular-expression fragment.  Each category compiles into one
case-insensitive, word-bounded alternation ``(?i)\\b(p1|p2|...)\\b``; the set
compiles into a single CASE expression evaluated by Spark's code generator.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewer_insights.functions.sqltext import case, ident, string
from viewer_insights.vocab import UNMAPPED

# Upper bound for a rule table read from storage.  The table becomes one
# expression on the driver, so its size must be bounded.
MAX_RULE_PHRASES = 20_000

# A small sample rule set (ASCII), used by the fixture queries and tests.
SAMPLE_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Warm", ("red", "hot")),
    ("Cool", ("blue", "cold")),
    ("Hardware", ("gear", "rod", "bolt")),
)


def category_pattern(phrases: Iterable[str]) -> str:
    return r"(?i)\b(" + "|".join(phrases) + r")\b"


def compile_rules(rules: Sequence[tuple[str, Sequence[str]]]) -> list[tuple[str, str]]:
    """``[(category, pattern)]`` in priority order."""
    out = []
    for category, phrases in rules:
        phrases = [p for p in phrases if p]
        if phrases:
            out.append((category, category_pattern(phrases)))
    return out


def rule_case_sql(c: str, rules: Sequence[tuple[str, Sequence[str]]], default: str | None = UNMAPPED,
                  subject_sql: str | None = None) -> str:
    """``CASE WHEN c RLIKE p1 THEN cat1 WHEN ... ELSE default END`` (SQL text).

    ``subject_sql`` replaces the plain column as the matched text (e.g. a
    folded form of it)."""
    d = string(default) if default is not None else None
    subject = subject_sql or ident(c)
    return case(((f"{subject} RLIKE {string(p)}", string(cat)) for cat, p in compile_rules(rules)), d)


def rule_case(c: str, rules: Sequence[tuple[str, Sequence[str]]], default: str = UNMAPPED,
              subject_sql: str | None = None) -> Column:
    """First matching rule's category for column ``c``, else ``default``."""
    return F.expr(rule_case_sql(c, rules, default, subject_sql))


def rules_from_table(table: DataFrame, max_phrases: int = MAX_RULE_PHRASES):
    """Build a rule set from a table ``(priority INT, category STRING, phrase STRING)``.

    The table is configuration (hundreds of phrases), so it is brought to the
    driver - but only after checking that it is within ``max_phrases``.  The
    first match by priority wins, also where a category has several priorities.
    """
    bounded = table.select("priority", "category", "phrase").limit(max_phrases + 1).collect()
    if len(bounded) > max_phrases:
        raise ValueError(f"rule table has more than {max_phrases} phrases")
    if any(r["priority"] is None or r["category"] is None for r in bounded):
        raise ValueError("a rule needs a priority and a category")
    rows = sorted(bounded, key=lambda r: (r["priority"], r["category"], r["phrase"] or ""))
    # neighbours in priority order share a branch; a category that comes again later is a branch of its own
    return [(category, tuple(r["phrase"] for r in group if r["phrase"])) for category, group in groupby(rows, key=lambda r: r["category"])]


# A phrase without regular-expression syntax: words, and single characters between them that match themselves.
_PLAIN = re.compile(r"[\w \-'&/,:;!#%@=<>\"~`]+")


def is_plain(phrase: str) -> bool:
    """Whether a phrase matches only itself (letter case aside) and begins and ends with an ASCII word
    character, so that it can be looked up instead of searched for.

    Only ASCII phrases count: Java's ``\\b`` and ``(?i)`` treat other letters by rules of their own, so
    they stay patterns."""
    ascii_word = lambda c: c.isalnum() or c == "_"
    return bool(phrase) and phrase.isascii() and bool(_PLAIN.fullmatch(phrase)) and ascii_word(phrase[0]) and ascii_word(phrase[-1])


def phrase_index(rules: Sequence[tuple[str, Sequence[str]]]) -> tuple[dict[str, int], list[tuple[int, str, str]]]:
    """A rule set as ``(plain phrase in lower case -> place of its first rule, [(place, category, pattern)])``:
    the patterns hold the phrases that can't be looked up."""
    plain: dict[str, int] = {}
    patterns = []
    for place, (category, phrases) in enumerate(rules):
        odd = [p for p in phrases if p and not is_plain(p)]
        for phrase in phrases:
            if phrase and is_plain(phrase):
                plain.setdefault(phrase.lower(), place)
        if odd:
            patterns.append((place, category, category_pattern(odd)))
    return plain, patterns
