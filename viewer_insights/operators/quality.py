"""Data-quality reports on the keyword rules."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewer_insights.functions.rules import rule_case_sql
from viewer_insights.vocab import UNMAPPED


_ESCAPED = re.compile(r"\\([^A-Za-z0-9])")
_PATTERN = re.compile(r"[\\.\[\](){}*+?|^$]")


def literal_text(phrase: str) -> str | None:
    """The text a phrase stands for (escaped punctuation as itself); None if it is a real pattern."""
    if _PATTERN.search(_ESCAPED.sub("", phrase)):
        return None
    return _ESCAPED.sub(r"\1", phrase)


def rule_conflicts(spark: SparkSession, rules: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """Literal phrases that can never produce their own category as a whole keyword.

    Each phrase's text is run through the full ordered rule set: an earlier
    rule may claim it (``mu`` inside ``hai tac mu rom``), or no rule may match
    it at all (``18+``: a word boundary after ``+`` needs a following word
    character).  Phrases that are patterns (``tap \\d+``) stand for many texts
    and are not judged.  One row per phrase: ``priority, category, phrase,
    text, assigned``; only conflicts.
    """
    rows = [(i, cat, p, literal_text(p)) for i, (cat, phrases) in enumerate(rules) for p in phrases if p]
    table = spark.createDataFrame([r for r in rows if r[3] is not None],
                                  "priority INT, category STRING, phrase STRING, text STRING")
    assigned = table.withColumn("assigned", F.expr(rule_case_sql("text", rules, UNMAPPED)))
    return assigned.filter("assigned <> category")
