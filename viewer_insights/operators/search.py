"""Search-log operators: clean, top keyword per user and month, scoring, keyword rules.

All operators are ``DataFrame -> DataFrame``.  A search log has the columns
``user_id STRING, keyword STRING, ts TIMESTAMP`` (plus ``period`` when several
months share one table).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from viewer_insights import vocab
from viewer_insights.functions.diacritics import fold_diacritics_sql
from viewer_insights.functions.rules import phrase_index, rule_case, rule_case_sql
from viewer_insights.functions.sqltext import case, ident, in_list, string
from viewer_insights.functions.text import is_present_sql, normalize_keyword_sql, not_junk_sql, word_count_sql
from viewer_insights.functions.timeparse import parse_log_time

DEFAULT_LABELS = ("t6", "t7")


def kw_col(label: str) -> str:
    return f"most_search_{label}"


def cnt_col(label: str) -> str:
    return f"cnt_{label}"


def cat_col(label: str) -> str:
    return f"category_{label}"


# ---------------------------------------------------------------------------
# B1, B2
# ---------------------------------------------------------------------------

def normalize_log_time(df: DataFrame, text_col: str = "datetime", out_col: str = "ts") -> DataFrame:
    """Add ``out_col``: the first of the fixed formats that parses ``text_col``."""
    return df.withColumn(out_col, parse_log_time(text_col))


def clean_search_log(df: DataFrame, user_col: str = "user_id", keyword_col: str = "keyword") -> DataFrame:
    """Drop rows with a NULL/blank user or keyword; keyword := trim(lower(keyword))."""
    return df.filter(F.expr(f"{is_present_sql(user_col)} AND {is_present_sql(keyword_col)}")).withColumn(
        keyword_col, F.expr(normalize_keyword_sql(ident(keyword_col)))
    )


# ---------------------------------------------------------------------------
# B3, B4: top keyword per user and month
# ---------------------------------------------------------------------------

def _rank_key_sql(ts_type) -> str:
    """Struct whose *minimum* is the winning keyword of a user.

    Order: count desc, last_seen desc with NULL last, keyword asc.  ``min`` of
    a struct is an algebraic aggregate, so Spark combines it map-side: a user
    with very many rows never has to be gathered whole into one task.
    """
    epoch = "TIMESTAMP_NTZ '1970-01-01'" if isinstance(ts_type, TimestampNTZType) else "TIMESTAMP '1970-01-01 00:00:00Z'"
    return (f"struct(-n AS neg_count, last_seen IS NULL AS no_time, -(last_seen - {epoch}) AS neg_time, "
            f"keyword AS keyword)")


def keyword_counts(df: DataFrame, keys: Sequence[str] = ("user_id",)) -> DataFrame:
    """(keys, keyword) -> number of searches and latest search time."""
    return df.groupBy(*keys, "keyword").agg(F.expr("count(1) AS n"), F.expr("max(ts) AS last_seen"))


# Tasks over which the keywords of one user are dealt where a log has partitions of its own number.
USER_SHARES = 16
SHARE = "_share"


def _best_per_user(df: DataFrame, keys: Sequence[str], best: dict[str, str], total: dict[str, str],
                   partitions: int | None) -> DataFrame:
    """Per user the least of each rank key (``best``: column -> SQL over ``keyword_counts``) and the sums (``total``).

    Spark deals both aggregations over the session's number of shuffle partitions.  With ``partitions`` the rows
    are dealt over so many tasks: by user and share of the user's keywords first, where each share is reduced to
    one row, then by user.  A user with very many rows is spread over ``USER_SHARES`` tasks.
    """
    def reduced(rows: DataFrame, by: Sequence[str], least: dict[str, str], sums: dict[str, str]) -> DataFrame:
        return rows.groupBy(*by).agg(*(F.expr(f"min({x}) AS {ident(c)}") for c, x in least.items()),
                                     *(F.expr(f"sum({x}) AS {ident(c)}") for c, x in sums.items()))

    if partitions is None:
        return reduced(keyword_counts(df, keys), ["user_id"], best, total)
    dealt = df.withColumn(SHARE, F.expr(f"CAST(pmod(xxhash64(keyword), {USER_SHARES}) AS INT)")).repartition(partitions, "user_id", SHARE)
    shares = reduced(keyword_counts(dealt, [*keys, SHARE]), ["user_id", SHARE], best, total)
    again = [{c: ident(c) for c in d} for d in (best, total)]
    return reduced(shares.repartition(partitions, "user_id"), ["user_id"], *again)


def top_keyword(df: DataFrame, label: str, partitions: int | None = None) -> DataFrame:
    """Per user of one month: most searched keyword and the user's total searches.

    Returns ``user_id, most_search_<label>, cnt_<label>``.  ``partitions`` as in ``monthly_top_keywords``.
    """
    key = _rank_key_sql(df.schema["ts"].dataType)
    best = _best_per_user(df, ["user_id"], {"_best": key}, {cnt_col(label): "n"}, partitions)
    return best.selectExpr("user_id", f"_best.keyword AS {ident(kw_col(label))}", ident(cnt_col(label)))


def month_over_month(a: DataFrame, b: DataFrame) -> DataFrame:
    """Full outer join of two months' top keywords on ``user_id``."""
    return a.join(b, on="user_id", how="full")


def monthly_top_keywords(df: DataFrame, labels: Sequence[str] = DEFAULT_LABELS, period_col: str = "period",
                         partitions: int | None = None) -> DataFrame:
    """One pass over a multi-month log: the same rows as ``month_over_month`` of
    ``top_keyword`` per label, without the join.

    A user appears when they searched in at least one of ``labels``; a month
    without searches gives NULL keyword and NULL count, as the outer join does.
    ``partitions`` (``sizing.partitions_for``) deals a log that is too large for the
    session's number of shuffle partitions over so many tasks.
    """
    p = ident(period_col)
    key = _rank_key_sql(df.schema["ts"].dataType)
    best = {f"_best_{lab}": f"CASE WHEN {p} = {string(lab)} THEN {key} END" for lab in labels}
    total = {cnt_col(lab): f"CASE WHEN {p} = {string(lab)} THEN n END" for lab in labels}
    per_user = _best_per_user(df.filter(F.expr(in_list(p, list(labels)))), ["user_id", period_col], best, total, partitions)
    cols = ["user_id"]
    for lab in labels:
        cols += [f"{ident('_best_' + lab)}.keyword AS {ident(kw_col(lab))}", ident(cnt_col(lab))]
    return per_user.selectExpr(*cols)


# ---------------------------------------------------------------------------
# B5, B6: scoring and top users
# ---------------------------------------------------------------------------

def intent_multiplier_sql(keyword: str, high_pattern: str, genre_pattern: str) -> str:
    k = ident(keyword)
    return case(
        [(f"{k} RLIKE {string(high_pattern)}", f"{vocab.MULTIPLIER_HIGH_INTENT!r}D"),
         (f"{k} RLIKE {string(genre_pattern)}", f"{vocab.MULTIPLIER_GENRE_INTENT!r}D"),
         (f"{word_count_sql(keyword)} BETWEEN {vocab.TITLE_MIN_WORDS} AND {vocab.TITLE_MAX_WORDS}",
          f"{vocab.MULTIPLIER_TITLE_LIKE!r}D")],
        f"{vocab.MULTIPLIER_DEFAULT!r}D",
    )


def intent_multiplier(keyword: str, high_pattern: str, genre_pattern: str) -> Column:
    return F.expr(intent_multiplier_sql(keyword, high_pattern, genre_pattern))


def drop_junk_users(users: DataFrame, labels: Sequence[str] = DEFAULT_LABELS) -> DataFrame:
    """Drop users whose month-B keyword is junk (one character or a long digit run)."""
    return users.filter(F.expr(not_junk_sql(kw_col(labels[1]))))


def score_users(
    users: DataFrame,
    labels: Sequence[str] = DEFAULT_LABELS,
    high_pattern: str = vocab.HIGH_INTENT_PATTERN,
    genre_pattern: str = vocab.GENRE_INTENT_PATTERN,
) -> DataFrame:
    """Score users (after ``drop_junk_users``).

    ``base = 1.5*cnt_B + 1.0*cnt_A + 50*[both > 0]`` (NULL counts as 0),
    ``movie_score = base * multiplier(month-B keyword)``.
    """
    a, b = labels
    kb = kw_col(b)
    ca, cb = ident(cnt_col(a)), ident(cnt_col(b))
    base = (f"CAST(coalesce({cb}, 0) * {vocab.WEIGHT_MONTH_B!r}D + coalesce({ca}, 0) * {vocab.WEIGHT_MONTH_A!r}D"
            f" + CASE WHEN {ca} > 0 AND {cb} > 0 THEN {vocab.BOTH_MONTHS_BONUS} ELSE 0 END AS DOUBLE)")
    return (
        users.withColumns({
            "word_count": F.expr(word_count_sql(kb)),
            "intent_multiplier": F.expr(intent_multiplier_sql(kb, high_pattern, genre_pattern)),
            "base_score": F.expr(base),
        })
        .withColumn("movie_score", F.expr("base_score * intent_multiplier"))
    )


def top_users(scored: DataFrame, n: int = vocab.TOP_USERS_N, labels: Sequence[str] = DEFAULT_LABELS) -> DataFrame:
    """The ``n`` best-scored users (score desc, user_id asc): a bounded top-k."""
    a, b = labels
    return (
        scored.orderBy(F.col("movie_score").desc(), F.col("user_id").asc())
        .limit(n)
        .select("user_id", kw_col(a), kw_col(b))
    )


# ---------------------------------------------------------------------------
# B7, B8, B9: distinct keywords and rule categories
# ---------------------------------------------------------------------------

def distinct_keywords(users: DataFrame, labels: Sequence[str] = DEFAULT_LABELS) -> DataFrame:
    """Distinct non-NULL keywords over the months' keyword columns (one scan)."""
    arr = ", ".join(ident(kw_col(lab)) for lab in labels)
    return users.selectExpr(f"explode(array({arr})) AS keyword").filter("keyword IS NOT NULL").distinct()


def categorize(keywords: DataFrame, rules, keyword_col: str = "keyword", fold_diacritics: bool = False) -> DataFrame:
    """Add ``category``: first matching rule in rule order, else ``Unmapped``.
    ``fold_diacritics`` matches the keyword with Latin accents removed."""
    subject = fold_diacritics_sql(ident(keyword_col)) if fold_diacritics else None
    return keywords.withColumn("category", rule_case(keyword_col, rules, subject_sql=subject))


def word_parts_sql(subject_sql: str) -> str:
    """A text in lower case as an array of its ASCII words and the gaps between them in turn, a word first."""
    return f"regexp_extract_all(regexp_replace(lower({subject_sql}), '^[^a-z0-9_]+', ''), '([a-z0-9_]+|[^a-z0-9_]+)', 1)"


def stretches_sql(parts: str, n_words: int) -> str:
    """The stretches from the start of one word to the end of a later one, ``n_words`` words at most, of an
    array column of ``word_parts_sql``: all that a plain phrase between two word boundaries can be."""
    return (f"flatten(transform({parts}, (x, i) -> CASE WHEN i % 2 = 1 THEN array() ELSE "
            f"transform(sequence(1, least({int(n_words)}, CAST((size({parts}) - i + 1) / 2 AS INT))), "
            f"n -> array_join(slice({parts}, i + 1, 2 * n - 1), '')) END))")


def categorize_by_index(keywords: DataFrame, rules, keyword_col: str = "keyword", fold_diacritics: bool = False) -> DataFrame:
    """``categorize`` for long rule tables: the same categories, in a time that does not grow with the phrases.

    Plain phrases (words that match themselves) are looked up: every stretch of a keyword's words as long as
    the longest phrase at most is joined to the table of phrases, and the phrase of the earliest rule wins.
    The lookup runs once per distinct keyword and is combined map-side (``min``); only phrases with
    regular-expression syntax or other than ASCII letters stay patterns in a CASE.  A keyword with a
    character outside ASCII next to a word is judged by the CASE of all rules, as Java's word boundaries
    decide there.  ``keyword_col`` is unique in ``keywords``; NULL keywords are ``Unmapped``.
    """
    plain, patterns = phrase_index(rules)
    col = ident(keyword_col)
    subject = fold_diacritics_sql(col) if fold_diacritics else col
    if not plain:
        return categorize(keywords, rules, keyword_col, fold_diacritics)
    longest = max(len(re.findall(r"\w+", p, re.ASCII)) for p in plain)
    spark = keywords.sparkSession
    index = spark.createDataFrame(list(plain.items()), "_phrase string, _place int")  # MAX_RULE_PHRASES rows at most
    names = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(rules)], "_rule int, _category string")
    ascii_only = f"NOT {subject} RLIKE '[^\\\\x00-\\\\x7F]'"
    parts = keywords.where(ascii_only).select(F.col(keyword_col).alias("_kw"), F.expr(word_parts_sql(subject)).alias("_parts"))
    stretches = parts.select("_kw", F.explode(F.expr(f"array_distinct({stretches_sql('_parts', longest)})")).alias("_stretch"))
    found = stretches.join(F.broadcast(index), F.col("_stretch") == F.col("_phrase")).groupBy("_kw").agg(F.min("_place").alias("_looked_up"))
    searched = case([(f"{subject} RLIKE {string(p)}", str(place)) for place, _, p in patterns])
    slow = rule_case_sql(keyword_col, rules, subject_sql=subject)
    first = F.expr(f"least(_looked_up, {searched})") if patterns else F.col("_looked_up")
    judged = (keywords.join(found, F.col(keyword_col) == F.col("_kw"), "left").withColumn("_first", first)
              .join(F.broadcast(names), F.col("_first") == F.col("_rule"), "left"))
    category = f"CASE WHEN {ascii_only} THEN coalesce(_category, {string(vocab.UNMAPPED)}) ELSE {slow} END"
    return judged.select(*(F.col(c) for c in keywords.columns), F.expr(category).alias("category"))


def split_review_queue(categorized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(mapped, review): the review queue carries ``family`` = the keyword itself."""
    mapped = categorized.filter(F.expr(f"category <> {string(vocab.UNMAPPED)}"))
    review = categorized.filter(F.expr(f"category = {string(vocab.UNMAPPED)}")).selectExpr(
        "keyword", "keyword AS family", "category"
    )
    return mapped, review
