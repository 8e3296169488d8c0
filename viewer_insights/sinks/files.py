"""File outputs: Parquet stage tables and CSV exports for people and BI tools.

All writes are distributed (one file per task); nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewer_insights.functions.sqltext import ident
from viewer_insights.sources.dictionary import CSV_OPTIONS, SHEET_CATEGORY, SHEET_FAMILY, SHEET_KEYWORD

# Writers of one day: a busy day is split over so many tasks and files.
FILES_PER_DAY = 8
# With a number of writing tasks: one file a day at least for so many of them (months have about 30 days).
FILES_OF_PARTITIONS = 16


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Stage table (users, rule dictionary, search master, viewing master)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_indexed_parquet(df: DataFrame, path: str, sort_by: Sequence[str], lookup: Sequence[str] = (), mode: str = "overwrite") -> None:
    """A Parquet table with access paths: rows range-partitioned and sorted by ``sort_by``, so that a filter on
    these columns skips files and row groups by their least and greatest values, and a Bloom filter on each
    column of ``lookup``, so that a lookup of one value skips those without it.

    Equal sort keys would meet in one task: a hash of the lookup columns (of the whole row without any) is the
    last range key, so a value that a third of the rows share is dealt over several files.
    """
    last = F.expr(f"xxhash64({', '.join(ident(c) for c in (lookup or df.columns))})")
    w = df.repartitionByRange(*(F.col(ident(c)) for c in sort_by), last).sortWithinPartitions(*(ident(c) for c in sort_by)).write.mode(mode)
    for c in lookup:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV as spreadsheets write it: quotes doubled inside quotes, white space kept."""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def export_review_queue(review: DataFrame, path: str) -> None:
    """Unmapped keywords for review, with the sheet's header names."""
    write_csv(
        review.select(
            F.col("keyword").alias(SHEET_KEYWORD),
            F.col("family").alias(SHEET_FAMILY),
            F.col("category").alias(SHEET_CATEGORY),
        ),
        path,
    )


def export_table(df: DataFrame, path: str) -> None:
    """Transition matrix / wide table as CSV with a header."""
    write_csv(df, path)


def write_search_log(df: DataFrame, root: str, day_col: str = "day", files_per_day: int = FILES_PER_DAY,
                     partitions: int | None = None) -> None:
    """Search log in day folders (``day=YYYYMMDD/``): ``user_id, keyword, datetime``.

    Rows are shuffled by (day, bucket) first so each day folder gets
    ``files_per_day`` files at most instead of one small file per writing task.
    ``partitions`` (``sizing.partitions_for``) is the number of writing tasks of a large log; its days get more
    files where so many tasks would not all have some."""
    out = df.select("user_id", "keyword", "datetime", day_col)
    _by_day(out, day_col, max(files_per_day, (partitions or 0) // FILES_OF_PARTITIONS), partitions).write.mode("overwrite").partitionBy(day_col).parquet(root)


def write_viewing_log(df: DataFrame, root: str, day_col: str = "day", files_per_day: int = FILES_PER_DAY) -> None:
    """Viewing log as JSON lines with the nested ``_source`` record, in day
    folders (``day=YYYYMMDD/``).  Input: ``user_id, app, duration, day``."""
    nested = df.selectExpr(
        "named_struct('Contract', user_id, 'AppName', app, 'TotalDuration', duration) AS _source", day_col)
    _by_day(nested, day_col, files_per_day).write.mode("overwrite").partitionBy(day_col).json(root)


def _by_day(df: DataFrame, day_col: str, files_per_day: int, partitions: int | None = None) -> DataFrame:
    # several writers per day; the bucket depends on the row alone, so a repeated task deals alike
    bucket = F.pmod(F.xxhash64(*df.columns), F.lit(int(files_per_day)))
    return df.repartition(*([partitions] if partitions else []), day_col, bucket)
