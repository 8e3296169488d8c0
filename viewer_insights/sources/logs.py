"""Readers for the raw logs.

* Search log: Parquet, one folder per day ``YYYYMMDD/`` (or ``day=YYYYMMDD/``
  when written by Spark's ``partitionBy``), columns ``user_id, keyword,
  datetime`` (text).  Several months are read in ONE scan; the month label
  comes from the folder name.
* Viewing log: JSON lines, one file per day ``YYYYMMDD.json`` (or
  ``day=YYYYMMDD/part-*.json``), with the nested record
  ``_source{Contract, AppName, TotalDuration}``; the day exists only in the
  path.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from viewer_insights import vocab
from viewer_insights.functions.sqltext import string
from viewer_insights.functions.timeparse import parse_log_time_sql

SEARCH_SCHEMA = StructType([
    StructField("user_id", StringType(), True),
    StructField("keyword", StringType(), True),
    StructField("datetime", StringType(), True),
])

VIEWING_SCHEMA = StructType([
    StructField("_source", StructType([
        StructField("Contract", StringType(), True),
        StructField("AppName", StringType(), True),
        StructField("TotalDuration", LongType(), True),
    ]), True),
])

# Month of a day folder: ``.../YYYYMMDD/<file>`` or ``.../day=YYYYMMDD/<file>``.
DAY_FOLDER_PATTERN = r"/(?:day=)?(\d{6})\d{2}/[^/]*$"
# Spark-written layout of the viewing log: ``day=YYYYMMDD/part-*.json``.
VIEW_DAY_FOLDER_PATTERN = r"/day=(\d{8})/[^/]*$"


def _months(m: str | Sequence[str]) -> list[str]:
    return [m] if isinstance(m, str) else list(m)


def read_search_log(spark: SparkSession, base: str, months: Mapping[str, str | Sequence[str]],
                    folder_prefix: str = "") -> DataFrame:
    """``months`` maps a label to one or more ``YYYYMM`` prefixes, e.g.
    ``{"t6": "202206", "t7": "202207"}``; ``folder_prefix="day="`` reads the
    Spark-written layout.

    Returns ``user_id, keyword, datetime, ts, period``.  Only the three
    declared columns are read; the month comes from the day folder in the
    file path, so all months share one scan and only their folders are listed.
    """
    root = base.rstrip("/")
    paths = [f"{root}/{folder_prefix}{yyyymm}*/*.parquet" for m in months.values() for yyyymm in _months(m)]
    raw = spark.read.schema(SEARCH_SCHEMA).parquet(*paths)
    folder_month = f"regexp_extract(_metadata.file_path, {string(DAY_FOLDER_PATTERN)}, 1)"
    labels: dict[str, str] = {}
    for label, m in months.items():
        for yyyymm in _months(m):
            labels.setdefault(yyyymm, label)
    # one map: the folder is taken from the path once per row, whatever the number of months
    period = f"element_at(map({', '.join(f'{string(m)}, {string(label)}' for m, label in labels.items())}), {folder_month})"
    return raw.selectExpr("user_id", "keyword", "datetime", f"{parse_log_time_sql('datetime')} AS ts",
                          f"{period} AS period")


def read_search_month(spark: SparkSession, base: str, yyyymm: str, folder_prefix: str = "") -> DataFrame:
    """One month: ``user_id, keyword, datetime, ts``."""
    raw = spark.read.schema(SEARCH_SCHEMA).parquet(f"{base.rstrip('/')}/{folder_prefix}{yyyymm}*/*.parquet")
    return raw.selectExpr("user_id", "keyword", "datetime", f"{parse_log_time_sql('datetime')} AS ts")


def file_date_sql(path_sql: str = "_metadata.file_path") -> str:
    """Day from a ``.../YYYYMMDD.json`` path (or a ``day=YYYYMMDD`` folder);
    NULL when the path carries no day."""
    by_name = f"nullif(regexp_extract({path_sql}, {string(vocab.VIEW_FILE_DATE_PATTERN)}, 1), '')"
    by_folder = f"nullif(regexp_extract({path_sql}, {string(VIEW_DAY_FOLDER_PATTERN)}, 1), '')"
    return f"try_to_date(coalesce({by_name}, {by_folder}), {string(vocab.VIEW_FILE_DATE_FORMAT)})"


def flatten_viewing(raw: DataFrame) -> DataFrame:
    """Nested viewing records -> ``user_id, app, duration, date``."""
    return raw.selectExpr(
        "_source.Contract AS user_id",
        "_source.AppName AS app",
        "CAST(_source.TotalDuration AS BIGINT) AS duration",
        f"{file_date_sql()} AS date",
    )


def read_viewing_log(spark: SparkSession, path_glob: str) -> DataFrame:
    """JSON lines with a fixed nested schema: unlisted fields are dropped, a
    quoted number under ``TotalDuration`` reads as NULL, a malformed line
    becomes an all-NULL row (PERMISSIVE)."""
    raw = spark.read.schema(VIEWING_SCHEMA).option("mode", "PERMISSIVE").json(path_glob)
    return flatten_viewing(raw)


#: Column of the viewing log's reader that holds a line Spark could not read as declared.
CORRUPT = "_corrupt_record"


def read_viewing_rejects(spark: SparkSession, path_glob: str) -> DataFrame:
    """The lines that ``read_viewing_log`` can't read as declared: ``file, date, line, reason``.

    ``malformed``: no JSON record; ``mistyped``: a record with a field of another type (the
    readable fields stay in the log, the others are NULL there).  A line that reads as declared
    is no reject, whatever its values.
    """
    schema = StructType([*VIEWING_SCHEMA.fields, StructField(CORRUPT, StringType(), True)])
    # read as text: the JSON reader refuses to return corrupt records alone
    lines = spark.read.text(path_glob).selectExpr("value", "_metadata.file_name AS file", f"{file_date_sql()} AS date")
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # a record parses as a variant whatever the types of its fields
    reason = "CASE WHEN try_parse_json(value) IS NULL THEN 'malformed' ELSE 'mistyped' END"
    return (lines.where("trim(value) <> ''").withColumn("_read", parsed).where(f"_read.{CORRUPT} IS NOT NULL")
            .selectExpr("file", "date", "value AS line", f"{reason} AS reason"))


def viewing_reject_counts(rejects: DataFrame) -> DataFrame:
    """Rejected lines per day and reason: ``date, reason, lines``."""
    return rejects.groupBy("date", "reason").agg(F.count(F.lit(1)).alias("lines"))
