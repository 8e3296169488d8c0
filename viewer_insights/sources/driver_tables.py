"""Adapters from the shared benchmark tables to the pipeline's input shapes.

* search log  = ``orders JOIN lineitem JOIN part``, all rows: the customer
  searched for the part name at a time on the order date; orders before
  ``SEARCH_SPLIT`` are month A (``t6``), the others month B (``t7``).
* viewing log = all ``events``: ``event_type`` plays the role of the
  application code and ``floor(value)`` the watched seconds.

Raw logs are dirty.  Some rows, told by their keys, have a NULL or blank user
or keyword, a padded upper-case keyword, one of a single character, a long
digit run, a line break, quotes and commas, or accents; some viewing rows have
a bad or missing account.  The same mapping is written in SQL by the oracle
queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewer_insights.operators.sizing import partitions_for
from viewer_insights.session import application

# FIXED VALUES of the fixture mapping (shared with the oracle SQL).
SEARCH_SPLIT = "1998-05-01"
FIXTURE_APP_MAP = {"view": "Live_TV", "click": "Movies", "purchase": "Relax", "signup": "Kids"}
FIXTURE_CATEGORIES = ("Live_TV", "Movies", "Relax", "Kids", "Sports")
FIXTURE_CATEGORY_COLUMNS = {c: c for c in FIXTURE_CATEGORIES}
FIXTURE_HIGH_INTENT = "(gizmo|widget)"
FIXTURE_GENRE_INTENT = "(ring|rod)"


_RELATIONS: dict[tuple[str, str], DataFrame] = {}


_ROWS: dict[tuple[str, str], int] = {}


def forget_relations() -> None:
    _RELATIONS.clear()
    _ROWS.clear()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet relation of one benchmark table.

    The relation (schema from the footers and the file listing) is resolved
    once per session and reused by every query built afterwards; the tables
    are read-only.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (application(spark), path)
    df = _RELATIONS.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(path)
        _RELATIONS[key] = df
    return df


USER_SQL = "CASE o_orderkey % 89 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE CAST(o_custkey AS STRING) END"
KEYWORD_SQL = """CASE WHEN (o_orderkey + l_partkey) % 97 = 0 THEN NULL WHEN (o_orderkey + l_partkey) % 97 = 1 THEN '   '
  WHEN o_custkey % 31 = 5 THEN '12345678' WHEN o_custkey % 31 = 6 THEN substr(p_name, 1, 1)
  WHEN o_custkey % 31 = 7 THEN concat(p_name, '\n', 'b') WHEN o_custkey % 31 = 8 THEN concat(p_name, ', "q"')
  WHEN o_custkey % 31 = 9 THEN translate(p_name, 'eo', 'éô') WHEN o_custkey % 31 = 10 THEN concat('  ', upper(p_name), ' ')
  ELSE p_name END"""
TIME_SQL = "o_orderdate + make_dt_interval(0, 0, 0, CAST(o_orderkey * 7919 % 86400 AS DECIMAL(18, 6)))"


def search_partitions(spark: SparkSession, sf_dir: str) -> int | None:
    """Shuffle partitions for the search log, from its number of rows (the file footers have it: no column is read)."""
    key = (application(spark), sf_dir)
    if key not in _ROWS:
        _ROWS[key] = table(spark, sf_dir, "lineitem").count()
    return partitions_for(spark, _ROWS[key])


def _search_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    n = search_partitions(spark, sf_dir)
    if n is not None:  # Spark deals the rows of the larger side of each join in the same way
        orders, part = orders.repartition(n, "o_orderkey"), part.repartition(n, "p_partkey")
    joined = orders.join(lineitem, F.expr("o_orderkey = l_orderkey")).join(part, F.expr("l_partkey = p_partkey"))
    return joined.selectExpr(
        f"{USER_SQL} AS user_id",
        f"{KEYWORD_SQL} AS keyword",
        f"{TIME_SQL} AS ts",
        f"CASE WHEN o_orderdate < TIMESTAMP_NTZ '{SEARCH_SPLIT}' THEN 't6' ELSE 't7' END AS period",
        "o_orderkey",
    )


def search_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_id STRING, keyword STRING, ts TIMESTAMP_NTZ, period STRING``.

    Only the join keys and three payload columns are read.
    """
    return _search_rows(spark, sf_dir).drop("o_orderkey")


def search_month(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """One month of the search log (the shape of one monthly folder)."""
    return search_log(spark, sf_dir).filter(F.expr(f"period = '{label}'")).drop("period")


def raw_search_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search log as raw rows: ``user_id, keyword, datetime`` text in the
    four timestamp styles of the original logs (24 h, 12 h with the
    Vietnamese markers, fractions, ISO), plus ``day`` = ``YYYYMMDD``, a day of
    June 2022 for month A and of July 2022 for month B."""
    text = (
        "CASE o_orderkey % 4 "
        "WHEN 0 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') "
        "WHEN 1 THEN replace(replace(date_format(ts, 'yyyy-MM-dd h:mm:ss a'), ' PM', ' CH'), ' AM', ' SA') "
        "WHEN 2 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSS') "
        "ELSE date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") END"
    )
    day = "concat(CASE period WHEN 't6' THEN '202206' ELSE '202207' END, lpad(o_orderkey % 28 + 1, 2, '0'))"
    return _search_rows(spark, sf_dir).selectExpr("user_id", "keyword", f"{text} AS datetime", f"{day} AS day")


VIEWER_SQL = "CASE event_id % 53 WHEN 0 THEN concat('#', user_id) WHEN 1 THEN NULL ELSE CAST(user_id AS STRING) END"


def raw_viewing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as viewing-log rows ``user_id, app, duration, day``."""
    ev = table(spark, sf_dir, "events")
    return ev.selectExpr(
        f"{VIEWER_SQL} AS user_id",
        "event_type AS app",
        "TRY_CAST(floor(value) AS BIGINT) AS duration",
        "date_format(ts, 'yyyyMMdd') AS day",
    )


VIEWING_LINE_SQL = """CASE event_id % 101
  WHEN 0 THEN concat('{"_source":{"Contract":"', event_id, '","AppName":"', event_type)
  WHEN 1 THEN concat('{"_source":{"Contract":"', event_id, '","TotalDuration":"', event_id, '"}}')
  WHEN 2 THEN concat('not a record ', event_id)
  ELSE concat('{"_source":{"Contract":"', user_id, '","AppName":"', event_type, '","TotalDuration":', CAST(floor(value) AS BIGINT), '}}') END"""


def dirty_viewing_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as lines of JSON day files, some of them cut off, mistyped or no record: ``value, day``."""
    return table(spark, sf_dir, "events").selectExpr(f"{VIEWING_LINE_SQL} AS value", "date_format(ts, 'yyyyMMdd') AS day")


def viewing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_id STRING, app STRING, duration BIGINT, date DATE`` - the flattened
    viewing-log shape (``Contract, AppName, TotalDuration`` + file date)."""
    ev = table(spark, sf_dir, "events")
    return ev.selectExpr(
        f"{VIEWER_SQL} AS user_id",
        "event_type AS app",
        "TRY_CAST(floor(value) AS BIGINT) AS duration",
        "CAST(ts AS DATE) AS date",
    )
