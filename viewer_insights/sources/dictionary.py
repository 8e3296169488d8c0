"""Keyword dictionaries: the reviewed (manual) sheet and the rule table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewer_insights.functions.rules import MAX_RULE_PHRASES, rules_from_table

# FIXED VALUES: header of the review sheet exported for people and read back.
SHEET_KEYWORD = "Keyword_Gốc"
SHEET_FAMILY = "Trưởng_Họ_(Family)"
SHEET_CATEGORY = "category"

# CSV as spreadsheets save it (RFC 4180): quotes doubled, line breaks inside quotes, white space kept.
CSV_OPTIONS = {"header": "true", "encoding": "UTF-8", "quote": '"', "escape": '"',
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

class DictionaryNotFound(FileNotFoundError):
    """The reviewed dictionary has not been produced yet."""


class SheetHeaderError(ValueError):
    """A sheet lacks a column, or holds one twice."""


def read_by_header(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """The columns of a CSV sheet, found by their headers: ``columns`` maps a header to the name it gets here.

    Order and further columns do not matter; white space and a byte-order mark around a
    header are ignored.  A missing or repeated header raises ``SheetHeaderError``.  All
    files of a folder must have the same header as the first, else Spark ends the read
    (``enforceSchema`` is off).  Every column is text; a missing path raises
    ``DictionaryNotFound``.
    """
    reader = spark.read.options(**CSV_OPTIONS).option("multiLine", True)
    try:
        # the header row as data: Spark would rename headers that occur twice
        first = reader.option("header", "false").csv(path).limit(1).first()
        schema = reader.option("header", "true").csv(path).schema
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise DictionaryNotFound(f"reviewed dictionary not found: {path}") from e
        raise
    header = [(h or "").strip().removeprefix("\ufeff").strip() for h in first or ()]
    wrong = [h for h in columns if header.count(h) != 1]
    if wrong:
        raise SheetHeaderError(f"{path}: no single column {', '.join(map(repr, wrong))} in the header {header}")
    raw = spark.read.schema(schema).options(**CSV_OPTIONS).option("multiLine", True).option("enforceSchema", False).csv(path)
    return raw.toDF(*(f"c{i}" for i in range(len(header)))).select(
        *(F.col(f"c{header.index(h)}").alias(name) for h, name in columns.items()))


def read_manual_dictionary(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Reviewed sheet -> ``keyword, family, category`` (not yet normalised;
    ``merge_dictionary`` strips/lowers keys and drops blank categories)."""
    columns = {SHEET_KEYWORD: "keyword", SHEET_FAMILY: "family", SHEET_CATEGORY: "category"}
    if fmt == "csv":
        return read_by_header(spark, path, columns)
    try:
        return spark.read.format(fmt).load(path).select(*(F.col(h).alias(name) for h, name in columns.items()))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise DictionaryNotFound(f"reviewed dictionary not found: {path}") from e
        raise


def read_rule_table(spark: SparkSession, path: str, fmt: str = "csv", max_phrases: int = MAX_RULE_PHRASES):
    """Rule table ``priority, category, phrase`` (by header) -> ordered rule set; a table of more than
    ``max_phrases`` is refused, and so is a row without a priority or category."""
    columns = {"priority": "priority", "category": "category", "phrase": "phrase"}
    table = read_by_header(spark, path, columns) if fmt == "csv" else spark.read.format(fmt).load(path)
    return rules_from_table(table.selectExpr("TRY_CAST(priority AS INT) AS priority", "category", "phrase"), max_phrases)
