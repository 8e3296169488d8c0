"""Serving-table contract: column names, types, defaults, key uniqueness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampType

from viewer_insights import vocab
from viewer_insights.operators.search import DEFAULT_LABELS, cat_col, kw_col
from viewer_insights.operators.viewing import total_col


def serving_schema(
    labels: Sequence[str] = DEFAULT_LABELS,
    categories: Sequence[str] = vocab.VIEW_CATEGORIES,
    column_names: Mapping[str, str] = vocab.VIEW_CATEGORY_COLUMNS,
) -> StructType:
    """``user_id`` key, keywords and categories per month, status, change,
    journey, one BIGINT total per viewing category, MostWatch, Taste,
    Active, updated_at.  ASCII column names."""
    fields = [StructField("user_id", StringType(), False)]
    for lab in labels:
        fields += [StructField(kw_col(lab), StringType(), True), StructField(cat_col(lab), StringType(), True)]
    fields += [
        StructField("user_status", StringType(), True),
        StructField("trending_types", StringType(), True),
        StructField("Previous", StringType(), True),
    ]
    fields += [StructField(total_col(c, column_names), LongType(), False) for c in categories]
    fields += [
        StructField("MostWatch", StringType(), True),
        StructField("Taste", StringType(), True),
        StructField("Active", DoubleType(), False),
        StructField("updated_at", TimestampType(), False),
    ]
    return StructType(fields)


# Columns with a declared default (applied when the value is missing).
def _defaults(schema: StructType) -> dict[str, object]:
    out: dict[str, object] = {}
    for f in schema.fields:
        if f.name.startswith("Total_"):
            out[f.name] = 0
        elif f.name == "Active":
            out[f.name] = 0.0
    return out


def align_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the contract's columns in order, cast, fill declared defaults,
    stamp ``updated_at``; absent optional columns become NULL."""
    defaults = _defaults(schema)
    cols = []
    for f in schema.fields:
        if f.name == "updated_at":
            c = F.current_timestamp()
        elif f.name in df.columns:
            c = F.col(f.name).cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        if f.name in defaults:
            c = F.coalesce(c, F.lit(defaults[f.name]).cast(f.dataType))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def duplicate_keys(df: DataFrame, key: str = "user_id") -> DataFrame:
    """Keys that occur more than once (empty when the key is unique)."""
    return df.groupBy(key).count().filter(F.col("count") > 1)


class ContractError(ValueError):
    """The serving table breaks its key contract."""


def assert_unique(df: DataFrame, key: str = "user_id") -> None:
    """Raise when ``key`` is not unique (one bounded job: stops at one hit)."""
    if duplicate_keys(df, key).limit(1).count():
        raise ContractError(f"{key} is not unique")


def assert_key(df: DataFrame, key: str = "user_id") -> None:
    """Raise when ``key`` is NULL somewhere or not unique."""
    if df.filter(F.col(key).isNull()).limit(1).count():
        raise ContractError(f"{key} is NULL")
    assert_unique(df, key)
