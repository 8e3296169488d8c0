"""Joining the search master and the viewing master into one wide row per user."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewer_insights.session import stage_table

JOIN_TYPES = ("inner", "full", "left", "right")


def merge_profiles(search: DataFrame, viewing: DataFrame, how: str = "full") -> DataFrame:
    """Keyed wide-table join on ``user_id`` (inner / full / left / right)."""
    if how not in JOIN_TYPES:
        raise ValueError(f"how must be one of {JOIN_TYPES}")
    return search.join(viewing, on="user_id", how=how)


def _order_cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def with_row_index(df: DataFrame, order: Sequence[str | Column], index_col: str = "row_idx",
                   buckets: int | None = None) -> DataFrame:
    """1-based position of each row in the total order ``order``.

    Distributed: rows are range-partitioned on the order key (Spark samples the
    boundaries; the shuffles before are not run again for it), sorted inside each
    range and numbered by ``monotonically_increasing_id`` (range number in the high
    bits, position in the low bits).  That numbered copy is the only one: it is written
    as a Parquet table in the shared ``spark.checkpoint.dir`` folder and read back, so
    index and counts come from the same stored rows (a second evaluation could sample
    other range bounds).  The rows of each range are counted from the file footers, no
    column is read for it.  The write happens in this call; run it inside
    ``session.scratch_tables`` to have the copy removed.  The count table has one row
    per range (bounded by ``buckets``); its running sum gives each range's
    offset and is broadcast back.  No step gathers the data in one task.

    ``order`` must be a unique key, otherwise equal keys are numbered in an
    arbitrary order.
    """
    cols = _order_cols(order)
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
    numbered = stage_table(ranged.withColumn("_mid", F.monotonically_increasing_id()), "row-index")
    offsets = spark.createDataFrame(_range_offsets(numbered), "_part long, _off long")
    return (
        numbered.withColumn("_part", F.expr("shiftright(_mid, 33)"))
        .join(F.broadcast(offsets), "_part")
        .withColumn(index_col, F.expr("_off + (_mid - shiftleft(_part, 33)) + 1"))
        .drop("_mid", "_part", "_off")
    )


def _range_offsets(numbered: DataFrame) -> list[tuple[int, int]]:
    """Rows before each range, from the row counts in the footers of a table that
    ``with_row_index`` wrote: task ``i`` wrote the files ``part-<i>-...`` (at most as many
    rows as there are files)."""
    counts = (
        numbered.groupBy(F.expr("CAST(regexp_extract(_metadata.file_name, '^part-([0-9]+)-', 1) AS BIGINT) AS part"))
        .agg(F.expr("count(1) AS n")).orderBy("part").collect()
    )
    ends = list(accumulate((r["n"] for r in counts), initial=0))
    return [(r["part"], before) for r, before in zip(counts, ends)]


def merge_positional(
    a: DataFrame,
    b: DataFrame,
    order_a: Sequence[str | Column] = ("user_id",),
    order_b: Sequence[str | Column] = ("user_id",),
    drop_b_key: str | None = "user_id",
) -> DataFrame:
    """Pair the i-th row of ``a`` with the i-th row of ``b`` (inner on position).

    Positions follow the explicit orders ``order_a`` / ``order_b``; as in the
    original merge, ``b``'s ``user_id`` is dropped so ``a``'s id is kept.
    """
    ia = with_row_index(a, order_a)
    ib = with_row_index(b, order_b)
    if drop_b_key and drop_b_key in ib.columns:
        ib = ib.drop(drop_b_key)
    return ia.join(ib, "row_idx", "inner").drop("row_idx")
