"""Numbers of shuffle partitions, and lookup joins on keys that may be hot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of a log that one task joins, counts and sorts, about: what a task holds does not grow with the log.
ROWS_PER_TASK = 400_000


def partitions_for(spark: SparkSession, rows: int) -> int | None:
    """Shuffle partitions for a log of so many rows; None where the session's own number does."""
    n = -(-rows // ROWS_PER_TASK)
    return n if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


# Number of salt buckets for a lookup join on a skew-prone key.
DEFAULT_SALT_BUCKETS = 16


def salted_left_lookup(big: DataFrame, small: DataFrame, big_key_sql: str, small_key: str,
                       salt_of_sql: str, buckets: int = DEFAULT_SALT_BUCKETS) -> DataFrame:
    """Left join ``big`` to a keyed ``small`` side without a hot-key task.

    ``big`` rows get a deterministic salt in ``[0, buckets)`` from
    ``salt_of_sql`` (e.g. a hash of the user id, so a recomputed task makes
    the same choice); ``small`` is replicated once per salt value.  A key
    shared by a third of ``big`` is then spread over ``buckets`` tasks.
    Rows without a key get a key of their own that nothing matches, so they
    spread over all tasks.  ``small`` must have unique keys, without white
    space at the edge; its columns other than the key are added.  Whether ``small`` is broadcast is left to Spark,
    which decides by bytes.
    """
    key = f"coalesce({big_key_sql}, concat(' no key ', CAST({salt_of_sql} AS STRING)))"
    salted_big = big.withColumn("_salt", F.expr(f"CAST(pmod({salt_of_sql}, {int(buckets)}) AS INT)"))
    salted_small = small.withColumn("_salt_s", F.explode(F.sequence(F.lit(0), F.lit(int(buckets) - 1))))
    cond = F.expr(f"{key} = {small_key} AND _salt = _salt_s")
    return salted_big.join(salted_small, cond, "left").drop("_salt", "_salt_s", small_key)


# The frequency sketch of a lookup's keys: how many of the most frequent keys it names, how many
# counters it keeps (a key with more than one in ``HOT_COUNTERS`` of the rows is among them), and the
# share of the rows from which a key counts as hot.
HOT_KEYS = 1_000
HOT_COUNTERS = 20_000
HOT_SHARE = 1 / 2_000
HOT_ROWS = 100


def hot_keys(rows: DataFrame, key: str) -> DataFrame:
    """``_hot_key``: the keys with more than ``HOT_SHARE`` of the rows (and ``HOT_ROWS`` rows), from one
    frequency sketch: a lazy table of ``HOT_KEYS`` rows at most."""
    top = rows.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {HOT_KEYS}, {HOT_COUNTERS})").alias("_top"), F.count(F.lit(1)).alias("_rows"))
    return top.select(F.explode("_top").alias("_t"), "_rows").where(
        F.expr(f"_t.count > greatest({HOT_ROWS}, _rows * {HOT_SHARE!r}D)")).select(F.col("_t.item").alias("_hot_key"))


def hot_salted_lookup(rows: DataFrame, small: DataFrame, key: str, small_key: str, salt_of_sql: str,
                      buckets: int = DEFAULT_SALT_BUCKETS) -> DataFrame:
    """Inner join ``rows`` to a keyed ``small`` side; only hot keys are salted.

    A frequency sketch of ``rows`` names the hot keys (``hot_keys``, broadcast: its size is
    fixed).  Their rows get a salt in ``[0, buckets)`` from ``salt_of_sql`` and their rows of
    ``small`` are repeated once per salt; all other keys are joined as they are, so ``small``
    grows by ``HOT_KEYS * buckets`` rows at most.  A key that the sketch misses costs time,
    never rows.  ``small`` must have unique keys; NULL keys match nothing.
    """
    hot = F.broadcast(hot_keys(rows, key))
    salt = F.expr(f"CASE WHEN _hot_key IS NULL THEN 0 ELSE CAST(pmod({salt_of_sql}, {int(buckets)}) AS INT) END")
    salts = F.expr(f"explode(sequence(0, CASE WHEN _hot_key IS NULL THEN 0 ELSE {int(buckets) - 1} END))")
    salted = rows.join(hot, F.col(key) == F.col("_hot_key"), "left").withColumn("_salt", salt).drop("_hot_key")
    repeated = small.join(hot, F.col(small_key) == F.col("_hot_key"), "left").withColumn("_salt_s", salts).drop("_hot_key")
    return salted.join(repeated, (F.col(key) == F.col(small_key)) & (F.col("_salt") == F.col("_salt_s"))).drop("_salt", "_salt_s", small_key)
