"""Publishing the serving table: checked before it is served, stamped where it changed.

``publish`` writes a fresh folder, checks the key there and only then swaps it in under
the served path, so a refused table never replaces a good one.  ``merge_serving`` compares
a new table with the stored one by key and row hash: rows that did not change keep their
stamp, keys that are gone are told.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewer_insights.functions.sqltext import ident
from viewer_insights.sinks import contract, files

#: Access paths of the serving table: reports filter on these columns, and users are looked up by their id.
SORT_BY = ("user_status", "trending_types", "Active")

STATUS = "merge_status"
NEW, CHANGED, SAME, GONE = "new", "changed", "same", "gone"


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def _swap(spark: SparkSession, fresh: str, path: str) -> None:
    """Let ``path`` be the folder ``fresh``; what was there goes only after that worked."""
    fs, target = _fs(spark, path)
    as_path = spark._jvm.org.apache.hadoop.fs.Path
    old = as_path(f"{path}.old-{uuid.uuid4().hex}")
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(as_path(fresh), target):
        if had:
            fs.rename(old, target)
        raise OSError(f"cannot move {fresh} to {path}")
    if had:
        fs.delete(old, True)


def write_served(df: DataFrame, path: str, key: str = "user_id") -> None:
    """The serving table with its access paths, as far as ``df`` has the columns."""
    sort_by = [c for c in SORT_BY if c in df.columns]
    if sort_by:
        files.write_indexed_parquet(df, path, sort_by, [key])
    else:
        files.write_parquet(df, path)


def publish(df: DataFrame, path: str, key: str = "user_id") -> DataFrame:
    """Write ``df`` to a fresh folder beside ``path``, check its key and swap it in; returns the served table.

    A table with a NULL or repeated key raises ``ContractError``: the fresh folder is removed
    and ``path`` still holds the table from before.  ``df`` may read the table at ``path``.
    The swap is two renames (on an object store without renames: two copies).
    """
    spark = df.sparkSession
    fresh = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    try:
        write_served(df, fresh, key)
        contract.assert_key(spark.read.parquet(fresh), key)
        _swap(spark, fresh, path.rstrip("/"))
    except BaseException:
        fs, at = _fs(spark, fresh)
        fs.delete(at, True)
        raise
    return spark.read.parquet(path)


def row_hash_sql(columns: list[str]) -> str:
    """Hash of a row's values.  Spark's hash passes over NULLs, so each column also says whether it is one."""
    return f"xxhash64({', '.join(f'{ident(c)}, {ident(c)} IS NULL' for c in columns)})" if columns else "0L"


def merge_serving(old: DataFrame, new: DataFrame, key: str = "user_id", stamp: str = "updated_at") -> DataFrame:
    """``new`` beside the stored ``old``: the columns of ``new`` and ``merge_status``.

    ``same``: the key is in both and no other column changed, the row keeps the old ``stamp``;
    ``changed`` and ``new`` rows keep the stamp of ``new``; ``gone``: a key that only ``old`` has,
    with its old stamp and NULL elsewhere.  Only key, hash and stamp of ``old`` are shuffled.
    Columns are compared by name; one that ``old`` lacks makes every row changed, one that only
    ``old`` has is ignored.  Keys are unique on both sides (``contract.assert_key``).
    """
    values = [c for c in new.columns if c not in (key, stamp)]
    known = [c for c in values if c in old.columns]
    then = old.selectExpr(f"{ident(key)} AS _key", f"{ident(stamp)} AS _stamp",
                          f"{row_hash_sql(values) if known == values else 'NULL'} AS _hash", "true AS _stored")
    now = new.withColumns({"_now": F.expr(row_hash_sql(values)), "_here": F.lit(True)})
    both = now.join(then, F.col(key) == F.col("_key"), "full")
    status = (F.when(F.isnull("_here"), GONE).when(F.isnull("_stored"), NEW)
              .when(F.col("_now") == F.col("_hash"), SAME).otherwise(CHANGED))
    kept = F.when(F.col("_status").isin(SAME, GONE), F.col("_stamp")).otherwise(F.col(stamp))
    return both.withColumn("_status", status).select(
        *(F.coalesce(F.col(key), F.col("_key")).alias(c) if c == key else kept.alias(c) if c == stamp else F.col(c) for c in new.columns),
        F.col("_status").alias(STATUS))


def merge_counts(merged: DataFrame) -> DataFrame:
    """Rows per ``merge_status``, zeros included: ``merge_status, users``."""
    each = F.explode(F.array(*(F.struct(F.lit(s).alias("s"), (F.col(STATUS) == s).cast("long").alias("n")) for s in (NEW, CHANGED, SAME, GONE))))
    zeros = merged.sparkSession.sql(f"SELECT explode(array('{NEW}', '{CHANGED}', '{SAME}', '{GONE}')) AS s, 0L AS n")
    return merged.select(each.alias("x")).select("x.s", "x.n").union(zeros).groupBy(F.col("s").alias(STATUS)).agg(F.sum("n").alias("users"))
