"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from viewer_insights.session import cut_lineage, scratch_path, stage_table

__all__ = ["read", "cut_lineage", "stage_table", "bucketed_table", "slices", "map_batches", "keep_rows", "connected_components", "texts", "numbered"]

SLICE_ROWS = 500


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bucketed_table(df: DataFrame, key: str, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder in buckets of ``key``, as many as the session has
    shuffle partitions, and read it back: joins on ``key`` then shuffle only the other side."""
    spark = df.sparkSession
    n = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 100_000)  # Spark's own limit of buckets
    table = f"scratch_{uuid.uuid4().hex}"
    df.repartition(n, key).write.bucketBy(n, key).option("path", scratch_path(spark, name)).saveAsTable(table)
    out = spark.table(table)
    out.schema  # resolved before the name goes; the files stay
    spark.sql(f"DROP TABLE {table}")
    return out


def numbered(df: DataFrame, group: list[str], order: list[str], name: str, total: str | None = None) -> DataFrame:
    """``df`` with ``_nth``, the 0-based place of each row among those of its ``group`` (null keys are equal) in
    ``order`` (nulls last), and with ``_before``, the sum of ``total`` over the rows before it.

    Rows are sorted by ranges and stored once in the shared folder; a range that begins inside a group adds what
    came before it, from a table of at most one row per range (broadcast).  So no task holds more than a range,
    whatever the size of a group or of a run of equal rows (which the row's number in its task parts).
    """
    keys = [F.col(c).asc_nulls_last() for c in [*group, *order, "_salt"]]
    ranged = (df.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
              .drop("_salt").withColumn("_mid", F.monotonically_increasing_id()))
    stored = stage_table(ranged, name).withColumn("_range", F.shiftright("_mid", 33))
    amount = F.col(total).cast("long") if total else F.lit(0).cast("long")
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (stored.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_t"))
               .select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_range").alias("_at"),
                       F.sum("_n").over(earlier).alias("_rows"), F.sum("_t").over(earlier).alias("_sum"))
               .where("_rows > 0"))
    same = F.col("_range") == F.col("_at")
    for i, c in enumerate(group):
        same &= F.col(c).eqNullSafe(F.col(f"_g{i}"))
    inside = Window.partitionBy(*group, "_range").orderBy("_mid")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (stored.withColumn("_r", F.row_number().over(inside) - 1)
            .withColumn("_s", F.sum(amount).over(upto) - amount)
            .join(F.broadcast(offsets), same, "left")
            .select(*df.columns, (F.col("_r") + F.coalesce("_rows", F.lit(0))).cast("long").alias("_nth"),
                    (F.col("_s") + F.coalesce("_sum", F.lit(0))).cast("long").alias("_before")))


def texts(column: pa.Array) -> list[str]:
    """Python strings of an Arrow string column; null becomes the empty text."""
    return [t or "" for t in column.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches of a task in stretches of ``rows`` rows, so that only few texts are Python
    objects at once; at the end of the task, freed memory goes back to the system (the
    worker process is kept for further tasks)."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # glibc only
        trim(0)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """Apply ``fn`` (record batch -> dict of columns, in the order of ``schema``) to stretches of the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield pa.RecordBatch.from_pydict(fn(b))

    return df.mapInArrow(run, schema)


def keep_rows(df: DataFrame, text_col: str, keep: Callable[[list[str]], list[bool]]) -> DataFrame:
    """Rows of ``df`` (all columns, unchanged) whose text ``keep`` accepts."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield b.filter(pa.array(keep(texts(b.column(at))), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of the undirected ``edges (a, b)``; root is the
    smallest node (signed order) that can be reached.

    Alternating large-star and small-star steps: each replaces the links of a node by
    links to the smallest node near it, so the forest flattens in a logarithmic number
    of rounds.  The largest sets gathered are per-node minima (map-side combined), no
    neighbour list is ever collected.  Each round is checkpointed to the shared folder.
    """
    def star(e: DataFrame, both: bool) -> DataFrame:
        # both: every neighbour (large star); else neighbours smaller than the node (small star)
        nbr = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if both:
            nbr = nbr.union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = nbr.groupBy("u").agg(F.min("v").alias("low")).select(
            F.col("u").alias("lu"), F.least("low", "u").alias("low"))
        linked = nbr.join(low, F.col("u") == F.col("lu"))
        if both:
            out = linked.where("v > u").select(F.col("v").alias("a"), F.col("low").alias("b"))
        else:
            out = linked.select(F.col("v").alias("a"), F.col("low").alias("b")).union(
                linked.select(F.col("u").alias("a"), F.col("low").alias("b")))
        return out.where("a <> b").distinct()

    # a > b everywhere: the small star sees the smaller neighbours of each node
    e = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(max_rounds):
        e = cut_lineage(star(star(e, True), False))
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("connected components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
