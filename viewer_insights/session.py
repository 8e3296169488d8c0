"""Session helpers for tests, the benchmark and command-line use.

The library itself never changes session settings; operators take whatever
session their DataFrames belong to.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
# Folders by Spark application: the own checkpoint folder of a local session, live scratch tables.
_LOCAL_DIRS: dict[str, str] = {}
_SCRATCH: dict[str, list[str]] = {}


class SharedStorageMissing(RuntimeError):
    """A cluster session names no shared folder in ``spark.checkpoint.dir``."""


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "viewer-insights",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None for a remote (Spark Connect) session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have none
        return None


def application(spark: SparkSession) -> str:
    """A key that names the running application (sessions of a stopped one never share it)."""
    sc = _context(spark)
    return sc.applicationId if sc is not None else f"remote-{spark.session_id}"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    A local session (``local[...]``, one machine) without the setting gets a folder of its
    own.  A cluster session without it raises ``SharedStorageMissing``: a machine-local
    folder would be another one on every executor.
    """
    sc = _context(spark)
    app = application(spark)
    d = sc.getConf().get(CHECKPOINT_CONF, None) if sc is not None else None
    if not d:
        try:
            d = spark.conf.get(CHECKPOINT_CONF, None)
        except Exception:  # noqa: BLE001 - not readable as a session option
            d = None
    d = d or _LOCAL_DIRS.get(app)
    if not d:
        master = sc.master if sc is not None else ""
        if not (master == "local" or master.startswith("local[")):
            raise SharedStorageMissing(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        d = _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="vi-checkpoint-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives the loss
    of executors, unlike a local checkpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder, removed by ``drop_scratch``."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(application(spark), []).append(path)
    return path


def is_live(spark: SparkSession, path: str) -> bool:
    """True while a scratch folder has not been dropped."""
    return path in _SCRATCH.get(application(spark), ())


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table under the shared checkpoint folder and
    read it back: one job, lineage cut, columnar storage, and every later use
    sees exactly the stored rows."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove one scratch table; nothing may read it any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    _SCRATCH[application(spark)].remove(path)


def drop_scratch(spark: SparkSession, first: int = 0) -> None:
    """Remove the scratch tables of this application made since the ``first``-th."""
    for path in _SCRATCH.get(application(spark), [])[first:]:
        drop_path(spark, path)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Scratch tables made inside are removed at the end: results that read them must be
    written or collected before."""
    first = len(_SCRATCH.get(application(spark), ()))
    try:
        yield
    finally:
        drop_scratch(spark, first)
