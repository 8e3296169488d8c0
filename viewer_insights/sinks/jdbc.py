"""Publishing the wide table to a relational serving database over JDBC."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame

# FIXED VALUES: serving table and the connection defaults used when the
# environment names none.
DEFAULT_TABLE = "customer_360_behavior"
DEFAULT_HOST, DEFAULT_PORT, DEFAULT_DB, DEFAULT_USER = "localhost", "3306", "big_data_analysis", "root"


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    num_partitions: int  # connections open at once; a write without a bound opens one per task
    table: str = DEFAULT_TABLE
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    batchsize: int = 10_000


def mysql_target_from_env(num_partitions: int, table: str = DEFAULT_TABLE) -> JdbcTarget:
    """MySQL connection from ``DB_HOST DB_PORT DB_NAME DB_USER DB_PASS``."""
    url = "jdbc:mysql://{}:{}/{}".format(
        os.getenv("DB_HOST", DEFAULT_HOST), os.getenv("DB_PORT", DEFAULT_PORT), os.getenv("DB_NAME", DEFAULT_DB)
    )
    return JdbcTarget(url=url, num_partitions=num_partitions, table=table, user=os.getenv("DB_USER", DEFAULT_USER),
                      password=os.getenv("DB_PASS", ""), driver="com.mysql.cj.jdbc.Driver")


def _options(t: JdbcTarget) -> dict[str, str]:
    opts = {"url": t.url, "dbtable": t.table, "batchsize": str(t.batchsize), "numPartitions": str(t.num_partitions)}
    if t.user is not None:
        opts["user"] = t.user
    if t.password is not None:
        opts["password"] = t.password
    if t.driver:
        opts["driver"] = t.driver
    return opts


def publish(df: DataFrame, target: JdbcTarget, mode: str = "overwrite") -> None:
    """Overwrite the serving table's rows.

    ``truncate=true`` keeps the existing table definition (key, indexes,
    defaults) instead of dropping and recreating it.  Each task inserts its
    partition in batches; ``num_partitions`` caps concurrent connections.
    """
    df.write.format("jdbc").options(**_options(target)).option("truncate", "true").mode(mode).save()


def read_table(spark, target: JdbcTarget) -> DataFrame:
    return spark.read.format("jdbc").options(**_options(target)).load()
