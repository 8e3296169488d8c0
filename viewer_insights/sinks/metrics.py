"""Row-count reports collected while a result is written (no extra job)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str, where: str = "true") -> tuple[DataFrame, Observation]:
    """Attach a counter of the rows that fulfil ``where``; ``obs.get`` is filled by the next
    action on the returned DataFrame (e.g. its write).  A range-partitioned write reads its
    input twice and would count twice: observe what it reads, where that is stored."""
    obs = Observation(name)
    return df.observe(obs, F.count_if(F.expr(where)).alias("rows")), obs
