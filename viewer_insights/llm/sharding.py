"""Shards by jump consistent hashing, in DataFrame operations only.

The key's linear congruential sequence decides where it jumps as shards are appended;
the last jump below the number of shards is its shard (Lamping and Veach 2014).  There
is no ring table, and one more shard takes rows only into itself.

Only ids, sizes and checksums are shuffled, never texts.  Places within a shard come from
a sort by ranges (``common.numbered``), so no task holds a whole shard, also where ids are
sparse or one id holds a third of the rows.

Defined cases: a null text has size 8 and checksum 0; a null id hashes as -1 and comes
last in its shard; rows that repeat an id share its shard and get places of their own;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewer_insights.llm.common import numbered, stage_table

SHARDS = 24


def jump_hash_sql(key: str, shards: int) -> str:
    """SQL: a struct whose ``lo`` is the shard of a bigint among ``shards`` and ``hi`` among one more.

    The sequence needs products modulo 2**64, which decimals hold exactly.
    """
    return f"""aggregate(sequence(1, {shards + 1}),
      named_struct('k', cast(pmod(cast({key} as decimal(38,0)), 18446744073709551616) as decimal(20,0)),
                   'j', 0L, 'lo', 0, 'hi', 0),
      (s, i) -> if(s.j > {shards}, s, transform(array(
          cast(pmod(cast(s.k as decimal(20,0)) * cast(2862933555777941757 as decimal(19,0)) + 1, 18446744073709551616)
               as decimal(20,0))),
        k -> named_struct('k', k,
          'j', cast((s.j + 1) * (2147483648D / cast((k div 8589934592) + 1 as double)) as bigint),
          'lo', if(s.j < {shards}, cast(s.j as int), s.lo),
          'hi', cast(s.j as int)))[0]))"""


def assign_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.expr("coalesce(octet_length(cast(text as string)), 0) + 8L").alias("size"),
        F.expr("crc32(cast(coalesce(cast(text as string), '') as binary))").alias("text_crc32"),
    ).withColumn("_jump", F.expr(jump_hash_sql("coalesce(doc_id, -1L)", shards)))
    rows = stage_table(rows.select("doc_id", "size", "text_crc32", F.col("_jump.lo").alias("shard"),
                                   F.col("_jump.hi").alias("grown_shard")), "shards")  # texts are read once
    return numbered(rows, ["shard"], ["doc_id", "text_crc32", "size"], "shard-places").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("_nth").alias("slot"), "grown_shard")
