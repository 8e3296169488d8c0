import pytest
from pyspark.sql import functions as F

from viewer_insights.operators import merge


def test_merge_profiles_join_types(spark):
    s = spark.createDataFrame([("1", "a"), ("2", "b")], "user_id string, x string")
    v = spark.createDataFrame([("2", 5), ("3", 6)], "user_id string, y int")
    assert merge.merge_profiles(s, v, "full").count() == 3
    assert merge.merge_profiles(s, v, "inner").count() == 1
    assert merge.merge_profiles(s, v, "left").count() == 2
    with pytest.raises(ValueError):
        merge.merge_profiles(s, v, "cross")


@pytest.mark.parametrize("parts", [1, 7])
def test_row_index_matches_brute_force(spark, parts):
    df = spark.range(0, 1000, 3).select(F.format_string("k%05d", F.col("id") * 7 % 1000).alias("k")).repartition(parts)
    idx = merge.with_row_index(df, ["k"], buckets=5)
    got = sorted((r["row_idx"], r["k"]) for r in idx.collect())
    keys = sorted(r["k"] for r in df.collect())
    assert got == list(enumerate(keys, start=1))


def test_merge_positional_pairs_by_order(spark):
    a = spark.createDataFrame([("u3", 1), ("u1", 2), ("u2", 3)], "user_id string, a int")
    b = spark.createDataFrame([("v9", 10), ("v5", 20)], "user_id string, b int")
    out = sorted(tuple(r) for r in merge.merge_positional(a, b).collect())
    # positions: a sorted u1,u2,u3 ; b sorted v5,v9 -> (u1,v5) (u2,v9); b's id dropped
    assert out == [("u1", 2, 20), ("u2", 3, 10)]
