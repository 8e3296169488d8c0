import random
import zlib
from collections import Counter

from viewer_insights.llm import sharding as s
from viewer_insights.llm.common import numbered


def jump(key, shards):
    key &= 2**64 - 1
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def test_shards_equal_the_published_loop(spark):
    ids = [*range(-50, 2000), 2**63 - 1, -2**63, 12345678901234567]
    df = spark.createDataFrame([(i, "t") for i in ids], "doc_id long, text string")
    for n in (1, 2, 24):
        for r in s.assign_shards(df, n).collect():
            assert (r["shard"], r["grown_shard"]) == (jump(r["doc_id"], n), jump(r["doc_id"], n + 1))


def test_one_more_shard_takes_rows_only_into_itself(spark):
    df = spark.createDataFrame([(i, None) for i in range(20_000)], "doc_id long, text string")
    rows = s.assign_shards(df).collect()
    moved = [r for r in rows if r["shard"] != r["grown_shard"]]
    assert all(r["grown_shard"] == 24 for r in moved) and 600 < len(moved) < 1000
    assert max(Counter(r["shard"] for r in rows).values()) < 1000


def test_odd_rows_sizes_checksums_and_gapless_places(docs, odd):
    rows = [*odd, (None, None), (None, "x"), *((i, "copy") for i in range(10_000, 14_000, 7)), (-1, "a"), (-1, "b")]
    got = s.assign_shards(docs(rows)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert all(r["law"] == "key" for r in got)
    places = {}
    for r in got:
        places.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_hashed_ids_and_an_id_in_a_third_of_the_rows_spread_over_tasks(spark):
    rng = random.Random(5)
    rows = [(rng.getrandbits(64) - 2**63, f"t{k % 9}") for k in range(2000)] + [(42, "copy")] * 1000
    got = s.assign_shards(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    places = {}
    for r in got:
        places.setdefault(r["shard"], []).append((r["slot"], r["doc_id"], r["text_crc32"], r["size"]))
    assert len(got) == 3000 and all([x[0] for x in sorted(p)] == list(range(len(p))) for p in places.values())
    assert all([x[1:] for x in sorted(p)] == sorted(x[1:] for x in p) for p in places.values())


def test_places_need_no_task_of_a_whole_group(spark):
    df = spark.createDataFrame([(1, k % 5) for k in range(4000)] + [(None, 1)] * 50, "g int, v int")
    got = numbered(df, ["g"], ["v"], "t", "v")
    assert got.columns == ["g", "v", "_nth", "_before"]
    rows = sorted((tuple(r) for r in got.collect()), key=lambda r: (r[0] is None, r[2]))
    total = 0
    for k, r in enumerate(rows[:4000]):
        assert r == (1, k // 800, k, total)
        total += r[1]
    assert rows[4000:] == [(None, 1, k, k) for k in range(50)]


def test_empty_table(docs):
    assert s.assign_shards(docs([])).collect() == []


def test_no_python_and_no_text_in_the_shuffle(docs):
    df = s.assign_shards(docs([(1, "a")]).select("doc_id", "text"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Nested" not in plan
