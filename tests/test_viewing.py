import datetime as dt

from pyspark.sql import functions as F

from viewer_insights import vocab
from viewer_insights.operators import viewing
from viewer_insights.sources.logs import read_viewing_log

EV = "user_id string, app string, duration long, date date"
D1, D2, D3 = dt.date(2022, 4, 1), dt.date(2022, 4, 2), dt.date(2022, 4, 3)


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_app_category_is_case_sensitive(spark):
    df = spark.createDataFrame([("KPLUS",), ("KPlus",), ("kplus",), (None,), ("VOD",), ("SPORT",)], "app string")
    out = [r["Type"] for r in viewing.map_app_category(df).collect()]
    assert out == ["Truyền Hình", "Truyền Hình", "Other", "Other", "Phim Truyện", "Thể Thao"]


def test_clean_viewing_log(spark):
    df = spark.createDataFrame(
        [("a1", "VOD", 0, D1), ("a2", "VOD", -5, D1), ("a3", "VOD", None, D1), ("_x", "VOD", 9, D1),
         ("", "VOD", 9, D1), (None, "VOD", 9, D1), ("a4", "kplus", 9, D1), ("a5", "VOD", 9, D1)], EV)
    out = viewing.clean_viewing_log(viewing.map_app_category(df))
    assert rows(out, "user_id") == [("a5",)]


def test_active_ratio(spark):
    df = spark.createDataFrame(
        [("u", "VOD", 1, D1), ("u", "VOD", 1, D1), ("u", "VOD", 1, D2), ("u", "VOD", 1, D3), ("u", "VOD", 1, None),
         ("v", "VOD", 1, None)], EV)
    got = dict(rows(viewing.active_ratio(df), "user_id", "Active"))
    assert got == {"u": 10.0, "v": 0.0}


def _profile(spark, totals):
    cats = vocab.VIEW_CATEGORIES
    data = [("u", code, t, D1) for code, t in zip(["CHANNEL", "VOD", "RELAX", "CHILD", "SPORT"], totals) if t]
    df = viewing.map_app_category(spark.createDataFrame(data, EV))
    return viewing.viewing_profile(df, cats).first()


def test_most_watched_and_taste(spark):
    r = _profile(spark, (5, 5, 0, 0, 0))
    assert (r["MostWatch"], r["Taste"]) == ("Truyền Hình", "Truyền Hình - Phim Truyện")
    assert (r["Total_Truyen_Hinh"], r["Total_Phim_Truyen"], r["Total_The_Thao"]) == (5, 5, 0)
    r = _profile(spark, (0, 0, 0, 0, 9))
    assert (r["MostWatch"], r["Taste"]) == ("Thể Thao", "Thể Thao")


def test_profile_one_pass_equals_join(spark):
    df = viewing.map_app_category(spark.createDataFrame(
        [("u", "VOD", 3, D1), ("u", "SPORT", 4, D2), ("w", "CHILD", 2, D1), ("w", "CHILD", 2, D1)], EV))
    a = viewing.viewing_profile(df)
    b = viewing.viewing_profile_by_join(df)
    assert rows(a, *a.columns) == rows(b, *a.columns)


def test_sample_is_stable_under_repartition(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("user_id"))
    a = [r[0] for r in viewing.sample_users(df, 37, seed=7).collect()]
    b = [r[0] for r in viewing.sample_users(df.repartition(13), 37, seed=7).collect()]
    c = [r[0] for r in viewing.sample_users(df, 37, seed=8).collect()]
    assert a == b and len(a) == 37 and a != c


def test_read_viewing_log_json(spark, tmp_path):
    d = tmp_path / "log_content"
    d.mkdir()
    (d / "20220401.json").write_text(
        '{"_index": "x", "_source": {"Contract": "AB1", "AppName": "VOD", "TotalDuration": 60, "Mac": "m"}}\n'
        '{"_source": {"Contract": "AB2", "AppName": "VOD", "TotalDuration": "12"}}\n'
        'this is not json\n', encoding="utf-8")
    (d / "extra.json").write_text('{"_source": {"Contract": "AB3", "AppName": "SPORT", "TotalDuration": 5}}\n')
    out = read_viewing_log(spark, str(d / "*.json"))
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == sorted([
        ("AB1", "VOD", 60, D1),
        ("AB2", "VOD", None, D1),         # quoted number -> NULL
        (None, None, None, D1),           # malformed line -> all-NULL row
        ("AB3", "SPORT", 5, None),        # no day in the file name
    ], key=str)


def test_viewing_master_with_sample(spark):
    from viewer_insights.plans import customer360 as plan
    data = [(f"u{i:03d}", "VOD", 10 + i, D1) for i in range(60)]
    events = spark.createDataFrame(data, EV)
    full = plan.viewing_master(events, plan.ViewingSettings())
    sampled = plan.viewing_master(events, plan.ViewingSettings(sample_n=7, sample_seed=3))
    got = [r["user_id"] for r in sampled.collect()]
    import hashlib
    want = sorted((r["user_id"] for r in full.collect()), key=lambda u: (hashlib.md5(f"{u}:3".encode()).hexdigest(), u))[:7]
    assert got == want


def test_day_maps_equal_the_distinct_count(spark):
    import datetime as dt
    import random
    rng = random.Random(4)
    days = [dt.date(2022, m, d) for m in (3, 4) for d in (1, 2, 15, 30, 31) if (m, d) != (4, 31)] + [None]
    data = [(rng.choice("abc"), "VOD", 5, rng.choice(days)) for _ in range(200)] + [("only", "VOD", 1, None), ("last", "VOD", 1, dt.date(2022, 3, 31))]
    df = spark.createDataFrame(data, "user_id string, app string, duration long, date date")
    want = sorted(map(tuple, viewing.active_ratio(df).collect()))
    maps = viewing.day_maps(df)
    assert sorted(map(tuple, viewing.active_ratio_from_maps(maps).collect())) == want and ("only", 0.0) in want
    # maps of overlapping halves merge to the same
    halves = [viewing.day_maps(df.limit(150)), viewing.day_maps(df), viewing.day_maps(df.where("user_id = 'a'"))]
    assert sorted(map(tuple, viewing.active_ratio_from_maps(viewing.merge_day_maps(*halves)).collect())) == want
    plan = viewing.active_ratio_from_maps(maps)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "distinct" not in plan.lower()
