import datetime as dt

import pytest
from pyspark.sql import functions as F

from viewer_insights import vocab
from viewer_insights.operators import search

NTZ = "user_id string, keyword string, ts timestamp"


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2022-06-01 1:05:09 CH", dt.datetime(2022, 6, 1, 13, 5, 9)),
        ("2022-06-01 12:00:00 SA", dt.datetime(2022, 6, 1, 0, 0, 0)),
        ("2022-06-01 13:05:09.12", dt.datetime(2022, 6, 1, 13, 5, 9, 120000)),
        ("2022-06-01 13:05:09.1", dt.datetime(2022, 6, 1, 13, 5, 9, 100000)),
        ("2022-06-01 13:05:09.123", dt.datetime(2022, 6, 1, 13, 5, 9, 123000)),
        ("2022-06-01 13:05:09", dt.datetime(2022, 6, 1, 13, 5, 9)),
        ("2022-06-01T13:05:09", dt.datetime(2022, 6, 1, 13, 5, 9)),
        ("2022-06-01", dt.datetime(2022, 6, 1)),
        ("2022-06-01 13:05:09 PM", None),
        ("garbage", None),
        ("", None),
        (None, None),
    ],
)
def test_normalize_log_time(spark, text, expected):
    df = spark.createDataFrame([(text,)], "datetime string")
    out = search.normalize_log_time(df).select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("t"))
    got = out.first()["t"]
    want = None if expected is None else expected.strftime("%Y-%m-%d %H:%M:%S.%f")
    assert got == want


def test_clean_search_log(spark):
    df = spark.createDataFrame(
        [(None, "a"), ("", "a"), ("  ", "a"), ("u1", None), ("u1", "   "), ("u1", "  Naruto "), ("u2", "X")],
        "user_id string, keyword string",
    )
    assert rows(search.clean_search_log(df), "user_id", "keyword") == [("u1", "naruto"), ("u2", "x")]


def _log(spark, data):
    return spark.createDataFrame(
        [(u, k, None if t is None else dt.datetime.fromisoformat(t)) for u, k, t in data], NTZ
    )


def test_top_keyword_ties_and_total(spark):
    log = _log(spark, [
        # u1: a and b twice each; b seen later -> b; total counts every keyword (5)
        ("u1", "a", "2022-06-01 10:00:00"), ("u1", "a", "2022-06-02 10:00:00"),
        ("u1", "b", "2022-06-01 10:00:00"), ("u1", "b", "2022-06-03 10:00:00"),
        ("u1", "c", "2022-06-05 10:00:00"),
        # u2: equal counts, NULL time loses
        ("u2", "x", None), ("u2", "y", "2022-06-01 00:00:00"),
        # u3: full tie -> keyword ascending
        ("u3", "q", "2022-06-01 00:00:00"), ("u3", "p", "2022-06-01 00:00:00"),
    ])
    out = search.top_keyword(log, "t6")
    assert rows(out, "user_id", "most_search_t6", "cnt_t6") == [("u1", "b", 5), ("u2", "y", 2), ("u3", "p", 2)]


def test_monthly_top_keywords_equals_outer_join(spark):
    log = _log(spark, [
        ("u1", "a", "2022-06-01 10:00:00"), ("u1", "b", "2022-07-01 10:00:00"),
        ("u2", "a", "2022-06-01 10:00:00"), ("u3", "c", "2022-07-02 10:00:00"),
        ("u3", "c", "2022-07-03 10:00:00"), ("u3", "d", "2022-07-04 10:00:00"),
    ]).withColumn("period", F.when(F.month("ts") == 6, "t6").otherwise("t7"))
    fused = search.monthly_top_keywords(log)
    joined = search.month_over_month(
        search.top_keyword(log.filter("period = 't6'"), "t6"), search.top_keyword(log.filter("period = 't7'"), "t7")
    )
    cols = ["user_id", "most_search_t6", "cnt_t6", "most_search_t7", "cnt_t7"]
    assert rows(fused, *cols) == rows(joined, *cols)
    assert rows(fused, *cols) == [("u1", "a", 1, "b", 1), ("u2", "a", 1, None, None), ("u3", None, None, "c", 3)]


def test_junk_filter(spark):
    users = spark.createDataFrame(
        [("1", "a"), ("2", "12345"), ("3", "1234"), ("4", "007"), ("5", None), ("6", "ok")],
        "user_id string, most_search_t7 string",
    ).withColumn("most_search_t6", F.lit(None).cast("string")).withColumn("cnt_t6", F.lit(1)).withColumn(
        "cnt_t7", F.lit(1))
    kept = [r[0] for r in rows(search.drop_junk_users(users), "user_id")]
    assert kept == ["3", "4", "5", "6"]


@pytest.mark.parametrize(
    "cnt_a, cnt_b, kw_b, score",
    [
        (4, 2, "phim hay", 171.0),
        (None, 10, "naruto", 15.0),
        (None, 10, "batman", 30.0),   # 'ma' inside a word: genre intent
        (None, 10, "one piece", 22.5),
        (7, None, None, 7.0),
        (None, 2, "ss2", 9.0),
    ],
)
def test_score(spark, cnt_a, cnt_b, kw_b, score):
    users = spark.createDataFrame(
        [("u", "kw-a" if cnt_a else None, cnt_a, kw_b, cnt_b)],
        "user_id string, most_search_t6 string, cnt_t6 long, most_search_t7 string, cnt_t7 long",
    )
    assert search.score_users(users).first()["movie_score"] == score


def test_top_users_order(spark):
    scored = spark.createDataFrame(
        [("b", 1.0), ("a", 1.0), ("c", 5.0), ("d", 0.5)], "user_id string, movie_score double"
    ).withColumn("most_search_t6", F.lit("x")).withColumn("most_search_t7", F.lit("y"))
    assert [r[0] for r in search.top_users(scored, 3).collect()] == ["c", "a", "b"]


# A rule set in priority order with the phrases the examples need; the
# behaviour under test is ordering, word boundaries and case folding.
RULES = [
    ("System", ["app", "vip"]),
    ("Sports", ["bong da", "mu"]),
    ("Anime", ["naruto", "hai tac mu rom"]),
    ("Music", ["nhac", "hat"]),
    ("Horror", ["kinh di", "ma", "phim ma"]),
    ("Thai-Drama", ["phim thai", "phim ma thai"]),
    ("Adult", [r"18\+"]),
    ("Movies_General", ["phim", "xem phim", r"tap \d+"]),
]


@pytest.mark.parametrize(
    "keyword, category",
    [
        ("naruto", "Anime"),
        ("tap 12", "Movies_General"),
        ("xem phim", "Movies_General"),
        ("hai tac mu rom", "Sports"),     # earlier rule wins through 'mu'
        ("phim ma thai", "Horror"),       # 'ma' in Horror beats Thai-Drama
        ("18+", "Unmapped"),              # \b after '+' needs a word character
        ("hát", "Unmapped"),              # accents are not folded
        ("NARUTO", "Anime"),
        ("mumu", "Unmapped"),
    ],
)
def test_categorize(spark, keyword, category):
    df = spark.createDataFrame([(keyword,)], "keyword string")
    assert search.categorize(df, RULES).first()["category"] == category


def test_distinct_keywords_and_review_queue(spark):
    users = spark.createDataFrame(
        [("1", "naruto", "xem phim"), ("2", None, "naruto"), ("3", "zzz", None)],
        "user_id string, most_search_t6 string, most_search_t7 string",
    )
    kws = search.distinct_keywords(users)
    assert rows(kws, "keyword") == [("naruto",), ("xem phim",), ("zzz",)]
    mapped, review = search.split_review_queue(search.categorize(kws, RULES))
    assert rows(mapped, "keyword", "category") == [("naruto", "Anime"), ("xem phim", "Movies_General")]
    assert rows(review, "keyword", "family", "category") == [("zzz", "zzz", vocab.UNMAPPED)]


def test_search_master_with_cohort_cap(spark):
    from viewer_insights.plans import customer360 as plan
    log = _log(spark, [
        ("u1", "red gear", "2022-06-01 10:00:00"), ("u1", "blue rod", "2022-07-01 10:00:00"),
        ("u2", "blue rod", "2022-07-01 10:00:00"), ("u2", "blue rod", "2022-07-02 10:00:00"),
        ("u3", "old anvil", "2022-06-03 10:00:00"),
    ]).withColumn("period", F.when(F.month("ts") == 6, "t6").otherwise("t7"))
    rules = [("Warm", ["red"]), ("Cool", ["blue"])]
    s = plan.SearchSettings(rules=rules, top_n=2, high_pattern="(gizmo)", genre_pattern="(ring)")
    master = plan.search_master(log, s)
    # scores: u1 = (1.5 + 1 + 50) * 1.5, u2 = 3 * 1.5, u3 = 1 * 1.0 -> keep u1, u2
    got = sorted(tuple(r) for r in master.select("user_id", "category_t6", "category_t7", "user_status").collect())
    assert got == [("u1", "Warm", "Cool", "Retained_User"), ("u2", "No_Search", "Cool", "New_User")]


def test_hot_user_is_spread_by_first_shuffle(spark):
    # a third of all rows belong to one user, each with a distinct keyword
    n = 3000
    data = [("hot" if i % 3 == 0 else f"u{i % 50}", f"kw{i}", dt.datetime(2022, 6, 1), "t6") for i in range(n)]
    log = spark.createDataFrame(data, "user_id string, keyword string, ts timestamp, period string")
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        counts = search.keyword_counts(log, ("user_id", "period"))
        per_task = (counts.filter("user_id = 'hot'").groupBy(F.spark_partition_id().alias("p")).count()
                    .agg(F.max("count")).first()[0])
        best = search.monthly_top_keywords(log).filter("user_id = 'hot'").first()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert per_task < n // 3 // 2            # spread over the shuffle partitions
    assert (best["most_search_t6"], best["cnt_t6"]) == ("kw0", n // 3)


def test_junk_users_go_with_and_without_a_cohort_bound(spark):
    from viewer_insights.plans import customer360 as plan
    log = spark.createDataFrame([("u1", "12345", "t7"), ("u2", "x", "t7"), ("u3", "red", "t7"), ("u4", "blue", "t6")],
                                "user_id string, keyword string, period string").withColumn("ts", F.lit(None).cast("timestamp"))
    for n in (None, 10):
        assert [r[0] for r in rows(plan.search_users(log, plan.SearchSettings(top_n=n)), "user_id")] == ["u3", "u4"]


def test_rules_run_once_above_the_distinct(spark):
    from viewer_insights.functions.rules import rules_from_table
    from viewer_insights.plans import customer360 as plan
    table = spark.createDataFrame([(1, "A", "x"), (2, "B", "y"), (3, "A", "z")], "priority int, category string, phrase string")
    rules = rules_from_table(table)
    assert rules == [("A", ("x",)), ("B", ("y",)), ("A", ("z",))]
    users = spark.createDataFrame([("1", "y z", "x y"), ("2", "z", "y z")], "user_id string, most_search_t6 string, most_search_t7 string")
    s = plan.SearchSettings(rules=rules)
    once = plan.keyword_categories(users, s)
    text = once._jdf.queryExecution().optimizedPlan().toString()
    top = text.splitlines()[0]  # the distinct, with the rules on its result
    assert top.startswith("Aggregate [keyword") and top.count("RLIKE") == text.count("RLIKE") == len(rules)
    stored = plan.staged_keyword_categories(users, s)
    mapped, review = search.split_review_queue(stored)
    for df in (mapped, review, plan.search_master_from_dictionary(users, stored, s)):
        assert "RLIKE" not in df._jdf.queryExecution().executedPlan().toString()
    assert rows(mapped, "keyword", "category") == [("x y", "A"), ("y z", "B"), ("z", "A")]


def test_folding_reaches_review_queue_and_both_forms(spark):
    from viewer_insights.plans import customer360 as plan
    s = plan.SearchSettings(rules=[("Music", ("hat",))], fold_diacritics=True)
    users = spark.createDataFrame([("1", "hát", "hat"), ("2", "xyz", "hát nhé")], "user_id string, most_search_t6 string, most_search_t7 string")
    categories = plan.staged_keyword_categories(users, s)
    assert [r[0] for r in rows(search.split_review_queue(categories)[1], "keyword")] == ["xyz"]
    cols = ["user_id", "category_t6", "category_t7"]
    lazy, stored = plan.search_master_from_users(users, s), plan.search_master_from_dictionary(users, categories, s)
    assert rows(lazy, *cols) == rows(stored, *cols) == [("1", "Music", "Music"), ("2", "Other", "Music")]


def _phrases(n, seed=3):
    import random
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in ("", "n", "r", "s", "t")]
    return rng, words, [" ".join(rng.choice(words) for _ in range(rng.choice((1, 1, 2, 2, 3)))) for _ in range(n)]


def test_rule_index_equals_the_case(spark):
    from viewer_insights.functions.rules import is_plain, phrase_index
    rng, words, phrases = _phrases(400)
    rules = [(f"C{i % 7}", tuple(phrases[20 * i:20 * i + 20])) for i in range(20)]
    rules[3] = ("Odd", ("b[ae]n", r"d\w+ g", "Kit", "don't", "18\\+", "hát", "", "mu-s", "_x"))
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(5))) for _ in range(600)]
    texts += ["BAN kit", "don't do", "dont", "x18+", "18+ x", "hát", "nhac hát ban", "mu-s", "mu - s", "_x", "a_x", "  ban  kit ", "ban\nkit", "ban,kit",
              "é ban", "ban é kit", "kitsch", "-kit-", "", "   ", "1", None, "long " * 200 + "kit"]
    kws = spark.createDataFrame([(t, 1) for t in dict.fromkeys(texts)], "keyword string, n int").repartition(5)
    want = {(r["keyword"], r["category"]) for r in search.categorize(kws, rules).collect()}
    got = search.categorize_by_index(kws, rules)
    assert got.columns == ["keyword", "n", "category"]
    assert {(r["keyword"], r["category"]) for r in got.collect()} == want and len(want) == kws.count()
    assert len({c for _, c in want}) > 5
    folded = {(r["keyword"], r["category"]) for r in search.categorize(kws, [("Music", ("hat",)), *rules], fold_diacritics=True).collect()}
    assert {(r["keyword"], r["category"]) for r in search.categorize_by_index(
        kws, [("Music", ("hat",)), *rules], fold_diacritics=True).collect()} == folded and ("hát", "Music") in folded
    assert {(r["keyword"], r["category"]) for r in search.categorize_by_index(kws, [("P", ("b[ae]n",))]).collect()} == {
        (r["keyword"], r["category"]) for r in search.categorize(kws, [("P", ("b[ae]n",))]).collect()}
    assert [is_plain(p) for p in ("kit", "a b", "a.b", "x+", "(a)", "", "hát", " a", "a-b", "a|b")] == [
        True, True, False, False, False, False, False, False, True, False]
    assert phrase_index([("A", ("x", "y.")), ("B", ("X", "z"))]) == ({"x": 0, "z": 1}, [(0, "A", r"(?i)\b(y.)\b")])


def test_rule_index_with_twenty_thousand_phrases(spark):
    import time
    rng, words, phrases = _phrases(60_000, 5)
    phrases = list(dict.fromkeys(phrases))[:20_000]
    rules = [(f"C{i}", tuple(phrases[400 * i:400 * i + 400])) for i in range(50)]
    texts = list(dict.fromkeys(" ".join(rng.choice(words) for _ in range(1 + rng.randrange(4))) for _ in range(3000)))
    kws = spark.createDataFrame([(t,) for t in texts], "keyword string").repartition(4)

    def run(f, r):
        t = time.perf_counter()
        got = {x["keyword"]: x["category"] for x in f(kws, r).collect()}
        return got, time.perf_counter() - t

    run(search.categorize_by_index, rules[:1])
    few, fast = run(search.categorize_by_index, rules[:3])
    got, full = run(search.categorize_by_index, rules)
    assert few == run(search.categorize, rules[:3])[0]
    assert full < 5 * fast + 5  # fifteen times the phrases
    sample = kws.where("crc32(keyword) % 10 = 0")
    want = {x["keyword"]: x["category"] for x in search.categorize(sample, rules).collect()}
    assert want and all(got[k] == c for k, c in want.items())


def test_log_time_tries_only_formats_of_the_same_shape(spark):
    from viewer_insights.functions.sqltext import string
    from viewer_insights.functions.timeparse import english_ampm_sql, parse_log_time_sql

    sql = parse_log_time_sql("t")
    # every text had up to eight attempts, one after the other
    assert max(part.count("try_to_timestamp(") for part in sql.split("coalesce(")) <= 4
    texts = ["2022-06-01 10:11:12", "2022-06-01 10:11:12.5", "2022-06-01 10:11:12.1234", "2022-06-01 1:11:12 CH", "2022-06-01 12:11:12.25 sa",
             "2022-06-01 1:11:12.123 SA", "2022-06-01 1:11:12 pm", "2022-06-01 13:11:12 PM", "2022-06-01T10:11:12", "2022-06-01T10:11:12.5Z",
             "2022-06-01", "2022-06", "2022-02-30 10:11:12", "2022-06-01 24:00:00", " 2022-06-01 10:11:12 ", "2022-06-01 10:11", "2022-6-1 1:2:3",
             "2022-06-01 10:11:12 America/New_York", "01.06.2022 um 10", "2022-03-27 02:30:00", "", "m", None]
    s = english_ampm_sql("t")
    in_turn = ", ".join(f"try_to_timestamp({s})" if f is None else f"try_to_timestamp({s}, {string(f)})" for f in vocab.TIMESTAMP_FORMATS)
    got = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", f"coalesce({in_turn}) AS want", f"{sql} AS got")
    assert got.where("NOT want <=> got").collect() == []


def test_top_keywords_of_a_log_with_partitions_of_its_own(spark):
    log = _log(spark, [
        *(("u1", f"k{i % 40}", f"2022-06-{i % 28 + 1:02d} 10:00:00") for i in range(100)),
        ("u1", "b", "2022-07-01 10:00:00"), ("u2", "x", None), ("u2", "y", None), ("u2", "x", "2022-06-01 00:00:00"),
        ("u3", "q", "2022-07-01 00:00:00"), ("u3", "p", "2022-07-01 00:00:00"), (None, "p", "2022-07-01 00:00:00"), ("u4", None, None),
    ]).withColumn("period", F.when(F.month("ts") == 6, "t6").otherwise("t7"))
    dealt = search.monthly_top_keywords(log, partitions=11)
    text = dealt._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(user_id" in text and text.count(", 11), REPARTITION_BY_NUM") == 2 and "ENSURE_REQUIREMENTS" not in text
    plain = search.monthly_top_keywords(log)
    assert dealt.schema == plain.schema
    assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
    month = log.where("period = 't6'")
    a, b = search.top_keyword(month, "t6", partitions=11), search.top_keyword(month, "t6")
    assert a.schema == b.schema and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
