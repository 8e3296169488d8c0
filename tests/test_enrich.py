from pyspark.sql import functions as F

from viewer_insights import vocab
from viewer_insights.operators import enrich

USERS = "user_id string, most_search_t6 string, most_search_t7 string"


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_merge_dictionary_manual_wins_and_blank_dropped(spark):
    rule = spark.createDataFrame(
        [("naruto", "Anime"), ("xem phim", "Movies_General"), ("zzz", vocab.UNMAPPED)], "keyword string, category string")
    manual = spark.createDataFrame(
        [(" Naruto ", "Cartoon_Kids"), ("zzz", " Music "), ("blank", "  "), ("none", None), ("zzz", "Anime")],
        "keyword string, category string")
    d = enrich.merge_dictionary(rule, manual)
    assert rows(d, "keyword", "category") == [
        ("naruto", "Cartoon_Kids"), ("xem phim", "Movies_General"), ("zzz", "Anime")]


def test_labels(spark):
    users = spark.createDataFrame(
        [("new", None, "naruto"), ("churn", "naruto", None), ("oth", "qqq", "www"), ("same", "naruto", "naruto"),
         ("none", None, None)], USERS)
    d = spark.createDataFrame([("naruto", "Anime")], "keyword string, category string")
    master = enrich.enrich_labels(enrich.map_categories(users, d))
    got = {r["user_id"]: tuple(r)[1:] for r in master.collect()}
    assert got["new"] == (None, "No_Search", "naruto", "Anime", "New_User", "changed", "No_Search -> Anime")
    assert got["churn"] == ("naruto", "Anime", None, "No_Search", "Churned_User", "changed", "Anime -> No_Search")
    assert got["oth"] == ("qqq", "Other", "www", "Other", "Retained_User", "unchanged", "Other")
    assert got["same"] == ("naruto", "Anime", "naruto", "Anime", "Retained_User", "unchanged", "Anime")
    assert got["none"][4] == "New_User"


def test_categorize_users_matches_dictionary_join(spark):
    rules = [("Warm", ["red", "hot"]), ("Cool", ["blue", "cold"])]
    users = spark.createDataFrame(
        [("1", "red gear", "blue rod"), ("2", None, "old anvil"), ("3", "hot blue", None), ("4", "new ring", "new ring")],
        USERS)
    manual = spark.createDataFrame([("NEW RING ", "Jewel"), ("red gear", "Override")], "keyword string, category string")
    from viewer_insights.operators import search
    mapped, _ = search.split_review_queue(search.categorize(search.distinct_keywords(users), rules))
    via_join = enrich.map_categories(users, enrich.merge_dictionary(mapped, manual))
    inline = enrich.categorize_users(users, rules, manual)
    cols = ["user_id", "category_t6", "category_t7"]
    assert rows(inline, *cols) == rows(via_join, *cols) == [
        ("1", "Override", "Cool"), ("2", "No_Search", "Other"), ("3", "Warm", "No_Search"), ("4", "Jewel", "Jewel")]


def test_transition_matrix_cells_sum_to_users(spark):
    master = spark.createDataFrame(
        [("1", "A", "B"), ("2", "A", "A"), ("3", "No_Search", "A"), ("4", "A", "B")],
        "user_id string, category_t6 string, category_t7 string")
    cats = ["A", "B", "Other", "No_Search"]
    m = enrich.transition_matrix(master, cats)
    assert m.columns == ["category_t6", *cats]
    got = {r["category_t6"]: tuple(r)[1:] for r in m.collect()}
    assert got == {"A": (1, 2, 0, 0), "No_Search": (1, 0, 0, 0)}
    assert sum(sum(v) for v in got.values()) == master.count()


def test_hot_keyword_lookup_is_salted(spark):
    # 3000 users, a third share one keyword; the dictionary is joined with a
    # salt so the hot keyword's users do not meet in one task
    data = [(str(i), "hot kw" if i % 3 == 0 else f"kw {i}", None) for i in range(3000)]
    users = spark.createDataFrame(data, USERS)
    d = spark.createDataFrame([("hot kw", "Hot")] + [(f"kw {i}", "Cold") for i in range(0, 3000, 7)],
                              "keyword string, category string")
    out = enrich.map_categories(users, d)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan
    got = dict((r["user_id"], r["category_t6"]) for r in out.collect())
    assert sum(1 for v in got.values() if v == "Hot") == 1000
    assert got["7"] == "Cold" and got["1"] == "Other" and len(got) == 3000
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        hot = enrich.map_categories(users, d).filter("category_t6 = 'Hot'")
        per_task = hot.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert per_task < 400


def test_fold_diacritics_option(spark):
    from viewer_insights.functions.diacritics import fold_table
    src, dst = fold_table()
    assert len(src) == len(dst) and "ệ" in src and "đ" in src
    rules = [("Music", ["hat", "nhac"])]
    users = spark.createDataFrame([("1", "hát", "NHẠC"), ("2", "hat", None)], USERS)
    users = users.withColumn("most_search_t7", F.lower("most_search_t7"))
    parity = enrich.categorize_users(users, rules)
    folded = enrich.categorize_users(users, rules, fold_diacritics=True)
    assert rows(parity, "user_id", "category_t6", "category_t7") == [("1", "Other", "Other"), ("2", "Music", "No_Search")]
    assert rows(folded, "user_id", "category_t6", "category_t7", "most_search_t6") == [
        ("1", "Music", "Music", "hát"), ("2", "Music", "No_Search", "hat")]


def test_rule_conflicts_report(spark):
    from viewer_insights.operators.quality import rule_conflicts
    rules = [("Sports", ["mu", "bong da"]), ("Anime", ["naruto", "hai tac mu rom"]),
             ("Horror", ["ma"]), ("Thai-Drama", ["phim ma thai"]), ("Adult", [r"18\+"]),
             ("Movies_General", ["phim", r"tap \d+"])]
    got = rows(rule_conflicts(spark, rules), "phrase", "assigned")
    # "tap \\d+" is a pattern that "tap 12" matches: not judged
    assert got == [("18\\+", "Unmapped"), ("hai tac mu rom", "Sports"), ("phim ma thai", "Horror")]


def test_lookup_of_a_reviewed_dictionary(spark):
    rules = [("Warm", ["red", "hot"]), ("Cool", ["blue", "cold"])]
    users = spark.createDataFrame(
        [("1", "red gear", "blue rod"), ("2", None, "old anvil"), ("3", "new ring", "hot blue")], USERS)
    manual = spark.createDataFrame([("NEW RING ", "Jewel"), ("red gear", "Override"), ("new ring", "Alpha")],
                                   "keyword string, category string")
    small = enrich.categorize_users(users, rules, manual, salt_buckets=1)
    large = enrich.categorize_users(users, rules, manual, salt_buckets=5)
    assert "_salt" in large._jdf.queryExecution().executedPlan().toString()
    cols = ["user_id", "category_t6", "category_t7"]
    assert rows(large, *cols) == rows(small, *cols) == [
        ("1", "Override", "Cool"), ("2", "No_Search", "Other"), ("3", "Alpha", "Warm")]


def test_matrix_has_columns_for_dictionary_only_categories(spark):
    import pytest

    master = spark.createDataFrame([("1", "Warm", "Tools"), ("2", "Warm", "Warm"), ("3", "Tools", "No_Search")],
                                   "user_id string, category_t6 string, category_t7 string")
    manual = spark.createDataFrame([("a", "Tools"), ("b", " "), ("c", "Warm")], "keyword string, category string")
    cats = enrich.matrix_categories(["Warm", "Cool", "Warm"], manual)
    assert cats == ["Warm", "Cool", "Tools", "Unmapped", "Other", "No_Search"]
    m = enrich.transition_matrix(master, cats)
    assert sum(sum(tuple(r)[1:]) for r in m.collect()) == master.count()
    with pytest.raises(Exception, match="outside the transition matrix: Tools"):
        enrich.transition_matrix(master, enrich.matrix_categories(["Warm", "Cool"])).collect()
    with pytest.raises(enrich.TooManyCategories):
        enrich.dictionary_categories(manual, max_categories=1)
    assert rows(enrich.transition_counts(master), "category_t6", "category_t7", "users") == [
        ("Tools", "No_Search", 1), ("Warm", "Tools", 1), ("Warm", "Warm", 1)]


def test_users_without_a_keyword_spread_over_the_tasks(spark):
    users = spark.createDataFrame([(str(i), None if i % 2 else f"k{i % 50}", "x") for i in range(4000)], USERS)
    d = spark.createDataFrame([(f"k{i}", "C") for i in range(0, 50, 4)], "keyword string, category string")
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = enrich.map_categories(users.select("user_id", "most_search_t6"), d, labels=("t6",))
        empty = out.filter("category_t6 = 'No_Search'")
        per_task = empty.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count"), F.sum("count")).first()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert per_task[1] == 2000 and per_task[0] < 500


def test_users_are_shuffled_once_for_all_months(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    users = spark.range(100).selectExpr("CAST(id AS STRING) AS user_id", "concat('k', id % 9) AS most_search_t6",
                                        "concat('k', id % 7) AS most_search_t7", "id AS payload")
    d = spark.createDataFrame([("k1", "A"), ("k2", "B")], "keyword string, category string")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = enrich.map_categories(users, d)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = {r["user_id"]: (r["category_t6"], r["category_t7"], r["payload"]) for r in out.collect()}
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    names = {"k1": "A", "k2": "B"}
    assert got == {str(i): (names.get(f"k{i % 9}", "Other"), names.get(f"k{i % 7}", "Other"), i) for i in range(100)}
    # one exchange of wide user rows, keyed by user; those keyed by keyword carry (user, key) alone
    wide = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "user_id" in x]
    assert len(wide) == 1 and plan.count("SortMergeJoin") == 2


def test_lookup_of_repeated_and_missing_users(spark):
    users = spark.createDataFrame([("a", "x", "y"), ("a", "y", "z"), (None, "x", None), ("b", None, None), ("c", " ", "X")], USERS)
    d = spark.createDataFrame([("x", "X1"), ("y", "Y1")], "keyword string, category string")
    got = sorted((str(r["user_id"]), r["category_t6"], r["category_t7"]) for r in enrich.map_categories(users, d).collect())
    assert got == [("None", "X1", "No_Search"), ("a", "X1", "Y1"), ("a", "Y1", "Other"), ("b", "No_Search", "No_Search"), ("c", "Other", "X1")]


def test_only_hot_keys_are_salted(spark):
    from viewer_insights.operators import sizing
    rows_ = spark.range(30_000).selectExpr("CAST(id AS STRING) AS u", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 100 = 1 THEN NULL ELSE concat('k', id) END AS k")
    assert [r["_hot_key"] for r in sizing.hot_keys(rows_, "k").collect()] == ["hot"]
    assert sizing.hot_keys(rows_.where("k <> 'hot'"), "k").collect() == [] == sizing.hot_keys(rows_.limit(0), "k").collect()
    small = spark.createDataFrame([("hot", 1), ("k1000", 2), ("none", 3)], "s string, v int")
    joined = sizing.hot_salted_lookup(rows_, small, "k", "s", "xxhash64(u)", 8)
    assert joined.columns == ["u", "k", "v"] and joined.where("v = 1").count() == 10_000 and joined.where("v = 2").count() == 1
    spread = sizing.hot_salted_lookup(rows_, small, "k", "s", "xxhash64(u)", 8)
    assert spread.count() == 10_001
