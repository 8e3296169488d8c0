import json

import pytest
from pyspark.sql import functions as F

from viewer_insights.operators import viewing
from viewer_insights.plans import customer360 as plan
from viewer_insights.plans import jobs
from viewer_insights.sinks import contract, jdbc
from viewer_insights.sources import dictionary, logs
from viewer_insights.streaming import viewing_stream

RULES = [("Warm", ["red", "hot"]), ("Cool", ["blue", "cold"])]


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


@pytest.fixture()
def search_dir(spark, tmp_path):
    base = tmp_path / "log_search"
    days = {
        "20220601": [("u1", "Red Gear", "2022-06-01 1:05:09 CH"), ("u1", "red gear", "2022-06-01 10:00:00"),
                     ("u2", "blue rod", "2022-06-01 12:00:00 SA"), ("", "x", "2022-06-01 10:00:00")],
        "20220702": [("u1", "cold bolt", "2022-07-02 08:00:00"), ("u3", "old anvil", "2022-07-02T08:00:00")],
        "20220801": [("u9", "red", "2022-08-01 08:00:00")],
    }
    for day, data in days.items():
        spark.createDataFrame(data, "user_id string, keyword string, datetime string").withColumn(
            "extra", F.lit(1)).write.parquet(str(base / day))
    return str(base)


def test_read_search_log_one_scan_two_months(spark, search_dir):
    log = logs.read_search_log(spark, search_dir, {"t6": "202206", "t7": "202207"})
    assert log.columns == ["user_id", "keyword", "datetime", "ts", "period"]
    got = rows(log, "user_id", "period")
    assert got == sorted([("u1", "t6"), ("u1", "t6"), ("u2", "t6"), ("", "t6"), ("u1", "t7"), ("u3", "t7")], key=str)
    one = logs.read_search_month(spark, search_dir, "202207")
    assert one.count() == 2


def test_manual_dictionary_roundtrip_and_missing(spark, tmp_path):
    p = tmp_path / "reviewed.csv"
    p.write_text("Keyword_Gốc,Trưởng_Họ_(Family),category\nold anvil,old anvil,Tools\nx,x,\n", encoding="utf-8")
    d = dictionary.read_manual_dictionary(spark, str(p))
    assert rows(d, "keyword", "category") == [("old anvil", "Tools"), ("x", None)]
    with pytest.raises(dictionary.DictionaryNotFound):
        dictionary.read_manual_dictionary(spark, str(tmp_path / "absent.csv"))


def test_rule_table(spark, tmp_path):
    p = tmp_path / "rules.csv"
    p.write_text("priority,category,phrase\n2,Cool,blue\n1,Warm,red\n1,Warm,hot\n2,Cool,cold\n", encoding="utf-8")
    assert dictionary.read_rule_table(spark, str(p)) == [("Warm", ("hot", "red")), ("Cool", ("blue", "cold"))]


def _json_logs(tmp_path):
    d = tmp_path / "log_content"
    d.mkdir()
    recs = {
        "20220401.json": [("u1", "VOD", 30), ("u1", "SPORT", 10), ("u2", "CHILD", 5), ("u2", "BAD", 9)],
        "20220402.json": [("u1", "VOD", 20), ("u3", "RELAX", 0)],
    }
    for name, data in recs.items():
        (d / name).write_text("".join(
            json.dumps({"_source": {"Contract": c, "AppName": a, "TotalDuration": t}}) + "\n" for c, a, t in data))
    return d


def test_jobs_end_to_end(spark, tmp_path, search_dir):
    s = plan.SearchSettings(rules=RULES)
    v = plan.ViewingSettings()
    out = jobs.Outputs(str(tmp_path / "out"))
    log = logs.read_search_log(spark, search_dir, {"t6": "202206", "t7": "202207"})
    events = logs.read_viewing_log(spark, str(_json_logs(tmp_path) / "*.json"))
    manual = spark.createDataFrame([("OLD ANVIL", "Tools")], "keyword string, category string")
    counts = jobs.run_all(spark, log, events, s, v, out, manual=manual)
    assert counts == {"users": 3, "mapped": 3, "review": 1, "dictionary": 4, "viewers": 2, "wide": 3}
    wide = spark.read.parquet(out.path("customer_360"))
    assert [f.name for f in wide.schema.fields] == [f.name for f in contract.serving_schema().fields]
    got = {r["user_id"]: r for r in wide.collect()}
    assert (got["u1"]["category_t6"], got["u1"]["category_t7"], got["u1"]["user_status"]) == ("Warm", "Cool", "Retained_User")
    assert got["u3"]["category_t7"] == "Tools" and got["u3"]["Total_Phim_Truyen"] == 0 and got["u3"]["Active"] == 0.0
    assert (got["u1"]["Total_Phim_Truyen"], got["u1"]["Active"], got["u1"]["Taste"]) == (50, 6.67, "Phim Truyện - Thể Thao")
    review = spark.read.option("header", True).csv(out.path("review_queue"))
    assert review.columns == ["Keyword_Gốc", "Trưởng_Họ_(Family)", "category"]
    assert rows(review, "Keyword_Gốc") == [("old anvil",)]
    matrix = spark.read.option("header", True).csv(out.path("transition_matrix"))
    assert "No_Search" in matrix.columns and "Tools" in matrix.columns
    cells = [int(v) for r in matrix.collect() for k, v in r.asDict().items() if k != "category_t6"]
    assert sum(cells) == counts["users"]
    long = spark.read.option("header", True).csv(out.path("transition_counts"))
    assert ("No_Search", "Tools", "1") in rows(long, "category_t6", "category_t7", "users")
    contract.assert_unique(wide)


def test_contract_unique_check(spark):
    df = spark.createDataFrame([("a",), ("a",)], "user_id string")
    with pytest.raises(contract.ContractError):
        contract.assert_unique(df)
    with pytest.raises(contract.ContractError, match="NULL"):
        contract.assert_key(spark.createDataFrame([("a",), (None,)], "user_id string"))
    contract.assert_key(spark.createDataFrame([("a",), ("b",)], "user_id string"))


def test_jdbc_writer_options_without_a_database(monkeypatch):
    # No database is started here (none may be): the writer configuration is
    # checked without a connection.
    t = jdbc.JdbcTarget(url="jdbc:mysql://db:3306/x", user="u", password="p", driver="com.mysql.cj.jdbc.Driver",
                        batchsize=500, num_partitions=16)
    assert jdbc._options(t) == {"url": "jdbc:mysql://db:3306/x", "dbtable": "customer_360_behavior",
                                "batchsize": "500", "user": "u", "password": "p",
                                "driver": "com.mysql.cj.jdbc.Driver", "numPartitions": "16"}
    for k in ("DB_HOST", "DB_PORT", "DB_NAME", "DB_USER", "DB_PASS"):
        monkeypatch.delenv(k, raising=False)
    env = jdbc.mysql_target_from_env(4)
    assert env.num_partitions == 4
    with pytest.raises(TypeError):
        jdbc.JdbcTarget(url="jdbc:x")  # a bound on connections is required
    assert (env.url, env.user, env.password) == ("jdbc:mysql://localhost:3306/big_data_analysis", "root", "")


def test_publish_uses_truncating_overwrite(spark, monkeypatch):
    calls = {}

    class FakeWriter:
        def format(self, f):
            calls["format"] = f
            return self

        def options(self, **o):
            calls["options"] = o
            return self

        def option(self, k, v):
            calls[k] = v
            return self

        def mode(self, m):
            calls["mode"] = m
            return self

        def save(self):
            calls["saved"] = True

    df = spark.range(1)
    monkeypatch.setattr(type(df), "write", property(lambda self: FakeWriter()))
    jdbc.publish(df, jdbc.JdbcTarget(url="jdbc:x", num_partitions=2))
    assert calls["format"] == "jdbc" and calls["truncate"] == "true" and calls["mode"] == "overwrite"
    assert calls["saved"] and calls["options"]["dbtable"] == "customer_360_behavior"


def test_serving_contract_alignment(spark):
    schema = contract.serving_schema(categories=("Phim Truyện",))
    wide = spark.createDataFrame([("u1", 5, 3.3), ("u2", None, None)], "user_id string, Total_Phim_Truyen long, Active double")
    aligned = contract.align_to_schema(wide, schema)
    assert [f.name for f in aligned.schema.fields] == [f.name for f in schema.fields]
    assert rows(aligned, "user_id", "Total_Phim_Truyen", "Active") == [("u1", 5, 3.3), ("u2", 0, 0.0)]


def test_streaming_daily_ingest_equals_batch(spark, tmp_path):
    src = _json_logs(tmp_path)
    out, chk = str(tmp_path / "daily"), str(tmp_path / "chk")
    q = viewing_stream.start_daily_ingest(viewing_stream.viewing_log_stream(spark, str(src), 1), out, chk)
    q.awaitTermination(120)
    daily = viewing_stream.read_daily_viewing(spark, out)
    streamed = viewing.viewing_profile(daily)
    batch = viewing.viewing_profile(viewing.clean_viewing_log(viewing.map_app_category(
        logs.read_viewing_log(spark, str(src / "*.json")))))
    assert rows(streamed, *batch.columns) == rows(batch, *batch.columns)
    # a re-start finds nothing new and leaves the result unchanged
    q2 = viewing_stream.start_daily_ingest(viewing_stream.viewing_log_stream(spark, str(src), 1), out, chk)
    q2.awaitTermination(120)
    assert rows(viewing.viewing_profile(viewing_stream.read_daily_viewing(spark, out)), *batch.columns) == rows(
        batch, *batch.columns)


def test_command_line_job(spark, tmp_path, search_dir):
    from viewer_insights.__main__ import main
    rules = tmp_path / "rules.csv"
    rules.write_text("priority,category,phrase\n1,Warm,red\n2,Cool,blue\n", encoding="utf-8")
    logs_dir = _json_logs(tmp_path)
    counts = main(["--search-log", search_dir, "--months", "t6=202206", "t7=202207",
                   "--viewing-log", str(logs_dir / "*.json"), "--rules", str(rules), "--out", str(tmp_path / "o"),
                   "--top-n", "2", "--insights", "--sample-users", "1", "--sample-seed", "3", "--days-per-month", "15",
                   "--fold-diacritics", "--salt-buckets", "4", "--rejects"], spark=spark)
    assert counts.pop("rejects") == 0
    assert counts == {"users": 2, "mapped": 1, "review": 2, "dictionary": 1, "viewers": 1, "wide": 3, "insights": 9}
    health = spark.read.option("header", True).csv(str(tmp_path / "o" / "insights" / "status_health"))
    assert health.columns == ["user_status", "User_Count", "Average_Active_Ratio", "Total_Platform_Watch_Time"]
    assert sum(int(r["User_Count"]) for r in health.collect()) == 3
    with pytest.raises(SystemExit):
        main(["--search-log", "a", "--months", "a=1", "b=2", "--viewing-log", "c", "--rules", "d", "--out", "e", "--jdbc-from-env"],
             spark=spark)


def test_sheet_saved_by_a_spreadsheet(spark, tmp_path):
    from viewer_insights.sinks import files
    p = tmp_path / "saved.csv"
    p.write_text('Keyword_Gốc,Trưởng_Họ_(Family),category\n"say ""hi"", now",fam,Music\n"two\nlines",fam,"A, B"\n" pad ",fam,\n',
                 encoding="utf-8")
    d = dictionary.read_manual_dictionary(spark, str(p))
    assert rows(d, "keyword", "category") == sorted(
        [('say "hi", now', "Music"), ("two\nlines", "A, B"), (" pad ", None)], key=str)
    review = spark.createDataFrame([(k, k, "Unmapped") for k in ('a "b"', "x\ny", "c, d", " e ", '"', "\\", "f\\")],
                                   "keyword string, family string, category string")
    files.export_review_queue(review, str(tmp_path / "out"))
    back = dictionary.read_manual_dictionary(spark, str(tmp_path / "out"))
    assert rows(back, "keyword", "family", "category") == rows(review, "keyword", "family", "category")


def test_a_hot_day_is_written_by_several_tasks(spark, tmp_path):
    from viewer_insights.sinks import files
    data = [(f"u{i}", f"k{i}", "2022-06-01 10:00:00", "20220601" if i % 10 else "20220602") for i in range(3000)]
    df = spark.createDataFrame(data, "user_id string, keyword string, datetime string, day string")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files.write_search_log(df, str(tmp_path / "log"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    back = spark.read.parquet(str(tmp_path / "log")).withColumn("f", F.input_file_name())
    sizes = [r["count"] for r in back.filter("day = 20220601").groupBy("f").count().collect()]
    assert back.count() == 3000 and len(sizes) > 2 and max(sizes) < 1500


def test_a_cluster_without_shared_storage_is_refused(monkeypatch):
    from viewer_insights import session

    class Session:
        class conf:  # noqa: N801 - stands for the session's options
            @staticmethod
            def get(key, default=None):
                return default

    class Context:
        master, applicationId = "spark://host:7077", "app-x"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    monkeypatch.setattr(session, "_context", lambda s: Context())
    with pytest.raises(session.SharedStorageMissing):
        session.checkpoint_dir(Session())


def test_no_scratch_folder_is_left(spark):
    import os

    from viewer_insights.operators import merge
    from viewer_insights.session import checkpoint_dir, scratch_tables
    root = checkpoint_dir(spark)
    before = set(os.listdir(root))
    a = spark.createDataFrame([(str(i), i) for i in range(50)], "user_id string, x int")
    b = spark.createDataFrame([(str(i), -i) for i in range(50)], "user_id string, y int")
    with scratch_tables(spark):
        got = rows(merge.merge_positional(a, b), "user_id", "x", "y")
        assert set(os.listdir(root)) > before
    assert set(os.listdir(root)) == before and all(x == -y for _, x, y in got)


def test_job_and_registered_insights_agree(spark, tmp_path):
    # the job's report runs on the served table, where a user without viewing has Active 0.0
    from viewer_insights.operators import insights
    wide = spark.createDataFrame([("u1", "Retained_User", 20.0, 5), ("u2", "Retained_User", None, None)],
                                 "user_id string, user_status string, Active double, Total_Phim_Truyen long")
    served = contract.align_to_schema(wide, contract.serving_schema(categories=("Phim Truyện",)))
    (r,) = insights.status_health(served, ["Total_Phim_Truyen"]).collect()
    assert (r["User_Count"], r["Average_Active_Ratio"], r["Total_Platform_Watch_Time"]) == (2, 10.0, 5)


def test_sheet_columns_are_found_by_header(spark, tmp_path):
    p = tmp_path / "moved.csv"
    p.write_text('category,note, Keyword_Gốc ,Trưởng_Họ_(Family),n\nTools,x,saw,fam,1\n,"a, b","two\nlines",fam,2\n', encoding="utf-8")
    assert rows(dictionary.read_manual_dictionary(spark, str(p)), "keyword", "family", "category") == sorted(
        [("saw", "fam", "Tools"), ("two\nlines", "fam", None)], key=str)
    p.write_text("﻿Keyword_Gốc,Trưởng_Họ_(Family),category\nsaw,fam,Tools\n", encoding="utf-8")
    assert rows(dictionary.read_manual_dictionary(spark, str(p)), "keyword", "category") == [("saw", "Tools")]
    for header in ("Keyword_Gốc,family,category", "Keyword_Gốc,Trưởng_Họ_(Family),category,category", "", "x"):
        p.write_text(header + "\na,b,c\n" if header else "", encoding="utf-8")
        with pytest.raises(dictionary.SheetHeaderError):
            dictionary.read_manual_dictionary(spark, str(p))


def test_files_of_a_sheet_with_different_headers_are_refused(spark, tmp_path):
    d = tmp_path / "sheet"
    d.mkdir()
    (d / "a.csv").write_text("Keyword_Gốc,Trưởng_Họ_(Family),category\nsaw,fam,Tools\n", encoding="utf-8")
    (d / "b.csv").write_text("category,Trưởng_Họ_(Family),Keyword_Gốc\nGarden,fam,spade\n", encoding="utf-8")
    with pytest.raises(Exception, match="header"):
        dictionary.read_manual_dictionary(spark, str(d)).collect()


def test_rule_table_by_header(spark, tmp_path):
    p = tmp_path / "rules.csv"
    p.write_text('phrase,why,category,priority\nblue,"two\nlines",Cool,2\nred,,Warm,1\n', encoding="utf-8")
    assert dictionary.read_rule_table(spark, str(p)) == [("Warm", ("red",)), ("Cool", ("blue",))]
    p.write_text("phrase,category,priority\nblue,Cool,high\n", encoding="utf-8")
    with pytest.raises(ValueError, match="priority"):
        dictionary.read_rule_table(spark, str(p))
    with pytest.raises(dictionary.SheetHeaderError):
        p.write_text("phrase,category\nblue,Cool\n", encoding="utf-8")
        dictionary.read_rule_table(spark, str(p))


TYPED = ["Tools", "tools", "K.Drama", "back`tick", "category_t6", "warm", "c0", "a,b\n\"c\""]


def test_search_stage_with_categories_as_people_type_them(spark, tmp_path, search_dir, monkeypatch):
    s = plan.SearchSettings(rules=[*RULES, ("WARM", ["gear"])])
    out = jobs.Outputs(str(tmp_path / "out"))
    log = logs.read_search_log(spark, search_dir, {"t6": "202206", "t7": "202207"})
    manual = spark.createDataFrame([(f"kw {i}", c) for i, c in enumerate(TYPED)] + [("old anvil", "back`tick"), ("cold bolt", "category_t6")],
                                   "keyword string, category string")
    jobs.run_search_stage(spark, log, s, out, manual)
    names = {r["header"]: r["category"] for r in dictionary.read_by_header(
        spark, out.path("transition_matrix_names"), {"header": "header", "category": "category"}).collect()}
    assert set(TYPED) < set(names.values()) and len({h.lower() for h in names}) == len(names) and "category_t6" not in names
    matrix = spark.read.options(**dictionary.CSV_OPTIONS).option("multiLine", True).csv(out.path("transition_matrix"))
    assert matrix.columns == ["category_t6", *(r[0] for r in dictionary.read_by_header(
        spark, out.path("transition_matrix_names"), {"header": "header", "position": "position"}).orderBy(
            F.expr("CAST(position AS INT)")).collect())]
    cells = {(r[0], names[h]): int(v) for r in matrix.collect() for h, v in zip(matrix.columns[1:], r[1:]) if v != "0"}
    assert cells == {("Warm", "category_t6"): 1, ("Cool", "No_Search"): 1, ("No_Search", "back`tick"): 1}
    # more categories than columns: the long form is there, and the job goes on
    from viewer_insights.operators import enrich
    monkeypatch.setattr(enrich, "matrix_categories", lambda *a: (_ for _ in ()).throw(enrich.TooManyCategories("too many")))
    wide = jobs.Outputs(str(tmp_path / "wide"))
    jobs.run_search_stage(spark, log, s, wide, manual)
    assert spark.read.option("header", True).csv(wide.path("transition_counts")).count() == 3
    assert not (tmp_path / "wide" / "transition_matrix").exists()


SERVED = "user_id string, a string, b string, n long, updated_at timestamp_ntz"


def _served(spark, data, stamp):
    from datetime import datetime
    return spark.createDataFrame([(*r, datetime(2024, stamp, 1)) for r in data], SERVED)


def test_serving_merge_keeps_stamps_of_unchanged_rows(spark):
    from viewer_insights.sinks import serving
    old = _served(spark, [("same", "x", None, 1), ("moved", None, "x", 1), ("num", "x", "y", 1), ("left", "x", "y", 1), ("nul", None, None, None)], 1)
    new = _served(spark, [("same", "x", None, 1), ("moved", "x", None, 1), ("num", "x", "y", 2), ("came", "x", "y", 1), ("nul", None, None, None)], 2)
    merged = serving.merge_serving(old, new)
    assert merged.columns == [*new.columns, "merge_status"]
    got = {r["user_id"]: (r["merge_status"], r["updated_at"].month) for r in merged.collect()}
    assert got == {"same": ("same", 1), "moved": ("changed", 2), "num": ("changed", 2), "came": ("new", 2), "left": ("gone", 1), "nul": ("same", 1)}
    assert {r["merge_status"]: r["users"] for r in serving.merge_counts(merged).collect()} == {"new": 1, "changed": 2, "same": 2, "gone": 1}
    assert {r["merge_status"]: r["users"] for r in serving.merge_counts(merged.limit(0)).collect()} == dict.fromkeys(("new", "changed", "same", "gone"), 0)
    # a column that the stored table lacks makes every common row a changed one; one that only it has is ignored
    assert {r[0]: r[-1] for r in serving.merge_serving(old.drop("b"), new).collect()}["same"] == "changed"
    assert {r[0]: r[-1] for r in serving.merge_serving(old.withColumn("z", F.lit(1)), new).collect()}["same"] == "same"


def test_a_refused_table_leaves_the_served_one(spark, tmp_path):
    from viewer_insights.sinks import serving
    path = str(tmp_path / "table")
    first = _served(spark, [("u1", "x", "y", 1), ("u2", "x", "y", 2)], 1)
    assert serving.publish(first, path).count() == 2
    for bad in ([("u1", "x", "y", 1), ("u1", "x", "y", 2)], [(None, "x", "y", 1)]):
        with pytest.raises(contract.ContractError):
            serving.publish(_served(spark, bad, 2), path)
        assert rows(spark.read.parquet(path), "user_id", "n") == [("u1", 1), ("u2", 2)]
    assert [p.name for p in tmp_path.iterdir()] == ["table"]
    # the new table may be made from the served one
    assert serving.publish(spark.read.parquet(path).withColumn("n", F.expr("n + 1")), path).agg(F.sum("n")).first()[0] == 5
    assert [p.name for p in tmp_path.iterdir()] == ["table"]


def test_a_second_run_stamps_only_what_changed(spark, tmp_path, search_dir):
    s, v = plan.SearchSettings(rules=RULES), plan.ViewingSettings()
    out = jobs.Outputs(str(tmp_path / "out"))
    log = logs.read_search_log(spark, search_dir, {"t6": "202206", "t7": "202207"})
    events = logs.read_viewing_log(spark, str(_json_logs(tmp_path) / "*.json"))
    jobs.run_all(spark, log, events, s, v, out)
    before = {r["user_id"]: r["updated_at"] for r in spark.read.parquet(out.path("customer_360")).collect()}
    assert jobs.run_all(spark, log.where("user_id <> 'u3'"), events.where("app <> 'CHILD'"), s, v, out)["wide"] == 2
    after = {r["user_id"]: r["updated_at"] for r in spark.read.parquet(out.path("customer_360")).collect()}
    assert after["u1"] == before["u1"] and after["u2"] > before["u2"]
    counts = spark.read.option("header", True).csv(out.path("serving_merge")).collect()
    assert {r["merge_status"]: r["users"] for r in counts} == {"new": "0", "changed": "1", "same": "1", "gone": "1"}
    assert rows(spark.read.option("header", True).csv(out.path("serving_gone")), "user_id") == [("u3",)]


def test_viewing_rejects_are_told_apart(spark, tmp_path):
    d = tmp_path / "log"
    d.mkdir()
    good = '{"_source":{"Contract":"u1","AppName":"VOD","TotalDuration":5}}'
    lines = [good, '{"_source":{"Contract":"u2"', "no record", '{"_source":{"Contract":"u3","TotalDuration":"7"}}', "", '{"other":1}', "  "]
    (d / "20220401.json").write_text("\n".join(lines), encoding="utf-8")
    rejects = logs.read_viewing_rejects(spark, str(d / "*.json"))
    assert rows(rejects, "file", "line", "reason") == sorted(
        [("20220401.json", lines[1], "malformed"), ("20220401.json", lines[2], "malformed"), ("20220401.json", lines[3], "mistyped")], key=str)
    assert rows(logs.viewing_reject_counts(rejects), "reason", "lines") == [("malformed", 2), ("mistyped", 1)]
    assert logs.read_viewing_log(spark, str(d / "*.json")).where("app = 'VOD'").count() == 1
    out = jobs.Outputs(str(tmp_path / "out"))
    assert jobs.export_rejects(spark, str(d / "*.json"), out) == 3
    back = spark.read.options(**dictionary.CSV_OPTIONS).csv(out.path("viewing_rejects"))
    assert rows(back, "line") == rows(rejects, "line")
    assert spark.read.option("header", True).csv(out.path("viewing_reject_counts")).count() == 2


def test_filters_on_the_serving_table_skip_files(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    from viewer_insights.sinks import serving
    df = spark.range(40_000).selectExpr(
        "CAST(id AS STRING) AS user_id", "element_at(array('Churned_User', 'New_User', 'Retained_User', NULL), CAST(id % 4 AS INT) + 1) AS user_status",
        "CASE WHEN id % 3 = 0 THEN 'changed' ELSE 'unchanged' END AS trending_types",
        "CASE WHEN id % 5 = 0 THEN 10.0D ELSE 0.0D END AS Active")
    path = str(tmp_path / "served")
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "40"}  # small tables become one file else
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        serving.write_served(df, path)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    parts = glob.glob(path + "/*.parquet")
    seen = [{(g.column(1).statistics.min, g.column(1).statistics.max) for g in
             (pq.ParquetFile(p).metadata.row_group(i) for i in range(pq.ParquetFile(p).metadata.num_row_groups))
             if g.column(1).statistics.has_min_max} for p in parts]
    assert len(parts) > 4
    with_churned = sum(any(low <= "Churned_User" <= high for low, high in s) for s in seen)
    assert 1 <= with_churned <= len(parts) // 2  # a third of the statuses lies in few files, yet in more than one
    jvm = spark._jvm.org.apache
    at = jvm.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.hadoop.fs.Path(parts[0]), spark._jsc.hadoopConfiguration())
    reader = jvm.parquet.hadoop.ParquetFileReader.open(at)
    offsets = [c.getBloomFilterOffset() for c in reader.getFooter().getBlocks().get(0).getColumns()]
    reader.close()
    assert offsets[0] > 0 and set(offsets[1:]) == {-1}  # on user_id alone
    table = spark.read.parquet(path)
    assert sorted(map(str, table.collect())) == sorted(map(str, df.collect()))
    q = table.where("trending_types = 'changed' AND user_status = 'Churned_User'")
    assert "PushedFilters: [IsNotNull(trending_types)" in q._jdf.queryExecution().executedPlan().toString()
    # files that top_shifts (changed) and vip_users (Active > 0.8) need not read
    stats = [pq.ParquetFile(p).metadata.row_group(0) for p in parts]
    assert any(g.column(2).statistics.min == "unchanged" for g in stats) and any(g.column(3).statistics.max <= 0.8 for g in stats)
    assert q.count() == df.where("trending_types = 'changed' AND user_status = 'Churned_User'").count()
