"""Plan-shape checks: pushdown, pruning, no single-partition steps, no Python UDFs."""

import pytest

import __spark_entry__ as E
from viewer_insights.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
# Queries whose last step is a top-k (a bounded TakeOrderedAndProject) or the
# explicitly positional merge are allowed their single final partition.
TOP_K = {"top_users", "top_users_100", "top_shifts", "top_shifts_10", "vip_users", "sample_users", "sample_users_100"}


def plan(df):
    """The physical plan; for an already executed adaptive plan only its final
    plan (the string also lists the initial plan)."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_and_no_single_partition(spark, name):
    p = plan(E.queries()[name](spark, SF))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
    if name in TOP_K:
        return
    lines = p.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            # allowed: the final step of a global aggregate (one partial row
            # per task) and the row index's per-range count table (one row
            # per range partition)
            child = lines[i + 1]
            assert "HashAggregate(keys=[]" in child or (name == "merge_positional" and "keys=[_part" in child), name


def test_search_scan_pruning(spark):
    df = E.queries()["search_master"](spark, SF)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in p


def test_search_master_reads_each_table_once(spark):
    p = plan(E.queries()["merge_profiles"](spark, SF))
    assert p.count("lineitem.parquet") == 1 and p.count("orders.parquet") == 1 and p.count("events.parquet") == 1


def test_insights_read_the_serving_table(spark):
    # insight questions are answered from the stored wide table, reading only
    # the columns they use
    p = plan(E.queries()["top_shifts"](spark, SF))
    assert p.count("lineitem.parquet") == 0 and p.count("events.parquet") == 0 and "customer-360" in p
    import re
    cols = {c.split(":")[0] for c in re.search(r"ReadSchema: struct<([^>]*)>", p).group(1).split(",")}
    assert cols == {"user_id", "category_t6", "category_t7", "trending_types"}


def test_viewing_profile_has_no_join(spark):
    p = plan(E.queries()["viewing_profile"](spark, SF))
    assert "Join" not in p


@pytest.mark.parametrize("name", ["monthly_top_keywords", "viewing_profile", "search_master"])
def test_every_user_shuffle_is_pre_aggregated(spark, name):
    """Rows are combined map-side before each shuffle keyed by user, so a user
    with a third of all rows never reaches one task whole."""
    lines = plan(E.queries()[name](spark, SF)).splitlines()
    user_exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(user_id" in line]
    assert user_exchanges, name
    for i in user_exchanges:
        assert "partial_" in lines[i + 1] or "merge_" in lines[i + 1], (name, lines[i + 1])


def test_dictionary_formulation_reads_staged_users(spark):
    # users feed three branches; they are staged once, so the raw tables are
    # not scanned (and the search aggregation not recomputed) three times
    p = plan(E.queries()["map_categories"](spark, SF))
    assert p.count("lineitem.parquet") == 0 and p.count("orders.parquet") == 0


def test_keyword_categories_come_from_the_stored_users(spark, monkeypatch):
    # the log is reduced to users once; the categories of their keywords read the result
    from viewer_insights.plans import registry

    written, write = [], registry.files.write_parquet

    def watched(df, path, *args, **kw):
        written.append(plan(df))
        write(df, path, *args, **kw)

    monkeypatch.setattr(registry.files, "write_parquet", watched)
    monkeypatch.setattr(registry, "_RAW_COPIES", {})
    E.queries()["map_categories"](spark, SF)
    assert len(written) == 2 and sum("lineitem.parquet" in p for p in written) == 1


@pytest.mark.parametrize("name", ["search_master", "search_master_from_raw_log", "month_over_month"])
def test_shuffles_of_the_search_log_follow_its_rows(spark, name, monkeypatch):
    # every shuffle of the log's rows has the number of partitions that its rows take, not the session's
    from viewer_insights.operators import sizing
    from viewer_insights.plans import registry

    def queried():
        registry.forget_plans()
        monkeypatch.setattr(registry, "_RAW_COPIES", {})
        return E.queries()[name](spark, SF)

    usual = sorted(map(str, queried().collect()))
    monkeypatch.setattr(sizing, "ROWS_PER_TASK", 300)  # about 20 tasks instead of 8
    dealt = queried()
    n = registry.dt.search_partitions(spark, SF)
    assert n > 8
    shuffles = [x for x in plan(dealt).splitlines() if "Exchange hashpartitioning" in x]
    assert shuffles and all(f", {n})" in x for x in shuffles)
    assert sorted(map(str, dealt.collect())) == usual
    registry.forget_plans()
