"""Every registered query against its SQL oracle (DuckDB) on the small tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from viewer_insights.plans.oracle import ORACLE_SQL
from viewer_insights.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        return v.isoformat() if hasattr(v, "isoformat") else v

    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(cur.fetchall(), ocols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["Old_Taste", "New_Taste", "Shift_Volume"]
    assert df.count() >= 0


@pytest.mark.parametrize("cte,kept,dropped", [
    ("search_log", "clean", "user_id IS NULL"), ("search_log", "clean", "trim(user_id) = ''"), ("search_log", "clean", "keyword IS NULL"),
    ("search_log", "clean", "trim(keyword) = ''"), ("all_users", "users", "length(most_search_t7) < 2"),
    ("all_users", "users", "most_search_t7 = '12345678'"), ("typed", "vclean", "user_id LIKE '#%'"), ("typed", "vclean", "user_id IS NULL"),
    ("typed", "vclean", "duration <= 0"), ("typed", "vclean", "\"Type\" = 'Other'")])
def test_every_filter_removes_rows_of_the_fixture(con, cte, kept, dropped):
    from viewer_insights.plans.oracle import CTES
    count = lambda t: con.execute(f"{CTES} SELECT count(*) FROM {t} WHERE {dropped}").fetchone()[0]
    assert count(cte) > 0 and count(kept) == 0


def test_both_dictionary_branches_win(con):
    from viewer_insights.plans.oracle import CTES
    n = con.execute(f"""{CTES} SELECT count(CASE WHEN m.keyword IS NULL THEN 1 END),
        count(CASE WHEN d.category <> m.category THEN 1 END) FROM dict d LEFT JOIN mdict m ON m.keyword = d.keyword""").fetchone()
    assert n[0] > 0 and n[1] > 0
