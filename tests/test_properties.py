"""Operators against brute force on random inputs."""

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from viewer_insights import vocab
from viewer_insights.operators import merge, search, viewing

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
T0 = dt.datetime(2022, 6, 1)

log_rows = st.lists(
    st.tuples(
        st.sampled_from(["u1", "u2", "u3", "u4"]),
        st.sampled_from(["a", "b", "c"]),
        st.one_of(st.none(), st.integers(0, 3).map(lambda h: T0 + dt.timedelta(hours=h))),
        st.sampled_from(["t6", "t7"]),
    ),
    min_size=1, max_size=40,
)


def brute_top(rows):
    """user -> {label: (keyword, total)} by count desc, last_seen desc (NULL last), keyword asc."""
    counts = defaultdict(lambda: [0, None])
    for u, k, t, p in rows:
        c = counts[(u, p, k)]
        c[0] += 1
        if t is not None and (c[1] is None or t > c[1]):
            c[1] = t
    out = defaultdict(dict)
    by_up = defaultdict(list)
    for (u, p, k), (n, last) in counts.items():
        by_up[(u, p)].append((n, last, k))
    for (u, p), cands in by_up.items():
        total = sum(n for n, _, _ in cands)
        best = sorted(cands, key=lambda x: (-x[0], x[1] is None, -(x[1] - T0).total_seconds() if x[1] else 0, x[2]))[0]
        out[u][p] = (best[2], total)
    return out


@SETTINGS
@given(log_rows)
def test_monthly_top_keywords_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "user_id string, keyword string, ts timestamp, period string")
    got = {r["user_id"]: r for r in search.monthly_top_keywords(df).collect()}
    want = brute_top(rows)
    assert set(got) == set(want)
    for u, per in want.items():
        for lab in ("t6", "t7"):
            exp = per.get(lab, (None, None))
            assert (got[u][f"most_search_{lab}"], got[u][f"cnt_{lab}"]) == exp


@SETTINGS
@given(st.lists(st.integers(0, 10_000), min_size=1, max_size=200, unique=True), st.integers(1, 9),
       st.integers(1, 6))
def test_row_index_is_dense_and_ordered(spark, keys, parts, buckets):
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(parts)
    got = sorted((r["row_idx"], r["k"]) for r in merge.with_row_index(df, ["k"], buckets=buckets).collect())
    assert got == list(enumerate(sorted(keys), start=1))


view_rows = st.lists(
    st.tuples(st.sampled_from(["a1", "b2", "c3"]), st.sampled_from(["VOD", "SPORT", "CHILD", "RELAX", "CHANNEL"]),
              st.integers(1, 50), st.sampled_from([dt.date(2022, 4, d) for d in (1, 2, 3)] + [None])),
    min_size=1, max_size=30,
)


@SETTINGS
@given(view_rows)
def test_viewing_profile_matches_brute_force(spark, rows):
    df = viewing.map_app_category(spark.createDataFrame(rows, "user_id string, app string, duration long, date date"))
    got = {r["user_id"]: r for r in viewing.viewing_profile(df).collect()}
    cats = vocab.VIEW_CATEGORIES
    for u in {r[0] for r in rows}:
        tot = {c: 0 for c in cats}
        days = set()
        for uu, app, d, day in rows:
            if uu == u:
                tot[vocab.APP_CATEGORY_MAP[app]] += d
                if day is not None:
                    days.add(day)
        top = max(tot.values())
        most = next(c for c in cats if tot[c] == top)
        taste = " - ".join(c for c in cats if tot[c] > 0)
        r = got[u]
        assert [r[f"Total_{vocab.VIEW_CATEGORY_COLUMNS[c]}"] for c in cats] == [tot[c] for c in cats]
        assert (r["MostWatch"], r["Taste"]) == (most, taste)
        assert r["Active"] == round(len(days) / 30 * 100, 2)


@SETTINGS
@given(st.integers(0, 50), st.integers(0, 50), st.integers(1, 20))
def test_score_is_monotone_in_counts(spark, a, b, extra):
    users = spark.createDataFrame(
        [("x", "kw a", a or None, "one piece", b or None), ("y", "kw a", (a or 0) + extra, "one piece", b or None)],
        "user_id string, most_search_t6 string, cnt_t6 long, most_search_t7 string, cnt_t7 long")
    s = {r["user_id"]: r["movie_score"] for r in search.score_users(users).collect()}
    assert s["y"] > s["x"]


def test_one_row_per_user_and_matrix_total(spark):
    import __spark_entry__ as E
    from viewer_insights.sinks.contract import duplicate_keys
    sf = "/root/testdata/sf0.001"
    for name in ("monthly_top_keywords", "top_users", "viewing_profile", "merge_profiles", "search_master"):
        df = E.queries()[name](spark, sf)
        assert duplicate_keys(df).count() == 0, name
    master = E.queries()["search_master"](spark, sf)
    matrix = E.queries()["transition_matrix"](spark, sf)
    cells = sum(sum(v for k, v in r.asDict().items() if k != "category_t6") for r in matrix.collect())
    assert cells == master.count()


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 200), st.sampled_from(["k1", "k2", "k3", "hot", None])), min_size=1, max_size=60),
       st.lists(st.sampled_from(["k1", "k2", "hot", "zz"]), unique=True), st.integers(1, 7))
def test_salted_lookup_equals_left_join(spark, big_rows, keys, buckets):
    from viewer_insights.operators.sizing import salted_left_lookup
    big = spark.createDataFrame(big_rows, "user_id long, kw string")
    small = spark.createDataFrame([(k, f"cat-{k}") for k in keys] or [("none", "x")], "k string, cat string")
    got = salted_left_lookup(big, small, "kw", "k", "xxhash64(user_id)", buckets)
    want = big.join(small, big.kw == small.k, "left").drop("k")
    key = lambda r: (r["user_id"], str(r["kw"]), str(r["cat"]))
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)
