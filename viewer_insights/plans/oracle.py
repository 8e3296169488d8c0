"""Plain-SQL oracle for every registered query (DuckDB dialect).

The tables ``orders lineitem part events`` are views over the same Parquet
files the Spark queries read.  The SQL is written independently of the Spark
operators: windows and joins where the Spark side uses other plans.
"""

from __future__ import annotations

from viewer_insights.sources import driver_tables as dt

_CATS = dt.FIXTURE_CATEGORIES
_TOTALS = [f'"Total_{c}"' for c in _CATS]
_MATRIX = ["Warm", "Cool", "Hardware", "Unmapped", "Other", "No_Search"]
_MATRIX_TYPED = ["Warm", "Cool", "Hardware", "Tools", "tools", "K.Drama", "back`tick", "category_t6", "warm", "c0", "user_id",
                 "Unmapped", "Other", "No_Search"]
_MATRIX_MANUAL = ["Warm", "Cool", "Hardware", "Garden", "Tools", "Unmapped", "Other", "No_Search"]


def _rule_case(col: str) -> str:
    """The sample rules, written out."""
    return (f"CASE WHEN regexp_matches({col}, '(?i)\\b(red|hot)\\b') THEN 'Warm' "
            f"WHEN regexp_matches({col}, '(?i)\\b(blue|cold)\\b') THEN 'Cool' "
            f"WHEN regexp_matches({col}, '(?i)\\b(gear|rod|bolt)\\b') THEN 'Hardware' ELSE 'Unmapped' END")


def _app_case(col: str) -> str:
    whens = " ".join(f"WHEN {col} = '{code}' THEN '{cat}'" for code, cat in dt.FIXTURE_APP_MAP.items())
    return f"CASE {whens} ELSE 'Other' END"


def _most_watch() -> str:
    g = f"greatest({', '.join(_TOTALS)})"
    whens = " ".join(f"WHEN {g} = {t} THEN '{c}'" for t, c in zip(_TOTALS, _CATS))
    return f"CASE WHEN {g} = 0 THEN 'None' {whens} ELSE 'Mixed' END"


def _taste() -> str:
    parts = ", ".join(f"CASE WHEN {t} > 0 THEN '{c}' END" for t, c in zip(_TOTALS, _CATS))
    return f"concat_ws(' - ', {parts})"


_TOTAL_SUMS = ",\n    ".join(
    f"CAST(COALESCE(SUM(CASE WHEN \"Type\" = '{c}' THEN duration END), 0) AS BIGINT) AS \"Total_{c}\"" for c in _CATS
)

CTES = f"""
WITH
search_log AS (
  SELECT CASE o_orderkey % 89 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE CAST(o_custkey AS VARCHAR) END AS user_id,
         CASE WHEN (o_orderkey + l_partkey) % 97 = 0 THEN NULL WHEN (o_orderkey + l_partkey) % 97 = 1 THEN '   '
              WHEN o_custkey % 31 = 5 THEN '12345678' WHEN o_custkey % 31 = 6 THEN substr(p_name, 1, 1)
              WHEN o_custkey % 31 = 7 THEN p_name || chr(10) || 'b' WHEN o_custkey % 31 = 8 THEN p_name || ', "q"'
              WHEN o_custkey % 31 = 9 THEN translate(p_name, 'eo', 'éô')
              WHEN o_custkey % 31 = 10 THEN '  ' || upper(p_name) || ' ' ELSE p_name END AS keyword,
         o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS ts,
         CASE WHEN o_orderdate < TIMESTAMP '{dt.SEARCH_SPLIT}' THEN 't6' ELSE 't7' END AS period
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey),
clean AS (
  SELECT user_id, trim(lower(keyword)) AS keyword, ts, period FROM search_log
  WHERE user_id IS NOT NULL AND trim(user_id) <> '' AND keyword IS NOT NULL AND trim(keyword) <> ''),
kw_counts AS (
  SELECT user_id, period, keyword, count(*) AS n, max(ts) AS last_seen
  FROM clean GROUP BY user_id, period, keyword),
ranked AS (
  SELECT user_id, period, keyword,
         row_number() OVER (PARTITION BY user_id, period
                            ORDER BY n DESC, last_seen DESC NULLS LAST, keyword ASC) AS rk,
         sum(n) OVER (PARTITION BY user_id, period) AS total
  FROM kw_counts),
top_kw AS (SELECT user_id, period, keyword, CAST(total AS BIGINT) AS total FROM ranked WHERE rk = 1),
all_users AS (
  SELECT COALESCE(a.user_id, b.user_id) AS user_id,
         a.keyword AS most_search_t6, a.total AS cnt_t6,
         b.keyword AS most_search_t7, b.total AS cnt_t7
  FROM (SELECT * FROM top_kw WHERE period = 't6') a
  FULL OUTER JOIN (SELECT * FROM top_kw WHERE period = 't7') b ON a.user_id = b.user_id),
users AS (
  SELECT * FROM all_users
  WHERE most_search_t7 IS NULL
     OR (length(most_search_t7) >= 2 AND NOT regexp_matches(most_search_t7, '^[0-9]{{5,}}$'))),
scored0 AS (
  SELECT *,
    CAST(len(string_split(most_search_t7, ' ')) AS INTEGER) AS word_count,
    CAST(COALESCE(cnt_t7, 0) * 1.5 + COALESCE(cnt_t6, 0) * 1.0
         + CASE WHEN cnt_t6 > 0 AND cnt_t7 > 0 THEN 50 ELSE 0 END AS DOUBLE) AS base_score
  FROM users),
scored1 AS (
  SELECT *,
    CAST(CASE WHEN regexp_matches(most_search_t7, '{dt.FIXTURE_HIGH_INTENT}') THEN 3.0
              WHEN regexp_matches(most_search_t7, '{dt.FIXTURE_GENRE_INTENT}') THEN 2.0
              WHEN word_count BETWEEN 2 AND 6 THEN 1.5 ELSE 1.0 END AS DOUBLE) AS intent_multiplier
  FROM scored0),
scored AS (SELECT *, base_score * intent_multiplier AS movie_score FROM scored1),
keywords AS (
  SELECT DISTINCT keyword
  FROM (SELECT most_search_t6 AS keyword FROM users UNION ALL SELECT most_search_t7 FROM users) k
  WHERE keyword IS NOT NULL),
kw_cat AS (SELECT keyword, {_rule_case("keyword")} AS category FROM keywords),
dict AS (SELECT keyword, category FROM kw_cat WHERE category <> 'Unmapped'),
categorized AS (
  SELECT u.user_id, u.most_search_t6, u.cnt_t6, u.most_search_t7, u.cnt_t7,
         CASE WHEN u.most_search_t6 IS NULL THEN 'No_Search' ELSE COALESCE(d6.category, 'Other') END AS category_t6,
         CASE WHEN u.most_search_t7 IS NULL THEN 'No_Search' ELSE COALESCE(d7.category, 'Other') END AS category_t7
  FROM users u
  LEFT JOIN dict d6 ON d6.keyword = u.most_search_t6
  LEFT JOIN dict d7 ON d7.keyword = u.most_search_t7),
master AS (
  SELECT user_id, most_search_t6, category_t6, most_search_t7, category_t7,
    CASE WHEN category_t6 = 'No_Search' THEN 'New_User'
         WHEN category_t7 = 'No_Search' THEN 'Churned_User' ELSE 'Retained_User' END AS user_status,
    CASE WHEN category_t6 = category_t7 THEN 'unchanged' ELSE 'changed' END AS trending_types,
    CASE WHEN category_t6 = category_t7 THEN category_t6
         ELSE category_t6 || ' -> ' || category_t7 END AS "Previous"
  FROM categorized),
content AS (
  SELECT CASE event_id % 53 WHEN 0 THEN '#' || user_id WHEN 1 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_id,
         event_type AS app, TRY_CAST(floor(value) AS BIGINT) AS duration, CAST(ts AS DATE) AS "date"
  FROM events),
typed AS (SELECT user_id, app, duration, "date", {_app_case("app")} AS "Type" FROM content),
vclean AS (
  SELECT * FROM typed
  WHERE duration > 0 AND "Type" <> 'Other' AND regexp_matches(user_id, '^[a-zA-Z0-9]')),
totals AS (
  SELECT user_id,
    {_TOTAL_SUMS}
  FROM vclean GROUP BY user_id),
active AS (
  SELECT user_id, round(CAST(count(DISTINCT "date") AS DOUBLE) / 30 * 100, 2) AS "Active"
  FROM vclean GROUP BY user_id),
profile AS (
  SELECT t.user_id, {", ".join("t." + c for c in _TOTALS)},
         {_most_watch()} AS "MostWatch", {_taste()} AS "Taste", a."Active"
  FROM totals t JOIN active a ON a.user_id = t.user_id),
wide AS (
  SELECT COALESCE(m.user_id, p.user_id) AS user_id,
         m.most_search_t6, m.category_t6, m.most_search_t7, m.category_t7,
         m.user_status, m.trending_types, m."Previous",
         {", ".join("p." + c for c in _TOTALS)}, p."MostWatch", p."Taste", p."Active"
  FROM master m FULL OUTER JOIN profile p ON m.user_id = p.user_id),
served AS (
  SELECT * REPLACE ({", ".join(f"COALESCE({c}, 0) AS {c}" for c in _TOTALS)}, COALESCE("Active", 0.0) AS "Active")
  FROM wide),
manual AS (
  SELECT ' ' || upper(p_name) || ' ' AS keyword,
         CASE length(p_name) % 4 WHEN 0 THEN 'Tools' WHEN 1 THEN '  ' WHEN 2 THEN 'Garden' ELSE 'Warm' END AS category
  FROM part),
mnorm AS (
  SELECT trim(lower(regexp_replace(keyword, '^\\s+|\\s+$', '', 'g'))) AS keyword,
         regexp_replace(category, '^\\s+|\\s+$', '', 'g') AS category
  FROM manual),
mdict AS (
  SELECT keyword, min(category) AS category FROM mnorm
  WHERE keyword IS NOT NULL AND trim(keyword) <> '' AND category IS NOT NULL AND trim(category) <> ''
  GROUP BY keyword),
mcategorized AS (
  SELECT u.user_id, u.most_search_t6, u.cnt_t6, u.most_search_t7, u.cnt_t7,
         CASE WHEN u.most_search_t6 IS NULL THEN 'No_Search'
              ELSE COALESCE(m6.category, d6.category, 'Other') END AS category_t6,
         CASE WHEN u.most_search_t7 IS NULL THEN 'No_Search'
              ELSE COALESCE(m7.category, d7.category, 'Other') END AS category_t7
  FROM users u
  LEFT JOIN mdict m6 ON m6.keyword = u.most_search_t6 LEFT JOIN dict d6 ON d6.keyword = u.most_search_t6
  LEFT JOIN mdict m7 ON m7.keyword = u.most_search_t7 LEFT JOIN dict d7 ON d7.keyword = u.most_search_t7)
"""


def _q(body: str) -> str:
    return CTES + body


def _cells(categories: list[str]) -> str:
    return ", ".join(
        f"CAST(SUM(CASE WHEN category_t7 = '{c}' THEN 1 ELSE 0 END) AS BIGINT) AS \"{c}\"" for c in categories)


_NONZERO = " + ".join(f"(CASE WHEN {t} > 0 THEN 1 ELSE 0 END)" for t in _TOTALS)

_STATUS_HEALTH = _q(
    f"""SELECT user_status, count(user_id) AS "User_Count",
       round(avg("Active"), 2) AS "Average_Active_Ratio",
       CAST(sum({" + ".join(_TOTALS)}) AS BIGINT) AS "Total_Platform_Watch_Time"
FROM served GROUP BY user_status""")

_SERVED = ('most_search_t6, category_t6, most_search_t7, category_t7, user_status, trending_types, "Previous", '
           + ", ".join(_TOTALS) + ', "MostWatch", "Taste", "Active"')
_SERVING_MERGE = _q(
    f""", numbered AS (SELECT *, CAST(user_id AS BIGINT) % 7 AS n FROM served),
judged AS (
  SELECT *, CASE WHEN n IN (0, 3) THEN 'new' WHEN n = 1 OR n = 2 AND user_status IS NOT NULL THEN 'changed' ELSE 'same' END AS merge_status
  FROM numbered)
SELECT user_id, {_SERVED}, CASE merge_status WHEN 'same' THEN '2024-01-01 00:00:00' ELSE '2024-02-01 00:00:00' END AS updated_at, merge_status
FROM judged
UNION ALL
SELECT 'left-' || user_id, {", ".join("NULL" for _ in _SERVED.split(", "))}, '2024-01-01 00:00:00', 'gone' FROM judged WHERE n = 3""")

_REJECTS = """SELECT CAST(ts AS DATE) AS "date",
       CASE event_id % 101 WHEN 0 THEN '{"_source":{"Contract":"' || event_id || '","AppName":"' || event_type
            WHEN 1 THEN '{"_source":{"Contract":"' || event_id || '","TotalDuration":"' || event_id || '"}}'
            WHEN 2 THEN 'not a record ' || event_id END AS line,
       CASE event_id % 101 WHEN 0 THEN 'malformed' WHEN 1 THEN 'mistyped' WHEN 2 THEN 'malformed' END AS reason FROM events"""

ORACLE_SQL = {
    "normalize_log_time": """SELECT o_orderkey,
       strftime(o_orderdate + to_seconds((o_orderkey * 7919) % 86400), '%Y-%m-%d %H:%M:%S') AS ts FROM orders""",
    "normalize_log_time_formats": """SELECT o_orderkey, CASE WHEN style = 7 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00.000'
            WHEN style < 9 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.') || lpad(CAST(CASE WHEN style IN (0, 4) THEN ms
                WHEN style IN (1, 5) THEN ms // 10 * 10 WHEN style = 2 THEN ms // 100 * 100 ELSE 0 END AS VARCHAR), 3, '0') END AS ts
       FROM (SELECT o_orderkey, o_orderdate, o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS ts,
                    o_orderkey * 31 % 1000 AS ms, o_orderkey % 11 AS style FROM orders)""",
    "clean_search_log": _q("SELECT user_id, keyword, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, period FROM clean"),
    "read_search_log": _q("SELECT user_id, keyword, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, period FROM search_log"),
    "search_master_from_raw_log": _q("SELECT * FROM master"),
    "customer_360_from_raw_logs": _q("SELECT * FROM wide"),
    "read_viewing_log": _q("SELECT * FROM content"),
    "top_keyword": _q("SELECT user_id, period, keyword AS most_search, total AS cnt FROM top_kw"),
    "month_over_month": _q("SELECT * FROM all_users"),
    "monthly_top_keywords": _q("SELECT * FROM all_users"),
    "score_users": _q("SELECT * FROM scored"),
    "top_users": _q(
        "SELECT user_id, most_search_t6, most_search_t7 FROM scored "
        "ORDER BY movie_score DESC, user_id ASC LIMIT 5000"),
    "top_users_100": _q(
        "SELECT user_id, most_search_t6, most_search_t7 FROM scored "
        "ORDER BY movie_score DESC, user_id ASC LIMIT 100"),
    "distinct_keywords": _q("SELECT keyword FROM keywords"),
    "categorize": _q("SELECT keyword, category FROM kw_cat"),
    "review_queue": _q("SELECT keyword, keyword AS family, category FROM kw_cat WHERE category = 'Unmapped'"),
    "review_sheet_roundtrip": _q(
        "SELECT keyword, keyword AS family, category FROM kw_cat WHERE category = 'Unmapped'"),
    "merge_dictionary": _q("""SELECT COALESCE(m.keyword, d.keyword) AS keyword, COALESCE(m.category, d.category) AS category
FROM mdict m FULL OUTER JOIN dict d ON m.keyword = d.keyword"""),
    "map_categories": _q("SELECT * FROM categorized"),
    "user_status": _q("SELECT user_id, category_t6, category_t7, user_status FROM master"),
    "preference_change": _q("SELECT user_id, category_t6, category_t7, trending_types FROM master"),
    "journey": _q('SELECT user_id, "Previous" FROM master'),
    "search_master": _q("SELECT * FROM master"),
    "search_master_via_dictionary": _q("SELECT * FROM master"),
    "categorize_users": _q("SELECT * FROM mcategorized"),
    "categorize_interleaved": _q(
        """SELECT keyword, CASE WHEN regexp_matches(keyword, '(?i)\\bred\\b') THEN 'Warm'
       WHEN regexp_matches(keyword, '(?i)\\b(gear|rod|bolt)\\b') THEN 'Hardware'
       WHEN regexp_matches(keyword, '(?i)\\b(hot|ring)\\b') THEN 'Warm' ELSE 'Unmapped' END AS category FROM keywords"""),
    "categorize_by_index": _q(
        """SELECT keyword, CASE WHEN regexp_matches(keyword, '(?i)\\b(red ring|b(lue|old))\\b') THEN 'Wide'
       WHEN regexp_matches(keyword, '(?i)\\b(red|hot)\\b') THEN 'Warm' WHEN regexp_matches(keyword, '(?i)\\b(blue|cold)\\b') THEN 'Cool'
       WHEN regexp_matches(keyword, '(?i)\\b(gear|rod|bolt)\\b') THEN 'Hardware'
       WHEN regexp_matches(keyword, '(?i)\\b(gizmo|ring|n[eu]w)\\b') THEN 'Late' ELSE 'Unmapped' END AS category FROM keywords"""),
    "active_ratio_from_maps": _q('SELECT user_id, "Active" FROM active'),
    "search_master_junk": _q("SELECT * FROM master"),
    "search_master_long_rules": _q("SELECT * FROM master"),
    "search_master_rule_index": _q("SELECT * FROM master"),
    "search_master_folded": _q(
        f""", folded AS (
  SELECT user_id, most_search_t6, most_search_t7,
         CASE WHEN most_search_t6 IS NULL THEN 'No_Search'
              ELSE replace({_rule_case("strip_accents(most_search_t6)")}, 'Unmapped', 'Other') END AS category_t6,
         CASE WHEN most_search_t7 IS NULL THEN 'No_Search'
              ELSE replace({_rule_case("strip_accents(most_search_t7)")}, 'Unmapped', 'Other') END AS category_t7 FROM users)
SELECT user_id, most_search_t6, category_t6, most_search_t7, category_t7,
  CASE WHEN category_t6 = 'No_Search' THEN 'New_User'
       WHEN category_t7 = 'No_Search' THEN 'Churned_User' ELSE 'Retained_User' END AS user_status,
  CASE WHEN category_t6 = category_t7 THEN 'unchanged' ELSE 'changed' END AS trending_types,
  CASE WHEN category_t6 = category_t7 THEN category_t6 ELSE category_t6 || ' -> ' || category_t7 END AS "Previous"
FROM folded"""),
    "transition_matrix": _q(f"SELECT category_t6, {_cells(_MATRIX)} FROM master GROUP BY category_t6"),
    "transition_counts": _q("SELECT category_t6, category_t7, count(*) AS users FROM mcategorized GROUP BY ALL"),
    "transition_matrix_manual": _q(
        f"SELECT category_t6, {_cells(_MATRIX_MANUAL)} FROM mcategorized GROUP BY category_t6"),
    "transition_matrix_names": _q(
        f""", typed_names AS (
  SELECT trim(lower(p_name)) AS keyword,
         min(CASE p_partkey % 8 WHEN 0 THEN 'Tools' WHEN 1 THEN 'tools' WHEN 2 THEN 'K.Drama' WHEN 3 THEN 'back`tick'
             WHEN 4 THEN 'category_t6' WHEN 5 THEN 'warm' WHEN 6 THEN 'c0' ELSE 'user_id' END) AS category
  FROM part WHERE trim(p_name) <> '' GROUP BY 1),
cats AS (
  SELECT CASE WHEN u.most_search_t6 IS NULL THEN 'No_Search' ELSE COALESCE(a.category, d6.category, 'Other') END AS category_t6,
         CASE WHEN u.most_search_t7 IS NULL THEN 'No_Search' ELSE COALESCE(b.category, d7.category, 'Other') END AS category_t7
  FROM users u
  LEFT JOIN typed_names a ON a.keyword = u.most_search_t6 LEFT JOIN dict d6 ON d6.keyword = u.most_search_t6
  LEFT JOIN typed_names b ON b.keyword = u.most_search_t7 LEFT JOIN dict d7 ON d7.keyword = u.most_search_t7)
SELECT category_t6, {", ".join(
            f"CAST(SUM(CASE WHEN category_t7 = '{c}' THEN 1 ELSE 0 END) AS BIGINT) AS c{i}" for i, c in enumerate(_MATRIX_TYPED))}
FROM cats GROUP BY category_t6"""),
    "sheet_by_header": _q("SELECT keyword, lower(keyword) AS family, category FROM manual"),
    "serving_merge": _SERVING_MERGE,
    "serving_merge_counts": f"""SELECT s.status AS merge_status, count(m.merge_status) AS users
FROM (VALUES ('new'), ('changed'), ('same'), ('gone')) s(status)
LEFT JOIN ({_SERVING_MERGE}) m ON m.merge_status = s.status GROUP BY s.status""",
    "read_viewing_rejects": f"SELECT * FROM ({_REJECTS}) r WHERE reason IS NOT NULL",
    "viewing_reject_counts": f'SELECT "date", reason, count(*) AS lines FROM ({_REJECTS}) r WHERE reason IS NOT NULL GROUP BY 1, 2',
    "map_app_category": _q('SELECT user_id, app, duration, "date", "Type" FROM typed'),
    "clean_viewing_log": _q("SELECT * FROM vclean"),
    "active_ratio": _q('SELECT user_id, "Active" FROM active'),
    "watch_totals": _q("SELECT * FROM totals"),
    "most_watched": _q('SELECT user_id, "MostWatch" FROM profile'),
    "taste": _q('SELECT user_id, "Taste" FROM profile'),
    "viewing_profile": _q("SELECT * FROM profile"),
    "viewing_profile_by_join": _q("SELECT * FROM profile"),
    "viewing_profile_streamed": _q("SELECT * FROM profile"),
    "sample_users": _q("SELECT * FROM profile ORDER BY md5(user_id || ':0'), user_id LIMIT 5000"),
    "sample_users_100": _q("SELECT * FROM profile ORDER BY md5(user_id || ':0'), user_id LIMIT 100"),
    "merge_profiles": _q("SELECT * FROM wide"),
    "merge_positional": _q(
        f"""SELECT a.user_id, a.most_search_t6, a.category_t6, a.most_search_t7, a.category_t7,
       a.user_status, a.trending_types, a."Previous",
       {", ".join("b." + t for t in _TOTALS)}, b."MostWatch", b."Taste", b."Active"
FROM (SELECT *, row_number() OVER (ORDER BY user_id) AS rn FROM master) a
JOIN (SELECT *, row_number() OVER (ORDER BY user_id) AS rn FROM profile) b ON a.rn = b.rn"""),
    "status_health": _STATUS_HEALTH,
    "status_health_served": _STATUS_HEALTH,
    "top_shifts": _q(
        """SELECT category_t6 AS "Old_Taste", category_t7 AS "New_Taste", count(user_id) AS "Shift_Volume"
FROM served WHERE trending_types = 'changed' GROUP BY category_t6, category_t7
ORDER BY 3 DESC, 1, 2 LIMIT 5"""),
    "top_shifts_10": _q(
        """SELECT category_t6 AS "Old_Taste", category_t7 AS "New_Taste", count(user_id) AS "Shift_Volume"
FROM served WHERE trending_types = 'changed' GROUP BY category_t6, category_t7
ORDER BY 3 DESC, 1, 2 LIMIT 10"""),
    "vip_users": _q(
        """SELECT user_id, user_status, "Taste", "Active", "Total_Movies" + "Total_Kids" AS "Target_Watch_Time"
FROM served WHERE "Active" > 0.8 AND "Taste" LIKE '%Movies%' AND "Taste" LIKE '%Kids%'
ORDER BY 5 DESC, user_id LIMIT 10"""),
    "shift_rate": _q(
        """SELECT count(user_id) AS users,
       count(CASE WHEN trending_types = 'changed' THEN 1 END) AS changed_users,
       CAST(count(CASE WHEN trending_types = 'changed' THEN 1 END) AS DOUBLE) / nullif(count(user_id), 0) AS shift_rate
FROM served WHERE user_status IS NOT NULL"""),
    "category_retention": _q(
        """, flows AS (
  SELECT category_t6 AS from_category, category_t7 AS to_category, count(user_id) AS users
  FROM served WHERE user_status IS NOT NULL GROUP BY 1, 2)
SELECT from_category, to_category, users,
       CAST(sum(users) OVER (PARTITION BY from_category) AS BIGINT) AS from_users,
       CAST(users AS DOUBLE) / sum(users) OVER (PARTITION BY from_category) AS share,
       from_category = to_category AS retained
FROM flows"""),
    "taste_engagement": _q(
        """SELECT "Taste", count(user_id) AS users, round(avg("Active"), 2) AS avg_active
FROM served WHERE "Taste" IS NOT NULL GROUP BY "Taste\""""),
    "archetype_engagement": _q(
        f"""SELECT CASE WHEN n >= 2 THEN 'Explorer' WHEN n = 1 THEN 'Loyalist' ELSE 'Inactive' END AS archetype,
       count(user_id) AS users, round(avg("Active"), 2) AS avg_active
FROM (SELECT *, {_NONZERO} AS n FROM served WHERE "Taste" IS NOT NULL) w GROUP BY 1"""),
    "intent_vs_watch": _q(
        """, sides AS (
  SELECT 'search' AS side, category_t7 AS category, count(user_id) AS users
  FROM served WHERE category_t7 IS NOT NULL GROUP BY category_t7
  UNION ALL
  SELECT 'watch' AS side, "MostWatch" AS category, count(user_id) AS users
  FROM served WHERE "MostWatch" IS NOT NULL GROUP BY "MostWatch")
SELECT side, category, users, CAST(users AS DOUBLE) / sum(users) OVER (PARTITION BY side) AS share
FROM sides"""),
}
