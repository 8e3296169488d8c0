"""The registered queries on the small given tables: against SQL where SQL can say it, else row by row."""

import zlib

import duckdb
import pytest

from viewer_insights.llm import decontamination, quality_rules, secret_scan, simhash
from viewer_insights.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("SELECT doc_id, text FROM documents").fetchall())


def run(spark, name):
    return QUERIES[next(n for n in QUERIES if n.startswith(name + "_"))](spark, SF).collect()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert sorted(map(str, (tuple(r) for r in df.select(*cols).collect()))) == sorted(map(str, cur.fetchall()))


def test_decontamination_covers_every_document(spark, con, texts):
    matcher = decontamination.Matcher(con.execute("SELECT item_id, text FROM benchmark").fetchall())
    want = {(i, m[1], m[2]) for i, t in texts.items() for m in matcher.search([t])}
    assert {(r["doc_id"], r["item_id"], r["edits"]) for r in run(spark, "op1")} == want and want


def test_quality_rules_cover_every_document(spark, con, texts):
    got = {r["doc_id"]: r for r in run(spark, "op2")}
    assert set(got) == set(texts)
    for i, t in texts.items():
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == quality_rules.base_statistics(t)
    labels = dict(con.execute("SELECT doc_id, quality FROM labels").fetchall())
    assert all(got[i]["kept"] or got[i]["base_failed"] for i, q in labels.items() if q == 1)
    assert not any(got[i]["kept"] for i, q in labels.items() if q == 0)


def test_secret_scan_covers_every_document(spark, texts):
    got = {r["doc_id"]: r["spans"] for r in run(spark, "op3")}
    assert got == {i: secret_scan.joined(secret_scan.find_spans(t)) for i, t in texts.items()} and any(got.values())


def test_near_dedup_equals_all_pairs(spark, texts):
    fps = {i: simhash.fingerprint(t) & (2**64 - 1) for i, t in texts.items()}
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in fps:
        for j in fps:
            if j < i and (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in run(spark, "op7")}
    assert got == {i: (f"{f:016x}", find(i)) for i, f in fps.items()}


def test_classifier_on_the_held_out_fold(spark):
    # a fold of the smallest tables holds 19 labels; these have some eighty
    sf = SF.replace("0.001", "0.01")
    name = next(n for n in QUERIES if n.startswith("op10_"))
    got = {r["doc_id"]: r for r in QUERIES[name](spark, sf).collect()}
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall()
    assert len(got) == duckdb.sql(f"SELECT count(*) FROM '{sf}/documents.parquet'").fetchall()[0][0]
    held = [(q, got[i]["predicted"]) for i, q in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 60 and sum(a == b for a, b in held) >= 0.95 * len(held)
    bad = [p for q, p in held if q == 0]
    assert len(bad) > 5 and sum(bad) <= 0.2 * len(bad)


def test_all_queries_run_on_workers_without_this_package(tmp_path):
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = f"""
import sys
sys.path.insert(0, {root!r})  # the driver alone
import __spark_entry__ as entry
from viewer_insights.session import drop_scratch, local_session
spark = local_session(cores=4, shuffle_partitions=4)
for name, query in entry.queries().items():
    if name == "pipeline" or name.startswith("op"):
        query(spark, {SF!r}).write.format("noop").mode("overwrite").save()
        print("ran", name, flush=True)
drop_scratch(spark)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.count("ran ") == 14
