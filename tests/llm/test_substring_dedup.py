import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from viewer_insights.llm import substring_dedup as s
from viewer_insights.llm.queries import QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(docs, window=35):
    found = [(i, WORD.findall(t or "")) for i, t in docs]
    places = Counter(tuple(w[k:k + window]) for _, w in found for k in range(len(w) - window + 1))
    out = []
    for i, w in found:
        gone = set()
        for k in range(len(w) - window + 1):
            if places[tuple(w[k:k + window])] > 1:
                gone.update(range(k, k + window))
        out.append((str(i), len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


def got(df):
    return sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["text"]) for r in df.collect())


def prose(n, seed):
    r = random.Random(seed)
    return [f"w{r.randrange(500)}" for _ in range(n)]


def planted(seed, n=40):
    """Documents with passages around the window's length, at borders and twice in a document, and near copies."""
    r = random.Random(seed)
    shared = [prose(k, 1000 + k) for k in (10, 34, 35, 36, 60, 130)]
    docs = []
    for i in range(n):
        w = prose(r.randrange(0, 120), seed * 100 + i)
        for _ in range(r.randrange(3)):
            at = r.choice([0, len(w), r.randrange(len(w) + 1)])
            p = r.choice(shared)
            low = r.randrange(0, max(1, len(p) - 30))
            w[at:at] = p[low:] if r.random() < 0.5 else p
        docs.append((i, " ".join(w)))
        if r.random() < 0.2:
            near = list(w)
            if near:
                near[r.randrange(len(near))] = "edited"
            docs.append((1000 + i, "\n".join(near)))
    return docs


def test_query_covers_every_document(spark):
    sf = "/root/testdata/sf0.001"
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    want = spark.createDataFrame(brute(docs), "doc_id string, n_words long, n_removed long, text string")
    want = sorted(map(tuple, want.select("doc_id", "n_words", "n_removed", F.sha2("text", 256)).collect()))
    df = QUERIES["op11_repeated_phrase_automata"](spark, sf)
    assert df.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    rows = df.collect()
    assert sorted((str(r[0]), *r[1:]) for r in rows) == want and sum(r["n_removed"] for r in rows) > 1000


@pytest.mark.parametrize("seed,rows", [(1, 500), (2, 3), (3, 1), (4, 7)])
def test_planted_passages_in_blocks_of_any_size(docs, monkeypatch, seed, rows):
    monkeypatch.setattr(s, "BLOCK_ROWS", rows)
    texts = planted(seed)
    assert got(s.keep_unique(docs(texts))) == brute(texts)


@pytest.mark.parametrize("window,anchor", [(2, 1), (3, 3), (6, 2), (7, 4)])
def test_other_windows(docs, window, anchor):
    r = random.Random(window)
    texts = [(i, " ".join(r.choice("abc") for _ in range(r.randrange(12)))) for i in range(60)]
    assert got(s.keep_unique(docs(texts), window, anchor)) == brute(texts, window)


def test_odd_rows_repeats_and_clashing_columns(docs, odd):
    rows = [*odd, (20, "x " * 35), (21, "x " * 34), (22, "y " * 36), (23, " ".join(prose(34, 5))), (24, " ".join(prose(34, 5))),
            (25, "a b " * 60), (26, " ".join(prose(300, 6))), (26, " ".join(prose(300, 6))), (None, " ".join(prose(50, 7)))]
    assert got(s.keep_unique(docs(rows))) == brute(rows)


def test_a_passage_in_a_third_of_the_documents(docs, monkeypatch):
    monkeypatch.setattr(s, "BLOCK_ROWS", 20)
    common = " ".join(prose(40, 1))
    rows = [(i, " ".join(prose(30, 50 + i)) + (" " + common if i % 3 == 0 else "")) for i in range(240)]
    assert got(s.keep_unique(docs(rows, 6))) == brute(rows)


def test_many_places_are_extended_in_steps(docs, monkeypatch):
    monkeypatch.setattr(s, "_PLACES", 5)
    monkeypatch.setattr(s, "_ROWS", 3)
    monkeypatch.setattr(s, "_STEP", 4)
    rows = [(1, "a b c " * 40), (2, " ".join(prose(80, 2)) + " a b c" * 13), (3, " ".join(prose(80, 2)))]
    assert got(s.keep_unique(docs(rows))) == brute(rows)


def test_anchors_follow_from_the_words_of_the_window():
    w = " ".join(prose(60, 3)).encode()
    a, b = s.tokenize([w, b"", b"other words " + w + b" end"]), s.tokenize([b"zz " + w])
    for t in (a, b):
        starts, at, values = s.anchors(t, s._word_hashes(t), 35, 12)
        assert all(k <= x <= k + 23 for k, x in zip(starts, at))
    (sa, xa, va), (sb, xb, vb) = (s.anchors(t, s._word_hashes(t), 35, 12) for t in (a, b))
    assert list(va[xa[:26]]) == list(vb[xb[1:27]]) and np.all(xa[:26] + 1 == xb[1:27])


def test_empty_table(docs):
    assert s.keep_unique(docs([])).collect() == []


def test_texts_are_shuffled_once(docs, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = s.keep_unique(docs(planted(5)))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [x for x in plan.splitlines() if "Exchange" in x]
    assert exchanges and "Bucketed: true" in plan and len(exchanges) == 1  # that of the list of starts
