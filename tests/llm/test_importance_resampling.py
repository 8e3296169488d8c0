import math
import re
import zlib
from collections import Counter
from hashlib import sha256

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from viewer_insights.llm import importance_resampling as r
from viewer_insights.llm.queries import QUERIES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [zlib.crc32(f.encode()) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def brute(docs, target, min_words=20, percent=25):
    found = [(i, *features(t)) for i, t in docs]
    s, t = Counter(), Counter()
    for _, _, f in found:
        s.update(f)
    for x in target:
        t.update(features(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    rows = []
    for i, words, f in found:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    able = sorted((x for x in rows if x[5] >= min_words), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1]))
    for k, x in enumerate(able[:percent * len(able) // 100]):
        x[4] = k + 1
    return sorted((tuple(x[:5]) for x in rows), key=str)


def got(df):
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"] and set(dict(df.dtypes).values()) == {"bigint"}
    return sorted((tuple(x) for x in df.collect()), key=str)


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "the quick brown fox"), (2, None), (3, "")], "item_id long, text string")


def test_query_covers_every_document(spark):
    sf = "/root/testdata/sf0.001"
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    target = [t for t, in duckdb.sql(f"SELECT text FROM '{sf}/benchmark.parquet'").fetchall()]
    assert got(QUERIES["op12_importance_resampling"](spark, sf)) == brute(docs, target)


def test_odd_rows_repeated_ids_and_clashing_columns(spark, docs, odd, target):
    rows = [*odd, *((50, f"{w} word " * 15) for w in "abcdefgh"), *((None, f"{w} thing " * 12) for w in "xyz"), (50, "a word " * 15)]
    assert got(r.resample(docs(rows), target)) == brute(rows, ["the quick brown fox", None, ""])


def test_a_third_of_the_rows_under_one_id_and_one_text(spark, docs, target):
    rows = [(i, f"w{i % 7} " * (18 + i % 9)) for i in range(600)] + [(5, "same words " * 30)] * 300
    assert got(r.resample(docs(rows), target)) == brute(rows, ["the quick brown fox"])


def test_empty_tables(spark, docs, target):
    assert r.resample(docs([]), target).collect() == []
    rows = [(i, f"w{i} x " * 20) for i in range(9)]
    assert got(r.resample(docs(rows), target.limit(0))) == brute(rows, [])


@pytest.mark.parametrize("step", [1, 2, 7, 1 << 20])
def test_stretches_of_any_length_give_the_same_features(monkeypatch, step):
    monkeypatch.setattr(r, "word_stretches", lambda raw, f=r.word_stretches: f(raw, step))
    text = "One TWO three-four été 5x\x7fy  z "
    words, want = features(text)
    parts = list(r.feature_buckets(text.encode()))
    assert sum(n for n, _ in parts) == len(words) and Counter(np.concatenate([f for _, f in parts]).tolist()) == Counter(want)
    three = Counter(np.concatenate([f for _, f in r.feature_buckets(text.encode(), 3)]).tolist())
    assert three == Counter(want + [zlib.crc32(" ".join(w).encode()) % 10000 for w in zip(words, words[1:], words[2:])])


def test_bracket_is_widened_until_it_holds_the_cutoff(spark, monkeypatch):
    df = spark.range(1000).withColumn("score", F.expr("id % 10"))
    values = sorted((i % 10 for i in range(1000)), reverse=True)
    tried = []
    real = type(df).approxQuantile

    def wrong_at_first(self, col, probabilities, error):
        tried.append(error)
        return [-5.0, -4.0] if len(tried) == 1 else real(self, col, probabilities, error)

    monkeypatch.setattr(type(df), "approxQuantile", wrong_at_first)
    low, high, above = r.bracket(df, "score", 250, 1000)
    assert len(tried) == 2 and low <= values[249] <= high and above == sum(v > high for v in values) < 250


@pytest.mark.parametrize("k", [1, 17, 299, 300])
def test_draw_equals_a_plain_sort(spark, k):
    rows = [(i * 37 % 101 if i % 5 else None, i % 3, 1, i % 4, i) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, n_features long, weight long, score long, _uid long").repartition(7)
    want = sorted(rows, key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1], x[4]))[:k]
    assert {x["_uid"] for x in r.drawn(df, k, 300).collect()} == {x[4] for x in want}
