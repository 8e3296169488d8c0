import random
import zlib

import numpy as np

from viewer_insights.llm import quality_gbt as q


def corpus(n=400, seed=5):
    rng = random.Random(seed)
    rows, y = [], []
    for i in range(n):
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(5, 60))]
        bad = i % 4 == 0
        rows.append((i, " ".join(w + ("###" if bad else "") for w in words)))
        y.append((i, 0 if bad else 1))
    return rows, y


def walk(model, row):
    """One row through the trees, node by node."""
    out = model.base
    for f, t, leaf in zip(model.feature, model.threshold, model.leaf):
        at = 0
        while at < len(f):
            at = 2 * at + (2 if row[f[at]] > t[at] else 1)
        out += leaf[at - len(f)]
    return 1 / (1 + np.exp(-out))


def test_scores_equal_a_walk_node_by_node_and_held_out_rows_are_right(docs, labels):
    rows, y = corpus()
    df, lab = docs(rows), labels([*y, (0, None), (None, 1), (9999, 1)])
    model = q.train(df, lab)
    got = {r["doc_id"]: r for r in q.classify(df, lab).collect()}
    truth = dict(y)
    assert len(got) == len(rows)
    for i, t in rows:
        assert abs(got[i]["score"] - walk(model, q.statistics(t))) < 1e-12
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert got[i]["predicted"] == (got[i]["score"] >= 0.3)
    held = [i for i, _ in rows if got[i]["held_out"]]
    assert len(held) > 40 and np.mean([got[i]["predicted"] == truth[i] for i in held]) > 0.97


def test_held_out_labels_are_never_learned(docs, labels):
    rows, y = corpus(120)
    flipped = [(i, 1 - v if zlib.crc32(str(i).encode()) % 5 == 0 else v) for i, v in y]
    a, b = (sorted((r["doc_id"], r["score"]) for r in q.classify(docs(rows), labels(x)).collect()) for x in (y, flipped))
    assert a == b


def test_training_bound_is_kept(docs, labels):
    rows, y = corpus(60)
    assert len(q.classify(docs(rows), labels(y), max_train_rows=10).collect()) == 60


def test_odd_rows_no_labels_one_class_and_empty(docs, labels, odd):
    df = docs(odd)
    for lab in (labels([]), labels([(4, 1), (5, 1)])):
        got = q.classify(df, lab).collect()
        assert len(got) == len(odd) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["score"] == 0.5 for r in q.classify(df, labels([])).collect())
    assert q.classify(docs([]), labels([])).collect() == []
    kept = q.keep_good(df, labels([]))
    assert kept.columns == df.columns and kept.count() == len(odd)


def test_rejected_documents_go(docs, labels):
    rows, y = corpus(200)
    df = docs(rows)
    kept = {r["doc_id"] for r in q.keep_good(df, labels(y)).collect()}
    assert kept == {r["doc_id"] for r in q.classify(df, labels(y)).collect() if r["predicted"] == 1}


def test_training_ids_are_those_of_smallest_hash_and_few_rows_reach_the_driver(spark):
    from pyspark.sql import functions as F

    labels = spark.range(5000).selectExpr("id AS doc_id", "id % 2 AS quality", "0 AS toxic").union(
        spark.range(2000).selectExpr("7 AS doc_id", "1 AS quality", "0 AS toxic"))
    free = spark.range(5000).where(~q.held_out(F.col("id"))).orderBy(F.xxhash64("id"), "id").limit(100)
    got = q.training_ids(labels, 100)
    assert {r["_id"] for r in got.collect()} == {r["id"] for r in free.collect()}
    assert q.training_ids(labels, 10_000).count() == spark.range(5000).where(~q.held_out(F.col("id"))).count()


def test_repeated_documents_are_one_training_row(docs, labels):
    rows = [(i, f"good words number {i} of a text") for i in range(30)] + [(3, "a b c")] * 50
    seen = []
    real = q.fit
    try:
        q.fit = lambda x, y, *a, **k: (seen.append(len(y)), real(x, y, *a, **k))[1]
        q.train(docs(rows), labels([(i, i % 2) for i in range(30)]))
    finally:
        q.fit = real
    from zlib import crc32
    assert seen == [sum(crc32(str(i).encode()) % 5 != 0 for i in range(30))]
