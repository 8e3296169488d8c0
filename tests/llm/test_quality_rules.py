import math
import random
from collections import Counter

from viewer_insights.llm import quality_rules as q


def slow_base(text):
    words = [w for w in text.translate({ord(c): " " for c in "\t\n\x0b\x0c\r"}).split(" ") if w]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\x0b\x0c\r"):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def corpus():
    rng = random.Random(3)
    rows, y = [], []
    for i in range(160):
        bad = i % 4 == 0
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) + ("%%%" if bad else "") for _ in range(rng.randint(40, 90))]
        if i % 7 == 0:
            words = words[:20] * 4
        rows.append((i, " ".join(words) + "\nline one\nline one\n \n"))
        y.append((i, 0 if bad else 1))
    return rows, y


def test_base_columns_equal_the_definitions(docs, labels, odd):
    rows, y = corpus()
    rows = [*rows, *((1000 + (i or -1000), t) for i, t in odd)]
    got = sorted((r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
                 for r in q.judge(docs(rows), labels(y)).collect())
    want = sorted((*b, b[0] < 50 or 100 * b[4] > 50 * b[0]) for b in (slow_base(t or "") for _, t in rows))
    assert got == want


def test_scores_equal_brute_force_counts(docs, labels):
    rows, y = corpus()
    truth = dict(y)
    raw, target = Counter(), Counter()

    def grams(text):
        b = text.encode()
        return [(int.from_bytes(b[i:i + 4], "big") * 0x9E3779B97F4A7C15 % 2**64) >> 48 for i in range(len(b) - 3)]

    for i, t in rows:
        raw.update(grams(t))
        if truth[i]:
            target.update(grams(t))
    nr, nt = (sum(c.values()) + 65536 for c in (raw, target))
    got = {r["doc_id"]: r for r in q.judge(docs(rows), labels(y)).collect()}
    for i, t in rows:
        g = grams(t)
        want = sum(math.log((target[x] + 1) / nt) - math.log((raw[x] + 1) / nr) for x in g) / len(g)
        assert abs(got[i]["score"] / 1e6 - want) < 2e-6
    # the two kinds are parted: every good document that passes the base rules is kept, the others go
    assert all(got[i]["kept"] == (not got[i]["base_failed"] and truth[i] == 1) for i, _ in rows)


def test_without_labels_nothing_is_rejected_by_the_ratio(docs, labels, odd):
    rows, _ = corpus()
    got = q.judge(docs([*rows, *odd]), labels([(3, None), (None, 1)])).collect()
    assert all(r["kept"] != r["base_failed"] and r["score"] == 0 for r in got) and len(got) == len(rows) + len(odd)
    assert q.judge(docs([]), labels([])).collect() == []


def test_conflicting_and_repeated_labels(labels):
    got = {r["_id"]: r["_good"] for r in q.trusted_labels(labels([(1, 1), (1, 1), (2, 0), (2, 1), (3, 0), (4, None)])).collect()}
    assert got == {1: 1, 3: 0}


def test_filter_of_ids_lets_all_that_match_pass_and_few_others(docs, spark):
    rows = docs([*((i, "t") for i in range(3000)), (None, "x"), (7, "again")]).select("doc_id", "text")
    ids = spark.createDataFrame([(i,) for i in range(0, 3000, 10)], "_id long")
    got = [r["doc_id"] for r in q.maybe_in(rows, "doc_id", ids, "_id").collect()]
    assert set(range(0, 3000, 10)) <= set(got) and len(got) < 320
    got = [r["doc_id"] for r in q.maybe_in(rows, "doc_id", spark.createDataFrame([(7,)], "_id long"), "_id", 64).collect()]
    assert got.count(7) == 2 and len(got) < 150
    assert q.maybe_in(rows, "doc_id", ids.limit(0), "_id").collect() == []
