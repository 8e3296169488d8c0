import random

import xxhash

from viewer_insights.llm import simhash
from viewer_insights.llm.common import connected_components


def slow_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).translate(
        {ord(c): " " for c in "\t\n\x0b\x0c\r"}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near(a, b, max_bits=2):
    return ((a ^ b) & (2**64 - 1)).bit_count() <= max_bits


def classes(fps, max_bits=2):
    """Smallest id reachable, by brute force over all pairs."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if near(fps[i], fps[j], max_bits):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def check(rows, result):
    got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in result.collect()), key=str)
    fps = [slow_fingerprint(t or "") for _, t in rows]
    roots = classes(fps)
    low = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            low[r] = min(low.get(r, i), i)
    assert got == sorted(((i, f"{f:016x}", low.get(r)) for (i, _), f, r in zip(rows, fps, roots)), key=str)


def test_odd_rows_and_near_copies_match_brute_force(docs, odd):
    rng = random.Random(1)
    base = [rng.choice(["red", "blue", "Tree", "sky", "stone"]) + str(rng.randint(0, 99)) for _ in range(300)]
    rows = list(odd)
    for k in range(40):
        words = list(base)
        for _ in range(k % 4):
            words[rng.randrange(300)] = f"new{rng.randint(0, 9)}"
        rows.append((100 + k, " ".join(words)))
    check(rows, simhash.near_duplicates(docs(rows)))


def test_large_buckets_are_split_exactly(spark):
    rng = random.Random(2)
    center = [rng.getrandbits(64) for _ in range(3)]
    fps = {c ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for c in center for _ in range(120)}
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    want = classes(fps)
    for bucket in (2, 64, 10_000):
        roots = {r["node"]: r["root"] for r in connected_components(simhash.links(df, max_bucket=bucket)).collect()}
        got = [roots.get(f, f) for f in fps]
        assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_pivot_discard_loses_no_pair():
    import numpy as np

    rng = np.random.default_rng(3)
    base = rng.integers(-2**63, 2**63, (200, 1))
    flips = np.int64(1) << rng.integers(0, 64, (200, 2))
    groups = np.concatenate([base, base ^ flips[:, :1], base ^ flips[:, :1] ^ flips[:, 1:], rng.integers(-2**63, 2**63, (200, 1))], axis=1)
    got = {frozenset(map(int, p)) for p in simhash.close_pairs(groups, 2)}
    want = {frozenset((int(g[i]), int(g[j]))) for g in groups for i in range(4) for j in range(i) if near(int(g[i]), int(g[j]))}
    assert got == want


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(1, n + 1)} | {1001: 1000}


def test_drop_keeps_one_document_of_each_group(docs, odd):
    rows = [*odd, (20, "same words here"), (21, "same words here"), (22, "other words there")]
    df = docs(rows)
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert ids.count(6) == 1 and 20 not in ids and 21 not in ids and 22 in ids and 2 not in ids and 1 in ids


def test_empty_table(docs):
    assert simhash.near_duplicates(docs([])).collect() == []
    assert simhash.drop_near_duplicates(docs([])).count() == 0


def test_drop_keeps_rows_not_ids(docs):
    rng = random.Random(8)
    text = [" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(60)) for _ in range(40)]
    # a default id on unrelated texts; (5, B) beside (3, B); groups without any id; repeats of one row
    rows = [*((0, t) for t in text[:20]), (5, text[20]), (5, text[21]), (3, text[21]), *[(None, text[22])] * 5,
            (None, text[23]), (9, text[23]), (9, text[23]), (None, text[24])]
    got = sorted(((r["doc_id"], r["text"]) for r in simhash.drop_near_duplicates(docs(rows)).collect()), key=str)
    want = [*((0, t) for t in text[:20]), (5, text[20]), (3, text[21]), (None, text[22]), (9, text[23]), (None, text[24])]
    assert got == sorted(want, key=str)
