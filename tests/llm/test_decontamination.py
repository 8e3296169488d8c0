import random

import pytest

from viewer_insights.llm import decontamination as d

WORDS = [f"w{i}" for i in range(60)]


def distance(p, t):
    """Least edits between p and any stretch of t."""
    col = list(range(len(p) + 1))
    best = len(p)
    for w in t:
        new = [0]
        for i, x in enumerate(p, 1):
            new.append(min(col[i] + 1, new[i - 1] + 1, col[i - 1] + (x != w)))
        col, best = new, min(best, new[-1])
    return best


def edited(words, n, rng):
    words = list(words)
    for _ in range(n):
        i = rng.randrange(len(words))
        rng.choice([lambda: words.pop(i), lambda: words.insert(i, "new"), lambda: words.__setitem__(i, "other")])()
    return words


def corpus():
    rng = random.Random(4)
    items = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 45)))) for i in range(25)]
    rows = []
    for k in range(120):
        filler = [rng.choice(WORDS) for _ in range(rng.randint(0, 80))]
        at = rng.randint(0, len(filler))
        inner = edited(items[k % 25][1].split(), rng.randint(0, 10), rng) if k % 3 and len(items[k % 25][1].split()) > 12 else []
        rows.append((k, " ".join([*filler[:at], *inner, *filler[at:]]).title() + (" é!" if k % 2 else "")))
    return items, rows


def test_myers_equals_dynamic_programming():
    rng = random.Random(1)
    for _ in range(400):
        p = [rng.randint(1, 4) for _ in range(rng.randint(1, 70))]
        t = [rng.randint(0, 4) for _ in range(rng.randint(0, 90))]
        assert d.myers(p, t)[0] == distance(p, t)


@pytest.mark.parametrize("block_bytes", [d.BLOCK_BYTES, 600])
def test_pairs_equal_brute_force(spark, docs, block_bytes):
    items, rows = corpus()
    bench = spark.createDataFrame([*items, (90, None), (91, " ?! "), (None, "only one of these words")], "item_id long, text string")
    want = set()
    for i, text in rows:
        for j, item in [*items, (None, "only one of these words")]:
            p, t = d.words_of(item), d.words_of(text)
            if distance(p, t) <= d.budget(len(p)):
                want.add((i, j, distance(p, t)))
    got = [(r["doc_id"], r["item_id"], r["edits"]) for r in d.find_matches(docs(rows), bench, block_bytes=block_bytes).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert any(e for *_, e in want)
    df = docs(rows)
    kept = d.drop_contaminated(df, bench, block_bytes=block_bytes)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in rows} - {w[0] for w in want}


def test_odd_rows_and_empty_tables(spark, docs, odd):
    bench = spark.createDataFrame([(1, "word " * 30), (1, "word " * 30)], "item_id long, text string")
    got = d.find_matches(docs(odd), bench).collect()
    assert {(r["doc_id"], r["item_id"], r["edits"]) for r in got} == {(9, 1, 0)} and len(got) == 2
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.find_matches(docs(odd), none).collect() == [] and d.find_matches(docs([]), bench).collect() == []
    assert d.drop_contaminated(docs(odd), none).count() == len(odd)


def test_punctuation_case_and_line_breaks_do_not_hide_a_passage(spark, docs):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta")], "item_id long, text string")
    rows = [(1, "x ALPHA, beta!\n\"gamma\" delta### epsilon|zeta eta theta. y"), (2, "alpha beta gamma"), (3, "é Alpha--Beta gamma delta epsilon zeta eta")]
    assert {r["doc_id"] for r in d.find_matches(docs(rows), bench).collect()} == {1, 3}


def test_decomposed_letters_do_not_hide_a_passage(spark, docs):
    import unicodedata

    french = "l’été déjà passé à côté d’une forêt où s’élève la fenêtre d’un château très âgé près du théâtre"
    hindi = "यह एक छोटा सा परीक्षण वाक्य है जिसे दस्तावेज़ में छिपाया गया है"
    assert len(d.words_of(hindi)) == len(hindi.split())
    forms = [(k, f"vorher {unicodedata.normalize(form, t)} nachher") for k, (form, t) in enumerate(
        (form, t) for form in ("NFC", "NFD") for t in (french, hindi))]
    for form in ("NFC", "NFD"):
        items = spark.createDataFrame([(i, unicodedata.normalize(form, t)) for i, t in enumerate((french, hindi))], "item_id long, text string")
        got = {(r["doc_id"], r["item_id"], r["edits"]) for r in d.find_matches(docs(forms), items).collect()}
        assert got == {(0, 0, 0), (1, 1, 0), (2, 0, 0), (3, 1, 0)}


def test_equal_items_are_one_entry_and_no_block_is_empty(spark, docs):
    text = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([(i, text) for i in range(3000)] + [(None, text), (9000, "other words of an item here now")],
                                  "item_id long, text string")
    blocks = list(d.item_blocks(items, 50))
    assert all(blocks) and sum(map(len, blocks)) == 2
    found = d.find_matches(docs([(1, f"x {text} y"), (2, "nothing")]), items, block_bytes=50).collect()
    assert len(found) == 3001 and {r["doc_id"] for r in found} == {1} and {r["item_id"] for r in found} == {*range(3000), None}
    assert [r["doc_id"] for r in d.drop_contaminated(docs([(1, f"x {text} y"), (2, "nothing")]), items, block_bytes=50).collect()] == [2]


def test_join_of_pieces_gives_the_matches_of_one_block(spark, docs, odd):
    import random

    items, rows = corpus()
    rng = random.Random(9)
    long_item = [rng.choice(WORDS) for _ in range(700)]
    items = [*items, (70, " ".join(long_item)), (71, items[3][1]), (72, "word " * 30), (73, "été déjà vu à la forêt d’hiver"), (90, None)]
    far = [rng.choice(WORDS) for _ in range(1500)]
    rows = [*rows, *odd, (500, " ".join(far + edited(long_item, 90, rng) + far)), (501, rows[1][1]), (502, rows[1][1].upper()),
            (503, "x" + " y" * 900 + " ÉTÉ déjà vu, à la forêt d’hiver")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs(rows)

    def key(r):
        return tuple((v is None, v) for v in r)

    want = sorted(d.find_matches(df, bench).collect(), key=key)
    got = sorted(d.find_matches(df, bench, max_passes=0).collect(), key=key)
    assert sorted(d.find_matches(df, bench, block_bytes=2000, max_passes=99).collect(), key=key) == want
    assert got == want and {70, 71, 72, 73} <= {r["item_id"] for r in got} and {500, 501, 503} <= {r["doc_id"] for r in got}
    kept = d.drop_contaminated(df, bench, max_passes=0)
    assert kept.columns == df.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, d.drop_contaminated(df, bench).collect()))


def test_join_of_pieces_deals_hot_pieces_and_copies(spark, docs):
    shared = "which of the following is the best answer to it"
    items = [(i, f"{shared} number{i} one{i} two{i}") for i in range(60)]
    rows = [(i, f"begin{i} {items[i % 60][1]} end") for i in range(240)] + [(1000 + i, f"copy {items[7][1]}") for i in range(300)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(map(tuple, d.find_matches(docs(rows), bench).collect()))
    assert sorted(map(tuple, d.find_matches(docs(rows), bench, max_passes=0).collect())) == want and len(want) >= 540


def test_join_of_pieces_takes_odd_and_empty_tables(spark, docs, odd):
    none = spark.createDataFrame([], "item_id long, text string")
    blank = spark.createDataFrame([(1, None), (2, " ?! ")], "item_id long, text string")
    some = spark.createDataFrame([(1, "same words here")], "item_id long, text string")
    for bench in (none, blank):
        assert d.find_matches(docs(odd), bench, max_passes=0).collect() == []
        assert d.drop_contaminated(docs(odd), bench, max_passes=0).count() == len(odd)
    assert d.find_matches(docs([]), some, max_passes=0).collect() == [] and d.drop_contaminated(docs([]), some, max_passes=0).count() == 0
    assert [r["doc_id"] for r in d.find_matches(docs(odd), some, max_passes=0).collect()] == [6, 6]
