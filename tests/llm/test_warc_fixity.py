import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from viewer_insights.llm import warc_fixity as w


def table(spark, rows):
    return spark.createDataFrame([(i, u, r, "x", 1) for i, u, r in rows], "id long, url string, record binary, digest string, seq int")


def rows(n=300):
    return [(i, f"u{i}", f"record {i} {'x' * (i % 50)}".encode()) for i in range(n)]


def report(spark, a, b, **sizes):
    ours = w.Tree(table(spark, a), **sizes)
    theirs = w.Tree(table(spark, b), **sizes, like=ours)
    return {(r["file"], r["seq"]): r["status"] for r in w.audit(ours, theirs).collect()}, ours, theirs


def test_levels_are_digests_of_their_children(spark):
    tree = w.Tree(table(spark, rows()), records_per_file=64, fanout=4)
    assert len(tree.levels) == 4
    for below, above in zip(tree.levels, tree.levels[1:]):
        kids = {}
        for r in sorted(below.collect(), key=lambda r: (r["file"], r["seq"])):
            kids.setdefault((r["file"], r["seq"] // 4), []).append((r["start"], r["end"], r["digest"]))
        got = {(r["file"], r["seq"]): (r["start"], r["end"], r["digest"]) for r in above.collect()}
        assert got == {k: (v[0][0], v[-1][1], hashlib.sha256(",".join(f"{a}:{b}:{d}" for a, b, d in v).encode()).hexdigest())
                       for k, v in kids.items()}
    leaf = {r["id"]: r for r in tree.levels[0].collect()}
    assert all(leaf[i]["digest"] == hashlib.sha256(x).hexdigest() and leaf[i]["end"] - leaf[i]["start"] == len(x) for i, _, x in rows())


@pytest.mark.parametrize("bad", [[], [0], [299], [5, 6, 130, 131, 250]])
def test_damage_is_located_exactly(spark, bad):
    b = [(i, u, bytes(len(x)) if i in bad else x) for i, u, x in rows()]
    found, *_ = report(spark, rows(), b, records_per_file=64, fanout=4)
    assert found == {(str(i // 64), i % 64): "damaged" for i in bad}


def test_missing_moved_and_extra_records(spark):
    a = rows(100)
    longer = [(i, u, x + b"!" if i == 10 else x) for i, u, x in a if i != 99] + [(200, "new", b"new")]
    found, *_ = report(spark, a, longer, records_per_file=64, fanout=4)
    assert found.pop(("0", 10)) == "damaged" and found.pop(("1", 35)) == "missing" and found.pop(("3", 0)) == "extra"
    assert found == {("0", i): "moved" for i in range(11, 64)}


def test_only_differing_branches_are_read(spark):
    b = [(i, u, bytes(len(x)) if i == 70 else x) for i, u, x in rows()]
    _, ours, theirs = report(spark, rows(), b, records_per_file=64, fanout=4)
    bad = w.differing(ours.levels[-1], theirs.levels[-1])
    assert [(r["file"], r["seq"]) for r in bad.collect()] == [("1", 0)]


def test_odd_rows_repeats_and_empty(spark):
    odd = [(None, None, None), (None, "", b""), (3, None, b"x"), (3, None, b"x"), (3, "u", b"y" * 100_000), (-5, "n", b"z")]
    found, ours, _ = report(spark, odd, odd)
    assert found == {} and ours.levels[0].count() == len(odd)
    found, *_ = report(spark, [(1, "u", b"x")] * 50, [(1, "u", b"x")] * 49, records_per_file=4, fanout=4)
    assert found == {("0", 49): "missing"}
    assert report(spark, [], [])[0] == {}
    assert set(report(spark, rows(3), [])[0].values()) == {"missing"}


def test_warc_records_carry_their_length(spark):
    df = spark.createDataFrame([(1, "http://é", "<p>ü"), (None, None, None)], "page_id long, url string, html string")
    for r in w.page_records(df).collect():
        head, body = bytes(r["record"]).split(b"\r\n\r\n", 1)
        assert head.startswith(b"WARC/1.1\r\n") and int(head.rsplit(b" ", 1)[1]) == len(body) - 4
    assert w.damaged_copy(df).where(F.length("html") >= 0).count() == 2


def test_files_hold_many_records_however_sparse_the_ids(spark):
    rng = random.Random(3)
    ids = [rng.getrandbits(64) - 2**63 for _ in range(4000)]
    a = [(i, "u", b"%d" % i) for i in ids]
    b = [(i, "u", bytes(len(x)) if k == 1234 else x) for k, (i, _, x) in enumerate(a)]
    found, ours, theirs = report(spark, a, b, records_per_file=64)
    assert list(found.values()) == ["damaged"] and ours.levels[-1].count() * 16 <= 4000
    assert len(w.differing(ours.levels[-1], theirs.levels[-1]).collect()) == 1


def test_one_record_in_a_third_of_the_rows(spark):
    hot = [(7, "u", b"same")] * 3000
    a = [*rows(600), *hot]
    b = [*rows(600)[1:], *hot, (7, "u", b"same")]
    _, ours, theirs = report(spark, a, b, records_per_file=64, fanout=4)
    leaf = sorted(ours.levels[0].where("file = '0'").collect(), key=lambda r: r["seq"])
    assert [r["seq"] for r in leaf] == list(range(3064))
    assert all(x["end"] == y["start"] for x, y in zip(leaf, leaf[1:])) and leaf[0]["start"] == 0
    told = Counter(r["status"] for r in w.audit_report(ours, theirs).where("id = 7 OR id = 0").collect())
    assert told["missing"] == 1 and told["extra"] == 1 and told["damaged"] == 0 and sum(told.values()) == 3003


def test_records_lost_and_inserted_inside_a_file_do_not_damage_the_others(spark):
    a = [*rows(128), (None, "n", b"no id"), (None, "n", b"no id")]
    b = [x for x in a if x[0] != 20]
    b[40] = (b[40][0], b[40][1], bytes(len(b[40][2])))
    b += [(70, "u70", rows(128)[70][2]), (75, "new", b"inserted"), (900, "new", b"in a file of its own")]
    b[127] = (None, "n", b"no ld")
    _, ours, theirs = report(spark, a, b, records_per_file=64, fanout=4)
    got = w.audit_report(ours, theirs).collect()
    told = sorted(((r["id"], r["status"]) for r in got if r["status"] not in ("ok", "moved")), key=str)
    assert told == sorted([(20, "missing"), (41, "damaged"), (70, "extra"), (75, "extra"), (900, "extra"), (None, "damaged")], key=str)
    assert len(got) == len(a) + 3 and sum(r["id"] == 70 for r in got) == 2
    extra = {r["id"]: r for r in got if r["status"] == "extra"}
    assert extra[75]["digest"] == hashlib.sha256(b"inserted").hexdigest() and extra[75]["end"] - extra[75]["start"] == 8
    assert {r["id"] for r in got if r["status"] == "moved"} == {*range(21, 64), *range(71, 128)} - {41}
