import hashlib
import random

import pytest

from viewer_insights.llm import chat_format as c


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", True) for r in rows], "conv_id long, turn long, role string, text string, formatted string, valid boolean")


NASTY = ["\\", "\\\\", "</turn>", "</turn>\n", "### User:", "### =x:\n", "\\h", "\\l\\b", "#", "<", "\n", ":", "é\U0001f600", "", None, "a:\nb", "[", "x" * 50_000]


def test_round_trip_of_any_text_and_role(spark):
    rng = random.Random(1)
    rows = [(i, t, rng.choice(["user", "assistant", "system", "User", "=user", "a\nb:", "", None, "tool"]), "".join(rng.choice(NASTY) or "" for _ in range(3)))
            for i in range(60) for t in range(rng.randint(1, 9))]
    f = c.read_back(c.format_conversations(table(spark, rows)))
    got = {r["conv_id"]: r for r in f.collect()}
    dig = {r["conv_id"]: r for r in c.digests(f).collect()}
    for i in range(60):
        turns = [(r or "", t) for k, _, r, t in rows if k == i]
        assert [(t["role"], t["text"]) for t in got[i]["turns"]] == turns
        assert "".join(s["text"] for s in got[i]["segments"]) == got[i]["formatted"]
        loss = "".join(t for r, t in turns if r == "assistant")
        assert dig[i]["n_turns"] == len(turns) and dig[i]["loss_chars"] == len(loss)
        assert dig[i]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert dig[i]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert dig[i]["formatted_chars"] == len(got[i]["formatted"])


@pytest.mark.parametrize("roles,valid,bad", [
    (["user", "assistant"], True, None), (["system", "user", "assistant", "user"], True, None), (["assistant"], False, 0),
    (["user", "user"], False, 1), (["system"], False, None), (["user", "assistant", "system", "user"], False, 2), ([None], False, 0)])
def test_state_machine(spark, roles, valid, bad):
    (r,) = c.format_conversations(table(spark, [(1, i, x, "t") for i, x in enumerate(roles)])).collect()
    assert (r["valid"], r["first_bad_turn"]) == (valid, bad)


def test_flags_cover_exactly_the_answers(spark):
    (r,) = c.format_conversations(table(spark, [(1, 0, "user", "q"), (1, 1, "assistant", "a <b>")])).collect()
    assert [(s["text"], s["loss"]) for s in r["segments"]] == [
        ("### User:\n", False), ("q", False), ("</turn>\n", False), ("### Assistant:\n", False), ("a \\lb>", True), ("</turn>\n", False)]


def test_order_repeats_nulls_and_empty(spark):
    rows = [(None, 1, "assistant", "b"), (None, None, "user", None), (None, 1, "assistant", "b"), (2, 5, "user", "y"), (2, 5, "user", "x")]
    got = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in c.read_back(c.format_conversations(table(spark, rows))).collect()}
    assert got == {None: [("user", ""), ("assistant", "b"), ("assistant", "b")], 2: [("user", "x"), ("user", "y")]}
    assert c.digests(c.read_back(c.format_conversations(table(spark, [])))).collect() == []


def test_another_template_and_a_bad_one(spark):
    t = c.Template(names={"human": "Human", "bot": "Bot"}, end="<end>", loss_roles=("bot",), moves={"": ("human",), "human": ("bot",)}, final=("bot",))
    rows = [(1, 0, "human", "<end>"), (1, 1, "bot", "### Bot:\n<end>")]
    (r,) = c.read_back(c.format_conversations(table(spark, rows), t), t).collect()
    assert r["valid"] and [x["text"] for x in r["turns"]] == ["<end>", "### Bot:\n<end>"]
    with pytest.raises(ValueError):
        c.format_conversations(table(spark, rows), c.Template(end="END"))


def test_no_python_in_the_plan(spark):
    plan = c.digests(c.read_back(c.format_conversations(table(spark, [(1, 0, "user", "q")]))))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
