"""Chat formatting by a role state machine and a declarative template, in DataFrame
operations only.

A template names the turn headers, the end mark, the roles under the loss mask and the
allowed moves between roles.  Formatting walks the turns of a conversation through the
state machine (``valid``, ``first_bad_turn``) and emits three segments a turn: header,
text, end mark, each with its loss flag.  Control strings inside texts are escaped (a
backslash and a code for each character that can begin one), so reading back is exact.

Texts are escaped row by row before turns are brought together.  A conversation is one
formatted text, so its turns meet in one row; that is the result asked for.

Defined cases: a null text or role is empty; turns are taken in order of turn, role and
text, a null turn first; repeated rows are turns of their own; conversations in an order
that the template does not allow are formatted all the same and flagged; a null id is a
conversation of its own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Headers are ``### Name:`` lines; roles without a name are written as ``### =role:``."""

    names: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    head: str = "### "
    end: str = "</turn>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: allowed moves; the empty string is the start
    moves: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple[str, ...] = ("assistant", "user")


#: Characters that can begin a control string, and their codes; a line feed ends a header.
ESCAPES = (("\\", "b"), ("#", "h"), ("<", "l"))
HEADER_ESCAPES = (*ESCAPES, ("\n", "n"), (":", "c"))


def escape(c: Column, escapes=ESCAPES) -> Column:
    for char, code in escapes:
        c = F.replace(c, F.lit(char), F.lit("\\" + code))
    return c


def unescape(c: Column, escapes=ESCAPES) -> Column:
    for char, code in reversed(escapes):
        c = F.replace(c, F.lit("\\" + code), F.lit(char))
    return c


def _header(t: Template, role: Column) -> Column:
    named = F.lit(None).cast("string")
    for r, name in t.names.items():
        named = F.when(role == r, F.lit(name)).otherwise(named)
    return F.concat(F.lit(t.head), F.coalesce(named, F.concat(F.lit("="), escape(role, HEADER_ESCAPES))), F.lit(":\n"))


def format_conversations(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """``conv_id, formatted, segments (text, loss), valid, first_bad_turn`` per conversation."""
    t = template or Template()
    if t.head[0] not in "#<" or t.end[0] not in "#<":
        raise ValueError("control strings must begin with a character that is escaped")
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(
        F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("_t")).select(
        "conv_id", F.struct("_t.turn", "_t.role", "_t.text", _header(t, F.col("_t.role")).alias("head"),
                            escape(F.col("_t.text")).alias("body"),
                            F.col("_t.role").isin(*t.loss_roles).alias("loss")).alias("_t"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("_t")).alias("_turns"))
    allowed = F.create_map(*[x for state, roles in t.moves.items() for x in (F.lit(state), F.array(*map(F.lit, roles)))])

    def move(s: Column, turn: Column) -> Column:
        ok = F.coalesce(F.array_contains(F.element_at(allowed, s["state"]), turn["role"]), F.lit(False))
        return F.struct(turn["role"].alias("state"), (s["at"] + 1).alias("at"),
                        F.when(s["bad"].isNull() & ~ok, s["at"]).otherwise(s["bad"]).alias("bad"))

    start = F.struct(F.lit("").alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bad"))
    walked = F.aggregate("_turns", start, move)

    def emit(turn: Column) -> Column:
        return F.array(F.struct(turn["head"].alias("text"), F.lit(False).alias("loss")),
                       F.struct(turn["body"].alias("text"), turn["loss"].alias("loss")),
                       F.struct(F.lit(t.end).alias("text"), F.lit(False).alias("loss")))

    out = convs.select("conv_id", F.flatten(F.transform("_turns", emit)).alias("segments"), walked.alias("_end"))
    return out.select("conv_id", F.array_join(F.col("segments.text"), "").alias("formatted"), "segments",
                      (F.col("_end.bad").isNull() & F.col("_end.state").isin(*t.final)).alias("valid"),
                      F.col("_end.bad").alias("first_bad_turn"))


def read_back(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """``formatted`` with ``turns (role, text, loss)`` parsed from the text and the segments' flags."""
    t = template or Template()
    pieces = F.split(F.col("formatted"), _literal(t.end), -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def parse(piece: Column, i: Column) -> Column:
        head = F.substring_index(piece, ":\n", 1)
        name = F.substr(head, F.lit(len(t.head) + 1))
        role = F.when(F.startswith(name, F.lit("=")), unescape(F.substr(name, F.lit(2)), HEADER_ESCAPES))
        for r, n in t.names.items():
            role = role.when(name == n, F.lit(r))
        return F.struct(role.alias("role"), unescape(F.substr(piece, F.length(head) + 3)).alias("text"),
                        F.get(F.col("segments"), i * 3 + 1)["loss"].alias("loss"))

    return formatted.withColumn("turns", F.transform(pieces, parse))


def _literal(s: str) -> str:
    """A pattern that matches exactly ``s``."""
    return "".join(c if c.isalnum() or c == "\n" else "\\" + c for c in s)


def digests(parsed: DataFrame) -> DataFrame:
    """Counts and digests of conversations that were read back."""
    told = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    under = F.array_join(F.filter("turns", lambda x: x["loss"])["text"], "")
    return parsed.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                         F.length(under).cast("long").alias("loss_chars"), F.sha2(under, 256).alias("loss_sha256"),
                         F.length("formatted").cast("long").alias("formatted_chars"), "valid", "first_bad_turn")
