"""Building Spark SQL expression text safely.

Large generated expressions (CASE chains over rule tables, category lists,
conditional sums) are handed to Spark as ONE ``F.expr`` string: Catalyst
resolves and code-generates them exactly like the Column-API form, but the
Python client makes a handful of calls instead of dozens per branch.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence


def ident(name: str) -> str:
    """Backtick-quoted identifier (dots are not treated as struct access)."""
    return "`" + name.replace("`", "``") + "`"


def string(value: str) -> str:
    """Single-quoted string literal; backslashes and quotes escaped."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float)):
        return repr(value)
    return string(str(value))


def case(branches: Iterable[tuple[str, str]], default: str | None = None) -> str:
    """``CASE WHEN c1 THEN v1 ... [ELSE d] END`` from SQL fragments."""
    body = " ".join(f"WHEN {cond} THEN {val}" for cond, val in branches)
    if not body:
        return default if default is not None else "NULL"
    tail = f" ELSE {default}" if default is not None else ""
    return f"CASE {body}{tail} END"


def in_list(col_sql: str, values: Sequence) -> str:
    return f"{col_sql} IN ({', '.join(literal(v) for v in values)})"

