"""Optional folding of Latin diacritics (``hát`` -> ``hat``) before keyword rules.

The character table is generated from Unicode decomposition (NFD, keep the
base letter) over the Latin blocks, plus the two letters that do not
decompose (``đ``/``Đ``).  Spark applies it with ``translate``, inside the
generated code of the stage.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from viewer_insights.functions.sqltext import ident, string

LATIN_RANGES = ((0x00C0, 0x024F), (0x1E00, 0x1EFF))
NON_DECOMPOSING = {"đ": "d", "Đ": "D"}


@lru_cache(maxsize=1)
def fold_table() -> tuple[str, str]:
    src, dst = [], []
    for lo, hi in LATIN_RANGES:
        for cp in range(lo, hi + 1):
            ch = chr(cp)
            base = unicodedata.normalize("NFD", ch)[0]
            if base != ch and base.isascii() and base.isalpha():
                src.append(ch)
                dst.append(base)
    for ch, base in NON_DECOMPOSING.items():
        src.append(ch)
        dst.append(base)
    return "".join(src), "".join(dst)


def fold_diacritics_sql(col_sql: str) -> str:
    src, dst = fold_table()
    return f"translate({col_sql}, {string(src)}, {string(dst)})"


def fold_diacritics(col: str) -> Column:
    return F.expr(fold_diacritics_sql(ident(col)))
