"""URL filter by a character language-model ratio, in DataFrame operations only.

Rules on host and path decide first; the longest fitting rule wins.  Its verdicts are
also the training data: URLs that a rule allows are the accepted ones, URLs that a rule
blocks the rejected ones.  Two variable-order Markov models over characters are counted
from all of them: a character's probability after a context of ``k`` characters is
``(n(context, char) + STRENGTH * p(shorter context)) / (n(context) + STRENGTH)``, down
to ``1 / ALPHABET`` below the empty context.  A URL's score is the mean over its
characters of ``ln p_accepted - ln p_rejected`` in millionths (integers, so the order of
addition does not matter).  One URL in five or so is kept out of the counts; the
threshold lies halfway between the mean scores of the accepted and rejected ones there.

Every distinct URL is scored once.  Its characters meet the table of log ratios by a
join whose hot contexts (the ``http`` of every URL) are salted; tables are summed
map-side first, and only the threshold comes to the driver.

Defined cases: a null URL has an empty host and path and is scored as the empty URL (its
end alone); a URL without ``://`` has an empty host and path and is scored whole;
without URLs of both kinds every score and the threshold are 0, which allows; repeated
rows each get their row and count each in training; an empty table gives an empty
result; other columns are ignored; long URLs are scored whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewer_insights.llm.common import stage_table

#: (verdict, host, path): fits the host and its subdomains if the URL's path begins with the path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
ORDER = 3  # characters of context
STRENGTH = 4.0
ALPHABET = 256
SALTS = 16
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_START, _END = "\u0002", "\u0003"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _CAPITALS, _SMALL)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """Struct ``rule, verdict`` of the longest rule that fits; null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _grams(urls: DataFrame, order: int) -> DataFrame:
    """``urls`` with a row per character: ``gram`` is the character after its context."""
    chars = F.split(F.concat(F.lit(_START * order), F.coalesce("url", F.lit("")), F.lit(_END)), "")
    return urls.withColumn("_chars", chars).select(
        *[c for c in urls.columns if c != "url"],
        F.explode(F.expr(f"transform(sequence(1, size(_chars) - {order}), i -> array_join(slice(_chars, i, {order + 1}), ''))"))
        .alias("gram"))


def log_ratios(grams: DataFrame, order: int = ORDER, strength: float = STRENGTH, alphabet: int = ALPHABET) -> DataFrame:
    """``gram, micro`` from distinct ``grams (gram, a, r)``, the counts of accepted and rejected uses.

    Level ``k`` holds the distinct endings of ``k + 1`` characters; its contexts' counts are
    sums over it, and its shorter probabilities come from level ``k - 1``.
    """
    level = {order: grams}
    for k in range(order - 1, -1, -1):
        level[k] = level[k + 1].groupBy(F.expr(f"substring(gram, -{k + 1}, {k + 1})").alias("gram")).agg(
            F.sum("a").alias("a"), F.sum("r").alias("r"))
    probs = None
    for k in range(order + 1):
        context = F.expr(f"substring(gram, 1, {k})")
        totals = level[k].groupBy(context.alias("_context")).agg(F.sum("a").alias("_ta"), F.sum("r").alias("_tr"))
        t = level[k].withColumn("_c", context).join(totals, F.col("_c") == F.col("_context"))
        if probs is None:
            t = t.withColumn("_pa", F.lit(1.0 / alphabet)).withColumn("_pr", F.lit(1.0 / alphabet))
        else:
            shorter = probs.select(F.col("gram").alias("_ending"), F.col("pa").alias("_pa"), F.col("pr").alias("_pr"))
            t = t.withColumn("_e", F.expr(f"substring(gram, -{k}, {k})")).join(shorter, F.col("_e") == F.col("_ending"))
        probs = t.select("gram", ((F.col("a") + strength * F.col("_pa")) / (F.col("_ta") + strength)).alias("pa"),
                         ((F.col("r") + strength * F.col("_pr")) / (F.col("_tr") + strength)).alias("pr"))
    return probs.select("gram", F.round((F.log("pa") - F.log("pr")) * 1e6).cast("long").alias("micro"))


def score_urls(urls: DataFrame, order: int = ORDER, strength: float = STRENGTH, salts: int = SALTS) -> DataFrame:
    """``u1, u2, score`` for distinct ``urls (url, u1, u2, uses, side)``; side is 1 (accepted),
    -1 (rejected) or 0, and 0 as well for those kept for calibration."""
    grams = _grams(urls, order)
    counted = grams.select("gram", F.expr("if(side > 0, uses, 0L)").alias("a"), F.expr("if(side < 0, uses, 0L)").alias("r"))
    totals = stage_table(counted.groupBy("gram").agg(F.sum("a").alias("a"), F.sum("r").alias("r")), "url-grams")
    table = log_ratios(totals, order, strength).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    uses = grams.select("u1", "u2", "gram", F.expr(f"pmod(u1, {salts})").cast("int").alias("s"))
    # the table grows with the URLs: a shuffle join at every size, never a broadcast
    hit = uses.hint("merge").join(table.withColumnRenamed("gram", "g"), (F.col("gram") == F.col("g")) & (F.col("s") == F.col("_salt")))
    return hit.groupBy("u1", "u2").agg(F.expr("sum(micro) div count(1)").alias("score"))


def threshold(scored: DataFrame) -> int | None:
    """Halfway between the mean scores of the accepted and the rejected URLs kept for calibration
    (0 where there are none of a kind); None if a model has no URL to count."""
    means = [f"sum(if(_held and _side = {v}, score, 0L)) div nullif(count_if(_held and _side = {v}), 0)" for v in (1, -1)]
    row = scored.agg(F.expr(f"(({means[0]}) + ({means[1]})) div 2"),
        F.expr("count_if(not _held and _side = 1) > 0 and count_if(not _held and _side = -1) > 0")).first()
    return (row[0] or 0) if row[1] else None


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, order: int = ORDER,
                strength: float = STRENGTH, salts: int = SALTS) -> DataFrame:
    """One row per row of ``pages``: ``page_id, host, path, rule, verdict, score, threshold``."""
    url = F.col("url").cast("string")
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url")).select(
        "page_id", "url", host.alias("host"), path.alias("path")).withColumn("_rule", fitting_rule(F.col("host"), F.col("path"), rules))
    # two hashes name a URL (the second differs by its seed column)
    rows = rows.withColumns({"u1": F.xxhash64(F.coalesce("url", F.lit(""))), "u2": F.xxhash64(F.coalesce("url", F.lit("")), F.lit(1))})
    held = F.substr(F.md5(F.coalesce("url", F.lit("")).cast("binary")), F.lit(1), F.lit(1)).isin("0", "1", "2")
    side = F.when(F.col("_rule.verdict") == "allow", 1).when(F.col("_rule.verdict") == "block", -1).otherwise(0)
    distinct = stage_table(
        rows.select(F.coalesce("url", F.lit("")).alias("url"), "u1", "u2", side.alias("_side"))
        .groupBy("url", "u1", "u2").agg(F.count(F.lit(1)).alias("uses"), F.max("_side").alias("_side"))
        .withColumn("_held", held), "url-distinct")
    scores = score_urls(distinct.select("url", "u1", "u2", "uses", F.expr("if(_held, 0, _side)").alias("side")), order, strength, salts)
    known = distinct.select(F.col("u1").alias("d1"), F.col("u2").alias("d2"), "_side", "_held")
    scored = stage_table(scores.join(known, (F.col("u1") == F.col("d1")) & (F.col("u2") == F.col("d2")))
                         .select("d1", "d2", "_side", "_held", "score"), "url-scores")
    cut = threshold(scored)
    judged = scored.select("d1", "d2", (F.col("score") if cut is not None else F.lit(0)).cast("long").alias("score"),
                           F.lit(cut or 0).cast("long").alias("threshold"))
    out = rows.join(judged, (F.col("u1") == F.col("d1")) & (F.col("u2") == F.col("d2")), "left")
    return out.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"),
                      F.coalesce("_rule.verdict", F.when(F.col("score") >= F.col("threshold"), "allow").otherwise("block")).alias("verdict"),
                      "score", "threshold")
