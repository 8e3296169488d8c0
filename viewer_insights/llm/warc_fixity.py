"""Merkle fixity audit of WARC records.

Every record is hashed; a leaf is a record's digest with its byte range in its file, and
a parent is the digest of up to ``fanout`` ordered children (range and digest) with
their joint range, up to one root per file.  Two replicas are compared by their roots;
only the children of branches that differ are read and compared, level by level, down
to the records that are damaged, missing or extra.

Records are hashed where they are read; only digests, lengths and ids are shuffled.  A
file holds the records of a stretch of ids, wide enough that files have
``records_per_file / 4`` records or more on average however sparse the ids are; both replicas
take the stretches of the first.  Places and offsets come from a sort by ranges
(``common.numbered``), so no task holds a whole file, also where one id or one record
repeats in a third of the rows.

Defined cases: null fields are empty; records are ordered in a file by id, URL and
digest (null ids have files of their own, by digest); repeated
rows are records of their own; an empty replica has no roots, so all records of the
other are missing; other columns are ignored; long records are hashed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewer_insights.llm.common import numbered, stage_table

RECORDS_PER_FILE = 1024  # a power of two
FANOUT = 16  # a power of two
LEAF = ("file", "seq", "id", "url", "start", "end", "digest")


def warc_record(page_id: Column, url: Column, payload: Column) -> Column:
    """The bytes of a WARC resource record."""
    body = F.coalesce(payload.cast("string"), F.lit("")).cast("binary")
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
                    F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">\r\nWARC-Target-URI: "),
                    F.coalesce(url.cast("string"), F.lit("")),
                    F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"),
                    F.lit("\r\n\r\n"))
    return F.concat(head.cast("binary"), body, F.lit("\r\n\r\n").cast("binary"))


def file_bits(records: DataFrame, records_per_file: int = RECORDS_PER_FILE) -> int:
    """How many low bits of an id a file covers: as few as let files hold ``records_per_file / 4`` records on average."""
    bits = records_per_file.bit_length() - 1
    low, high, n = records.agg(F.min("id"), F.max("id"), F.count("id")).first()
    if n:
        while bits < 63 and (files := (high >> bits) - (low >> bits) + 1) > 1 and files * records_per_file > 4 * n:
            bits += 1
    return bits


def hashed(records: DataFrame) -> DataFrame:
    """``id, url, length, digest`` of ``records (id, url, record)``."""
    return records.select(F.col("id").cast("long").alias("id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                          F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("digest"))


def leaves(digests: DataFrame, bits: int) -> DataFrame:
    """``file, seq, id, url, start, end, digest`` of ``digests (id, url, length, digest)``."""
    rows = digests.withColumn("file", F.when(F.col("id").isNotNull(), F.shiftright("id", bits).cast("string"))
                              .otherwise(F.concat(F.lit("none-"), F.substr("digest", F.lit(1), F.lit(3)))))
    return numbered(rows, ["file"], ["id", "url", "digest"], "fixity-places", "length").select(
        "file", F.col("_nth").alias("seq"), "id", "url", F.col("_before").alias("start"),
        (F.col("_before") + F.col("length")).alias("end"), "digest")


def parents(children: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The next level of a tree (``file, seq, start, end, digest``)."""
    bits = fanout.bit_length() - 1
    line = F.concat_ws(":", "start", "end", "digest")
    return (children.groupBy("file", F.shiftright("seq", bits).alias("seq"))
            .agg(F.min("start").alias("start"), F.max("end").alias("end"),
                 F.sort_array(F.collect_list(F.struct("seq", line.alias("line")))).alias("_lines"))  # at most fanout
            .select("file", "seq", "start", "end", F.sha2(F.array_join("_lines.line", ","), 256).alias("digest")))


class Tree:
    """Stored levels of the trees of one replica, leaves first; the last level is the roots.  ``like`` is the tree
    whose files this one shares."""

    def __init__(self, records: DataFrame, records_per_file: int = RECORDS_PER_FILE, fanout: int = FANOUT, like: Tree | None = None):
        self.fanout = fanout
        digests = stage_table(hashed(records), "fixity-digests")
        self.bits = like.bits if like else file_bits(digests, records_per_file)
        self.levels = [stage_table(leaves(digests, self.bits), "fixity-leaves")]
        while True:
            # a file may hold any number of records: go on until one root a file
            self.levels.append(stage_table(parents(self.levels[-1], fanout), "fixity-level"))
            if (self.levels[-1].agg(F.max("seq")).first()[0] or 0) == 0:
                break


def differing(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Places ``file, seq`` where two levels differ or one has no node."""
    a = ours.select("file", "seq", F.struct("start", "end", "digest").alias("_a"))
    b = theirs.select("file", "seq", F.struct("start", "end", "digest").alias("_b"))
    return a.join(b, ["file", "seq"], "full").where("NOT (_a <=> _b)").select("file", "seq")


def audit(ours: Tree, theirs: Tree) -> DataFrame:
    """Records that differ: ``file, seq, status``, found from the roots down; only children of differing
    nodes are compared.

    Below the differing nodes records are matched by what they are, not by their place: equal records first
    (``moved`` if their byte range is another), then by id and URL (``damaged``); the rest is ``missing`` or
    ``extra``.  An extra record is told by its place in ``theirs``, the others by theirs in ``ours``.
    """
    bits = ours.fanout.bit_length() - 1
    # trees of unequal height meet at the lower one's roots
    top = min(len(ours.levels), len(theirs.levels)) - 1
    bad = differing(ours.levels[top], theirs.levels[top])
    for level in range(top - 1, -1, -1):
        bad = bad.select(F.col("file").alias("_f"), F.col("seq").alias("_s"))
        under = [t.levels[level].join(bad, (F.col("file") == F.col("_f")) & (F.shiftright("seq", bits) == F.col("_s")),
                                      "left_semi") for t in (ours, theirs)]
        if level:
            bad = differing(*under)
    pair = stage_table(_matched(*under, ["file", "id", "url", "digest"]), "fixity-equal")
    moved = pair.where("a IS NOT NULL AND b IS NOT NULL AND (a.start <> b.start OR a.end <> b.end)")
    # a damaged record without an id is in the file of another digest: matched without the file
    rest = _matched(*(pair.where(f"{x} IS NULL").select(f"{y}.*") for x, y in (("b", "a"), ("a", "b"))), ["id", "url"])
    status = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("damaged")
    place = F.coalesce("a", "b")
    return (moved.select("a.file", "a.seq", F.lit("moved").alias("status"))
            .union(rest.select(place["file"], place["seq"], status)))


def _matched(ours: DataFrame, theirs: DataFrame, keys: list[str]) -> DataFrame:
    """Leaves of two replicas as ``a, b`` (structs, one may be null), the n-th of a key beside the n-th."""
    order = [c for c in ("file", "seq") if c not in keys]
    a, b = (numbered(t.select(*LEAF), keys, order, "fixity-match").select(F.struct(*LEAF).alias(name), F.col("_nth").alias(f"{name}_nth"))
            for t, name in ((ours, "a"), (theirs, "b")))
    same = F.col("a_nth") == F.col("b_nth")
    for k in keys:  # null ids are equal here
        same &= F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) if k == "id" else F.col(f"a.{k}") == F.col(f"b.{k}")
    return a.join(b, same, "full").select("a", "b")


def audit_report(ours: Tree, theirs: Tree) -> DataFrame:
    """Every record of our replica, and the extra ones of theirs: ``id, file, seq, start, end, digest, status``
    (``ok`` or as in ``audit``); the place of an extra record is that in theirs."""
    found = stage_table(audit(ours, theirs).select(F.col("file").alias("_f"), F.col("seq").alias("_s"), "status"), "fixity-found")
    same = (F.col("file") == F.col("_f")) & (F.col("seq") == F.col("_s"))
    columns = ["id", "file", "seq", "start", "end", "digest", F.coalesce("status", F.lit("ok")).alias("status")]
    return (ours.levels[0].join(found.where("status <> 'extra'"), same, "left").select(*columns)
            .union(theirs.levels[0].join(found.where("status = 'extra'"), same).select(*columns)))


def damaged_copy(pages: DataFrame) -> DataFrame:
    """A replica of ``pages (page_id, url, html)`` with faults that can be foretold from the first two digits of the
    page's MD5: ``00`` its first character is another, ``01`` it is zero-filled, ``02`` and ``03`` it is lost, ``04`` and
    ``05`` it comes twice, ``06`` and ``07`` an empty page with ``#new`` behind the URL comes besides."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    sign = F.substr(F.md5(html.cast("binary")), F.lit(1), F.lit(2))
    rot = (F.when((sign == "00") & (F.length(html) > 0), F.concat(F.lit("~"), F.substr(html, F.lit(2))))
           .when(sign == "01", F.repeat(F.lit("0"), F.octet_length(html))).otherwise(html))
    copies = F.when(sign.isin("02", "03"), F.expr("array()")).when(sign.isin("04", "05", "06", "07"), F.expr("array(0, 1)")).otherwise(
        F.expr("array(0)"))
    new = (F.col("_copy") == 1) & F.col("_sign").isin("06", "07")
    return (pages.select("page_id", "url", rot.alias("html"), sign.alias("_sign"), F.explode(copies.cast("array<int>")).alias("_copy"))
            .select("page_id", F.when(new, F.concat(F.coalesce("url", F.lit("")), F.lit("#new"))).otherwise(F.col("url")).alias("url"),
                    F.when(new, F.lit("")).otherwise(F.col("html")).alias("html")))


def page_records(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").alias("id"), "url",
                        warc_record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))
