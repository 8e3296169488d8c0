"""Quality rules: base statistics and a hashed n-gram log-likelihood ratio.

Two multinomials over hashed byte n-grams are counted from all data: the raw corpus
(every document) and the trusted target (every document labelled good).  A document's
score is the mean over its n-grams of ``ln p_target - ln p_raw``, in millionths, as an
integer, so it does not depend on the order of addition.  Every document is held
against one threshold (nothing is resampled): the one that parts the labelled
documents with the fewest errors, a lost good document counting ``GOOD_WEIGHT`` times.

The two count tables have ``BUCKETS`` entries whatever the corpus; each task sends its
partial counts packed, one row per ``BLOCK`` buckets, and they are added as they come.  The raw corpus is counted where it is read; only texts
that a filter of hashed good ids lets pass (``FILTER_BITS`` bits, broadcast) are shuffled, for
the exact join with labels (a sort-merge join at every size: labels grow with the corpus
and are never broadcast).  With far more good ids than bits the filter lets all pass.

Defined cases: a null text has no words and fails the base rules; a text with fewer
bytes than an n-gram scores 0; a document is trusted if all rows of its label say 1 and
distrusted if all say 0; without labels of both kinds the threshold rejects nothing;
repeated rows each get their row (and count each in the raw corpus); null ids match no
label; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewer_insights.llm.common import map_batches, slices, stage_table, texts

ORDER = 4
BUCKETS = 1 << 16
MIN_WORDS = 50
GOOD_WEIGHT = 20
SMOOTHING = 1.0
BLOCK = 1 << 10
FILTER_BITS = 1 << 23  # a power of two: at most 131,072 words of 64 bits
_STEP = 1 << 20  # n-grams held at once
_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"


def buckets_of(raw: bytes, order: int = ORDER, n_buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """Hash buckets of all byte n-grams, a bounded stretch at a time."""
    a = np.frombuffer(raw, np.uint8)
    shift = np.uint64(64 - n_buckets.bit_length() + 1)
    for at in range(0, len(a) - order + 1, _STEP):
        part = a[at:at + _STEP + order - 1].astype(np.uint64)
        n = len(part) - order + 1
        code = np.zeros(n, np.uint64)
        for j in range(order):
            code = code << np.uint64(8) | part[j:j + n]
        yield (code * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.int64)


def base_statistics(text: str) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, words in repeated 3-word windows."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    chars = len(text) - sum(map(text.count, _SPACES))
    symbols = sum(map(text.count, _SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    if n < 4:
        return n, chars, symbols, dup_lines, 0
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    w = np.fromiter(map(numbers.__getitem__, words), np.int64, n)
    pair = np.unique(w[:-1] * len(numbers) + w[1:], return_inverse=True)[1].ravel()
    window = pair[:-1] * len(numbers) + w[2:]
    order = np.argsort(window, kind="stable")
    same = window[order][1:] == window[order][:-1]
    often = np.zeros(n - 2, bool)
    often[order[1:][same]] = True
    often[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for j in range(3):
        covered[j:n - 2 + j] |= often
    return n, chars, symbols, dup_lines, int(covered.sum())


def trusted_labels(labels: DataFrame) -> DataFrame:
    """One row per labelled document: ``_id, _good`` (1: all its labels say good, 0: all say bad)."""
    y = F.col("quality").cast("int")
    return (labels.select(F.col("doc_id").cast("long").alias("_id"), y.alias("_y")).where("_id is not null and _y in (0, 1)")
            .groupBy("_id").agg(F.min("_y").alias("_low"), F.max("_y").alias("_high"))
            .where("_low = _high").select("_id", F.col("_low").alias("_good")))


def maybe_in(rows: DataFrame, key: str, ids: DataFrame, id_col: str, bits: int = FILTER_BITS) -> DataFrame:
    """The ``rows`` whose hashed key is that of one of ``ids``: all that match and some that don't.  The words of the
    filter, at most ``bits / 64`` rows, are broadcast."""
    place = "pmod(xxhash64({}), %d)" % bits
    words = (ids.selectExpr(f"{place.format(id_col)} AS _h").groupBy(F.expr("_h div 64").alias("_word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(_h % 64 as int)))").alias("_set")))
    return (rows.withColumn("_h", F.expr(place.format(key))).join(F.broadcast(words), F.expr("_h div 64 = _word"))
            .where("getbit(_set, cast(_h % 64 as int)) = 1").select(*rows.columns))


def ngram_counts(docs: DataFrame, labels: DataFrame, order: int = ORDER, n_buckets: int = BUCKETS) -> DataFrame:
    """``bucket, raw, target`` summed over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(n_buckets, np.int64)
        for b in slices(batches):
            for text in texts(b.column(0)):
                for g in buckets_of(text.encode(), order, n_buckets):
                    if len(g) > n_buckets // 8:
                        table += np.bincount(g, minlength=n_buckets)
                    else:
                        np.add.at(table, g, 1)
        blocks = [i for i in range(0, n_buckets, BLOCK) if table[i:i + BLOCK].any()]
        yield pa.RecordBatch.from_pydict({"block": pa.array(blocks, pa.int32()), "counts": pa.array(
            [zlib.compress(table[i:i + BLOCK].tobytes(), 1) for i in blocks], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.zeros((2, n_buckets), np.int64)
        for b in batches:
            for block, counts, trusted in zip(*(c.to_pylist() for c in b.columns)):
                got = np.frombuffer(zlib.decompress(counts), np.int64)
                tables[int(trusted), block:block + len(got)] += got
        at = np.nonzero(tables[0])[0]
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at.astype(np.int32)), "raw": tables[0][at], "target": tables[1][at]})

    rows = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.col("text").cast("string").alias("text"))
    good = trusted_labels(labels).where("_good = 1")
    target = maybe_in(rows, "_doc", good, "_id").hint("merge").join(good, F.col("_doc") == F.col("_id"))
    raw, trusted = (x.select("text").mapInArrow(run, "block int, counts binary").withColumn("trusted", F.lit(side))
                    for x, side in ((rows, False), (target, True)))
    return raw.union(trusted).repartition("block").mapInArrow(add, "bucket int, raw long, target long")


def log_ratios(counts: DataFrame, n_buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> np.ndarray:
    """``ln p_target - ln p_raw`` of each bucket in millionths; zero everywhere without a target."""
    raw, target = np.zeros(n_buckets), np.zeros(n_buckets)
    for r in counts.collect():  # at most n_buckets rows
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    if not target.sum():
        return np.zeros(n_buckets, np.int64)
    total = smoothing * n_buckets
    ratio = np.log((target + smoothing) / (target.sum() + total)) - np.log((raw + smoothing) / (raw.sum() + total))
    return np.rint(ratio * 1e6).astype(np.int64)


def score(raw: bytes, ratios: np.ndarray, order: int = ORDER) -> int:
    """Mean log ratio of a text's n-grams, in millionths (rounded down); 0 for none."""
    total = n = 0
    for g in buckets_of(raw, order, len(ratios)):
        total += int(ratios[g].sum())
        n += len(g)
    return total // n if n else 0


def threshold(scored: DataFrame, labels: DataFrame, good_weight: int = GOOD_WEIGHT) -> int:
    """The score that parts good from bad labelled documents with the least weighted error."""
    # scores fall into a bounded number of bins, so a bounded table comes to the driver
    bins = (scored.where("n_words >= %d" % MIN_WORDS).join(trusted_labels(labels), F.col("doc_id") == F.col("_id"))
            .groupBy(F.expr("greatest(-20000, least(20000, floor(score / 1000)))").alias("bin"))
            .agg(F.sum("_good").alias("good"), F.sum(1 - F.col("_good")).alias("bad")).orderBy("bin").collect())
    good, bad = sum(r["good"] for r in bins), sum(r["bad"] for r in bins)
    if not good or not bad:
        return -(1 << 62)
    best, cut, lost, kept = bad, -(1 << 62), 0, bad
    for r, nxt in zip(bins, [*(b["bin"] for b in bins[1:]), bins[-1]["bin"] + 1]):
        lost, kept = lost + r["good"], kept - r["bad"]
        if lost * good_weight + kept < best:  # the cut lies halfway to the next bin that has documents
            best, cut = lost * good_weight + kept, (r["bin"] + 1 + nxt) * 500
    return cut


def judge(docs: DataFrame, labels: DataFrame, order: int = ORDER, n_buckets: int = BUCKETS) -> DataFrame:
    """One row per row of ``docs``: the base columns, ``score``, ``base_failed`` and ``kept``."""
    ratios = docs.sparkSession.sparkContext.broadcast(log_ratios(ngram_counts(docs, labels, order, n_buckets), n_buckets))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def batch(b: pa.RecordBatch) -> dict:
        ts = texts(b.column(1))
        stats = np.array([base_statistics(t) for t in ts], np.int64)
        return {"doc_id": b.column(0)} | {k: stats[:, i].copy() for i, k in enumerate(names)} | {
            "score": pa.array([score(t.encode(), ratios.value, order) for t in ts], pa.int64())}

    scored = stage_table(map_batches(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), batch,
        "doc_id long, " + ", ".join(f"{n} long" for n in names) + ", score long"), "quality-rules")
    cut = threshold(scored, labels)
    return (scored.withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words"))
            .withColumn("kept", F.expr(f"NOT base_failed AND score >= {cut}L")))
