"""Target-distribution importance resampling.

Documents and a target (benchmark texts) are bags of word n-grams hashed into a fixed
number of buckets.  A bucket's gain is its smoothed log ratio of target to corpus in
thousandths; a document's weight is the mean gain of its features; the score is the
weight plus a Gumbel number that follows from the document's id, so the documents with
the highest scores are a draw without replacement by weight.

Steps: (1) bucket counts of corpus and target, one array per task, summed by Spark;
(2) every document scored against the array of gains and stored once; (3) the cutoff: a
quantile sketch of the scores brackets it, exact counts outside the bracket validate or
widen it, and only the rows inside are sorted to find the last one drawn; (4) the drawn
rows get their ranks from a range-partitioned sort.  No step brings rows to the driver
but the cutoff row, the bucket counts (``BUCKETS`` at most) and one count per range.

Defined cases: a null text has no words; a document without features weighs 0; a null id
is hashed as the empty text and comes last among equal scores; documents with fewer than
``MIN_WORDS`` words are scored and never drawn; rows that repeat an id each take part, and
rows equal in score and id are drawn by the number of features, then in stored order; an
empty target has no counts, so gains follow from the smoothing alone; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewer_insights.llm.common import map_batches, slices, stage_table
from viewer_insights.operators.merge import with_row_index

ORDER = 2
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = 7
#: rank error of the quantile sketch, as a share of the rows
SKETCH_ERROR = 0.001
_STEP = 1 << 20  # bytes of a text cut into words at once
_KEPT = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def word_stretches(raw: bytes, step: int = _STEP) -> Iterator[list[bytes]]:
    """The words of a text (A-Z lower-cased; runs of digits, letters and bytes over 127) in bounded stretches."""
    at = 0
    while at < len(raw):
        end = at + step
        while end < len(raw) and _KEPT[raw[end]] != 32:
            end += 1
        yield raw[at:end].translate(_KEPT).split()
        at = end


def feature_buckets(raw: bytes, order: int = ORDER, n_buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray]]:
    """``(number of words, buckets of the features that end in them)`` of each stretch of a text."""
    tails: list[list[int]] = [[] for _ in range(order - 1)]  # CRC of the run of 1, 2, ... words before the stretch
    for words in word_stretches(raw):
        if not words:
            continue
        found = runs = list(map(crc32, words))
        spaced = [b" " + w for w in words] if order > 1 else []
        for n in range(1, order):  # a run of n + 1 words continues the CRC of the n words before its last
            before = tails[n - 1] + runs[:-1]
            tails[n - 1] = runs[-1:] or tails[n - 1]
            runs = list(map(crc32, spaced[len(spaced) - len(before):], before))
            found = found + runs
        yield len(words), (np.array(found, np.int64) % n_buckets)


def bucket_counts(rows: DataFrame, order: int = ORDER, n_buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all texts of ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for b in slices(batches):
            for raw in b.column(0).to_pylist():
                for _, found in feature_buckets(raw or b"", order, n_buckets):
                    if len(found) > n_buckets:
                        total += np.bincount(found, minlength=n_buckets)
                    else:
                        np.add.at(total, found, 1)
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at.astype(np.int32)), "n": total[at]})

    counts = (rows.select(F.col("text").cast("string").cast("binary")).mapInArrow(run, "bucket int, n long")
              .groupBy("bucket").agg(F.sum("n").alias("n")))
    out = np.zeros(n_buckets, np.int64)
    for r in counts.collect():  # at most n_buckets rows
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Smoothed log ratio of target to corpus per bucket, in thousandths, rounded down."""
    n = len(corpus)
    s_all, t_all = float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def gumbel(doc_id: int | None, seed: int = SEED) -> int:
    """A Gumbel number in thousandths that follows from the id."""
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score_documents(docs: DataFrame, gain: np.ndarray, order: int = ORDER, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row of ``docs``."""
    table = docs.sparkSession.sparkContext.broadcast(gain)  # as many numbers as buckets

    def batch(b: pa.RecordBatch) -> dict:
        rows = []
        for i, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            n_words = n = total = 0
            for k, found in feature_buckets(raw or b"", order, len(table.value)):
                n_words, n, total = n_words + k, n + len(found), total + int(table.value[found].sum())
            weight = total // n if n else 0
            rows.append((n_words, n, weight, weight + gumbel(i, seed)))
        columns = zip(*rows) if rows else [()] * 4
        return {"doc_id": b.column(0)} | {k: pa.array(c, pa.int64()) for k, c in zip(("n_words", "n_features", "weight", "score"), columns)}

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary")), batch,
                       "doc_id long, n_words long, n_features long, weight long, score long")


def bracket(rows: DataFrame, col: str, k: int, n: int, error: float = SKETCH_ERROR) -> tuple[float, float, int]:
    """``(low, high, above)``: the ``k``-th highest of ``n`` values of ``col`` lies from low to high,
    ``above`` rows exceed high.  The sketch proposes, exact counts decide; a bracket that misses is widened."""
    share = 1 - k / n
    while True:
        low, high = rows.approxQuantile(col, [max(0.0, share - 2 * error), min(1.0, share + 2 * error)], min(error, 1.0))
        if error >= 1:
            low, high = rows.agg(F.min(col), F.max(col)).first()
        above, reached = rows.agg(F.count_if(F.col(col) > high), F.count_if(F.col(col) >= low)).first()
        if above < k <= reached:
            return low, high, above
        error *= 8


_KEY = ("score", "doc_id", "n_features", "_uid")


def _order():
    return [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("_uid")]


def drawn(stored: DataFrame, k: int, n: int) -> DataFrame:
    """The first ``k`` of the ``n`` rows of a stored table in draw order."""
    if k <= 0:
        return stored.limit(0)
    low, high, above = bracket(stored, "score", k, n)
    inside = stored.where((F.col("score") >= F.lit(low)) & (F.col("score") <= F.lit(high))).select(*_KEY)
    score, doc_id, n_features, uid = with_row_index(inside, _order(), "_pos").where(F.col("_pos") == k - above).select(*_KEY).first()
    last = F.struct(F.lit(doc_id is None), F.lit(doc_id or 0).cast("long"), F.lit(n_features).cast("long"), F.lit(uid).cast("long"))
    own = F.struct(F.isnull("doc_id"), F.coalesce("doc_id", F.lit(0)), "n_features", "_uid")
    return stored.where((F.col("score") > score) | (F.col("score") == score) & (own <= last))


def resample(docs: DataFrame, target: DataFrame, order: int = ORDER, n_buckets: int = BUCKETS, percent: int = PERCENT,
             min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row; rank is null for rows not drawn."""
    gain = gains(bucket_counts(docs, order, n_buckets), bucket_counts(target, order, n_buckets))
    stored = stage_table(score_documents(docs, gain, order, seed).withColumn("_uid", F.monotonically_increasing_id()), "resampling")
    able = stored.where(F.col("n_words") >= min_words)
    n = able.count()
    out = ["doc_id", "n_features", "weight", "score"]
    ranks = with_row_index(drawn(able, percent * n // 100, n).select(*_KEY), _order(), "rank").select("_uid", "rank")
    return stored.join(ranks, "_uid", "left").select(*out, F.col("rank").cast("long"))
