"""Quality classifier: histogram gradient-boosted trees over document statistics.

The trees are complete binary trees flattened into arrays (feature, threshold, leaf
value); a batch of documents walks all of them with numpy indexing.  They are fitted
on the driver on at most ``max_train_rows`` labelled documents (those of smallest id
hash); statistics and scores cover every document.  What the driver gathers is that sample
alone: a cut of the hash from the number of labelled ids lets about as many ids pass as are
wanted before they are sorted, and rows that share an id meet map-side.

Defined cases: a null text is the empty text (all statistics zero, scored like any
other); labels of a repeated doc_id are averaged (1 from one half up), and of its documents
the one with the smallest statistics is fitted; a null quality
or a label without document is ignored; repeated rows each get their row; without any
usable label every score is 0.5; with one class only, the score leans to that class;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewer_insights.llm.common import keep_rows, map_batches, texts

MAX_TRAIN_ROWS = 20_000
THRESHOLD = 0.3

#: Byte classes counted by one histogram per text.
CLASSES = ("upper", "lower", "digit", "space", "newline", "symbol", "pipe", "bang", "period", "other_punct", "high")
#: Statistics of a document, in the order of ``statistics``.
FEATURES = ("log_bytes", "log_words", "bytes_per_word", *(f"{c}_share" for c in CLASSES), "symbols_per_word",
            "unique_words", "adjacent_repeats", "upper_words", "repeated_lines", "words_per_line", "longest_word")


def _class_table() -> np.ndarray:
    out = np.zeros((256, len(CLASSES)))
    for byte in range(256):
        c = chr(byte)
        k = ("high" if byte >= 128 else "upper" if c.isupper() else "lower" if c.islower() else
             "digit" if c.isdigit() else "newline" if c == "\n" else "space" if c.isspace() else
             "pipe" if c == "|" else "symbol" if c in "#*$%&<>" else "bang" if c == "!" else
             "period" if c == "." else "other_punct")
        out[byte, CLASSES.index(k)] = 1
    return out


_TABLE = _class_table()


def statistics(text: str) -> list[float]:
    """The ``FEATURES`` of one text."""
    raw = text.encode()
    n = len(raw)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _TABLE
    words = raw.split()
    m = max(len(words), 1)
    lines = [x for x in raw.split(b"\n") if x]
    k = max(len(lines), 1)
    distinct = set(words)
    symbols = counts[CLASSES.index("symbol")] + counts[CLASSES.index("pipe")]
    return [np.log1p(n), np.log1p(len(words)), n / m, *(counts / n), symbols / m, len(distinct) / m,
            sum(map(eq, words, words[1:])) / m, sum(map(bytes.isupper, words)) / m, 1 - len(set(lines)) / k,
            len(words) / k, max(map(len, distinct), default=0) / 100]


@dataclass
class Trees:
    """Flattened complete trees: inner nodes in heap order, then leaf values."""

    base: float
    feature: np.ndarray  # (trees, 2**depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # (trees, 2**depth)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of ``x``."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(inner.bit_length()):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += leaf[at - inner]
        return 1 / (1 + np.exp(-out))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
        l2: float = 1.0, min_weight: float = 1.0) -> Trees:
    """Second-order boosting of the logistic loss on feature histograms."""
    inner, leaves = 2**depth - 1, 2**depth
    if not len(y):
        return Trees(0.0, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    prior = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(prior / (1 - prior)))
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    code = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    flat = code + np.arange(width) * bins
    margin = np.full(n, base)
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, leaves))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            slot = ((at - first)[:, None] * (width * bins) + flat).ravel()
            size = nodes * width * bins
            g = np.bincount(slot, np.repeat(grad, width), size).reshape(nodes, width, bins).cumsum(2)
            h = np.bincount(slot, np.repeat(hess, width), size).reshape(nodes, width, bins).cumsum(2)
            gt, ht = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + l2) + (gt - g) ** 2 / (ht - h + l2) - gt**2 / (ht + l2)
            gain[(h < min_weight) | (ht - h < min_weight)] = 0
            best = gain.reshape(nodes, -1).argmax(1)
            for node in range(nodes):
                f, b = divmod(int(best[node]), bins)
                if gain[node, f, b] > 1e-9 and b < len(edges[f]):
                    feature[t, first + node], threshold[t, first + node] = f, edges[f][b]
            at = 2 * at + 1 + (x[np.arange(n), feature[t, at]] > threshold[t, at])
        at -= inner
        g, h = np.bincount(at, grad, leaves), np.bincount(at, hess, leaves)
        leaf[t] = -rate * g / (h + l2)
        margin += leaf[t, at]
    return Trees(base, feature, threshold, leaf)


def held_out(doc_id: Column) -> Column:
    """The fold kept out of training: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_ids(labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """``_id, _y``: the labelled ids outside the held-out fold with the smallest hashes, ``max_train_rows`` at most."""
    ids = (labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("double").alias("_y"))
           .where(F.col("_id").isNotNull() & F.col("_y").isNotNull() & ~held_out(F.col("_id")))
           .groupBy("_id").agg(F.avg("_y").alias("_y")).withColumn("_hash", F.xxhash64("_id")))
    n, spare = ids.count(), 1.2
    passing = ids
    while spare * max_train_rows < n:  # hashes are spread evenly from -2**63 on
        passing = ids.where(F.col("_hash") < F.lit(int(-(2**63) + 2.0**64 * spare * max_train_rows / n)))
        if passing.count() >= max_train_rows:
            break
        passing, spare = ids, spare * 2
    return passing.orderBy("_hash", "_id").limit(max_train_rows).select("_id", "_y")


def train(docs: DataFrame, labels: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS) -> Trees:
    """Fit on at most ``max_train_rows`` labelled documents outside the held-out fold."""
    ids = training_ids(labels, max_train_rows)  # bounded: may be broadcast
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(ids), F.col("doc_id") == F.col("_id"))

    def batch(b: pa.RecordBatch) -> dict:
        return {"_id": b.column(0), "_y": b.column(1),
                "x": pa.array([statistics(t) for t in texts(b.column(2))], pa.list_(pa.float64()))}

    sample = (map_batches(rows.select("_id", "_y", "text"), batch, "_id long, _y double, x array<double>")
              .groupBy("_id").agg(F.first("_y").alias("_y"), F.min("x").alias("x"))
              .orderBy(F.xxhash64("_id"), "_id").collect())  # one row per training id
    x = np.array([r["x"] for r in sample], float).reshape(len(sample), len(FEATURES))
    return fit(x, np.array([float(r["_y"] >= 0.5) for r in sample]))


def _scores(model: Trees, batch_texts: list[str]) -> np.ndarray:
    return model.score(np.array([statistics(t) for t in batch_texts], float).reshape(len(batch_texts), len(FEATURES)))


def _ship(docs: DataFrame, model: Trees):
    """Broadcast a model as plain arrays: broadcast values go by name, and workers need not have this package."""
    return docs.sparkSession.sparkContext.broadcast((model.base, model.feature, model.threshold, model.leaf))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
             max_train_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``."""
    model = _ship(docs, train(docs, labels, max_train_rows))

    def batch(b: pa.RecordBatch) -> dict:
        s = _scores(Trees(*model.value), texts(b.column(1)))
        return {"doc_id": b.column(0), "score": pa.array(s), "predicted": pa.array((s >= threshold).astype(np.int32))}

    scored = map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), batch,
                         "doc_id long, score double, predicted int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
              max_train_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` (all columns) that the classifier does not reject."""
    model = _ship(docs, train(docs, labels, max_train_rows))
    return keep_rows(docs, "text", lambda ts: (_scores(Trees(*model.value), ts) >= threshold).tolist())
