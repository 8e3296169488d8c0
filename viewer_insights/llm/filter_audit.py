"""Filter interaction audit over a sparse document-term matrix.

Five filters judge each document.  The audit applies them in all 120 orders and counts,
per part of the corpus, what each step keeps and removes, what earlier filters had removed
already, what only one filter catches, and which good or toxic documents each step costs.

The matrix: (1) every task cuts its documents into blocks of bounded size and counts words
under numbers of the block's own, as a CSR block with its distinct words in lists by hash
bucket; (2) each bucket is one task's: it numbers the words of its lists, so that a word has
one number in all blocks (the global dictionary ``word -> term``); (3) the numbers go back to
the blocks: CSR shards.  Lists travel packed, one row per block and bucket; a word occurs once
in a block's lists, so a frequent word is no hot key.  Row sums (words) and nonzero counts
(distinct words) of the shards decide filters A and B; C and D are counted with the text; E
follows from the smallest id of each text digest.  Documents are then counted per (id, part,
failing filters) before labels are joined, so an id that repeats is one row there, and the
orders are applied to at most 32 x 4 counts of each part.

Defined cases: a null text is empty (0 words, identical to other empty texts); a null part is
the empty string; a null id never has a smaller id with its text, and matches no label; rows
that repeat an id each count; a document is good (toxic) if any row of its label says so; an
empty table gives an empty result; other columns are ignored.  A document is never cut: a very
long one is a block of its own.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import count, permutations
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewer_insights.llm.common import slices, stage_table

#: a block ends at so many documents or words, whichever comes first
BLOCK_ROWS = 500
BLOCK_WORDS = 250_000
#: hash buckets of words per shuffle partition
BUCKETS_PER_TASK = 4
FILTERS = "ABCDE"
MIN_WORDS = 200
MARKS = "#$%&*|"
_CAPITALS = np.zeros(256, bool)
_CAPITALS[65:91] = True

_ROWS = "rows array<struct<doc_id: bigint, part: string, digest: binary, chars: bigint, capitals: bigint, marked: boolean>>"
_BLOCK = f"{_ROWS}, indptr binary, indices binary, counts binary, lists array<struct<bucket: int, words: binary>>"
_SHARD = f"block long, {_ROWS}, indptr binary, terms binary, counts binary"


@dataclass(frozen=True)
class DocumentTermMatrix:
    """``dictionary``: ``word string, term long``, one row per distinct word.  ``shards``: one CSR shard per
    row, ``block, rows, indptr, terms, counts``; the last three are packed numbers (``numbers_of``) of kinds
    ``<i8``, ``<i8`` and ``<i4``.  Row ``i`` has ``counts[j]`` occurrences of ``terms[j]`` for ``j`` from ``indptr[i]`` to
    ``indptr[i + 1]``."""

    dictionary: DataFrame
    shards: DataFrame


def _pack(raw: bytes) -> bytes:
    return zlib.compress(raw, 1)


def numbers_of(packed: bytes, kind: str) -> np.ndarray:
    """The numbers of a packed column."""
    return np.frombuffer(zlib.decompress(packed), kind)


class _Block:
    """CSR rows under construction, with word numbers of their own."""

    def __init__(self):
        self.rows, self.indptr, self.indices, self.counts = [], [0], [], []
        self.numbers: dict[bytes, int] = defaultdict(count().__next__)
        self.n_words = 0

    def add(self, row: dict, raw: bytes) -> None:
        words = raw.split()
        ids, n = np.unique(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)), return_counts=True)
        self.rows.append(row)
        self.indptr.append(self.indptr[-1] + len(ids))
        self.indices.append(ids)
        self.counts.append(n.astype("<i4"))
        self.n_words += len(words)

    def batch(self, n_buckets: int) -> pa.RecordBatch:
        """The block as one row; its words are numbered anew in the order of their buckets."""
        words = list(self.numbers)
        buckets = np.fromiter(map(crc32, words), np.int64, len(words)) % n_buckets
        order = np.argsort(buckets, kind="stable")
        place = np.empty(len(words), "<i4")
        place[order] = np.arange(len(words))
        names, starts = np.unique(buckets[order], return_index=True)
        ends = [*starts[1:].tolist(), len(words)]
        lists = [{"bucket": k, "words": _pack(b"\n".join(map(words.__getitem__, order[low:end].tolist())))}
                 for k, low, end in zip(names.tolist(), starts.tolist(), ends)]
        packed = [_pack(x.tobytes()) for x in (np.array(self.indptr, "<i8"), place[np.concatenate(self.indices)], np.concatenate(self.counts))]
        row = pa.struct([("doc_id", pa.int64()), ("part", pa.string()), ("digest", pa.binary()), ("chars", pa.int64()),
                         ("capitals", pa.int64()), ("marked", pa.bool_())])
        return pa.RecordBatch.from_arrays(
            [pa.array([self.rows], pa.list_(row)), *(pa.array([x], pa.binary()) for x in packed),
             pa.array([lists], pa.list_(pa.struct([("bucket", pa.int32()), ("words", pa.binary())])))],
            ["rows", "indptr", "indices", "counts", "lists"])


def csr_blocks(docs: DataFrame, n_buckets: int, part_col: str = "lang") -> DataFrame:
    """Documents as stored CSR blocks with word numbers of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for b in slices(batches):
            for i, part, text in zip(*(c.to_pylist() for c in b.columns)):
                text = text or ""
                raw = text.encode()
                capitals = int(_CAPITALS[np.frombuffer(raw, np.uint8)].sum())
                block.add({"doc_id": i, "part": part, "digest": sha256(raw).digest(), "chars": len(text), "capitals": capitals,
                           "marked": any(m in text for m in MARKS)}, raw)
                if len(block.rows) >= BLOCK_ROWS or block.n_words >= BLOCK_WORDS:
                    yield block.batch(n_buckets)
                    block = _Block()
        if block.rows:
            yield block.batch(n_buckets)

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col(part_col).cast("string"), F.lit("")), F.col("text").cast("string"))
    return stage_table(rows.mapInArrow(run, _BLOCK).withColumn("block", F.monotonically_increasing_id()), "csr-blocks")


def number_words(blocks: DataFrame, n_buckets: int) -> DataFrame:
    """``bucket, block, terms, before, fresh``, stored: the global numbers of each list's words, the words that
    occur for the first time in their bucket there (packed), and how many the bucket had before.

    The ``k``-th word of bucket ``b`` gets number ``k * n_buckets + b``.  A bucket is numbered in one task in the
    order of blocks, so a repeated task numbers alike.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, numbers = None, {}
        for b in slices(batches):
            out = []
            for bucket, block, words in zip(*(c.to_pylist() for c in b.columns)):
                if bucket != current:
                    current, numbers = bucket, {}
                words, before = zlib.decompress(words).split(b"\n"), len(numbers)
                own = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), "<i8", len(words))
                fresh = [w for w, k in zip(words, own.tolist()) if k >= before]
                out.append((bucket, block, _pack((own * n_buckets + bucket).tobytes()), before, _pack(b"\n".join(fresh))))
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                             ["bucket", "block", "terms", "before", "fresh"])

    lists = blocks.select("block", F.explode("lists").alias("list")).select("list.bucket", "block", "list.words")
    dealt = lists.repartition(max(1, n_buckets // BUCKETS_PER_TASK), "bucket").sortWithinPartitions("bucket", "block")
    return stage_table(dealt.mapInArrow(run, "bucket int, block long, terms binary, before long, fresh binary"), "terms")


def global_dictionary(numbered: DataFrame, n_buckets: int) -> DataFrame:
    """``word, term`` of every distinct word, from the lists of words that occurred for the first time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            bucket, before, fresh = (c[0].as_py() for c in b.columns)
            words = zlib.decompress(fresh).split(b"\n")
            if words != [b""]:
                terms = (before + np.arange(len(words))) * n_buckets + bucket
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), pa.array(terms)], ["word", "term"])

    return numbered.select("bucket", "before", "fresh").mapInArrow(run, "word string, term long")


def document_term_matrix(docs: DataFrame, part_col: str = "lang") -> DocumentTermMatrix:
    """The word counts of all documents under one global dictionary."""
    n_buckets = BUCKETS_PER_TASK * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = csr_blocks(docs, n_buckets, part_col)
    numbered = number_words(blocks, n_buckets)
    # the numbers of a block's words, in the order of its buckets; a block is of bounded size
    terms = numbered.groupBy("block").agg(F.expr("transform(array_sort(collect_list(struct(bucket, terms))), x -> x.terms)").alias("_terms"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            lists = [numbers_of(x, "<i8") for x in b.column("_terms").flatten().to_pylist()]
            numbers = np.concatenate([np.zeros(0, "<i8"), *lists])
            own = numbers_of(b.column("indices")[0].as_py(), "<i4")
            yield pa.RecordBatch.from_arrays([b.column("block"), b.column("rows"), b.column("indptr"),
                                              pa.array([_pack(numbers[own].tobytes())], pa.binary()), b.column("counts")],
                                             ["block", "rows", "indptr", "terms", "counts"])

    return DocumentTermMatrix(global_dictionary(numbered, n_buckets), blocks.drop("lists").join(terms, "block", "left").mapInArrow(run, _SHARD))


def row_statistics(shards: DataFrame) -> DataFrame:
    """``doc_id, part, digest, chars, capitals, marked, n_words, n_distinct``: row sums and nonzero counts of the matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            indptr, counts = (numbers_of(b.column(c)[0].as_py(), k) for c, k in (("indptr", "<i8"), ("counts", "<i4")))
            sums = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])[indptr]
            rows = b.column("rows").flatten()
            yield pa.RecordBatch.from_arrays([*rows.flatten(), pa.array(np.diff(sums)), pa.array(np.diff(indptr))],
                                             [*(f.name for f in rows.type), "n_words", "n_distinct"])

    return shards.select("rows", "indptr", "terms", "counts").mapInArrow(
        run, "doc_id long, part string, digest binary, chars long, capitals long, marked boolean, n_words long, n_distinct long")


def failing_filters(statistics: DataFrame) -> DataFrame:
    """``doc_id, part, failed, n``: documents per id, part and failing filters (letters of ``FILTERS`` in order).

    E: the text occurs under a smaller id.  A row holds the smallest id of its text if (digest, id) is
    among the (digest, smallest id) pairs; both keys together are nearly unique, so copies are no hot key.
    """
    own = (f"concat(CASE WHEN n_words < {MIN_WORDS} THEN 'A' ELSE '' END, "
           "CASE WHEN 100 * n_distinct < 50 * n_words THEN 'B' ELSE '' END, "
           "CASE WHEN 100 * capitals > 3 * chars THEN 'C' ELSE '' END, CASE WHEN marked THEN 'D' ELSE '' END)")
    rows = stage_table(statistics.select("doc_id", "part", "digest", F.expr(own).alias("failed"))
                       .groupBy("doc_id", "part", "digest", "failed").agg(F.count("*").alias("n")), "filter-flags")
    first = rows.where("doc_id is not null").groupBy(F.col("digest").alias("_digest")).agg(F.min("doc_id").alias("_id"))
    copy = F.col("_id").isNull() & F.col("doc_id").isNotNull()
    return (rows.join(first, (F.col("digest") == F.col("_digest")) & (F.col("doc_id") == F.col("_id")), "left")
            .withColumn("failed", F.concat("failed", F.when(copy, F.lit("E")).otherwise(F.lit(""))))
            .groupBy("doc_id", "part", "failed").agg(F.sum("n").alias("n")))


def label_counts(failing: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, failed, n, n_good, n_toxic``: documents per part and failing filters."""
    known = (labels.select(F.col("doc_id").cast("long").alias("_id"), "quality", "toxic").where("_id is not null")
             .groupBy("_id").agg(F.max(F.expr("int(quality = 1)")).alias("_good"), F.max(F.expr("int(toxic = 1)")).alias("_toxic")))
    return (failing.join(known, F.col("doc_id") == F.col("_id"), "left").groupBy("part", "failed")
            .agg(F.sum("n").alias("n"), F.sum(F.expr("n * coalesce(_good, 0)")).alias("n_good"),
                 F.sum(F.expr("n * coalesce(_toxic, 0)")).alias("n_toxic")))


def interactions(counts: DataFrame) -> DataFrame:
    """The audit of ``label_counts``: per part, order and step what happens to the part's documents.

    The orders are a literal of 120 strings beside each of the few count rows.  A document is still there at a
    step if none of the earlier letters is among its failing filters.
    """
    orders = F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))
    steps = counts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    letter, before = "substr(filter_order, step, 1)", "substr(filter_order, 1, step - 1)"
    steps = steps.selectExpr("*", f"{letter} AS letter", f"locate({letter}, failed) > 0 AS fails",
                             f"translate({before}, failed, '') = {before} AS there")

    def total(what: str, name: str, of: str = "n"):
        return F.expr(f"CAST(sum(CASE WHEN {what} THEN {of} ELSE 0 END) AS BIGINT)").alias(name)

    table = steps.groupBy("part", "filter_order", "step", "letter").agg(
        total("there AND NOT fails", "kept"), total("there AND fails", "removed"), total("NOT there AND fails", "redundant"),
        total("failed = letter", "unique_fails"), total("there AND fails", "good_lost", "n_good"),
        total("there AND fails", "toxic_lost", "n_toxic"))
    # the same sum per (part, letter), again from the few count rows
    shapley = steps.groupBy(F.col("part").alias("_part"), F.col("letter").alias("_letter")).agg(total("there AND fails", "shapley"))
    return (table.join(shapley, (F.col("part") == F.col("_part")) & (F.col("letter") == F.col("_letter")))
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))


def audit(docs: DataFrame, labels: DataFrame, part_col: str = "lang") -> DataFrame:
    """All orders of the five filters over ``docs``: one row per part, order and step."""
    flags = failing_filters(row_statistics(document_term_matrix(docs, part_col).shards))
    return interactions(stage_table(label_counts(flags, labels), "filter-counts"))
