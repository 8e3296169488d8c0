"""Sum-of-squares packing of tokenized documents into fixed-length sequences.

Each document is tokenized once, followed by a separator id.  Documents longer than a
sequence are cut into full pieces and a last, shorter one; full pieces are sequences of
their own.  The rest is placed by the sum-of-squares rule: of all open bins (by residual
gap) and a new bin, take the one after which the sum of squared counts of open bins per
gap is smallest.  Pieces are taken longest first, so the short ones fill the gaps left;
the bins then left open are taken up and packed again by the same rule while that saves
a bin.

Pieces are dealt evenly into groups of about ``group_rows`` (their number grows with the
input) and each group is packed by one task: a group holds only lengths and ids, never
tokens.  A group leaves only a few bins unfilled, which is what packing in groups costs.

Defined cases: a null or empty text is one piece of the separator alone; repeated rows
are packed each; null ids are carried; an empty table gives an empty result; other
columns are ignored; a very long text is tokenized whole.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import sys
import types
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewer_insights.llm.common import slices, stage_table, texts

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
LENGTH = 2048
GROUP_ROWS = 1 << 16
CACHE_WORDS = 500_000
_TOGETHER = 64
#: How a vocabulary must prepare texts for ``parted`` to be right (small letters, words, single digits and
#: runs of marks apart, white space dropped).
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PARTING = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed", "invert": True}
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: ASCII and the letters of Latin-1: such a text may be made small and parted after its letters and digits.
_PLAIN = re.compile(r"[\t\n -~À-ÖØ-öø-ÿ]*").fullmatch
_IS_MARK = np.array([chr(i) in _PUNCTUATION for i in range(256)])
_AFTER_WORD = re.compile(r"(?<=[0-9a-zà-öø-ÿß])(?=[!-/:-@\[-`{-~])").sub


def parted(text: str, whole: tuple[str, ...] = ()) -> list[str]:
    """The words of a text, split at spaces and line feeds; other white space stays with them.
    Plain texts are made small first and parted between a letter or digit and a punctuation
    mark, where tokens always part, so that fewer different words are met; not texts that
    hold one of ``whole`` (special tokens), in any case of letters."""
    small = text.lower()
    if _PLAIN(text) and not any(w in small for w in whole):
        text = small
        marks = _IS_MARK[np.frombuffer(text.encode("latin-1"), np.uint8)]
        if (marks[1:] & marks[:-1]).any():
            text = _AFTER_WORD(" ", text)
        else:  # no mark follows another: a space before each parts it from its word
            for mark in _PUNCTUATION:
                if mark in text:
                    text = text.replace(mark, " " + mark)
    return text.replace("\n", " ").split(" ")


class WordTokens:
    """Token ids of whole texts, with the ids of words kept for reuse.

    A vocabulary with word ends that makes letters small and parts words, digits and marks
    drops white space and never joins across it, so the ids
    of a text are those of its words in a row (``parted``).  Words of small letters are
    tokenized many in one text and parted at the word-end tokens, other words one by
    one.  Memory is bounded: at ``cache_words`` words the cache starts anew.  Other kinds
    of vocabulary get whole texts.
    """

    def __init__(self, data: bytes, cache_words: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(data)
        self.cache_words = cache_words
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        how = json.loads(data)
        steps = (how.get("pre_tokenizer") or {}).get("pretokenizers") or [None]
        self.by_word = bool(suffix) and how.get("normalizer") == _NORMALIZER and steps[0] == _PARTING and all(
            x["type"] == "ByteLevel" and not x["add_prefix_space"] and not x["use_regex"] for x in steps[1:])
        self.special = tuple(t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values())
        if self.by_word:
            vocabulary = self.tokenizer.get_vocab()
            self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends_word[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = defaultdict(itertools.count().__next__)
        self.known = 0
        self.begin = np.zeros(1, np.int64)  # where the ids of a word begin in self.ids
        self.ids = np.zeros(0, np.uint32)

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(itertools.chain.from_iterable(got), np.uint32, int(sizes.sum())), sizes

    def _learn(self) -> None:
        """Tokenize the words met since the last call."""
        fresh = list(itertools.islice(self.number, self.known, None))
        letters = np.fromiter(map(str.isalpha, fresh), bool, len(fresh))
        runs, others = list(itertools.compress(fresh, letters)), list(itertools.compress(fresh, ~letters))
        ids, _ = self._encode([" ".join(runs[i:i + _TOGETHER]) for i in range(0, len(runs), _TOGETHER)])
        cuts = np.flatnonzero(self.ends_word[ids]) + 1
        if len(cuts) == len(runs) and (not len(runs) or cuts[-1] == len(ids)):
            sizes = np.diff(cuts, prepend=0)
        else:  # a run that is not one word to the tokenizer
            ids, sizes = self._encode(runs)
        other_ids, other_sizes = self._encode(others)
        where, count = np.empty(len(fresh), np.int64), np.empty(len(fresh), np.int64)
        count[letters], count[~letters] = sizes, other_sizes
        where[letters] = np.cumsum(sizes) - sizes
        where[~letters] = len(ids) + np.cumsum(other_sizes) - other_sizes
        both = np.concatenate([ids, other_ids])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(count)])
        self.ids = np.concatenate([self.ids, both[_stretches(where, count)]])
        self.known = len(self.number)

    def encode(self, docs: list[str]) -> Iterator[np.ndarray]:
        if not self.by_word:
            for e in self.tokenizer.encode_batch_fast(docs, add_special_tokens=False):
                yield np.array(e.ids, np.uint32)
            return
        if len(self.number) > self.cache_words:
            self.clear()
        get = self.number.__getitem__
        words = [np.fromiter(map(get, x), np.int32, len(x)) for x in (parted(t, self.special) for t in docs)]
        if len(self.number) > self.known:
            self._learn()
        for at in words:
            first = self.begin[at]
            yield self.ids[_stretches(first, self.begin[at + 1] - first)]


def _stretches(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``first[0], first[0] + 1, ...`` for ``size[0]`` places, then those of the next, and so on."""
    total = np.cumsum(size)
    return np.repeat(first - total + size, size) + np.arange(total[-1] if len(total) else 0)


def _tokens(data: bytes) -> WordTokens:
    """The word cache of this Python worker (kept between tasks that the worker runs)."""
    holder = sys.modules.setdefault("_training_tokens", types.ModuleType("_training_tokens"))
    key = zlib.crc32(data)
    if getattr(holder, "key", None) != key:
        holder.key, holder.tokens = key, WordTokens(data)
    return holder.tokens


def tokenized_pieces(docs: DataFrame, tokenizer: str = TOKENIZER, length: int = LENGTH, end_id: int = 0,
                     chars: int = 1 << 20) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` for every piece of every row of ``docs``."""
    with open(tokenizer, "rb") as f:  # sent to the tasks: executors need not have the file
        data = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(data.value)
        for b in slices(batches):
            out: list[tuple] = []
            ids, ts = b.column(0).to_pylist(), texts(b.column(1))
            for lo, hi in stretches(ts, chars):
                for doc_id, got in zip(ids[lo:hi], tokens.encode(ts[lo:hi])):
                    whole = np.append(got, end_id).astype("<u4")
                    for piece, start in enumerate(range(0, len(whole), length)):
                        part = whole[start:start + length]
                        out.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(cols[0], pa.int64()), "piece": pa.array(cols[1], pa.int32()),
                **{n: pa.array(c, pa.int64()) for n, c in zip(("start", "length", "ids_crc32"), cols[2:])}})

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def stretches(ts: list[str], chars: int) -> Iterator[tuple[int, int]]:
    """Stretches of about ``chars`` characters."""
    first, held = 0, 0
    for i, t in enumerate(ts):
        held += len(t)
        if held >= chars or i == len(ts) - 1:
            yield first, i + 1
            first, held = i + 1, 0


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of every item, placed in the given order."""
    counts = np.zeros(capacity + 1, np.int64)  # open bins per residual gap
    # placing into gap g: -2 N[g] + 1 for the gap that closes, 2 N[g - s] + 1 for the one that opens
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    never = np.int64(1) << 40
    cost = np.full(capacity + 1, never)  # -2 N[g] + 1 where a bin is open
    bins, offsets, used = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for i, s in enumerate(lengths.tolist()):
        change = cost[s:capacity] + 2 * counts[:capacity - s] + 1
        if s < capacity:
            change[0] = cost[s]  # an exact fit opens no gap
        fresh = 2 * counts[capacity - s] + 1 if s < capacity else 0
        k = int(change.argmin()) if len(change) else 0
        if len(change) and change[k] <= fresh:
            gap = k + s
            b = open_bins[gap].pop()
            counts[gap] -= 1
            cost[gap] = 1 - 2 * counts[gap] if counts[gap] else never
        else:
            gap, b, used = capacity, used, used + 1
        bins[i], offsets[i] = b, capacity - gap
        left = gap - s
        if left:
            open_bins[left].append(b)
            counts[left] += 1
            cost[left] = 1 - 2 * counts[left]
    return bins, offsets


def pack(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of every item: sum of squares, longest first, repeated over the
    bins left open while that saves bins."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    at, first, best = np.argsort(-lengths, kind="stable"), 0, None
    while len(at):
        b, o = sum_of_squares(lengths[at], capacity)
        used = int(b.max()) + 1
        if best is not None and used >= best:
            break
        bins[at], offsets[at] = first + b, o
        left = np.bincount(b, lengths[at], used) < capacity
        # full bins keep their numbers, open ones are numbered after them
        number = np.where(left, int((~left).sum()) + np.cumsum(left) - 1, np.cumsum(~left) - 1)
        bins[at] = first + number[b]
        first, best = first + int((~left).sum()), int(left.sum())
        at = at[left[b]]
    return bins, offsets


def pack_documents(docs: DataFrame, tokenizer: str = TOKENIZER, length: int = LENGTH, end_id: int = 0,
                   group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    pieces = stage_table(tokenized_pieces(docs, tokenizer, length, end_id), "packing-pieces")
    short = pieces.where(F.col("length") < length)
    groups = max(1, -(-short.count() // group_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows are in no certain order after a shuffle: a fixed order makes a repeated task agree
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held).sort_by([(n, "ascending") for n in held[0].schema.names])
        bins, offsets = pack(t.column("length").to_numpy(), length)
        group = TaskContext.get().partitionId()
        t = t.append_column("sequence_id", pa.array((np.int64(group) << 40) + bins)).append_column("offset", pa.array(offsets))
        yield from t.to_batches(max_chunksize=100_000)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    packed = short.repartition(groups).mapInArrow(run, schema)
    # full pieces are sequences of their own; their ids are negative
    full = pieces.where(F.col("length") == length).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.union(full)
