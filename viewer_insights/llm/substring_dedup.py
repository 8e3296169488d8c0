"""Substring dedup: words of passages that recur are removed, wherever they occur.

A window is ``WINDOW`` consecutive words of one document; it recurs if its word sequence
starts at any other place of the corpus, the same document included.  Every word that a
recurring window covers is removed.

Steps.  Documents are stored once in blocks of bounded size, bucketed by block, so that the
later passes read them without shuffling texts again.
(1) Candidates: of the hashed runs of ``ANCHOR`` words in a window the smallest is its anchor.
Equal windows have equal anchors, so a window can only recur if its anchor does.  Each block
sends its distinct anchors with their counts; those counted twice go back to their blocks.
(2) Confirmation: windows with a recurring anchor are counted by 128-bit fingerprints of
their words, one row per distinct window and block; those counted twice are confirmed.
(3) Automata: confirmed windows that follow each other are a passage.  The passages that can
occur in a block are compiled into one Aho-Corasick automaton over word numbers, from pieces
of ``(WINDOW + 1) // 2`` words: any window of a passage holds one whole piece.  All documents
of the block stream through it; each piece found is extended word by word to both sides, and
where at least a window agrees, its words are removed.

Keys of every shuffle are anchors or windows, distinct per block, or blocks; a passage that a
third of all documents share is one row per block.  Nothing is capped or sampled.

Defined cases: a null text has no words; documents shorter than a window keep every word and
recur nowhere; rows that repeat an id or a text each count as a place and each get a row; a
null id stays null; an empty table gives an empty result; other columns are ignored.  A
document is never cut: a very long one is a block of its own.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewer_insights.llm.common import bucketed_table, slices, stage_table

WINDOW = 35
ANCHOR = 12
#: a block ends at so many documents or bytes of text, whichever comes first
BLOCK_ROWS = 500
BLOCK_BYTES = 1 << 20
_STEP = 1 << 20  # bytes of a text cut into words at once
_ROWS = 1 << 16  # windows searched for their anchor at once
_PLACES = 1 << 20  # piece hits extended at once
_BASES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
_SPACES = b" \t\n\x0b\x0c\r"


@dataclass
class Tokens:
    """The words of a block's documents as numbers: 0 ends a document, word ``i`` is ``words[i]``."""

    ids: np.ndarray
    words: list[bytes]
    starts: np.ndarray  # of each document
    ends: np.ndarray

    def windows(self, size: int) -> np.ndarray:
        """Places where ``size`` words of one document start."""
        rest = np.repeat(self.ends, self.ends - self.starts + 1) - np.arange(len(self.ids))
        return np.flatnonzero(rest >= size)


def tokenize(raws: list[bytes]) -> Tokens:
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    numbers[b""]  # no word: the end of a document
    parts, ends, at = [], [], 0
    for raw in raws:
        done = 0
        while done < len(raw):
            end = done + _STEP
            while end < len(raw) and raw[end] not in _SPACES:
                end += 1
            words = raw[done:end].split()
            parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
            at, done = at + len(words), end
        ends.append(at)
        parts.append(np.zeros(1, np.int32))
        at += 1
    ends = np.array(ends, np.int64)
    return Tokens(np.concatenate(parts), list(numbers), np.concatenate([[0], ends[:-1] + 1]), ends)


def _rolling(x: np.ndarray, size: int, base: np.uint64) -> np.ndarray:
    """Hash of the ``size`` numbers from each place on."""
    n = max(0, len(x) - size + 1)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out = out * base + x[j:j + n]
    out ^= out >> np.uint64(32)
    out *= _BASES[0]
    return out ^ (out >> np.uint64(29))


def _word_hashes(t: Tokens) -> np.ndarray:
    """Two 64-bit hashes of every word of a block."""
    table = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, t.words)), np.uint64).reshape(-1, 2)
    return table[t.ids].T


def anchors(t: Tokens, hashes: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, at, values)``: places of windows, where the anchor of each lies, hashes of the runs at all places."""
    starts = t.windows(window)
    values = _rolling(hashes[0], anchor, _BASES[1])
    if not len(starts):
        return starts, starts, values
    runs = np.lib.stride_tricks.sliding_window_view(values, window - anchor + 1)
    smallest = np.concatenate([runs[i:i + _ROWS].argmin(axis=1) for i in range(0, len(runs), _ROWS)])
    return starts, starts + smallest[starts], values


def _unpack(b: pa.RecordBatch) -> list[bytes]:
    lengths = b.column("lengths").flatten().to_pylist()
    text, at, out = zlib.decompress(b.column("texts")[0].as_py()), 0, []
    for n in lengths:
        out.append(text[at:at + n])
        at += n
    return out


def document_blocks(docs: DataFrame) -> DataFrame:
    """``block, ids, lengths, texts``: documents in blocks of bounded size, texts packed, bucketed by block."""

    def pack(ids: list, raws: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([ids], pa.list_(pa.int64())), pa.array([[len(r) for r in raws]], pa.list_(pa.int64())),
             pa.array([zlib.compress(b"".join(raws), 1)], pa.binary())], ["ids", "lengths", "texts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, raws, size = [], [], 0
        for b in slices(batches):
            for i, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids.append(i)
                raws.append(raw or b"")
                size += len(raws[-1])
                if size >= BLOCK_BYTES or len(ids) >= BLOCK_ROWS:
                    yield pack(ids, raws)
                    ids, raws, size = [], [], 0
        if ids:
            yield pack(ids, raws)

    blocks = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary")).mapInArrow(
        run, "ids array<long>, lengths array<long>, texts binary")
    return bucketed_table(blocks.withColumn("block", F.monotonically_increasing_id()), "block", "text-blocks")


def recurring_anchors(blocks: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``block, anchors``: the anchors of each block that lie at two or more places of the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            t = tokenize(_unpack(b))
            _, at, values = anchors(t, _word_hashes(t), window, anchor)
            found, n = np.unique(values[np.unique(at)], return_counts=True)
            yield pa.RecordBatch.from_pydict({"anchor": found.view(np.int64), "block": np.repeat(b.column("block").to_numpy(), len(found)),
                                              "n": n.astype(np.int32)})

    rows = blocks.select("block", "lengths", "texts").mapInArrow(run, "anchor long, block long, n int")
    places = F.sum("n").over(Window.partitionBy("anchor"))
    return stage_table(rows.withColumn("places", places).where("places > 1").groupBy("block").agg(
        F.collect_list("anchor").alias("anchors")), "recurring-anchors")


def recurring_windows(blocks: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``block, starts``: the first place in each block of every window that recurs in the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            t = tokenize(_unpack(b))
            hashes = _word_hashes(t)
            starts, at, values = anchors(t, hashes, window, anchor)
            starts = starts[np.isin(values[at], b.column("anchors").flatten().to_numpy().view(np.uint64))]
            one, two = (_rolling(h, window, base)[starts] for h, base in zip(hashes, _BASES))
            order = np.lexsort((starts, two, one))
            one, two, starts = one[order], two[order], starts[order]
            first = np.flatnonzero(np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])[:len(one)])
            yield pa.RecordBatch.from_pydict({
                "one": one[first].view(np.int64), "two": two[first].view(np.int64), "block": np.repeat(b.column("block").to_numpy(), len(first)),
                "start": starts[first], "n": np.diff(np.append(first, len(one))).astype(np.int32)})

    marked = blocks.select("block", "lengths", "texts").join(recurring_anchors(blocks, window, anchor), "block")
    rows = marked.mapInArrow(run, "one long, two long, block long, start long, n int")
    places = F.sum("n").over(Window.partitionBy("one", "two"))
    return stage_table(rows.withColumn("places", places).where("places > 1").groupBy("block").agg(
        F.collect_list("start").alias("starts")), "recurring-windows")


def passages(starts: np.ndarray, t: Tokens, window: int) -> tuple[np.ndarray, np.ndarray]:
    """First place and end of each stretch that consecutive confirmed windows cover."""
    starts = np.sort(starts)
    cut = np.flatnonzero(np.diff(starts) != 1) + 1
    lows = starts[np.concatenate([[0], cut])]
    return lows, starts[np.append(cut, len(starts)) - 1] + window


def compile_automaton(t: Tokens, lows: np.ndarray, ends: np.ndarray, piece: int):
    """The automaton of the passages' pieces and, for each, the places ``(piece start, passage start, passage end)``."""
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    numbers: dict[tuple, int] = {}
    places: list[list[tuple[int, int, int]]] = []
    for low, end in zip(lows.tolist(), ends.tolist()):
        words = t.ids[low:end].tolist()
        for at in range(0, len(words) - piece + 1, piece):
            key = tuple(words[at:at + piece])
            k = numbers.setdefault(key, len(places))
            if k == len(places):
                places.append([])
                automaton.add_word(key, k)
            places[k].append((low + at, low, end))
    automaton.make_automaton()
    return automaton, places


def covered_words(t: Tokens, starts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Whether each word of a block lies in an occurrence of a confirmed window."""
    change = np.zeros(len(t.ids) + 1, np.int64)
    if not len(starts):
        return change[:-1] > 0
    piece = (window + 1) // 2
    automaton, places = compile_automaton(t, *passages(starts, t, window), piece)
    flat, pending, held = t.ids, [], 0

    def extend() -> None:
        own, low, end, at = (np.array(c, np.int64) for c in zip(*pending))
        left, right = np.zeros(len(at), np.int64), np.full(len(at), piece)
        going = np.ones(len(at), bool)
        for j in range(1, window - piece + 1):  # number 0 ends documents and equals no word of a passage
            going &= (own - j >= low) & (at - j >= 0)
            going &= flat[np.maximum(own - j, 0)] == flat[np.maximum(at - j, 0)]
            left += going
        going[:] = True
        for j in range(piece, window):
            going &= own + j < end
            going &= flat[np.minimum(own + j, len(flat) - 1)] == flat[np.minimum(at + j, len(flat) - 1)]
            right += going
        whole = left + right >= window
        np.add.at(change, (at - left)[whole], 1)
        np.add.at(change, (at + right)[whole], -1)
        pending.clear()

    for low, end in zip(t.starts.tolist(), t.ends.tolist()):
        if end - low < window:
            continue
        for last, k in automaton.iter(tuple(flat[low:end].tolist())):
            at = low + last - piece + 1
            pending.extend((*p, at) for p in places[k])
            if len(pending) >= _PLACES:
                extend()
    if pending:
        extend()
    return np.cumsum(change[:-1]) > 0


def keep_unique(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id, n_words, n_removed, text``: each document without the words of recurring windows, joined by one space."""
    blocks = document_blocks(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            t = tokenize(_unpack(b))
            gone = covered_words(t, b.column("starts").flatten().to_numpy(), window)
            ids, n, removed, kept, size = b.column("ids").flatten(), [], [], [], 0
            for k, (low, end) in enumerate(zip(t.starts.tolist(), t.ends.tolist()), 1):
                own = t.ids[low:end][~gone[low:end]]
                kept.append(b" ".join(map(t.words.__getitem__, own.tolist())))
                n.append(end - low)
                removed.append(end - low - len(own))
                size += len(kept[-1])
                if size >= BLOCK_BYTES or k == len(ids):
                    yield pa.RecordBatch.from_arrays(
                        [ids[k - len(kept):k], pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                         pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "text"])
                    n, removed, kept, size = [], [], [], 0

    return blocks.join(recurring_windows(blocks, window, anchor), "block", "left").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, text string")
