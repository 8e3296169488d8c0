"""Benchmark decontamination by pigeonhole edit matching.

A test item of ``n`` words has an error budget of ``k = floor((1 - similarity) * n)``
word edits and is split into ``k + 1`` pieces.  A passage within the budget holds one
piece unchanged, so exact piece hits find every candidate; around each hit Myers'
bit-parallel algorithm (one bit per word of the item) gives the edit distance between
the item and the best passage of the document.

Words are runs of letters, digits, marks and connectors in lower case, in composed form
(NFC): punctuation, symbols, line breaks and decomposed letters do not hide a passage.

The test items are a fixed query set.  Their distinct texts are broadcast in blocks of
about ``block_bytes`` at most, so what is sent at once does not grow with the benchmark;
each block is held against all documents.  Documents are never shuffled.  Items that share
a text are one entry; their ids are joined to its matches.

More than ``max_passes`` blocks would read the documents as many times.  Beyond that, one
pass finds the places of all pieces (a bit map of fixed size lets only stretches through
that are pieces or share a hash with one), and the pieces hit are joined to their items by
hash; only the stretches of documents with a hit leave their task.  The matches are the same.

Defined cases: null or wordless texts match nothing; items of fewer than five words
have no error budget and match whole only; repeated items and repeated documents each
match on their own; null ids are carried; an empty table gives an empty result; other
columns are ignored; long texts are read whole, in pieces of one Arrow batch.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewer_insights.llm.common import keep_rows, map_batches, slices, stage_table, texts
from viewer_insights.operators.sizing import hot_keys

SIMILARITY = 0.8
BLOCK_BYTES = 8 << 20
#: Blocks of items that are held against the documents one by one; more items are joined by their pieces.
MAX_PASSES = 4
#: The bit map of piece hashes has 2 ** 26 bits (8 MB) whatever the number of pieces.
MAP_SHIFT = 38
#: A hot key is dealt over SALTS * SALTS tasks.
SALTS = 8
_BREAKS = regex.compile(r"[^\w\s]+")  # \w of this module holds marks, that of re does not
#: ASCII punctuation becomes a space, capitals become small letters.
_ASCII = bytes.maketrans(b"!\"#$%&'()*+,-./:;<=>?@[\\]^`{|}~ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                         b" " * 31 + b"abcdefghijklmnopqrstuvwxyz")


def words_of(text: str) -> list[bytes]:
    """Lower-case words without punctuation and symbols."""
    if not text.isascii():
        text = _BREAKS.sub(" ", unicodedata.normalize("NFC", text.lower()))
        return " ".join(text.split()).encode("utf-8", "replace").split()
    return text.encode().translate(_ASCII).split()


def budget(n_words: int, similarity: float = SIMILARITY) -> int:
    return int((1 - similarity) * n_words + 1e-9) if n_words >= 5 else 0


def pieces_of(words: list, k: int) -> list[tuple[int, tuple]]:
    """``k + 1`` pieces of nearly equal length: (offset, words)."""
    cuts = [len(words) * i // (k + 1) for i in range(k + 2)]
    return [(a, tuple(words[a:b])) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: list[int], passage: list[int]) -> tuple[int, int]:
    """Least edit distance between ``pattern`` and any stretch of ``passage``, and where
    the first such stretch ends (Myers 1999: the pattern's rows are bits of one integer)."""
    n = len(pattern)
    where: dict[int, int] = {}
    for i, w in enumerate(pattern):
        where[w] = where.get(w, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score = full, 0, n
    best, end = n, 0
    for j, w in enumerate(passage, 1):
        eq = where.get(w, 0)
        zero = (((eq & up) + up) ^ up) | eq | down
        right, left = down | (full & ~(zero | up)), up & zero
        score += 1 if right & top else -1 if left & top else 0
        right, left = right << 1 & full, left << 1 & full
        up, down = left | (full & ~(zero | right)), right & zero
        if score < best:
            best, end = score, j
    return best, end


class Matcher:
    """Exact piece index of a block of items ``(item_id, text)``, and the search with it."""

    def __init__(self, items: list[tuple[int | str | None, str]], similarity: float = SIMILARITY):
        self.vocabulary: dict[bytes, int] = {}
        self.items: list[tuple[int | str | None, list[int], int]] = []
        by_size: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            if not ids:
                continue
            k = budget(len(ids), similarity)
            for offset, piece in pieces_of(ids, k):
                code = int(self.codes(np.array(piece, np.uint64), len(piece))[0])
                by_size.setdefault(len(piece), {}).setdefault(code, []).append((len(self.items), offset))
            self.items.append((item_id, ids, k))
        self.by_size = {size: (np.array(sorted(p), np.uint64), p) for size, p in by_size.items()}
        self.masks = {}
        for size, (codes, _) in self.by_size.items():  # a bitmap turns most windows away
            mask = np.zeros(1 << 22, bool)
            mask[(codes >> np.uint64(42)).astype(np.int64)] = True
            self.masks[size] = mask

    @staticmethod
    def codes(ids: np.ndarray, size: int) -> np.ndarray:
        """Hash of every window of ``size`` word numbers (verified later, so collisions do no harm)."""
        n = len(ids) - size + 1
        out = np.zeros(max(n, 0), np.uint64)
        for j in range(size if n > 0 else 0):
            out = (out ^ ids[j:j + n]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out * np.uint64(0xBF58476D1CE4E5B9)

    def search(self, docs: list[str], chars: int = 4 << 20) -> list[tuple[int, int | str | None, int, int, int]]:
        """Matches in a batch: (document's place, item_id, edits, item's words, end word); the
        best passage for each item of a document.  About ``chars`` characters are held at once."""
        out, first, held = [], 0, 0
        for i, t in enumerate(docs):
            held += len(t)
            if held >= chars or i == len(docs) - 1:
                out += [(first + m[0], *m[1:]) for m in self._search(docs[first:i + 1])]
                first, held = i + 1, 0
        return out

    def _search(self, docs: list[str]) -> list[tuple[int, int | str | None, int, int, int]]:
        get = self.vocabulary.get
        parts = [np.fromiter(map(get, w, repeat(0)), np.uint64, len(w)) for w in map(words_of, docs)]
        lengths = np.array([len(p) for p in parts], np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths + 1)])  # a word number 0 parts the documents
        flat = np.zeros(int(starts[-1]), np.uint64)
        for s, p in zip(starts, parts):
            flat[s:s + len(p)] = p
        near: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for size, (sorted_codes, places) in self.by_size.items():
            codes = self.codes(flat, size)
            at = np.nonzero(self.masks[size][(codes >> np.uint64(42)).astype(np.int64)])[0]
            at = at[np.isin(codes[at], sorted_codes)]
            for pos, doc in zip(at.tolist(), (np.searchsorted(starts, at, "right") - 1).tolist()):
                for item, offset in places[int(codes[pos])]:
                    k, begin = self.items[item][2], pos - int(starts[doc]) - offset
                    near.setdefault((doc, item), []).append((begin - k, begin + len(self.items[item][1]) + k))
        out = []
        for (doc, item), windows in sorted(near.items()):
            item_id, ids, k = self.items[item]
            best: tuple[int, int] | None = None
            for a, b in _merged(windows, len(parts[doc])):
                edits, end = myers(ids, parts[doc][a:b].tolist())
                if edits <= k and (best is None or edits < best[0]):
                    best = edits, a + end
            if best is not None:
                out.append((doc, item_id, best[0], len(ids), best[1]))
        return out


def _merged(windows: list[tuple[int, int]], length: int) -> Iterator[tuple[int, int]]:
    """Overlapping windows joined and clipped to the document."""
    at = None
    for a, b in sorted(windows):
        a, b = max(a, 0), min(b, length)
        if at is not None and a <= at[1]:
            at = (at[0], max(at[1], b))
        else:
            if at is not None:
                yield at
            at = (a, b)
    if at is not None:
        yield at


def item_texts(benchmark: DataFrame) -> DataFrame:
    """``item_id, t, entry``: the items that have a text; ``entry`` is the digest of the text."""
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string").alias("t")).where("t is not null")
    return rows.withColumn("entry", F.sha2("t", 256))


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str, str]]]:
    """The distinct test texts as ``(entry, text)``, in blocks of about ``block_bytes`` of text at most; none is empty."""
    rows = item_texts(benchmark).select("entry", "t").distinct()
    n = block_count(benchmark, block_bytes)
    for k in range(n):
        block = rows.where(F.pmod(F.xxhash64("entry"), F.lit(n)) == k) if n > 1 else rows
        items = sorted((r["entry"], r["t"]) for r in block.collect())
        if items:
            yield items


def block_count(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    """Into how many blocks the distinct test texts are dealt."""
    rows = item_texts(benchmark).select("entry", "t").distinct()
    total = rows.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    return -(-2 * total // block_bytes) if total > block_bytes else 1


def _ship(docs: DataFrame, matcher: Matcher):
    """Broadcast a matcher as plain data: broadcast values go by name, and workers need not have this package."""
    return docs.sparkSession.sparkContext.broadcast(vars(matcher))


def _matcher(fields: dict) -> Matcher:
    out = Matcher.__new__(Matcher)
    vars(out).update(fields)
    return out


def word_codes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def piece_codes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every stretch of ``size`` words, the size included."""
    return Matcher.codes(hashes, size) + np.uint64(size)


def piece_index(entries: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``code, size, entry, at, n, k``: every piece of every entry ``(entry, t)``; ``at`` is its first word, ``n`` the
    entry's words and ``k`` its budget."""

    def batch(b: pa.RecordBatch) -> dict:
        out: dict[str, list] = {c: [] for c in ("code", "size", "entry", "at", "n", "k")}
        for entry, t in zip(b.column(0).to_pylist(), texts(b.column(1))):
            words = words_of(t)
            if not words:
                continue
            hashes, k = word_codes(words), budget(len(words), similarity)
            for at, piece in pieces_of(words, k):
                size = len(piece)
                code = int(piece_codes(hashes[at:at + size], size).view(np.int64)[0])
                for c, v in zip(out, (code, size, entry, at, len(words), k)):
                    out[c].append(v)
        types = (pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32())
        return {c: pa.array(v, t) for (c, v), t in zip(out.items(), types)}

    return map_batches(entries.select("entry", "t"), batch, "code long, size int, entry string, at int, n int, k int")


def piece_map(index: DataFrame) -> np.ndarray:
    """The bit map of all piece hashes: at most 2 ** 20 words of 64 bits come to the driver."""
    place = index.selectExpr(f"shiftrightunsigned(code, {MAP_SHIFT}) AS h")
    words = (place.groupBy(F.expr("h div 64").alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(h % 64 as int)))").alias("bits")).toArrow())
    out = np.zeros(1 << (64 - MAP_SHIFT - 6), np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def hit_stretches(docs: DataFrame, index: DataFrame) -> tuple[DataFrame, int]:
    """``key, chunk, words, codes, places`` and the step of the chunks.  A chunk holds two steps of words, from
    ``chunk * step``; the step is as long as the longest passage with its margins, so a passage lies whole in the
    chunk in which it begins.  Chunks without a hit are left out; ``key`` is the text's digest."""
    shape = index.agg(F.max(F.expr("n + 2 * k")).alias("longest"), F.collect_set("size").alias("sizes")).first()
    sizes, step = sorted(shape["sizes"]), max(shape["longest"] or 0, 256)  # a handful of sizes: a piece has a few words
    held = docs.sparkSession.sparkContext.broadcast(piece_map(index))

    def hits(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        hashes, codes, places = word_codes(words), [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for size in sizes:
            c = piece_codes(hashes, size)
            bit = c >> np.uint64(MAP_SHIFT)
            at = np.nonzero(held.value[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1))[0]
            codes.append(c[at]), places.append(at)
        return np.concatenate(codes).view(np.int64), np.concatenate(places)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, chars = [], 0

        def flush() -> pa.RecordBatch:
            cols = list(zip(*rows)) or [[]] * 5
            types = (pa.string(), pa.int32(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                              ["key", "chunk", "words", "codes", "places"])

        for b in slices(batches):
            for i in range(b.num_rows):  # one text is a Python object at a time
                words = words_of(b.column(1)[i].as_py())
                codes, places = hits(words)
                inside = places // step
                for c in sorted({*inside.tolist(), *(inside - 1).tolist()} - {-1}):
                    part = b" ".join(words[c * step:(c + 2) * step]).decode()
                    rows.append((b.column(0)[i].as_py(), c, part, codes[inside == c].tolist(), places[inside == c].tolist()))
                    chars += len(part)
                    if chars > 1 << 20:
                        yield flush()
                        rows, chars = [], 0
            yield flush()
            rows, chars = [], 0

    of_text = docs.where("text is not null").select(F.sha2("text", 256).alias("key"), "text")
    return stage_table(of_text.mapInArrow(scan, "key string, chunk int, words string, codes array<long>, places array<int>"),
                       "decontamination-stretches"), step


def _dealt_join(left: DataFrame, right: DataFrame, on: str, counted: DataFrame, left_row: str, right_row: str) -> DataFrame:
    """Inner join on the column ``on``.  Keys that are hot in ``counted`` are dealt over a grid of tasks: a row of either
    side goes to one line of the grid by a hash of its own columns and is repeated along it.  Every pair meets once."""
    hot = F.broadcast(hot_keys(counted.select(on), on))  # at most 1,000 names

    def dealt(df: DataFrame, row: str, own: str, other: str) -> DataFrame:
        every = f"explode(sequence(0, CASE WHEN _hot_key IS NULL THEN 0 ELSE {SALTS - 1} END))"
        return (df.join(hot, F.col(on) == F.col("_hot_key"), "left")
                .withColumn(own, F.expr(f"CASE WHEN _hot_key IS NULL THEN 0 ELSE cast(pmod(xxhash64({row}), {SALTS}) AS int) END"))
                .withColumn(other, F.expr(every)).drop("_hot_key"))

    return dealt(left, left_row, "_l", "_r").join(dealt(right, right_row, "_r", "_l"), [on, "_l", "_r"]).drop("_l", "_r")


def matches_by_pieces(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """Matches per distinct text, ``key, entry, edits, item_words, end_word``, and the stretches with a hit, whose ``key``
    (digest of the text) occurs about as often as the text does."""
    entries = stage_table(item_texts(benchmark).select("entry", "t").distinct(), "decontamination-entries")
    index = stage_table(piece_index(entries, similarity), "decontamination-pieces")
    found, step = hit_stretches(docs, index)
    hits = found.selectExpr("key", "inline(arrays_zip(codes, places))").selectExpr("key", "codes AS code", "places AS place").distinct()
    placed = _dealt_join(hits, index, "code", hits.select("code").union(index.select("code")), "key, place", "entry, at")
    windows = stage_table(
        placed.selectExpr("key", "entry", "n", "k", "place - at - k AS a", "place - at + n + k AS b")
        .selectExpr("key", "entry", "n", "k", "greatest(a, 0) AS a", "b").distinct()
        .withColumn("chunk", F.expr(f"cast(a div {step} as int)")).withColumn("stretch", F.expr("concat(key, '-', chunk)")),
        "decontamination-windows")
    stretches = found.groupBy("key", "chunk").agg(F.first("words").alias("words")).selectExpr(
        "concat(key, '-', chunk) AS stretch", "words")
    with_item = _dealt_join(windows, entries, "entry", windows, "key, a", "entry")
    with_text = _dealt_join(with_item, stretches, "stretch", windows, "entry, a", "stretch")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = []
            for i in range(b.num_rows):  # an item and a passage are Python objects at a time
                key, entry, n, k, a, passage, item = (c[i].as_py() for c in b.columns)
                edits, at = myers(words_of(item), passage.encode().split(b" "))
                if edits <= k:
                    out.append((key, entry, edits, n, a + at))
            cols = list(zip(*out)) or [[]] * 5
            types = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             ["key", "entry", "edits", "item_words", "end_word"])

    # cut before the rows leave the JVM: one long item makes all stretches long, not all passages
    passage = F.expr(f"array_join(slice(split(words, ' '), cast(a - chunk * {step} AS int) + 1, cast(b - a AS int)), ' ')")
    passages = with_text.select("key", "entry", "n", "k", "a", passage.alias("passage"), "t").mapInArrow(
        verify, "key string, entry string, edits int, item_words int, end_word long")
    best = passages.groupBy("key", "entry").agg(F.min(F.struct("edits", "end_word")).alias("m"), F.min("item_words").alias("item_words"))
    return stage_table(best.select("key", "entry", "m.edits", "item_words", "m.end_word"), "decontamination-matches"), found


def find_matches(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY,
                 block_bytes: int = BLOCK_BYTES, max_passes: int = MAX_PASSES) -> DataFrame:
    """Pairs within the budget: ``doc_id, item_id, edits, item_words, end_word``."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ids = item_texts(benchmark).select("item_id", F.col("entry").alias("_entry"))
    if block_count(benchmark, block_bytes) > max_passes:
        found, seen = matches_by_pieces(rows, benchmark, similarity)
        out = _dealt_join(rows.select("doc_id", F.sha2("text", 256).alias("key")), found, "key", seen, "doc_id", "entry")
        return out.join(ids, F.col("entry") == F.col("_entry")).select("doc_id", "item_id", "edits", "item_words", "end_word")
    schema = "doc_id long, entry string, edits int, item_words int, end_word long"
    out = docs.sparkSession.createDataFrame([], schema)
    for items in item_blocks(benchmark, block_bytes):
        held = _ship(docs, Matcher(items, similarity))

        def batch(b: pa.RecordBatch, held=held) -> dict:
            got = _matcher(held.value).search(texts(b.column(1)))
            cols = list(zip(*got)) or [[]] * 5
            return {"doc_id": b.column(0).take(pa.array(cols[0], pa.int64())), "entry": pa.array(cols[1], pa.string()),
                    "edits": pa.array(cols[2], pa.int32()), "item_words": pa.array(cols[3], pa.int32()),
                    "end_word": pa.array(cols[4], pa.int64())}

        out = out.union(map_batches(rows, batch, schema))
    return out.join(ids, F.col("entry") == F.col("_entry")).select("doc_id", "item_id", "edits", "item_words", "end_word")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY,
                      block_bytes: int = BLOCK_BYTES, max_passes: int = MAX_PASSES) -> DataFrame:
    """The rows of ``docs`` (all columns) that hold no test item within its budget."""
    if block_count(benchmark, block_bytes) > max_passes:
        found, _ = matches_by_pieces(docs.select(F.col("text").cast("string")), benchmark, similarity)
        return docs.join(found.select(F.col("key").alias("_text_key")).distinct(),
                         F.sha2(docs["text"].cast("string"), 256) == F.col("_text_key"), "left_anti")
    for items in item_blocks(benchmark, block_bytes):
        held = _ship(docs, Matcher(items, similarity))

        def clean(ts: list[str], held=held) -> list[bool]:
            hit = {m[0] for m in _matcher(held.value).search(ts)}
            return [i not in hit for i in range(len(ts))]

        docs = keep_rows(docs, "text", clean)
    return docs
