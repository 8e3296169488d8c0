"""SimHash near-dedup by pivot distance tables.

Every distinct fingerprint gets a table of Hamming distances to many reference
fingerprints (pivots), block by block of its 64 bits.  By the triangle inequality a
pair within ``max_bits`` differs by at most ``max_bits`` in every coordinate, and,
as the bits fall into ``max_bits + 4`` disjoint blocks, agrees exactly in all
coordinates of at least four blocks.  Fingerprints are therefore joined on the
coordinates of each choice of four blocks; the pairs of a bucket are discarded by
their largest coordinate difference, and survivors are verified bit by bit.  No pair
within the limit is lost.

A bucket of more than ``max_bucket`` fingerprints is not paired off.  Its members
share about two thirds of the bits, so each is dealt to itself and to every
fingerprint one flip away inside the free blocks: two members are within two bits
exactly when they meet there, and a meeting point holds at most
``free bits + 1`` members (exact, linear).

Defined cases: a null text is the empty text; texts without words have fingerprint
zero and are linked like any other; texts of fewer words than a shingle are one
shingle; repeated rows each get their row; a null doc_id keeps its row and does not
count for component ids; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewer_insights.llm.common import connected_components, map_batches, stage_table, texts

BITS = 64
PIVOTS_PER_BLOCK = 6
MAX_BUCKET = 64


def fingerprint(text: str, size: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the lower-cased word shingles of a text (as a signed integer)."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) < size:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(size)))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, len(shingles))
    ones = np.zeros(BITS, np.int64)
    for part in np.array_split(hashes, len(hashes) // 65536 + 1):
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(shingles), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """``(doc_id, fp)`` per row of ``docs (doc_id, text)``."""

    def batch(b: pa.RecordBatch) -> dict:
        return {"doc_id": b.column(0),
                "fp": pa.array([fingerprint(t, size) for t in texts(b.column(1))], pa.int64())}

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), batch,
                       "doc_id long, fp long")


def blocks(max_bits: int) -> list[list[int]]:
    """Bit positions of the ``max_bits + 4`` disjoint blocks."""
    return [list(map(int, x)) for x in np.array_split(np.arange(BITS), max_bits + 4)]


def pivot_table(max_bits: int) -> list[tuple[int, list[int]]]:
    """Per block: its bit mask and its pivots (fixed fingerprints, drawn by hashing their number)."""
    out = []
    for b, bits in enumerate(blocks(max_bits)):
        mask = sum(1 << i for i in bits)
        out.append((mask, [xxhash.xxh64_intdigest(f"pivot {b} {j}", 0) & mask for j in range(PIVOTS_PER_BLOCK)]))
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _coordinates(block: tuple[int, list[int]]) -> str:
    """SQL: the distances of one block to its pivots, packed, seven bits each."""
    mask, pivots = block
    return " + ".join(
        f"shiftleft(cast(bit_count((fp ^ {_signed(p)}L) & {_signed(mask)}L) as bigint), {7 * j})"
        for j, p in enumerate(pivots))


def close_pairs(groups: np.ndarray, max_bits: int) -> np.ndarray:
    """Pairs within ``max_bits`` in each row of ``groups`` (buckets of equal size):
    distance tables, discard by the largest coordinate difference, verify."""
    table = pivot_table(max_bits)
    fps = groups.view(np.uint64)
    dist = np.stack([np.bitwise_count((fps ^ np.uint64(p)) & np.uint64(mask)) for mask, ps in table for p in ps],
                    axis=-1).astype(np.int8)
    i, j = np.triu_indices(groups.shape[1], 1)
    keep_rows, keep_cols = [], []
    for lo in range(0, len(i), 256):  # bounded memory for wide buckets
        a, b = i[lo:lo + 256], j[lo:lo + 256]
        near = np.ones((len(groups), len(a)), bool)
        for c in range(dist.shape[-1]):
            near &= np.abs(dist[:, a, c] - dist[:, b, c]) <= max_bits
        r, k = np.nonzero(near)
        keep_rows.append(r), keep_cols.append(k + lo)
    r, k = np.concatenate(keep_rows), np.concatenate(keep_cols)
    x, y = fps[r, i[k]], fps[r, j[k]]
    ok = np.bitwise_count(x ^ y) <= max_bits
    return np.stack([x[ok], y[ok]], axis=1).view(np.int64)


def links(distinct_fps: DataFrame, max_bits: int = 2, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``(fp)``.  Every pair within
    ``max_bits`` is linked directly or, in buckets over ``max_bucket``, through the
    fingerprints it meets; no farther pair is linked."""
    if max_bits != 2:
        raise ValueError("the exact split of large buckets is written for two bits")
    table, bits = pivot_table(max_bits), blocks(max_bits)
    combos = list(combinations(range(len(table)), len(table) - max_bits))
    sigs = distinct_fps.select("fp", *[F.expr(_coordinates(t)).alias(f"s{b}") for b, t in enumerate(table)])
    keys = F.array(*[F.xxhash64(F.lit(c), *[F.col(f"s{b}") for b in combo]) for c, combo in enumerate(combos)])
    keyed = sigs.select("fp", F.posexplode(keys).alias("combo", "key"))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumnRenamed("key", "k")
    members = stage_table(keyed.join(sizes, F.col("key") == F.col("k")).select("fp", "combo", "key", "n"), "simhash-members")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by_size: dict[int, list] = {}
            for fps in b.column(0).to_pylist():
                by_size.setdefault(len(fps), []).append(fps)
            for size, rows in by_size.items():
                step = max(1, 200_000 // size**2)
                for at in range(0, len(rows), step):
                    found = close_pairs(np.array(rows[at:at + step], np.int64), max_bits)
                    yield pa.RecordBatch.from_pydict({"a": found[:, 0].copy(), "b": found[:, 1].copy()})

    small = (members.where(F.col("n") <= max_bucket).groupBy("key").agg(F.collect_list("fp").alias("fps"))
             .select("fps").mapInArrow(pairs, "a long, b long"))
    # combos keep all blocks but two: their bits are the free ones
    free = [[i for b in range(len(bits)) if b not in combo for i in bits[b]] for combo in combos]
    flips = F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)).cast("long") for i in f]
                              + [F.lit(0).cast("long")] * (max(map(len, free)) - len(f))) for f in free])
    met = (members.where(F.col("n") > max_bucket)
           .select("fp", "key", F.explode(F.array_distinct(F.element_at(flips, F.col("combo") + 1))).alias("flip"))
           .groupBy("key", F.expr("fp ^ flip").alias("z")).agg(F.collect_set("fp").alias("fps"))
           .where("size(fps) > 1"))
    large = met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b")
    return small.union(large).distinct()


def near_duplicates(docs: DataFrame, size: int = 3, max_bits: int = 2, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint, component_id``."""
    fps = stage_table(fingerprints(docs, size), "simhash-fp")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = connected_components(links(nodes.select("fp"), max_bits, max_bucket))
    labelled = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        F.col("fp").alias("f"), "first_id", F.coalesce("root", "fp").alias("root"))
    ids = labelled.groupBy("root").agg(F.min("first_id").alias("component_id")).withColumnRenamed("root", "r")
    classes = labelled.join(ids, F.col("root") == F.col("r")).select("f", "component_id")
    return fps.join(classes, F.col("fp") == F.col("f"), "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, size: int = 3, max_bits: int = 2, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Exactly one row (all columns) of each group of near duplicates: the one with the smallest
    doc_id (nulls last), of these the first as stored.

    Rows are kept, not ids: rows that share a doc_id, or have none, are documents of their own.
    """
    # the number of a row holds once it is stored
    stored = stage_table(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")), "simhash-rows")

    def batch(b: pa.RecordBatch) -> dict:
        return {"row": b.column(0), "id": b.column(1),
                "fp": pa.array([fingerprint(t, size) for t in texts(b.column(2))], pa.int64())}

    of_text = stored.select("row", F.col("doc.doc_id").cast("long").alias("id"), F.col("doc.text").cast("string").alias("text"))
    fps = stage_table(map_batches(of_text, batch, "row long, id long, fp long"), "simhash-row-fp")
    nodes = fps.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first"))
    roots = connected_components(links(nodes.select("fp"), max_bits, max_bucket))
    keep = (nodes.join(roots, F.col("fp") == F.col("node"), "left")
            .groupBy(F.coalesce("root", "fp").alias("group")).agg(F.min("first").alias("first")).select(F.col("first.row").alias("kept")))
    return stored.join(keep, F.col("row") == F.col("kept"), "left_semi").select("doc.*")
