"""Near copies by SimHash, joined through a hierarchical index in Gray order.

Fingerprints that differ in at most two of 64 bits agree in at least two of four 16-bit quarters,
so six tables keyed by a pair of quarters bring every link into one block of some table.  A block's
fingerprints are sorted by Gray rank, where neighbours differ in few bits, and grouped.
Each group keeps the bits all its members share; groups of groups keep those all of them share.
Two groups whose shared bits differ in more than two places hold no link and are dropped together;
the others are opened.  Groups that are already in one component are not opened either.

A block returns one edge per linked fingerprint (to the smallest one it is connected with), not
all pairs.  Blocks over ``HOT_BLOCK`` fingerprints are cut again by the thirds of their other 32
bits, one of which linked fingerprints share; at most 2**22 fingerprints can then meet.

Equal fingerprints are one class from the start, whatever their number.  Null text is empty;
texts without words have fingerprint zero, and link like any other.  Null ids are ignored where
the smallest id of a component is asked, unless all are null.  Repeated rows share a class.

The pipeline's ``keep_one`` links fingerprints of five-word shingles by the same index and checks each link by the
shingles in common; two bits miss most near copies, so ``near_copies`` adds candidates by MinHash bands.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellarium.llm import near_copies
from cellarium.llm.common import batches
from cellarium.llm.graph import Union, components
from cellarium.plans.scratch import settle
from cellarium.plans.skew import attach

SEED = 42
SHINGLE = 3
MOST_BITS = 2
HOT_BLOCK = 20_000
LEAF = 16
FAN = 8
OPENED = 4096  # group pairs that are opened at a time

QUARTERS = [(a, b) for a in range(4) for b in range(a + 1, 4)]


def fingerprint(text: str | None) -> int:
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    ends = [words[k:] for k in range(SHINGLE)]
    shingles = map(b" ".join, zip(*ends, strict=False)) if len(words) >= SHINGLE else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype=">u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
    more = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int.from_bytes(np.packbits(more).tobytes(), "big")


def _fingerprints(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows, 1024):
        prints = np.array([fingerprint(x.as_py()) for x in batch.column(1)], dtype=np.uint64)
        column = pa.array(prints.view(np.int64), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), column], names=["_id", "fp"])


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Place of each 64-bit value in the reflected binary Gray sequence."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= MOST_BITS


def link_block(prints: np.ndarray) -> np.ndarray:
    """Component (a place) of each of one block's fingerprints, sorted by Gray rank."""
    found = Union(len(prints))
    follow = np.flatnonzero(_near(prints[:-1], prints[1:]))
    found.link(follow, follow + 1)
    levels = _index(prints)
    top = len(levels) - 1
    n = len(levels[top][0])
    a, b = np.triu_indices(n)
    todo = [(top, a, b)]
    while todo:
        level, a, b = todo.pop()
        if len(a) > OPENED:
            todo.append((level, a[OPENED:], b[OPENED:]))
            a, b = a[:OPENED], b[:OPENED]
        shared, pattern, starts = levels[level]
        apart = np.bitwise_count((pattern[a] ^ pattern[b]) & shared[a] & shared[b])
        low = np.minimum.reduceat(found.root, starts)
        high = np.maximum.reduceat(found.root, starts)
        one = (low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b])
        keep = (apart <= MOST_BITS) & ~one
        a, b = a[keep], b[keep]
        if not len(a):
            continue
        if level:
            todo.append((level - 1, *_open(a, b, FAN, len(levels[level - 1][0]))))
        else:
            i, j = _open(a, b, LEAF, len(prints))
            hit = _near(prints[i], prints[j])
            found.link(i[hit], j[hit])
    return found.root


def _open(a: np.ndarray, b: np.ndarray, fan: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of the members of paired groups, each pair once."""
    step = np.arange(fan)
    i = np.repeat(a[:, None] * fan + step, fan, axis=1).ravel()
    j = np.tile(b[:, None] * fan + step, (1, fan)).ravel()
    real = (i <= j) & (j < n) & (i < n)
    return i[real], j[real]


def _index(prints: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per level, from the leaves up: shared bits, their pattern, first place of each group."""
    starts = np.arange(0, len(prints), LEAF)
    every = np.bitwise_and.reduceat(prints, starts)
    some = np.bitwise_or.reduceat(prints, starts)
    levels = [(~(every ^ some), every, starts)]
    while len(starts) > FAN:
        groups = np.arange(0, len(starts), FAN)
        every = np.bitwise_and.reduceat(every, groups)
        some = np.bitwise_or.reduceat(some, groups)
        starts = starts[groups]
        levels.append((~(every ^ some), every, starts))
    return levels


def _block_edges(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of the blocks of one partition; rows come sorted by block."""

    def edges(prints: np.ndarray, blocks: np.ndarray) -> pa.RecordBatch | None:
        starts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]])
        sizes = np.diff(np.r_[starts, len(prints)])
        a, b = [], []
        pairs = starts[sizes == 2]
        hit = pairs[_near(prints[pairs], prints[pairs + 1])]
        a.append(prints[hit])
        b.append(prints[hit + 1])
        for start, size in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
            block = prints[start : start + size]
            block = block[np.argsort(gray_rank(block))]
            root = link_block(block)
            moved = np.flatnonzero(root != np.arange(size))
            a.append(block[moved])
            b.append(block[root[moved]])
        a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    prints, blocks = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for batch in rows:
        blocks = np.concatenate([blocks, batch.column(0).to_numpy(zero_copy_only=False)])
        new = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        prints = np.concatenate([prints, new])
        if len(blocks):
            cut = int((blocks == blocks[-1]).argmax())  # the last block may go on
            if cut:
                yield edges(prints[:cut], blocks[:cut])
                prints, blocks = prints[cut:], blocks[cut:]
    if len(blocks):
        yield edges(prints, blocks)


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all of the distinct fingerprints ``fp`` that link.

    The key of a block is its 32 shared bits with the table's number above them.
    """
    quarter = [F.shiftrightunsigned("fp", 16 * k).bitwiseAND(0xFFFF) for k in range(4)]

    def key(table: int):
        a, b = QUARTERS[table]
        return F.lit(table << 32) + F.shiftleft(quarter[a], 16) + quarter[b]

    keys = F.explode(F.array(*[key(k) for k in range(len(QUARTERS))]))
    keyed = prints.select("fp", keys.alias("block"))
    sizes = keyed.groupBy("block").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    sizes = settle(sizes, "blocks")
    hot = sizes.where(F.col("n") > HOT_BLOCK).select("block")
    shared = keyed.join(sizes.where(F.col("n") <= HOT_BLOCK).select("block"), "block", "left_semi")
    if hot.limit(1).count():
        shared = shared.unionByName(_cut_again(attach(keyed, hot, ["block"], "inner")))
    sorted_rows = shared.select("block", "fp").repartition("block").sortWithinPartitions("block")
    return sorted_rows.mapInArrow(_block_edges, "a bigint, b bigint").distinct()


def _cut_again(rows: DataFrame) -> DataFrame:
    """Hot blocks by the thirds (11, 11 and 10 bits) of the bits their members don't share."""
    table = F.shiftright("block", 32)
    other = F.lit(None).cast("bigint")
    for k, (a, b) in enumerate(QUARTERS):
        c, d = (q for q in range(4) if q not in (a, b))
        bits = [F.shiftrightunsigned("fp", 16 * q).bitwiseAND(0xFFFF) for q in (c, d)]
        other = F.when(table == k, F.shiftleft(bits[0], 16) + bits[1]).otherwise(other)
    thirds = [(0, 11), (11, 11), (22, 10)]
    # Above the table's 3 bits: the third's number and its value; the rest is a hash of the block.
    keys = [
        F.xxhash64("block", F.lit(k), F.shiftright(other, at).bitwiseAND((1 << n) - 1))
        for k, (at, n) in enumerate(thirds)
    ]
    return rows.select(F.explode(F.array(*keys)).alias("block"), "fp")


def classes(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key``, fp (signed) and component_id of every document."""
    rows = docs.select(F.col(key).alias("_id"), F.col("text"))
    kind = rows.schema["_id"].dataType.simpleString()
    prints = settle(rows.mapInArrow(_fingerprints, f"_id {kind}, fp bigint"), "prints")
    each = settle(prints.groupBy("fp").agg(F.min("_id").alias("least")), "classes")
    found = components(links(each.select("fp")))
    rooted = each.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = settle(rooted.join(least, "root").select("fp", "component_id"), "components")
    return prints.join(named, "fp").select(F.col("_id").alias(key), "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each class of near copies: the one with the smallest id (null last), as it came.

    Near copies are those of ``near_copies`` (five-word shingles, similarity 0.8), found by the index of
    fingerprints and, beyond two bits, by MinHash bands.
    """
    numbered = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        F.monotonically_increasing_id().alias("place"),
    )
    # Written once, so that a document keeps its number however often it is read.
    stored = settle(numbered, "numbered")
    found = near_copies.classes(stored.select("place", F.col("_doc.text").alias("text")), links)
    ids = stored.select("place", F.col("_doc.doc_id").alias("_id"))
    ranked = ids.join(found, "place")
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "place")).alias("first")
    kept = ranked.groupBy("component_id").agg(first).select(F.col("first.place").alias("place"))
    return stored.join(kept, "place", "left_semi").select("_doc.*")
