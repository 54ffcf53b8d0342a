"""Near copies by the shingles they share: fingerprints and MinHash bands give candidates, an exact count decides.

A text is the set of its runs of SHINGLE words (ASCII lower case, white space between them), or of
all its words if these are fewer.  Two texts link if their sets have a Jaccard similarity of four
fifths or more; components of links are one class.  Texts with equal sets are one class from the
start, whatever their number; null text is empty, and all texts without words are one class.

Every other set has a SimHash of its shingles, and sets whose fingerprints the index of ``simhash``
links are candidates first.  At 0.8 fingerprints differ in about ten of 64 bits, and no cut of the bits is
left unchanged by so many, so BANDS x ROWS minima are taken too: two sets are also candidates if all
minima of some band agree.  That is the one step left to chance: a pair with similarity j is missed
by all bands with probability (1 - j^ROWS)^BANDS, 0.04% at 0.8 and less above.

A bucket's members are first compared with its smallest one.  Buckets that are then still in several
components are compared within one task each, by counts of common shingles, and return the edges that
join components, not pairs.  Members of a large bucket are dealt in blocks of ``BLOCK`` shingles, and
every two blocks meet in a task of their own, so no bucket is too large and no pair of it left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellarium.llm.common import batches, mix
from cellarium.llm.graph import Union, components
from cellarium.plans.scratch import settle
from cellarium.plans.skew import attach, running

SEED = 42
SHINGLE = 5
BANDS = 20
ROWS = 5
BLOCK = 150_000  # shingles of the members that one side of a task holds
EACH = 150  # what a member counts besides its shingles; so a side has 1,000 at most
COLUMNS = 8192  # shingles that are counted at a time

_draw = np.random.default_rng(SEED)
_FLIP = _draw.integers(0, 2**64, BANDS * ROWS, dtype=np.uint64)
_TIMES = _draw.integers(0, 2**64, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """Hashes of the distinct shingles of a text, sorted."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    known = {w: xxhash.xxh64_intdigest(w, SEED) for w in set(words)}
    hashes = np.array([known[w] for w in words], np.uint64)
    size = min(SHINGLE, len(words))
    n = len(words) - size + 1
    runs = np.full(n, size, np.uint64)
    for k in range(size):
        runs = mix(runs ^ hashes[k : k + n], k + 1)
    return np.unique(runs)


def bands(own: np.ndarray) -> np.ndarray:
    least = np.array([((own ^ flip) * times).min() for flip, times in zip(_FLIP, _TIMES, strict=True)])
    least = least.reshape(BANDS, ROWS)
    keys = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        keys = mix(keys ^ least[:, k], k + 1)
    return keys


def simhash_of(own: np.ndarray) -> int:
    """Fingerprint of a set: a bit is 1 if set in over half of its shingles."""
    bits = np.unpackbits(own.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    more = 2 * bits.sum(axis=0, dtype=np.int64) > len(own)
    return int.from_bytes(np.packbits(more).tobytes(), "big", signed=True)


def _sketches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch in batches(rows, 1024):
        own = [shingles(x.as_py()) for x in batch.column(1)]
        columns = [
            batch.column(0),
            pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in own], pa.binary()),
            pa.array([len(s) for s in own], pa.int64()),
            pa.array([simhash_of(s) for s in own], pa.int64()),
            pa.array([bands(s).view(np.int64) if len(s) else [] for s in own], pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["place", "same", "n", "fp", "bands"])


def _sets(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(rows, 256):
        own = [shingles(x.as_py()).view(np.int64) for x in batch.column(1)]
        columns = [batch.column(0), pa.array(own, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["place", "own"])


def _fits(n: Column, m: Column) -> Column:
    """Sets of these sizes can be similar enough."""
    return 5 * F.least(n, m) >= 4 * F.greatest(n, m)


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets have four fifths of all their shingles in common."""
    left = sets.select(F.col("place").alias("a"), F.col("own").alias("ours"))
    right = sets.select(F.col("place").alias("b"), F.col("own").alias("theirs"))
    met = pairs.join(right, "b").join(left, "a")
    both = F.size(F.array_intersect("ours", "theirs"))
    every = F.size("ours") + F.size("theirs")
    return met.where(9 * both >= 4 * every).select("a", "b")


def _rooted(rows: DataFrame, edges: list[DataFrame]) -> DataFrame:
    """Adds ``root``, the smallest place of the component, to rows with a ``place``."""
    roots = components(reduce(DataFrame.unionByName, edges))
    rooted = attach(rows, settle(roots.withColumnRenamed("node", "place"), "roots"), ["place"], "left")
    return rooted.withColumn("root", F.coalesce("root", "place"))


def _by_prints(each: DataFrame, near: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Pairs (a, b) of sets that have one fingerprint, or the first ones of two that are linked."""
    prints = each.where("n > 0").select("fp", F.struct("place", "n").alias("set"))
    first = settle(prints.groupBy("fp").agg(F.min("set").alias("first")), "prints")
    equal = prints.join(first, "fp").where("set.place <> first.place")
    equal = equal.select(F.col("first").alias("x"), F.col("set").alias("y"))
    found = near(first.select("fp"))
    for end in ("a", "b"):
        found = found.join(first.select(F.col("fp").alias(end), F.col("first").alias(f"of_{end}")), end)
    linked = found.select(F.least("of_a", "of_b").alias("x"), F.greatest("of_a", "of_b").alias("y"))
    fits = equal.unionByName(linked).where(_fits(F.col("x.n"), F.col("y.n")))
    return settle(fits.select(F.col("x.place").alias("a"), F.col("y.place").alias("b")).distinct(), "near")


def links(
    each: DataFrame, texts: DataFrame, near: Callable[[DataFrame], DataFrame] | None = None
) -> list[DataFrame]:
    """Edges (a, b) that connect the linked ones of distinct sets (place, n, fp, bands).

    ``near`` gives the edges (a, b) of distinct fingerprints ``fp`` that are candidates.
    """
    keyed = each.select("place", "n", F.explode("bands").alias("bucket"))
    met = keyed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("members"), F.min(F.struct("place", "n")).alias("first")
    )
    met = settle(met.where(F.col("members") > 1), "buckets")
    shared = settle(attach(keyed, met, ["bucket"], "inner"), "shared")
    asked = shared.select("place")
    by_prints = None if near is None else _by_prints(each, near)
    if by_prints is not None:
        asked = asked.union(by_prints.select("a")).union(by_prints.select("b"))
    asked = settle(asked.distinct(), "asked")
    sets = settle(
        attach(texts, asked, ["place"], "left_semi")
        .select("place", "text")
        .mapInArrow(_sets, "place bigint, own array<bigint>"),
        "sets",
    )
    others = shared.where((F.col("place") != F.col("first.place")) & _fits(F.col("n"), F.col("first.n")))
    star = others.select(F.col("first.place").alias("a"), F.col("place").alias("b"))
    star = (star if by_prints is None else by_prints.unionByName(star)).distinct()
    edges = [settle(_linked(settle(star, "pairs"), sets), "edges")]
    rows = shared.where(F.col("members") > 2).select("bucket", "place", "n", "members")
    rooted = settle(_rooted(rows, edges), "rooted")
    ends = rooted.groupBy("bucket").agg(
        F.min("root").alias("_low"), F.max("root").alias("_high"), F.sum(F.col("n") + EACH).alias("_all")
    )
    apart = settle(ends.where(F.col("_low") != F.col("_high")).select("bucket", "_all"), "apart")
    rooted = attach(rooted.select("bucket", "place", "n", "root"), apart, ["bucket"], "inner")
    return [*edges, settle(_met(rooted, sets), "edges")]


def _met(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """Edges between components of the buckets of rows (bucket, place, n, root, and _all their weight)."""
    last = F.floor((F.col("_all") - 1) / BLOCK)
    placed = running(rows, ["bucket"], [F.col("place")], {"_before": ("sum", F.col("n") + EACH, False)})
    block = F.floor(F.col("_before") / BLOCK)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), last))
    placed = placed.select("bucket", "place", "root", block.alias("block"), other.alias("other"))
    low, high = F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    dealt = placed.select(F.xxhash64("bucket", low, high).alias("task"), "place", "root", "block").join(sets, "place")
    dealt = dealt.select("task", "block", "place", "root", "own")
    dealt = dealt.repartition("task").sortWithinPartitions("task", "block", "place")
    return dealt.mapInArrow(_join_components, "a bigint, b bigint").distinct()


def _join_components(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of one task after the other; rows come sorted by task and block."""
    held = None
    for batch in rows:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        tasks = held.column(0).to_numpy()
        cut = int((tasks == tasks[-1]).argmax())  # the last task may go on
        if cut:
            yield _edges(held.slice(0, cut))
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield _edges(held)


def _edges(table: pa.Table) -> pa.RecordBatch:
    table = table.combine_chunks()
    tasks, blocks, places, roots = (table.column(k).to_numpy() for k in range(4))
    lists = table.column(4).combine_chunks()
    sizes = np.asarray(lists.value_lengths())
    shingle = lists.flatten().to_numpy()
    ends = np.cumsum(sizes)
    starts = np.flatnonzero(np.r_[True, tasks[1:] != tasks[:-1]])
    found = [np.zeros((0, 2), np.int64)]
    for start, stop in zip(starts, [*starts[1:], len(tasks)], strict=True):
        if (roots[start:stop] == roots[start]).all():
            continue
        inside = slice(ends[start] - sizes[start], ends[stop - 1])
        cut = int((blocks[start:stop] != blocks[start]).argmax())  # 0: one block with itself
        i, j = linked_pairs(shingle[inside], sizes[start:stop], cut, roots[start:stop])
        names, at = np.unique(roots[start:stop], return_inverse=True)
        union = Union(len(names))
        union.link(at[i], at[j])
        moved = np.flatnonzero(union.root != np.arange(len(names)))
        found.append(np.stack([names[union.root[moved]], names[moved]], axis=1))
    pairs = np.concatenate(found)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def linked_pairs(
    shingle: np.ndarray, sizes: np.ndarray, cut: int, roots: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of linked sets of different components, one after the other in ``shingle``.

    With ``cut`` the sets before it meet those from it on; with 0 all meet.
    """
    _, column, times = np.unique(shingle, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    common = np.flatnonzero(times[column] > 1)  # shingles of one set only join nothing
    column, owner = column[common], owner[common]
    order = np.argsort(column, kind="stable")
    column, owner = np.unique(column[order], return_inverse=True)[1], owner[order]
    first = cut or len(sizes)
    both = np.zeros((first, len(sizes) - (cut or 0)), np.float32)
    for at in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
        low, high = np.searchsorted(column, [at, at + COLUMNS])
        has = np.zeros((len(sizes), COLUMNS), np.float32)
        has[owner[low:high], column[low:high] - at] = 1
        both += has[:first] @ has[cut:].T
    every = sizes[:first, None] + sizes[None, cut:]
    i, j = np.nonzero((9 * both >= 4 * every) & (roots[:first, None] != roots[None, cut:]))
    return i, j + cut


def classes(docs: DataFrame, near: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """place and component_id (the smallest place of the class) of rows with a ``place`` and ``text``.

    Places are distinct numbers, the same whenever ``docs`` is read.  ``near`` is as in ``links``.
    """
    kind = "place bigint, same binary, n bigint, fp bigint, bands array<bigint>"
    sketches = settle(docs.select("place", "text").mapInArrow(_sketches, kind), "sketches")
    each = sketches.groupBy("same").agg(F.min(F.struct("place", "n", "fp", "bands")).alias("e"))
    each = settle(each.select("same", "e.*"), "classes")
    found = _rooted(each.select("same", "place"), links(each, docs, near))
    named = settle(found.select("same", F.col("root").alias("component_id")), "components")
    return attach(sketches.select("place", "same"), named, ["same"], "inner").drop("same")
