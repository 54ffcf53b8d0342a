"""Repeated substrings across all texts, by longest-previous-factor arrays over sampled groups.

A string of LEAST bytes that occurs twice holds, in both places, the same *seed*: of all the
GRAM-byte strings in it the one with the smallest hash (the leftmost of equal ones).  So every window
of LEAST bytes belongs to one seed of its text, a text falls into runs of windows with one seed each,
and equal windows are in runs of equal seeds.  That spreads the work over all tasks by seed hash:

1. Every run sends a hash of its seed and one of its whole stretch of text; seeds that occur
   once are done.  Runs that agree in the whole stretch are one class.
2. Where a seed has several classes, one stretch of each is fetched.  Stretches of one seed are laid
   end to end in text order and their windows put in suffix order (rank doubling).  The previous and
   next window in that order with a smaller place in the text give the longest previous factor:
   where it reaches LEAST, the window has an earlier copy.  With larger places it has a later one.
3. Windows with an earlier copy (``keep="first"``) or any other copy (``keep="none"``) are taken out
   of each text, with every byte they cover.

Seeds with more than HOT_CLASSES classes would make a large group: there the windows themselves are
hashed, summed by hash in every task before they are sent, and joined back, to the same effect.
Runs of a class with more than HOT_ROWS rows are not dealt by class: its one record goes to them.

Hashes only bring candidates together in step 2; classes and hot windows rely on two 64-bit hashes
agreeing (seed and stretch).  Texts are UTF-8 bytes and matches never cross texts.  The order of
texts is by id (null last), then by text hash.  Null text is empty; texts shorter than LEAST stay.
Repeated rows are copies of each other; with ``keep="first"`` rows equal in id and text are one text.
An empty table gives an empty one.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellarium.llm.common import batches, mix
from cellarium.plans.scratch import settle
from cellarium.plans.skew import attach, measured

LEAST = 400
GRAM = 200
SPAN = LEAST - GRAM + 1  # seeds to choose from in a window
PIECE = 1 << 20  # windows of a text that are looked at at a time
PLACE = np.uint64((1 << 24) - 1)
HOT_CLASSES = 2000
HOT_ROWS = 2000
BATCH_BYTES = 2 << 20
ORDER = ["_none", "_id", "_text", "nth"]


@functools.lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random values for bytes, and powers of an odd base and of its inverse modulo 2**64."""
    base = 0x9E3779B97F4A7C15
    size = PIECE + LEAST + 1
    up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 2**64), np.uint64)
    up[0] = down[0] = 1
    return mix(np.arange(256, dtype=np.uint64), 11), np.cumprod(up), np.cumprod(down)


def runs(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window and the seed's place, for each run of windows with one seed."""
    windows = len(raw) - LEAST + 1
    first, last, seed = [], [], []
    for at in range(0, max(windows, 0), PIECE):
        n = min(PIECE, windows - at)
        key = _window_keys(np.frombuffer(raw, np.uint8, n + LEAST - 1, at), at, n)
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        place = start + at
        place = place + ((key[start] - place.astype(np.uint64)) & PLACE).astype(np.int64)
        end = np.r_[start[1:], n] - 1
        if seed and seed[-1][-1] == place[0]:  # the last run of the piece before goes on
            last[-1][-1] = end[0] + at
            start, end, place = start[1:], end[1:], place[1:]
        if len(start):
            first.append(start + at)
            last.append(end + at)
            seed.append(place)
    if not first:
        none = np.zeros(0, np.int64)
        return none, none, none
    return np.concatenate(first), np.concatenate(last), np.concatenate(seed)


def _window_keys(raw: np.ndarray, at: int, n: int) -> np.ndarray:
    """For each window the smallest seed hash, with the seed's place in the low bits."""
    values, up, down = _powers()
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(values[raw] * up[: len(raw)], out=total[1:])
    grams = len(raw) - GRAM + 1
    key = mix((total[GRAM:] - total[:-GRAM]) * down[:grams], 5)
    key = (key & ~PLACE) | (np.arange(at, at + grams).astype(np.uint64) & PLACE)
    pad = -grams % SPAN
    blocks = np.concatenate([key, np.full(pad, 2**64 - 1, np.uint64)]).reshape(-1, SPAN)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[SPAN - 1 : SPAN - 1 + n])


def _encoded(text) -> bytes:
    return (text.as_py() or "").encode()


def _run_rows(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch in batches(rows, 256):
        owner, nth, seeds, stretches = [], [], [], []
        for k, text in enumerate(batch.column(2)):
            raw = memoryview(_encoded(text))
            first, last, seed = runs(raw)
            owner.append(np.full(len(first), k))
            nth.append(np.arange(len(first), dtype=np.int32))
            seeds += [xxhash.xxh64_intdigest(raw[s : s + GRAM], 1) for s in seed.tolist()]
            ends = zip(first.tolist(), last.tolist(), strict=True)
            stretches += [xxhash.xxh64_intdigest(raw[a : b + LEAST], 2) for a, b in ends]
        owner = pa.array(np.concatenate(owner))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(owner),
                batch.column(1).take(owner),
                pa.array(np.concatenate(nth)),
                pa.array(np.array(seeds, np.uint64).view(np.int64)),
                pa.array(np.array(stretches, np.uint64).view(np.int64)),
            ],
            names=["_id", "_text", "nth", "seed", "stretch"],
        )


def _fetched(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stretches of text of the wanted runs."""
    for batch in batches(rows, 64):
        owner, nth, seed, stretch = [], [], [], []
        for k, (text, wanted) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
            raw = _encoded(text)
            first, last, _ = runs(raw)
            for one in json.loads(wanted.as_py()):
                a, b = int(first[one["nth"]]), int(last[one["nth"]])
                owner.append(k)
                nth.append(one["nth"])
                seed.append(one["seed"])
                stretch.append(raw[a : b + LEAST])
        at = pa.array(owner, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(at), batch.column(1).take(at), pa.array(nth, pa.int32()),
                pa.array(seed, pa.int64()), pa.array(stretch, pa.binary()),
            ],
            names=["_id", "_text", "nth", "seed", "stretch"],
        )


def suffix_order(text: np.ndarray, group: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places ``at`` in the order of the LEAST bytes from there (by group first, equal ones by
    place), and whether each agrees with the one before it in all of them."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(len(text), np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k : k + len(text)]
    rank, length, ranks = _ranked(key), 8, {}
    while length < 256:
        ranks[length] = rank
        longer = np.zeros(len(rank), np.int64)
        longer[: len(rank) - length] = rank[length:]
        rank = _ranked(rank * (int(rank.max()) + 1) + longer)
        length *= 2
    # 400 bytes are 256, 128 and 16 of them.
    parts = [rank[at], ranks[128][at + 256], ranks[16][at + 384]]
    order = np.lexsort((at, *reversed(parts), group))
    same = np.ones(len(at), bool)
    same[:1] = False
    for part in (group, *parts):
        same[1:] &= part[order][1:] == part[order][:-1]
    return order, same


def _ranked(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key)
    rank = np.empty(len(key), np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
    return rank


def nearest_smaller(place: np.ndarray) -> np.ndarray:
    """For each entry the nearest one before it with a smaller value, or -1."""
    found = np.arange(len(place)) - 1
    todo = np.flatnonzero(found >= 0)
    while len(todo):
        todo = todo[place[found[todo]] > place[todo]]
        found[todo] = found[found[todo]]
        todo = todo[found[todo] >= 0]
    return found


def copied(place: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Whether the longest previous factor of each window reaches LEAST.

    ``place`` are windows in suffix order, ``kind`` numbers the runs of windows that agree in LEAST
    bytes.  A factor that long is shared with the previous or the next smaller place, if any.
    """
    back = nearest_smaller(place)
    ahead = len(place) - 1 - nearest_smaller(place[::-1])[::-1]
    out = np.zeros(len(place), bool)
    has = back >= 0
    out[has] = kind[back[has]] == kind[has]
    has = ahead < len(place)
    out[has] |= kind[ahead[has]] == kind[has]
    return out


def matched(stretches: list[bytes], groups: list[int], keep: str) -> list[np.ndarray]:
    """For each stretch, which of its windows go; stretches come in text order."""
    text = np.frombuffer(b"".join(stretches), np.uint8)
    sizes = np.array([len(s) for s in stretches])
    begins = np.cumsum(sizes) - sizes
    counts = sizes - LEAST + 1
    owner = np.repeat(np.arange(len(sizes)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = begins[owner] + offset
    order, same = suffix_order(text, np.array(groups)[owner], at)
    kind = np.cumsum(~same)
    gone = copied(at[order], kind)
    if keep == "none":
        gone |= copied(-at[order], kind)
    marked = np.zeros(len(at), bool)
    marked[order] = gone
    return np.split(marked, np.cumsum(counts)[:-1])


def _spans_of(marked: np.ndarray) -> list[int]:
    """First and last of each run of marked windows, in turn."""
    edge = np.flatnonzero(np.diff(np.r_[False, marked, False].astype(np.int8)))
    edge[1::2] -= 1
    return edge.tolist()


def _matcher(keep: str):
    def match(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # id, text, nth, seed, stretch
        size = 0

        def done(part: list[tuple]) -> pa.RecordBatch:
            found = matched([r[4] for r in part], [r[3] for r in part], keep)
            kept = [(r, _spans_of(m)) for r, m in zip(part, found, strict=True) if m.any()]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r, _ in kept], id_type),
                    pa.array([r[1] for r, _ in kept], pa.int64()),
                    pa.array([r[2] for r, _ in kept], pa.int32()),
                    pa.array([s for _, s in kept], pa.list_(pa.int32())),
                ],
                names=["_id", "_text", "nth", "windows"],
            )

        for batch in rows:
            id_type = batch.column(0).type
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                # Rows are sorted by seed; a batch of groups is closed where a group ends.
                if size >= BATCH_BYTES and row[3] != held[-1][3]:
                    yield done(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield done(held)

    return match


def _window_rows(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A hash for each window of the stretches of hot seeds."""
    import xxhash

    for batch in batches(rows, 64):
        owner, offset, hashes = [], [], []
        for k, stretch in enumerate(batch.column(4)):
            raw = memoryview(stretch.as_py())
            n = len(raw) - LEAST + 1
            owner += [k] * n
            offset += range(n)
            hashes += [xxhash.xxh64_intdigest(raw[i : i + LEAST], 3) for i in range(n)]
        at = pa.array(owner, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(c).take(at) for c in range(4)],
                pa.array(offset, pa.int32()),
                pa.array(np.array(hashes, np.uint64).view(np.int64)),
            ],
            names=["_id", "_text", "nth", "seed", "offset", "window"],
        )


def _cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is taken out of each text."""
    for batch in batches(rows, 256):
        sizes, spans, digests = [], [], []
        for text, marks in zip(batch.column(1), batch.column(2), strict=True):
            raw = _encoded(text)
            gone = _removed(raw, marks.as_py() or [])
            digest, at = hashlib.sha256(), 0
            for a, b in gone:
                digest.update(raw[at:a])
                at = b
            digest.update(raw[at:])
            sizes.append(len(raw))
            spans.append([{"start": a, "end": b} for a, b in gone])
            digests.append(digest.hexdigest())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(digests)],
            names=["_id", "n_bytes", "spans", "kept_sha256"],
        )


def _removed(raw: bytes, marks: list[dict]) -> list[tuple[int, int]]:
    if not marks:
        return []
    first, last, _ = runs(raw)
    pairs = []
    for mark in marks:
        a, b = int(first[mark["nth"]]), int(last[mark["nth"]])
        windows = mark["windows"]
        if windows is None:
            pairs.append((a, b + LEAST))
        else:
            pairs += [(a + f, a + t + LEAST) for f, t in zip(windows[::2], windows[1::2], strict=True)]
    pairs.sort()
    out = [pairs[0]]
    for a, b in pairs[1:]:
        if a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def repeats(docs: DataFrame, keep: str = "first", key: str = "doc_id") -> DataFrame:
    """``key``, n_bytes, spans (start, end: the bytes taken out) and kept_sha256 of each text."""
    if keep not in ("first", "none"):
        raise ValueError("keep is 'first' or 'none'")
    text = F.xxhash64(F.col("text"))
    named = docs.select(F.col(key).alias("_id"), text.alias("_text"), F.col("text").alias("body"))
    kind = named.schema["_id"].dataType.simpleString()
    head = f"_id {kind}, _text bigint, nth int"
    found = settle(named.mapInArrow(_run_rows, f"{head}, seed bigint, stretch bigint"), "runs")

    often = found.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    shared = settle(found.join(settle(often, "seeds").select("seed"), "seed", "left_semi"), "shared")
    place = F.struct(F.col("_id").isNull().alias("_none"), "_id", "_text", "nth").alias("place")
    classes = shared.groupBy("seed", "stretch").agg(
        F.count(F.lit(1)).alias("n"), F.min(place).alias("place")
    )
    classes = settle(classes, "classes")
    marks = _copies(shared, classes, keep)
    several = classes.groupBy("seed").agg(F.count(F.lit(1)).alias("classes"))
    several = settle(several.where(F.col("classes") > 1), "several")
    fetched = _fetch(named, classes.join(several.select("seed"), "seed", "left_semi"), head)
    hot = several.where(F.col("classes") > HOT_CLASSES).select("seed")
    if hot.limit(1).count():
        fetched = settle(fetched, "stretches")
        marks = marks.unionByName(_hot(attach(fetched, hot, ["seed"], "left_semi"), keep, head))
        fetched = attach(fetched, hot, ["seed"], "left_anti")
    grouped = fetched.repartition("seed").sortWithinPartitions(
        "seed", F.col("_id").isNull(), "_id", "_text", "nth"
    )
    marks = marks.unionByName(grouped.mapInArrow(_matcher(keep), f"{head}, windows array<int>"))
    return _apply(named, settle(marks, "marks"), kind).withColumnRenamed("_id", key)


def _copies(shared: DataFrame, classes: DataFrame, keep: str) -> DataFrame:
    """Marks of runs that occur as a whole elsewhere."""
    twice, on = classes.where(F.col("n") > 1), ["seed", "stretch"]
    hot = twice.where(F.col("n") > HOT_ROWS)
    if hot.limit(1).count():
        # Shared runs are stored by seed, so Spark can't split a class's rows by where they come from.
        side = measured(hot)
        cold = side.join(shared, on, "left_anti").join(twice.where(F.col("n") <= HOT_ROWS), on)
        met = cold.unionByName(side.join(shared, on, "inner"))
    else:
        met = shared.join(twice, on)
    if keep == "first":
        own = F.struct(F.col("_id").isNull().alias("_none"), "_id", "_text", "nth")
        met = met.where(~own.eqNullSafe(F.col("place")))
    return met.select("_id", "_text", "nth", F.lit(None).cast("array<int>").alias("windows"))


def _keyed(df: DataFrame) -> DataFrame:
    """A key that is never null, for joins by text."""
    return df.withColumn("_key", F.xxhash64("_id"))


def _fetch(named: DataFrame, wanted: DataFrame, head: str) -> DataFrame:
    each = wanted.select("place._id", "place._text", F.struct("place.nth", "seed").alias("one"))
    # As text, so that its size is counted before it may be broadcast.
    listed = F.to_json(F.collect_list("one")).alias("wanted")
    lists = _keyed(each).groupBy("_key", "_text").agg(listed)
    rows = attach(_keyed(named), settle(lists, "wanted"), ["_key", "_text"], "inner")
    # Rows that repeat a text with its id would send its stretches again.
    rows = rows.select("_id", "_text", "body", "wanted")
    out = rows.mapInArrow(_fetched, f"{head}, seed bigint, stretch binary")
    return out.dropDuplicates(["_id", "_text", "nth"])


def _hot(fetched: DataFrame, keep: str, head: str) -> DataFrame:
    rows = settle(
        fetched.mapInArrow(_window_rows, f"{head}, seed bigint, offset int, window bigint"), "windows"
    )
    own = F.struct(F.col("_id").isNull().alias("_none"), "_id", "_text", "nth", "offset")
    met = rows.groupBy("seed", "window").agg(F.count(F.lit(1)).alias("n"), F.min(own).alias("first"))
    met = rows.join(settle(met.where(F.col("n") > 1), "met"), ["seed", "window"])
    if keep == "first":
        met = met.where(~own.eqNullSafe(F.col("first")))
    pair = F.array("offset", "offset")
    return met.groupBy("_id", "_text", "nth").agg(F.flatten(F.collect_list(pair)).alias("windows"))


def _apply(named: DataFrame, marks: DataFrame, kind: str) -> DataFrame:
    each = _keyed(marks).groupBy("_key", "_text").agg(
        F.collect_set(F.struct("nth", "windows")).alias("marks")
    )
    rows = _keyed(named).join(settle(each, "cuts"), ["_key", "_text"], "left")
    schema = f"_id {kind}, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept_sha256 string"
    return rows.select("_id", "body", "marks").mapInArrow(_cut, schema)
