"""Hard negatives by Fagin's threshold algorithm, over integer vectors with labels.

A row's score is its inner product with an anchor; higher scores come first, ties by the smaller id.
An anchor's positives are its best other rows of its label.  For every positive the best rows of other
labels are wanted whose score lies in a window, between ``low`` and ``high`` hundredths of the
positive's.

Rows are packed into shelves, without a shuffle, and anchors into groups.  A shelf keeps its rows in
one list per dimension, sorted by component.  An anchor reads every list from the end its own
component's sign favours (sorted access), in steps of growing depth; rows met for the first time are
scored by their whole vector (random access).  No unmet row can score more than the anchor's product
with the components at the lists' present ends, the threshold.  A shelf is left once the threshold is
strictly below each window's k-th score (an equal one could still win by its id) or below the window.
The best rows so far go along from shelf to shelf of a run, so later shelves are left sooner; the best of
all runs are few rows and are ranked with a group limit before the shuffle.

Every group of anchors meets every shelf, as the stated query set demands, in tasks of one group and
``RUN`` shelves; nothing in a task grows with the data.

Scores are exact: sums below 2^53 are taken in doubles, others in 64-bit integers.  Rows with a null
label or vector, or a null component, take no part.  Vectors are read as if filled up with zeros to
the longest.  A null id is no anchor's; as a candidate it comes last among equals (ids are below
2^63 - 1).  Repeated rows are rows of their own: each is an anchor, and a positive or negative of others.
Empty tables give empty results, and an anchor without positives has no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellarium.plans.scratch import settle
from cellarium.plans.skew import topmost

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90
SHELF = 8192  # rows
GROUP = 128  # anchors
RUN = 8  # shelves
FIRST_DEPTH = 64
MOST_TASKS = 100_000

NO_ID = 2**63 - 1
ANY = -(2**63), 2**63 - 1


class Best:
    """The best ``k`` rows with a score from ``low`` to ``high``."""

    def __init__(self, k: int, low: int, high: int):
        self.k, self.low, self.high = k, low, high
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        self.place = np.zeros(0, np.int64)

    def bar(self) -> int:
        """Rows that score less than this change nothing."""
        return max(self.low, int(self.score[-1])) if len(self.score) == self.k else self.low

    def offer(self, score: np.ndarray, ids: np.ndarray, places: np.ndarray) -> None:
        fit = np.flatnonzero((score >= self.bar()) & (score <= self.high))
        if not len(fit):
            return
        score = np.concatenate([self.score, score[fit]])
        ids = np.concatenate([self.id, ids[fit]])
        places = np.concatenate([self.place, places[fit]])
        first = np.lexsort((places, ids, -score))[: self.k]
        self.score, self.id, self.place = score[first], ids[first], places[first]


class Shelf:
    """Rows with their components in one sorted list per dimension."""

    def __init__(self, places: bytes, ids: bytes, labels: bytes, values: bytes, kind: str, width: int):
        self.place, self.id, self.label = (np.frombuffer(x, np.int64) for x in (places, ids, labels))
        self.values = np.frombuffer(values, kind).reshape(len(self.id), width)
        self.doubles = self.values.astype(np.float64)
        self.most = float(np.abs(self.doubles).max(initial=0))
        order = np.argsort(self.values, axis=0, kind="stable")
        self.order = order.T.astype(np.int32)
        self.sorted = np.take_along_axis(self.values, order, axis=0).T

    def score(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        if self.most * float(np.abs(anchor.astype(np.float64)).max(initial=0)) * len(anchor) < 2**53:
            return (self.doubles[rows] @ anchor.astype(np.float64)).astype(np.int64)
        return self.values[rows].astype(np.int64) @ anchor

    def walk(self, anchor: np.ndarray, fit: np.ndarray, wanted: list[Best]) -> int:
        """Offers rows of ``fit`` (a mask) until no other can count; the number of rows scored."""
        n, unmet = len(self.id), fit.copy()
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        if not len(up) and not len(down):
            rows = np.flatnonzero(unmet)
            for best in wanted:
                best.offer(np.zeros(len(rows), np.int64), self.id[rows], self.place[rows])
            return len(rows)
        signed = np.concatenate([anchor[up], anchor[down]]).tolist()
        scored = depth = 0
        step = FIRST_DEPTH
        while depth < n:
            ends = np.concatenate([self.sorted[up, n - depth - 1], self.sorted[down, depth]]).tolist()
            threshold = sum(map(mul, signed, ends))  # Python's integers: never rounded down
            if all(threshold < best.bar() for best in wanted):
                break
            end = min(n, depth + step)
            met = np.zeros(n, bool)
            met[self.order[up, n - end : n - depth]] = True
            met[self.order[down, depth:end]] = True
            rows = np.flatnonzero(met & unmet)
            unmet[rows] = False
            if len(rows):
                score = self.score(rows, anchor)
                scored += len(rows)
                for best in wanted:
                    best.offer(score, self.id[rows], self.place[rows])
            depth, step = end, 2 * step
        return scored


def _pack(size: int, width: int, extra: bool):
    """Arrow rows (place, vec_id, label, vector[, windows]) to packed rows of at most ``size``."""

    def packed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                values = np.zeros((part.num_rows, width), np.int64)
                lists = part.column(3)
                lengths = np.asarray(lists.value_lengths())
                inside = np.arange(width) < lengths[:, None]
                values[inside] = lists.flatten().to_numpy(zero_copy_only=False)
                kind = next(k for k in ("<i2", "<i4", "<i8") if _fits(values, k))
                made = [pa.array([x], pa.binary()) for x in (
                    part.column(0).to_numpy().tobytes(),
                    part.column(1).fill_null(NO_ID).to_numpy().tobytes(),
                    part.column(2).to_numpy().tobytes(),
                    values.astype(kind).tobytes(),
                )]
                names = ["places", "ids", "labels", "values", "kind"]
                made.append(pa.array([kind]))
                if extra:
                    windows = part.column(4)
                    made.append(pa.array([np.asarray(windows.value_lengths(), np.int64).tobytes()], pa.binary()))
                    made.append(pa.array([windows.flatten().to_numpy(zero_copy_only=False).astype(np.int64).tobytes()], pa.binary()))
                    names += ["n_windows", "windows"]
                yield pa.RecordBatch.from_arrays(made, names=names)

    return packed


def _fits(values: np.ndarray, kind: str) -> bool:
    range_ = np.iinfo(kind)
    return not values.size or (range_.min <= values.min() and values.max() <= range_.max)


PACKED = "places binary, ids binary, labels binary, values binary, kind string"


def shelves(rows: DataFrame, width: int) -> DataFrame:
    """All rows (place, vec_id, label, vector) in shelves, with a number ``shelf``."""
    packed = rows.mapInArrow(_pack(SHELF, width, False), PACKED)
    return settle(packed.withColumn("shelf", F.monotonically_increasing_id()), "shelves")


def _searched(groups: DataFrame, shelves: DataFrame, width: int, k: int, low: int, high: int, same: bool) -> DataFrame:
    """The best rows of each run of shelves for each anchor and window of ``groups``.

    With ``same`` rows of the anchor's label count (but for itself), else those of other labels.  A
    window is named by the score it was derived from.
    """
    # One number for GROUP anchors, and one for SHELF rows.
    numbers = [[r[0] for r in df.select(df.columns[-1]).collect()] for df in (groups, shelves)]
    run_of = {shelf: at // RUN for at, shelf in enumerate(sorted(numbers[1]))}
    spark = shelves.sparkSession
    kinds = "place bigint, name bigint, score bigint, other bigint, other_place bigint"
    if not numbers[0] or not numbers[1]:
        return spark.createDataFrame([], kinds)
    runs = spark.createDataFrame(sorted(run_of.items()), "shelf bigint, run bigint")
    laid = shelves.join(F.broadcast(runs), "shelf")
    laid = laid.withColumn("group", F.explode(F.lit(numbers[0]).cast("array<bigint>")))
    asked = groups.select("group", *[F.col(c).alias(f"a_{c}") for c in groups.columns if c != "group"])
    asked = asked.withColumn("run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(max(run_of.values())).cast("bigint"))))
    tasks = min(len(numbers[0]) * (max(run_of.values()) + 1), MOST_TASKS)
    left = laid.select("group", "run", "shelf", "places", "ids", "labels", "values", "kind")
    # A group goes with the first shelf of each run only; rows of one (group, run) follow each other.
    head = asked.withColumn("shelf", F.lit(-1).cast("bigint"))
    none = {c: F.lit(None).cast(head.schema[c].dataType) for c in head.columns if c.startswith("a_")}
    rest = {c: F.lit(None).cast(left.schema[c].dataType) for c in ("places", "ids", "labels", "values", "kind")}
    both = head.withColumns(rest).unionByName(left.withColumns(none))
    columns = ["group", "run", "shelf", *rest, *none]
    dealt = both.select(*columns).repartition(tasks, "group", "run").sortWithinPartitions("group", "run", "shelf")
    at = {c: k for k, c in enumerate(columns)}

    def searched(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asking = None
        for batch in batches_:
            for row in range(batch.num_rows):
                cell = {c: batch.column(k)[row].as_py() for c, k in at.items()}
                if cell["a_places"] is not None:
                    if asking is not None:
                        yield _told(asking)
                    asking = _asking(cell, width, k, low, high)
                    continue
                shelf = Shelf(*(cell[c] for c in ("places", "ids", "labels", "values", "kind")), width)
                masks: dict[int, np.ndarray] = {}
                for place, label, vector, wanted in asking:
                    if label not in masks:
                        masks[label] = (shelf.label == label) == same
                    fit = masks[label]
                    if same:
                        fit = fit & (shelf.place != place)
                    shelf.walk(vector, fit, list(wanted.values()))
        if asking is not None:
            yield _told(asking)

    return dealt.mapInArrow(searched, kinds)


def _asking(cell: dict, width: int, k: int, low: int, high: int) -> list[tuple]:
    places, labels = (np.frombuffer(cell[f"a_{c}"], np.int64) for c in ("places", "labels"))
    vectors = np.frombuffer(cell["a_values"], cell["a_kind"]).reshape(len(places), width).astype(np.int64)
    if "a_windows" not in cell:
        windows = [{0: Best(k, *ANY)} for _ in places]
    else:
        scores = np.frombuffer(cell["a_windows"], np.int64).tolist()
        windows, start = [], 0
        for n in np.frombuffer(cell["a_n_windows"], np.int64):
            own = set(scores[start : start + n])
            # low * p <= 100 * score <= high * p, in whole numbers
            windows.append({p: Best(k, -((-low * p) // 100), high * p // 100) for p in own})
            start += n
    return [(int(p), int(y), v, w) for p, y, v, w in zip(places, labels, vectors, windows, strict=True)]


def _told(asking: list[tuple]) -> pa.RecordBatch:
    found = [(place, name, best) for place, _, _, wanted in asking for name, best in wanted.items()]
    sizes = [len(best.score) for _, _, best in found]
    columns = [
        np.repeat(np.array([place for place, _, _ in found], np.int64), sizes),
        np.repeat(np.array([name for _, name, _ in found], np.int64), sizes),
        *[np.concatenate([np.zeros(0, np.int64), *[getattr(best, c) for _, _, best in found]]) for c in ("score", "id", "place")],
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array(c) for c in columns], names=["place", "name", "score", "other", "other_place"]
    )


def mine(
    rows: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has vec_id, label and vector (array of bigint); ``anchor`` says which rows are anchors.
    """
    whole = F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull())
    kept = rows.where(whole).select(
        F.monotonically_increasing_id().alias("place"), F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("label").cast("bigint").alias("label"), "vector",
        F.coalesce(F.col("anchor") & F.col("vec_id").isNotNull(), F.lit(False)).alias("anchor"),
    )
    # Written once: a row keeps its place however often it is read.
    kept = settle(kept, "rows")
    width = kept.agg(F.max(F.size("vector"))).first()[0] or 0
    stored = shelves(kept.select("place", "vec_id", "label", "vector"), width)
    anchors = kept.where("anchor").select("place", "vec_id", "label", "vector")
    order = [F.col("score").desc(), F.col("other").asc(), F.col("other_place").asc()]

    def grouped(asked: DataFrame, extra: bool) -> DataFrame:
        packed = asked.mapInArrow(
            _pack(GROUP, width, extra), PACKED + (", n_windows binary, windows binary" if extra else "")
        )
        return settle(packed.withColumn("group", F.monotonically_increasing_id()), "anchors")

    near = _searched(grouped(anchors, False), stored, width, positives, low, high, True)
    near = settle(topmost(near, ["place"], order, positives).drop("rank", "name"), "positives")
    windows = near.groupBy("place").agg(F.collect_set("score").alias("windows"))
    asked = anchors.join(windows, "place").select("place", "vec_id", "label", "vector", "windows")
    far = _searched(grouped(asked, True), stored, width, negatives, low, high, False)
    far = topmost(far, ["place", "name"], order, negatives)
    names = anchors.select("place", F.col("vec_id").alias("anchor_id"))
    pairs = near.join(names, "place").select(
        "place", "anchor_id", F.col("other").alias("positive_id"), F.col("score").alias("name")
    )
    found = far.select("place", "name", "rank", F.col("other").alias("negative_id"), F.col("score").alias("negative_score"))

    def shown(column: str):
        return F.when(F.col(column) != NO_ID, F.col(column)).alias(column)

    return pairs.join(found, ["place", "name"]).select(
        "anchor_id", shown("positive_id"), F.col("rank").cast("int").alias("rank"), shown("negative_id"),
        F.col("name").alias("positive_score"), "negative_score",
    )
