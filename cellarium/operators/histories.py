"""Histories of columns: what increments and appends read and write, in order, hot columns in pieces.

A column's events are put in order and walked.  A hot column's are range-cut into pieces that run in
tasks of their own.  A piece does not know what stands before it, so it first tells, in a ``Summary``,
what it makes of *any* newest version that may come in:

* an incoming version no newer than some put or delete of the piece is lost at that point, and what
  stands at the end is known;
* a newer one lives, at its own timestamp or at that of a later write on top of it, with bytes appended
  and amounts added.  Which increments succeed depends on whether the value has 8 bytes, so
  incoming values are told apart by their length, up to 8 and beyond.

Summaries compose: one record per piece is passed along per column, and gives every piece the version
that comes in.  Then all pieces run at once.  Two kinds of pieces have no such summary: those of columns with
deletes of single versions, where older versions come back, and those where an append might outgrow
the largest cell.  They run in waves, each piece once the one before has said what it leaves; a delete of the
whole column starts a wave of its own.  Memory is one piece's live versions, at most.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cellarium.model import COLUMN
from cellarium.operators.sequential import APPEND, INCREMENT, PUT, Versions, added
from cellarium.plans.scratch import settle
from cellarium.plans.skew import hot_keys, measured

EVENT = [*COLUMN, "piece", "seq", "op", "ts", "value", "amount", "pinned"]
STATE = "STATE"  # what stands before a piece, or after it
LONG = 9  # stands for every length over 8


# ---- summaries --------------------------------------------------------------


@dataclass
class Strand:
    """One way a piece may go: for incoming newest versions whose values have these lengths.

    ``levels`` are (up to which incoming timestamp, what stands now: ts and value or None), rising.
    Newer incoming versions live on, as ``pre``, then ``delta`` added, then ``post`` appended.
    """

    sizes: frozenset[int]
    levels: list[tuple[int, tuple[int, bytes] | None]] = field(default_factory=list)
    raised: int | None = None
    pre: bytearray = field(default_factory=bytearray)
    delta: int | None = None
    post: bytearray = field(default_factory=bytearray)

    def copy(self, sizes: frozenset[int]) -> Strand:
        return Strand(sizes, list(self.levels), self.raised, self.pre[:], self.delta, self.post[:])

    def size(self, incoming: int) -> int:
        start = incoming + len(self.pre) if self.delta is None else 8
        return start + len(self.post)

    def lost_to(self, ts: int, stands: tuple[int, bytes] | None) -> None:
        """Incoming versions up to ``ts`` are lost from here on, unless a write has lifted them above."""
        if (self.raised is None or ts >= self.raised) and (not self.levels or ts > self.levels[-1][0]):
            self.levels.append((ts, stands))

    def write(self, ts: int) -> None:
        self.raised = ts if self.raised is None else max(self.raised, ts)


class Summary:
    def __init__(self, max_bytes: int):
        self.max_bytes = max_bytes
        self.plain = Versions()  # with nothing coming in
        self.sealed = False  # nothing that comes in can matter any more
        self.several = False  # more than the newest version has to be known
        self.strands = [Strand(frozenset(range(LONG + 1)))]

    def apply(self, op: str, ts: int | None, value, amount, pinned: bool | None) -> None:
        self.plain.apply(op, ts, value, amount, self.max_bytes, bool(pinned))
        self.several |= pinned is not None
        covers = op not in (PUT, INCREMENT, APPEND, "DELETE_VERSION", "DELETE_COLUMN_TO")
        if covers:
            self.sealed = True
        if self.several or self.sealed:
            self.strands = []
            return
        strands = []
        for strand in self.strands:
            strand.levels = self._known(strand.levels, op, ts, value, amount)
            if op == PUT:
                strand.lost_to(ts, (ts, value))
            elif op == "DELETE_COLUMN_TO":
                strand.lost_to(ts, None)
            elif op == APPEND:
                (strand.pre if strand.delta is None else strand.post).extend(value or b"")
                strand.write(ts)
            elif op == INCREMENT:
                fit = frozenset(s for s in strand.sizes if s != LONG and strand.size(s) == 8)
                if fit and fit != strand.sizes:
                    strands.append(strand.copy(strand.sizes - fit))
                    strand.sizes = fit
                if fit:
                    strand.delta = (strand.delta or 0) + amount
                    strand.write(ts)
            strands.append(strand)
        self.strands = strands

    def _known(self, levels: list, op: str, ts: int, value, amount) -> list:
        done: list = []
        for upto, stands in levels:
            live = Versions()
            if stands is not None:
                live.put(*stands, False)
            live.apply(op, ts, value, amount, self.max_bytes, False)
            newest = live.newest()
            stands = None if newest[0] is None else newest
            if done and done[-1][1] == stands:
                done.pop()
            done.append((upto, stands))
        return done

    def after(self, state: list[tuple] | None) -> list[tuple] | None:
        """The versions (ts, value, pinned) that stand after the piece; None if that can't be told."""
        if self.sealed or state == []:
            return kept(self.plain)
        if self.several or state is None:
            return None
        ts, value, _ = state[-1]
        strand = next(s for s in self.strands if min(len(value), LONG) in s.sizes)
        for upto, stands in strand.levels:
            if ts <= upto:
                return [] if stands is None else [(*stands, False)]
        if len(value) + len(strand.pre) + len(strand.post) > self.max_bytes:
            return None
        value = value + bytes(strand.pre)
        if strand.delta is not None:
            value = added(value, strand.delta)
        return [(ts if strand.raised is None else max(ts, strand.raised), value + bytes(strand.post), False)]


def kept(live: Versions) -> list[tuple]:
    return [(ts, live.values[ts], live.floor is None or ts > live.floor) for ts in live.times]


# ---- passes over sorted rows ------------------------------------------------


def _events(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(key of column and piece, whether it is new, the rest) of every event."""
    key = None
    for batch in rows:
        for event in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            yield event[:4], event[:4] != key, event[4:]
            key = event[:4]


def _batched(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], size: int = 64 << 20):
    """Record batches of plain tuples; a batch ends after 4096 rows, or some bytes of values."""
    out: list[tuple] = []
    weight = 0
    for row in rows:
        out.append(row)
        weight += sum(len(x) for x in row if isinstance(x, bytes))
        if len(out) == 4096 or weight > size:
            yield _batch(out, names, types)
            out, weight = [], 0
    if out:
        yield _batch(out, names, types)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


KEY_TYPES = [pa.binary(), pa.string(), pa.binary(), pa.int64()]


def column_pass(max_bytes: int, seq: pa.DataType, tell: bool) -> Callable:
    """Results of increments and appends; with ``tell`` also what stands after each piece."""
    names = [*COLUMN, "piece", "seq", "op", "ts", "value", "error"]
    types = [*KEY_TYPES, seq, pa.string(), pa.int64(), pa.binary(), pa.string()]

    def results(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        at, live = None, Versions()
        for key, new, (number, op, ts, value, amount, pinned) in _events(rows):
            if new:
                if tell and at is not None:
                    yield (*at, None, STATE, None, pickle.dumps(kept(live)), None)
                at, live = key, Versions()
            if op == STATE:
                for version in pickle.loads(value):
                    live.put(*version)
                continue
            found = live.apply(op, ts, value, amount, max_bytes, bool(pinned))
            if op in (INCREMENT, APPEND):
                yield (*key, number, op, *found)
        if tell and at is not None:
            yield (*at, None, STATE, None, pickle.dumps(kept(live)), None)

    return lambda rows: _batched(results(rows), names, types)


def summary_pass(max_bytes: int) -> Callable:
    """One summary per column and piece."""

    def summaries(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        at, summary = None, None
        for key, new, (_, op, ts, value, amount, pinned) in _events(rows):
            if new:
                if at is not None:
                    yield (*at, pickle.dumps(summary))
                at, summary = key, Summary(max_bytes)
            summary.apply(op, ts, value, amount, pinned)
        if at is not None:
            yield (*at, pickle.dumps(summary))

    return lambda rows: _batched(summaries(rows), [*COLUMN, "piece", "summary"], [*KEY_TYPES, pa.binary()])


def composed_pass() -> Callable:
    """What comes into every piece, null if only a wave can tell; summaries come by column and piece."""
    names = [*COLUMN, "piece", "before", "state"]

    def states(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        column, before, state = None, None, None
        for batch in rows:
            for *key, summary in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if key[:3] != column:
                    column, before, state = key[:3], None, []
                yield (*key, before, None if state is None else pickle.dumps(state))
                before, state = key[3], pickle.loads(summary).after(state)

    return lambda rows: _batched(states(rows), names, [*KEY_TYPES, pa.int64(), pa.binary()])


# ---- jobs -------------------------------------------------------------------


def walk(events: DataFrame, max_bytes: int) -> DataFrame:
    """column, seq, op, ts, value and error of every increment and append of ``events``.

    Events have the cell columns, seq, op, amount and ``pinned``: whether a delete of a single version
    names this one; null if the column has no such delete.  Equal seqs are ordered by timestamp.
    """
    fields = [c for c in EVENT if c != "piece"]
    hot, pieces = hot_keys(events, COLUMN)
    by = [*COLUMN, "seq", "ts"]
    if hot is None:
        return _passed(_one_piece(events), by, max_bytes)
    side = measured(hot)
    cold = _passed(_one_piece(side.join(events.select(*fields), COLUMN, "left_anti")), by, max_bytes)
    laid = side.join(events.select(*fields), COLUMN, "left_semi")
    parts = max(pieces, int(events.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    laid = laid.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    laid = settle(laid.withColumn("pos", F.monotonically_increasing_id()), "history")
    laid = laid.withColumn("piece", F.shiftright("pos", 33))
    return cold.unionByName(_in_pieces(laid, max_bytes))


def _one_piece(events: DataFrame) -> DataFrame:
    return events.withColumn("piece", F.lit(0).cast("bigint"))


def _kinds(events: DataFrame, with_piece: bool) -> str:
    seq = events.schema["seq"].dataType.simpleString()
    piece = "piece bigint, " if with_piece else ""
    return (
        f"row binary, family string, qualifier binary, {piece}"
        f"seq {seq}, op string, ts bigint, value binary, error string"
    )


def _seq(events: DataFrame) -> pa.DataType:
    return to_arrow_type(events.schema["seq"].dataType)


def _passed(events: DataFrame, by: list[str], max_bytes: int) -> DataFrame:
    dealt = events.select(*EVENT).repartition(*COLUMN).sortWithinPartitions(*by)
    return dealt.mapInArrow(column_pass(max_bytes, _seq(events), False), _kinds(events, True)).drop("piece")


def _dealt(laid: DataFrame) -> DataFrame:
    key = ["piece", *COLUMN]
    return laid.repartition(*key).sortWithinPartitions(*key, "pos").select(*EVENT)


def _in_pieces(laid: DataFrame, max_bytes: int) -> DataFrame:
    key = "row binary, family string, qualifier binary, piece bigint"
    summaries = _dealt(laid).mapInArrow(summary_pass(max_bytes), f"{key}, summary binary")
    summaries = settle(summaries, "summaries")  # so that large records are made once
    chained = summaries.repartition(*COLUMN).sortWithinPartitions(*COLUMN, "piece")
    states = chained.mapInArrow(composed_pass(), f"{key}, before bigint, state binary")
    states = settle(states, "states")
    ready, waiting = states.where("state IS NOT NULL"), states.where("state IS NULL")
    found = []
    while True:
        come = ready.select(
            *COLUMN, "piece", F.lit(-1).cast("bigint").alias("pos"), F.lit(STATE).alias("op"),
            F.col("state").alias("value"),
        )
        ours = measured(ready.select(*COLUMN, "piece")).join(laid, [*COLUMN, "piece"], "left_semi")
        told = _dealt(ours.unionByName(come, allowMissingColumns=True))
        told = told.mapInArrow(column_pass(max_bytes, _seq(laid), True), _kinds(laid, True))
        told = settle(told, "walked")
        found.append(told.where(F.col("op") != STATE).drop("piece"))
        left = told.where(F.col("op") == STATE).select(*COLUMN, F.col("piece").alias("before"), F.col("value").alias("_left"))
        ready = waiting.join(left, [*COLUMN, "before"]).select(*COLUMN, "piece", "before", F.col("_left").alias("state"))
        ready = settle(ready, "states")
        if ready.isEmpty():
            return reduce(DataFrame.unionByName, found)
        waiting = settle(waiting.join(ready.select(*COLUMN, "piece"), [*COLUMN, "piece"], "left_anti"), "waiting")
