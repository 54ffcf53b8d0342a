"""Exact ordered passes over the events of a column or a row.

Most mutations are set-based (``operators.mutate``).  What a counter or a check reads is the newest
version *at that moment*, and deletes of single versions or up to a timestamp can bring an
older one back; then only the order of events decides.  The events of a key come sorted, one after the other;
a pass keeps the versions of that key that can still be read and nothing else, and rows of other keys run in
other tasks.  Hot columns are cut (``operators.histories``).
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa

PUT = "PUT"
INCREMENT = "INCREMENT"
APPEND = "APPEND"
NOT_A_COUNTER = "increment of a value that is not 8 bytes"
TOO_LARGE = "appended cell too large"


@dataclass
class Versions:
    """Live versions of one column, as far as anything later can read them.

    Only the newest is read, and only a delete of a single version brings an older one back.
    Versions that no such delete of the log names are not ``pinned``: all older ones are dropped.
    """

    values: dict[int, bytes] = field(default_factory=dict)
    times: list[int] = field(default_factory=list)
    floor: int | None = None  # the newest version that is not pinned

    def put(self, ts: int, value: bytes, pinned: bool = True) -> None:
        if self.floor is not None and ts < self.floor:
            return
        if ts not in self.values:
            insort(self.times, ts)
        self.values[ts] = value
        if not pinned:
            self.floor = ts
            for gone in self.times[: bisect_left(self.times, ts)]:
                del self.values[gone]
            del self.times[: bisect_left(self.times, ts)]

    def newest(self) -> tuple[int | None, bytes | None]:
        return (self.times[-1], self.values[self.times[-1]]) if self.times else (None, None)

    def drop(self, ts: int) -> None:
        if self.values.pop(ts, None) is not None:
            del self.times[bisect_left(self.times, ts)]
            self.floor = None if self.floor == ts else self.floor

    def drop_to(self, ts: int) -> None:
        at = bisect_right(self.times, ts)
        for gone in self.times[:at]:
            del self.values[gone]
        del self.times[:at]
        self.floor = None if self.floor is not None and self.floor <= ts else self.floor

    def clear(self) -> None:
        self.values.clear()
        self.times.clear()
        self.floor = None

    def apply(self, op: str, ts: int | None, value, amount, max_bytes: int, pinned: bool = True) -> tuple:
        """Does what the operation does to this column; (ts, value, error) of a result."""
        if op == PUT:
            self.put(ts, value, pinned)
        elif op == "DELETE_VERSION":
            self.drop(ts)
        elif op == "DELETE_COLUMN_TO":
            self.drop_to(ts)
        elif op not in (INCREMENT, APPEND):
            self.clear()
        else:
            return self._modify(op, ts, value, amount, max_bytes, pinned)
        return None, None, None

    def _modify(self, op: str, ts: int, value, amount, max_bytes: int, pinned: bool) -> tuple:
        newest, before = self.newest()
        if op == INCREMENT:
            if before is not None and len(before) != 8:
                return None, None, NOT_A_COUNTER
            after = added(before or b"", amount)
        else:
            after = (before or b"") + (value or b"")
            if len(after) > max_bytes:
                return None, None, TOO_LARGE
        if newest is None or ts > newest:
            self.put(ts, after, pinned)
            return ts, after, None
        self.values[newest] = after
        return newest, after, None


def added(counter: bytes, amount: int) -> bytes:
    total = (int.from_bytes(counter, "big", signed=True) + amount + (1 << 63)) % (1 << 64) - (1 << 63)
    return total.to_bytes(8, "big", signed=True)


def row_pass(passed: Callable[[tuple, int | None, bytes | None], bool], max_bytes: int) -> Callable:
    """Answers of checks; rows are (row, seq, kind, family, qualifier, op, ts, value, amount, and
    the check's own columns), sorted by row, order and kind: stored cells, checks, their deletes,
    their puts and other operations.  A mutation acts if the check of its seq passed."""

    def walk(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, state, answer = None, {}, (None, False)
        for batch in rows:
            out = []
            for event in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if event[0] != row:
                    row, state, answer = event[0], {}, (None, False)
                _, seq, kind, family, qualifier, op, ts, value, amount, *rest = event
                if kind == "check":
                    newest = state.get((family, qualifier), Versions()).newest()
                    answer = (seq, passed((op, *rest), *newest))
                    out.append(answer)
                elif kind == "stored" or answer == (seq, True):
                    act(state, family, qualifier, op, ts, value, amount, max_bytes)
            columns = list(zip(*out, strict=True)) if out else [(), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], batch.column(1).type), pa.array(columns[1], pa.bool_())],
                names=["seq", "applied"],
            )

    return walk


def piece_pass(
    passed: Callable[[tuple, int | None, bytes | None], bool], max_bytes: int, seq: pa.DataType
) -> Callable:
    """Answers of the checks of pieces of rows, and what the pieces leave.

    Rows are (row, piece, seq, kind, family, qualifier, op, ts, value, amount, the check's own
    columns, pinned, versions): the versions that come in for each column the piece names, then checks
    and mutations in order.  Told are answers; the versions of named columns that were touched; and scopes
    that were cleared (the row if no family is given).
    """
    version = pa.struct([("ts", pa.int64()), ("value", pa.binary()), ("pinned", pa.bool_())])
    names = ["row", "piece", "kind", "seq", "applied", "family", "qualifier", "versions"]

    def left(key: tuple, state: dict, known: set, touched: set, cleared: set) -> Iterator[tuple]:
        for column in known:
            if column in touched or (None,) in cleared or (column[0],) in cleared:
                live = state.get(column, Versions())
                versions = [
                    {"ts": ts, "value": live.values[ts], "pinned": live.floor is None or ts > live.floor}
                    for ts in live.times
                ]
                yield (*key, "left", None, None, *column, versions)
        for (family,) in cleared:
            yield (*key, "cleared", None, None, family, None, None)

    def told(rows: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        key, state, known, touched, cleared, answer = None, {}, set(), set(), set(), (None, False)
        for batch in rows:
            out: list[tuple] = []
            for event in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if event[:2] != key:
                    if key is not None:
                        out.extend(left(key, state, known, touched, cleared))
                    key, state, known, touched, cleared = event[:2], {}, set(), set(), set()
                seq, kind, family, qualifier, op, ts, value, amount, *rest, pinned, versions = event[2:]
                if kind == "state":
                    known.add((family, qualifier))
                    live = state.setdefault((family, qualifier), Versions())
                    for v in versions:
                        live.put(v["ts"], v["value"], v["pinned"])
                elif kind == "check":
                    newest = state.get((family, qualifier), Versions()).newest()
                    answer = (seq, passed((op, *rest), *newest))
                    out.append((*key, "answer", *answer, None, None, None))
                elif answer == (seq, True):
                    act(state, family, qualifier, op, ts, value, amount, max_bytes, bool(pinned))
                    if op in ("DELETE_ROW", "DELETE_FAMILY"):
                        cleared.add((family if op == "DELETE_FAMILY" else None,))
                    else:
                        touched.add((family, qualifier))
            yield out
        if key is not None:
            yield list(left(key, state, known, touched, cleared))

    def walk(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in told(rows):
            if out:
                types = [pa.binary(), pa.int64(), pa.string(), seq, pa.bool_(), pa.string(), pa.binary(), pa.list_(version)]
                columns = zip(*out, strict=True)
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return walk


def act(state: dict, family, qualifier, op, ts, value, amount, max_bytes: int, pinned: bool = True) -> None:
    if op == "DELETE_ROW":
        state.clear()
    elif op == "DELETE_FAMILY":
        for column in [c for c in state if c[0] == family]:
            del state[column]
    else:
        column = state.setdefault((family, qualifier), Versions())
        column.apply(op, ts, value, amount, max_bytes, pinned)
