"""Sets of row-key ranges and the predicates they turn into.

A range predicate on a BINARY column reaches the Parquet scan; ``startswith``,
regex and user filters do not.  So filters hand in the ranges they imply and the
scan adds them as plain comparisons.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellarium.functions.bytewise import successor
from cellarium.model import as_bytes

# A bound is the first key that is inside (start) or outside (stop).  Open and
# closed ends become that form by appending a zero byte, the next possible key.
Bound = bytes | None


@dataclass(frozen=True)
class Span:
    """Keys k with start <= k < stop; ``stop`` None is unbounded."""

    start: bytes = b""
    stop: Bound = None

    def empty(self) -> bool:
        return self.stop is not None and self.start >= self.stop


class KeySet:
    """Disjoint, ordered spans."""

    def __init__(self, spans: list[Span]):
        merged: list[Span] = []
        for span in sorted((s for s in spans if not s.empty()), key=lambda s: s.start):
            last = merged[-1] if merged else None
            if last is not None and (last.stop is None or span.start <= last.stop):
                stop = None if None in (last.stop, span.stop) else max(last.stop, span.stop)
                merged[-1] = Span(last.start, stop)
            else:
                merged.append(span)
        self.spans = merged

    @classmethod
    def all(cls) -> KeySet:
        return cls([Span()])

    @classmethod
    def none(cls) -> KeySet:
        return cls([])

    @classmethod
    def point(cls, key: bytes | str) -> KeySet:
        key = as_bytes(key)
        return cls([Span(key, key + b"\x00")])

    @classmethod
    def points(cls, keys) -> KeySet:
        return cls([Span(as_bytes(k), as_bytes(k) + b"\x00") for k in keys])

    @classmethod
    def prefix(cls, prefix: bytes | str) -> KeySet:
        prefix = as_bytes(prefix)
        return cls([Span(prefix, successor(prefix))])

    @classmethod
    def between(
        cls,
        start: bytes | str = b"",
        stop: bytes | str = b"",
        start_inclusive: bool = True,
        stop_inclusive: bool = False,
    ) -> KeySet:
        """An empty bound is unbounded."""
        start, stop = as_bytes(start), as_bytes(stop)
        first = start if start_inclusive or not start else start + b"\x00"
        after = None if not stop else (stop + b"\x00" if stop_inclusive else stop)
        return cls([Span(first, after)])

    def is_all(self) -> bool:
        return self.spans == [Span()]

    def __eq__(self, other) -> bool:
        return isinstance(other, KeySet) and self.spans == other.spans

    def __repr__(self) -> str:
        return f"KeySet({self.spans})"

    def bounds(self) -> Span:
        """The smallest single span around the set."""
        return Span(self.spans[0].start, self.spans[-1].stop) if self.spans else Span(b"", b"")

    def union(self, other: KeySet) -> KeySet:
        return KeySet(self.spans + other.spans)

    def complement(self) -> KeySet:
        gaps, at = [], b""
        for span in self.spans:
            gaps.append(Span(at, span.start))
            if span.stop is None:
                return KeySet(gaps)
            at = span.stop
        return KeySet([*gaps, Span(at, None)])

    def intersect(self, other: KeySet) -> KeySet:
        return self.complement().union(other.complement()).complement()

    def test(self, key: Column) -> Column:
        """The whole set as one predicate the Parquet scan can use."""
        tests = [_span_test(key, span) for span in self.spans]
        return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def is_point(span: Span) -> bool:
    return span.stop == span.start + b"\x00"


def _span_test(key: Column, span: Span) -> Column:
    if is_point(span):
        return key == F.lit(span.start)
    test = key >= F.lit(span.start) if span.start else F.lit(True)
    return test if span.stop is None else test & (key < F.lit(span.stop))
