"""Bundles of neighbouring rows, each closed by the row that fills it.

A bundle ends at the first row with which one of its sums reaches its limit; the next row opens a new one.
Where a bundle ends depends on where it began, and so on back to the first row of the key.

Hot keys are range-cut into pieces.  Into a piece come the sums of the bundle that is open before it,
and only they.  The open bundle ends somewhere among the rows of the first bundle's worth, and everything
after that row follows from it.  So a piece tells, per row of those, how many bundles it closes after it
and with which open sums it ends.  These tables are passed along once per key, and give every piece the
number and sums that come in; then all pieces are numbered at once.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from cellarium.plans.scratch import settle
from cellarium.plans.skew import HOT_ROWS_DEFAULT, HOT_ROWS_SETTING, hot_keys, measured


class Piece:
    """Sizes of a piece's rows, one column a sum, as a function of the sums that come in."""

    def __init__(self, sizes: np.ndarray, limits: list[int]):
        upto = np.cumsum(sizes, axis=0)
        n = len(upto)
        before = np.vstack([np.zeros((1, len(limits)), np.int64), upto])
        # The row that closes a bundle which opens at each row, n if none does.
        closes = np.full(n + 1, n)
        for k, limit in enumerate(limits):
            closes = np.minimum(closes, np.searchsorted(upto[:, k], before[:, k] + limit))
        # Bundles closed from a row on, and the row that opens the last one.
        count, opened = np.zeros(n + 1, np.int64), np.arange(n + 1)
        for at in range(n - 1, -1, -1):
            if closes[at] < n:
                count[at] = count[closes[at] + 1] + 1
                opened[at] = opened[closes[at] + 1]
        near = min(int(closes[0]) + 1, n)
        self.limits = limits
        self.total = upto[-1] if n else np.zeros(len(limits), np.int64)
        self.first = upto[:near]  # sums up to each row that may close the incoming bundle
        self.count = 1 + count[1 : near + 1]
        self.left = self.total - before[opened[1 : near + 1]]

    def after(self, number: int, sums: np.ndarray) -> tuple[int, np.ndarray]:
        """Number and sums of the bundle that is open at the end."""
        at = len(self.first)
        for k, limit in enumerate(self.limits):
            at = min(at, int(np.searchsorted(self.first[:, k], limit - sums[k])))
        if at == len(self.first):
            return number, sums + self.total
        return number + int(self.count[at]), self.left[at]


def _pieces(rows: Iterator[pa.RecordBatch], limits: list[int], keys: int) -> Iterator[tuple]:
    """One piece after the other; columns are the keys, the piece and the sums."""
    key, held = None, []
    for batch in rows:
        names = list(zip(*[batch.column(k).to_pylist() for k in range(keys + 1)], strict=True))
        sizes = np.stack([batch.column(keys + 1 + k).to_numpy() for k in range(len(limits))], axis=1)
        start = 0
        for at in range(1, len(names) + 1):
            if at == len(names) or names[at] != names[start]:
                if names[start] != key:
                    if held:
                        yield (*key, pickle.dumps(Piece(np.concatenate(held), limits)))
                    key, held = names[start], []
                held.append(sizes[start:at])
                start = at
    if held:
        yield (*key, pickle.dumps(Piece(np.concatenate(held), limits)))


def _told(limits: list[int], kinds: list[pa.DataType], names: list[str]) -> Callable:
    def told(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _pieces(rows, limits, len(kinds) - 1):
            yield _row(row, [*kinds, pa.binary()], [*names, "told"])

    return told


def _row(row: tuple, kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], names=names)


def _come(limits: list[int], kinds: list[pa.DataType], names: list[str]) -> Callable:
    """What comes into each piece; told pieces are ordered by key and piece."""

    def come(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, number, sums = None, 0, np.zeros(len(limits), np.int64)
        for batch in rows:
            for *own, told in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if own[:-1] != key:
                    key, number, sums = own[:-1], 0, np.zeros(len(limits), np.int64)
                yield _row((*own, number, sums.tolist()), [*kinds, pa.int64(), pa.list_(pa.int64())],
                           [*names, "_number", "_sums"])
                number, sums = pickle.loads(told).after(number, sums)

    return come


def _numbered(limits: list[int], key_at: list[int], size_at: list[int], name: str) -> Callable:
    """Rows with their bundle's number; the last two columns are what comes into a piece."""

    def numbered(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, number, sums = None, 0, [0] * len(limits)
        for batch in rows:
            keys = list(zip(*[batch.column(k).to_pylist() for k in key_at], strict=True))
            sizes = zip(*[batch.column(k).to_pylist() for k in size_at], strict=True)
            numbers = []
            for at, (own, more) in enumerate(zip(keys, sizes, strict=True)):
                if own != key:
                    key, number = own, batch.column(batch.num_columns - 2)[at].as_py()
                    sums = batch.column(batch.num_columns - 1)[at].as_py()
                sums = [a + b for a, b in zip(sums, more, strict=True)]
                numbers.append(number)
                if any(a >= limit for a, limit in zip(sums, limits, strict=True)):
                    number, sums = number + 1, [0] * len(limits)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(numbers, pa.int64())], names=[*batch.schema.names[:-2], name]
            )

    return numbered


def bundles(df: DataFrame, keys: list[str], order: list[Column], limits: dict[str, int], name: str) -> DataFrame:
    """Adds to each row the number of its bundle, from 0 in each key, in the given order.

    ``limits`` maps columns (sizes of rows, not negative or null) to what their sum in a bundle may reach.
    With no keys the table is one sequence.  The order must tell all rows of a key apart.
    """
    spark = df.sparkSession
    columns = df.columns
    if keys:
        hot, pieces = hot_keys(df, keys)
        if hot is None:
            return _in_tasks(df, keys, order, limits, name)
        side = measured(hot)
        cold = _in_tasks(side.join(df, keys, "left_anti"), keys, order, limits, name)
        return cold.unionByName(_in_pieces(side.join(df, keys, "left_semi"), keys, order, limits, name, pieces))
    stored = settle(df, "sequence")
    limit = int(spark.conf.get(HOT_ROWS_SETTING, str(HOT_ROWS_DEFAULT)))
    pieces = stored.count() // limit + 1
    return _in_pieces(stored.select(*columns), keys, order, limits, name, pieces)


def _result(df: DataFrame, ready: DataFrame, limits: dict[str, int], name: str, key: list[str]) -> DataFrame:
    at = {c: k for k, c in enumerate(ready.columns)}
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in ready.schema.fields[:-2]]
    walk = _numbered(list(limits.values()), [at[c] for c in key], [at[c] for c in limits], name)
    return ready.mapInArrow(walk, ", ".join([*kinds, f"`{name}` bigint"])).select(*df.columns, name)


def _in_tasks(df: DataFrame, keys: list[str], order: list[Column], limits: dict[str, int], name: str) -> DataFrame:
    none = F.array_repeat(F.lit(0).cast("bigint"), len(limits))
    dealt = df.repartition(*keys).sortWithinPartitions(*keys, *order)
    ready = dealt.withColumns({"_number": F.lit(0).cast("bigint"), "_sums": none})
    return _result(df, ready, limits, name, keys)


def _in_pieces(df, keys: list[str], order: list[Column], limits: dict[str, int], name: str, pieces: int) -> DataFrame:
    by = [*[F.col(k).asc() for k in keys], *order]
    laid = df.repartitionByRange(pieces, *by).sortWithinPartitions(*by)
    laid = settle(laid.withColumn("_pos", F.monotonically_increasing_id()), "laid")
    laid = laid.withColumn("_piece", F.shiftright("_pos", 33))
    names = [*keys, "_piece"]
    kinds = [to_arrow_type(laid.schema[c].dataType) for c in names]
    named = ", ".join(f"`{c}` {laid.schema[c].dataType.simpleString()}" for c in names)
    sizes = [F.col(c).cast("bigint").alias(c) for c in limits]
    dealt = laid.repartition(*names).sortWithinPartitions(*names, "_pos")
    told = dealt.select(*names, *sizes).mapInArrow(_told(list(limits.values()), kinds, names), f"{named}, told binary")
    # One record per piece and key in it; with no keys the pieces of the table pass through one task.
    told = settle(told, "told")
    chained = (told.repartition(*keys) if keys else told.coalesce(1)).sortWithinPartitions(*names)
    come = chained.mapInArrow(_come(list(limits.values()), kinds, names), f"{named}, _number bigint, _sums array<bigint>")
    ready = measured(settle(come, "come")).join(dealt, names, "inner")
    ready = ready.repartition(*names).sortWithinPartitions(*names, "_pos")
    return _result(df, ready, limits, name, names)
