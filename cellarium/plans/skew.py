"""Ordered and keyed work that holds when one key owns a third of the rows.

Three situations, three plans:

* a bounded number of rows per key (``topmost``): Spark keeps only the best n of
  each key before the shuffle, so a hot key ships n rows per task;
* a running value over all rows of a key (``running``, ``ranked``): ordinary keys
  use a window; hot keys are found first, cut into ordered pieces by range, scanned
  piece by piece, and joined up with one small carry record per piece;
* one record per key looked up by many rows (``measured``, ``attach``): broadcast when
  its measured size allows it, otherwise shuffled in several copies so that the rows
  of one key spread over several tasks.  ``lookup`` finds the hot keys first and
  broadcasts their records only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellarium.plans.scratch import settle

# Rows of one key above which its ordered work is cut into pieces.
HOT_ROWS_SETTING = "spark.cellarium.hotGroupRows"
HOT_ROWS_DEFAULT = 2_000_000
# Up to this many hot keys are listed by the driver; more are kept as a table.
HOT_KEYS_SETTING = "spark.cellarium.listedHotKeys"
HOT_KEYS_DEFAULT = 4096
# Largest right side that is broadcast, in rows and in bytes.
BROADCAST_ROWS_SETTING = "spark.cellarium.broadcastRows"
BROADCAST_ROWS_DEFAULT = 100_000
BROADCAST_BYTES = 32 << 20
# Up to this many first keys are kept by every task and merged in one.
ORDERED_KEYS = 100_000
# Copies of a larger side, each met by a part of every key's rows.
COPIES = 8
# Up to this many rows per key every task may ship its own first rows of a hot key.
# (Spark itself limits groups before the shuffle below 1000 rows.)
SHIPPED_ROWS = 100


def _setting(df: DataFrame, name: str, default: int) -> int:
    return int(df.sparkSession.conf.get(name, str(default)))


def tune(spark: SparkSession) -> None:
    """Session settings the joins rely on.

    Without the last one Spark leaves a skewed join alone if a later aggregate or
    window could reuse its partitioning; the hot key would then stay in one task.
    """
    for name in ("enabled", "skewJoin.enabled", "forceOptimizeSkewedJoin"):
        spark.conf.set(f"spark.sql.adaptive.{name}", "true")


def hot_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame | None, int]:
    """The keys with too many rows for one task and the pieces their rows should be cut into."""
    limit = _setting(df, HOT_ROWS_SETTING, HOT_ROWS_DEFAULT)
    most = _setting(df, HOT_KEYS_SETTING, HOT_KEYS_DEFAULT)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    found = counts.limit(most + 1).toArrow()
    if not found.num_rows:
        return None, 0
    if found.num_rows > most:
        stored = settle(counts, "hot")
        return stored.select(*keys), stored.agg(F.sum("_n")).first()[0] // limit + 1
    pieces = sum(found.column("_n").to_pylist()) // limit + 1
    return df.sparkSession.createDataFrame(found.select(keys), df.select(*keys).schema), pieces


def running(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    values: dict[str, tuple],
    hot: tuple[DataFrame | None, int] | None = None,
) -> DataFrame:
    """Adds running values over the rows of each key, in the given order.

    ``values`` maps a new column to ``(kind, column)`` or ``(kind, column, False)``
    where the row itself is left out.  Kinds: sum, max, min, last (newest non-null).
    With no keys the whole table is one sequence, in one task only if its counted rows
    are no more than one task of a hot key may have.  ``hot`` may hand in an earlier
    answer of ``hot_keys``.
    """
    wanted = {name: (spec[0], spec[1], spec[2] if len(spec) > 2 else True)
              for name, spec in values.items()}
    if not keys:
        stored = settle(df, "sequence")
        if stored.count() <= _setting(df, HOT_ROWS_SETTING, HOT_ROWS_DEFAULT):
            return _running_in_window(stored, keys, order, wanted)
        return _running_in_pieces(stored, keys, order, wanted, 0)
    hot, pieces = hot if hot is not None else hot_keys(df, keys)
    if hot is None:
        return _running_in_window(df, keys, order, wanted)
    side = measured(hot)
    cold = _running_in_window(side.join(df, keys, "left_anti"), keys, order, wanted)
    cut = _running_in_pieces(side.join(df, keys, "left_semi"), keys, order, wanted, pieces)
    return cold.unionByName(cut)


def ranked(
    df: DataFrame, keys: list[str], order: list[Column], name: str = "rank", hot=None
) -> DataFrame:
    """Adds the 1-based position of each row inside its key."""
    return running(df, keys, order, {name: ("sum", F.lit(1).cast("bigint"))}, hot)


def topmost(
    df: DataFrame, keys: list[str], order: list[Column], n: int, name: str = "rank"
) -> DataFrame:
    """The first n rows of each key, with their position."""
    if n <= SHIPPED_ROWS:
        window = Window.partitionBy(*keys).orderBy(*order)
        placed = df.withColumn(name, F.row_number().over(window))
    else:
        placed = ranked(df, keys, order, name)
    return placed.where(F.col(name) <= n)


def last_before(
    asked: DataFrame, events: DataFrame, keys: list[str], name: str, hot=None
) -> DataFrame:
    """Adds to each asked record the newest event of its keys before its ``seq``.

    Both sides carry the keys and ``seq``; events also carry a struct ``_event``.
    An event with the seq of a record comes after it.
    """
    rest = [c for c in asked.columns if c not in (*keys, "seq")]
    body = F.struct(F.lit(True).alias("_asked"), *rest).alias("_body")
    left = asked.select(*keys, "seq", body)
    left = left.withColumn("_event", F.lit(None).cast(events.schema["_event"].dataType))
    right = events.select(
        *keys, "seq", F.lit(None).cast(left.schema["_body"].dataType).alias("_body"), "_event"
    )
    order = [F.col("seq").asc(), F.col("_body").isNull().asc()]
    walked = running(left.unionByName(right), keys, order, {name: ("last", F.col("_event"))}, hot)
    kept = walked.where(F.col("_body").isNotNull())
    return kept.select(*keys, "seq", *[F.col(f"_body.{c}").alias(c) for c in rest], name)


def _over(kind: str, column: Column, frame) -> Column:
    if kind == "last":
        return F.last(column, ignorenulls=True).over(frame)
    return getattr(F, kind)(column).over(frame)


def _frames(window):
    first = Window.unboundedPreceding
    return {True: window.rowsBetween(first, 0), False: window.rowsBetween(first, -1)}


def _running_in_window(df, keys, order, wanted) -> DataFrame:
    frames = _frames(Window.partitionBy(*keys).orderBy(*order))
    return df.select(
        "*",
        *[
            _finish(kind, None, _over(kind, column, frames[inclusive])).alias(name)
            for name, (kind, column, inclusive) in wanted.items()
        ],
    )


def _running_in_pieces(df, keys, order, wanted, pieces: int) -> DataFrame:
    parts = max(pieces, _setting(df, "spark.sql.shuffle.partitions", 200))
    by = [F.col(key).asc() for key in keys] + list(order)
    columns = df.columns
    inputs = {f"_in_{name}": column for name, (_, column, _) in wanted.items()}
    laid = (
        df.select("*", *[column.alias(name) for name, column in inputs.items()])
        .repartitionByRange(parts, *by)
        .sortWithinPartitions(*by)
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    # The pieces are read twice below and must be the same both times.
    laid = settle(laid, "pieces").withColumn("_piece", F.shiftright("_pos", 33))
    group = ["_piece", *keys]

    ends = laid.groupBy(*group).agg(
        *[_total(kind, F.col(f"_in_{name}")).alias(f"_end_{name}")
          for name, (kind, _, _) in wanted.items()]
    )
    # One record per piece and hot key in it.
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(
        *group,
        *[
            _over(kind, F.col(f"_end_{name}"), before).alias(f"_carry_{name}")
            for name, (kind, _, _) in wanted.items()
        ],
    )
    frames = _frames(Window.partitionBy(*group).orderBy("_pos"))
    local = laid.select(
        *columns,
        "_piece",
        *[
            _over(kind, F.col(f"_in_{name}"), frames[inclusive]).alias(f"_here_{name}")
            for name, (kind, _, inclusive) in wanted.items()
        ],
    )
    return measured(settle(carry, "carry")).join(local, group).select(
        *columns,
        *[
            _finish(kind, F.col(f"_carry_{name}"), F.col(f"_here_{name}")).alias(name)
            for name, (kind, _, _) in wanted.items()
        ],
    )


def _total(kind: str, column: Column) -> Column:
    if kind == "last":
        return F.max_by(column, F.when(column.isNotNull(), F.col("_pos")))
    return getattr(F, kind)(column)


def _finish(kind: str, carry: Column | None, here: Column) -> Column:
    if kind == "sum":
        terms = [here] if carry is None else [carry, here]
        return reduce(lambda a, b: a + b, [F.coalesce(term, F.lit(0)) for term in terms])
    if carry is None:
        return here
    if kind == "last":
        return F.coalesce(here, carry)
    return F.greatest(carry, here) if kind == "max" else F.least(carry, here)


def row_bytes(df: DataFrame) -> Column:
    width = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.BinaryType, T.StringType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        width = width + 16
    return width


def within_broadcast(df: DataFrame, rows: int, size: int | None) -> bool:
    limit = _setting(df, BROADCAST_ROWS_SETTING, BROADCAST_ROWS_DEFAULT)
    return rows <= limit and (size or 0) <= BROADCAST_BYTES


@dataclass(frozen=True)
class Side:
    """The right side of a join, at most one record per key, of known size class."""

    df: DataFrame
    small: bool

    def join(self, left: DataFrame, on: list[str], how: str = "left") -> DataFrame:
        """``left`` (its columns first, in order) with this side."""
        if self.small:
            joined = left.join(F.broadcast(self.df), on, how)
        else:
            joined = self._spread(left, on, how)
        added = [] if how in ("left_semi", "left_anti") else self.df.columns
        return joined.select(*left.columns, *[c for c in added if c not in on])

    def _spread(self, left: DataFrame, on: list[str], how: str) -> DataFrame:
        """Copies of the records meet the rows of a key in as many tasks.

        Adaptive execution can split a skewed join only where both inputs come
        straight from a shuffle and nothing above reuses its partitioning; the extra
        key makes both true, so a very hot key is split further.  Without the hint it
        would broadcast records whose compressed shuffle is small, and hold them,
        unpacked, once more in every task and in the driver.
        """
        rest = [c for c in left.columns if c not in on]
        if not rest:
            return left.join(self.df.hint("merge"), on, how)
        copies = F.sequence(F.lit(0), F.lit(COPIES - 1))
        right = self.df.withColumn("_copy", F.explode(copies))
        spread = left.withColumn("_copy", F.pmod(F.xxhash64(*rest), F.lit(COPIES)).cast("int"))
        return spread.join(right.hint("merge"), [*on, "_copy"], how)


def measured(df: DataFrame) -> Side:
    limit = _setting(df, BROADCAST_ROWS_SETTING, BROADCAST_ROWS_DEFAULT)
    rows, size = df.limit(limit + 1).agg(F.count(F.lit(1)), F.sum(row_bytes(df))).first()
    return Side(df, within_broadcast(df, rows, size))


def attach(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join a large table with a side that is usually small; its size is measured first."""
    return measured(right).join(left, on, how)


def lookup(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Left join with one record per key, where a key may own much of the left side.

    The records of the hot keys go to the rows where they lie; only the rest is
    shuffled by key.
    """
    hot, _ = hot_keys(left, on)
    if hot is None:
        return left.join(right, on, "left")
    side = measured(hot)
    few = side.join(right, on, "left_semi")
    cold = side.join(left, on, "left_anti").join(right, on, "left")
    return cold.unionByName(attach(side.join(left, on, "left_semi"), few, on))


def first_rows(cells: DataFrame, n: int, reverse: bool = False) -> DataFrame:
    """All cells of the first n row keys in scan order.

    Only the n-th key is looked for; the cells themselves are filtered in place.
    """
    if n <= 0:
        return cells.where(F.lit(False))
    order = F.col("row").desc() if reverse else F.col("row").asc()
    keys = cells.select("row").distinct()
    if n <= ORDERED_KEYS:
        keys = keys.orderBy(order).limit(n)
    else:
        keys = ranked(keys, [], [order], "_rank").where(F.col("_rank") <= n)
    if reverse:
        return cells.where(F.col("row") >= keys.agg(F.min("row")).scalar())
    return cells.where(F.col("row") <= keys.agg(F.max("row")).scalar())
