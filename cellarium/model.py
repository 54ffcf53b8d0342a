"""The cell table: one DataFrame row per (row, family, qualifier, ts) version.

Everything stays in this long form.  A row key, or one column of it, may hold a
large share of the whole table, so no operator gathers "the cells of a row" into
one value or one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LATEST = 2**63 - 1

ROW = ["row"]
FAMILY = ["row", "family"]
COLUMN = ["row", "family", "qualifier"]
VERSION = ["row", "family", "qualifier", "ts"]
CELL = ["row", "family", "qualifier", "ts", "value"]

CELL_SCHEMA = T.StructType(
    [
        T.StructField("row", T.BinaryType()),
        T.StructField("family", T.StringType()),
        T.StructField("qualifier", T.BinaryType()),
        T.StructField("ts", T.LongType()),
        T.StructField("value", T.BinaryType()),
    ]
)


def as_bytes(value: bytes | str) -> bytes:
    return value.encode("utf-8") if isinstance(value, str) else bytes(value)


def bytes_lit(value: bytes | str) -> Column:
    """A BINARY literal; the empty value stays distinct from NULL."""
    return F.lit(as_bytes(value))


def cell_order() -> list[Column]:
    """Order of cells inside a row: family, qualifier, newest version first."""
    return [F.col("family").asc(), F.col("qualifier").asc(), F.col("ts").desc()]


def version_order() -> list[Column]:
    return [F.col("ts").desc()]


def sort_cells(cells: DataFrame, reverse: bool = False) -> DataFrame:
    """Scan order.  A reversed scan turns only the row keys around."""
    row = F.col("row").desc() if reverse else F.col("row").asc()
    return cells.orderBy(row, *cell_order())


def layout(cells: DataFrame, parts: int | None = None) -> DataFrame:
    """Storage layout: range partitioned on the whole cell key, sorted inside.

    Cutting on the whole key rather than on the row lets a very large row span
    several files.
    """
    keys = [F.col("row").asc(), *cell_order()]
    ranged = cells.repartitionByRange(parts, *keys) if parts else cells.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def from_wide(
    df: DataFrame,
    row: Column,
    columns: dict[tuple[str, str], Column],
    ts: Column,
    keep: list[str] | None = None,
) -> DataFrame:
    """Melt a wide table: one cell per non-null column, no shuffle."""
    cells = [
        F.struct(
            F.lit(family).alias("family"),
            bytes_lit(qualifier).alias("qualifier"),
            value.cast("string").cast("binary").alias("value"),
        )
        for (family, qualifier), value in columns.items()
    ]
    melted = df.select(
        row.cast("string").cast("binary").alias("row"),
        ts.cast("bigint").alias("ts"),
        *(keep or []),
        F.inline(F.array(*cells)),
    )
    return melted.where(F.col("value").isNotNull()).select(*CELL, *(keep or []))


def to_wide(cells: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """One record per row key with the newest value of each named column."""
    wanted = None
    for family, qualifier in columns.values():
        hit = (F.col("family") == family) & (F.col("qualifier") == bytes_lit(qualifier))
        wanted = hit if wanted is None else wanted | hit
    picks = []
    for name, (family, qualifier) in columns.items():
        hit = (F.col("family") == family) & (F.col("qualifier") == bytes_lit(qualifier))
        picks.append(F.max_by(F.when(hit, F.col("value")), F.when(hit, F.col("ts"))).alias(name))
    return cells.where(wanted).groupBy("row").agg(*picks)


def text(column: str | Column) -> Column:
    return F.decode(F.col(column) if isinstance(column, str) else column, "UTF-8")


def text_view(cells: DataFrame, *extra: str) -> DataFrame:
    """Cells with the byte columns shown as text."""
    return cells.select(
        text("row").alias("row_key"),
        "family",
        text("qualifier").alias("qualifier"),
        "ts",
        text("value").alias("value"),
        *extra,
    )
