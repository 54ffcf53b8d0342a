"""Steps between reading exported cells and writing them to a table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellarium.functions.bytewise import stored_cell_size
from cellarium.model import CELL, COLUMN, FAMILY, ROW, VERSION, cell_order
from cellarium.operators.mutate import PUT
from cellarium.plans.scratch import settle
from cellarium.plans.skew import Side, attach, ranked, row_bytes, running, within_broadcast

# Kinds of delete markers in exported data.
DELETE = "DELETE"
DELETE_FAMILY_VERSION = "DELETE_FAMILY_VERSION"
DELETE_COLUMN = "DELETE_COLUMN"
DELETE_FAMILY = "DELETE_FAMILY"
MARKER_SCOPE = {
    DELETE: VERSION,
    DELETE_FAMILY_VERSION: [*FAMILY, "ts"],
    DELETE_COLUMN: COLUMN,
    DELETE_FAMILY: FAMILY,
}

# Cells of one row mutation.
MAX_MUTATION_CELLS = 99_999


def mask_tombstones(typed: DataFrame) -> DataFrame:
    """Drops cells a marker of their row and family hides, and the markers.

    ``typed`` has the cell columns and ``type``.  Markers mask by timestamp alone:
    the place in the data plays no part, unlike in a mutation log.  Per scope only
    the largest timestamp matters, so there is one marker per key to join with.
    """
    kind = F.col("type")
    reduced = (
        typed.where(kind.isin(*MARKER_SCOPE))
        .groupBy(
            "type",
            "row",
            "family",
            F.when(kind.isin(DELETE, DELETE_COLUMN), F.col("qualifier")).alias("qualifier"),
            F.when(kind.isin(DELETE, DELETE_FAMILY_VERSION), F.col("ts")).alias("ts"),
        )
        .agg(F.max("ts").alias("_to"))
    )
    reduced = settle(reduced, "markers")
    sizes = reduced.groupBy("type").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(reduced)).alias("bytes")
    )
    live = typed.where(kind == PUT).select(*CELL)
    for found in sizes.collect():
        scope = MARKER_SCOPE[found["type"]]
        marks = reduced.where(kind == found["type"]).select(*scope, "_to")
        side = Side(marks, within_broadcast(typed, found["rows"], found["bytes"]))
        if "ts" in scope:
            live = side.join(live, scope, "left_anti")
        else:
            live = side.join(live, scope)
            live = live.where(F.col("_to").isNull() | (F.col("ts") > F.col("_to"))).select(*CELL)
    return live


def chunk_rows(cells: DataFrame, size: int = MAX_MUTATION_CELLS, hot=None) -> DataFrame:
    """Numbers the mutations (``chunk``) a wide row is written in.

    ``hot`` may hand in the hot rows of a table the cells were taken from.
    """
    placed = ranked(cells, ROW, cell_order(), "_rank", hot)
    return placed.withColumn("chunk", F.floor((F.col("_rank") - 1) / size).cast("bigint")).drop(
        "_rank"
    )


@dataclass(frozen=True)
class Limits:
    """Sizes above which data is dropped; None switches a guard off."""

    row_key_bytes: int | None = 4 << 10
    cell_bytes: int | None = 100 << 20
    row_bytes: int | None = 256 << 20
    row_cells: int | None = None


def _over(size: Column, limit: int | None) -> Column:
    return F.lit(False) if limit is None else size > limit


def _sized_cells(cells: DataFrame, limits: Limits) -> DataFrame:
    return cells.where(~_over(F.octet_length("row"), limits.row_key_bytes)).withColumn(
        "_large", _over(F.octet_length("value"), limits.cell_bytes)
    )


def _row_totals(tested: DataFrame, limits: Limits, by: list[str]) -> DataFrame:
    kept = F.when(~F.col("_large"), stored_cell_size())
    totals = tested.groupBy(*by).agg(
        F.coalesce(F.sum(kept), F.lit(0)).alias("_bytes"),
        F.count(kept).alias("_cells"),
        F.count_if("_large").alias("_large_cells"),
    )
    over = _over(F.col("_bytes"), limits.row_bytes) | _over(F.col("_cells"), limits.row_cells)
    return totals.withColumn("_over", over)


def size_guards(cells: DataFrame, limits: Limits, by: list[str] = ROW) -> DataFrame:
    """Cells that pass: long keys, large cells and over-limit rows are left out.

    Large cells do not count towards the size of their row.  ``by`` names what makes
    a row where several tables are guarded together.
    """
    tested = _sized_cells(cells, limits)
    kept = tested.where(~F.col("_large")).select(*cells.columns)
    if limits.row_bytes is None and limits.row_cells is None:
        return kept
    bad = settle(_row_totals(tested, limits, by).where("_over").select(*by), "overlimit")
    return attach(kept, bad, by, "left_anti")


def size_guard_counts(cells: DataFrame, limits: Limits) -> DataFrame:
    """dropped_row_keys, dropped_cells, dropped_rows.

    A row is read in cell order and given up at the cell that takes it over a limit:
    large cells after that point are not counted.
    """
    long_keys = cells.where(_over(F.octet_length("row"), limits.row_key_bytes))
    tested = _sized_cells(cells, limits)
    rows = settle(_row_totals(tested, limits, ROW), "rowtotals")
    split = rows.where(F.col("_over") & (F.col("_large_cells") > 0)).select("row")
    read = running(
        attach(tested, split, ROW, "left_semi"),
        ROW,
        cell_order(),
        {
            "_so_far": ("sum", F.when(~F.col("_large"), stored_cell_size())),
            "_count": ("sum", F.when(~F.col("_large"), F.lit(1).cast("bigint"))),
        },
    )
    given_up = _over(F.col("_so_far"), limits.row_bytes) | _over(F.col("_count"), limits.row_cells)
    whole = rows.where(~F.col("_over")).agg(F.sum("_large_cells").alias("n"))
    partly = read.where(F.col("_large") & ~given_up).agg(F.count(F.lit(1)).alias("n"))
    dropped = rows.agg(F.count_if(F.col("_over") | (F.col("_cells") == 0)).alias("n"))
    zero = F.lit(0).cast("bigint")
    return long_keys.agg(F.count_distinct("row").alias("dropped_row_keys")).select(
        "dropped_row_keys",
        (F.coalesce(whole.scalar(), zero) + F.coalesce(partly.scalar(), zero)).alias(
            "dropped_cells"
        ),
        F.coalesce(dropped.scalar(), zero).alias("dropped_rows"),
    )


def rename(column: str, names: dict[str, str]) -> Column:
    """``column`` with some values renamed, others unchanged."""
    if not names:
        return F.col(column)
    pairs = [F.lit(text) for pair in names.items() for text in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col(column)), F.col(column))


def rename_families(cells: DataFrame, names: dict[str, str]) -> DataFrame:
    return cells.withColumn("family", rename("family", names))


def import_filter(cells: DataFrame, row_test: Column | None, cell_test: Column | None) -> DataFrame:
    """A row-key test, then a cell test, both the caller's own."""
    for test in (row_test, cell_test):
        cells = cells if test is None else cells.where(test)
    return cells


def write_steps(typed: DataFrame) -> DataFrame:
    """Order in which a row's exported cells are written back.

    Family deletes go first, each by itself; then all puts; then other deletes.
    """
    step = F.when(F.col("type") == DELETE_FAMILY, 0).when(F.col("type") == PUT, 1).otherwise(2)
    return typed.withColumn("step", step)


def multi_table_counts(written: DataFrame) -> DataFrame:
    return written.groupBy("table").agg(
        F.count_distinct("row").alias("rows"), F.count(F.lit(1)).alias("cells")
    )


def failures_by_message(judged: DataFrame) -> DataFrame:
    """Mutations per outcome; ``error`` is NULL where the write succeeded."""
    return judged.groupBy(F.coalesce("error", F.lit("ok")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("mutations")
    )


def row_cell_counts(cells: DataFrame) -> DataFrame:
    per_row = cells.groupBy("row").agg(F.count(F.lit(1)).alias("_n"))
    return per_row.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("_n"), F.lit(0)).alias("cells")
    )


def family_diff(current: DataFrame, wanted: DataFrame) -> DataFrame:
    """Families to add, keep and delete, with the cells on either side."""

    def families(cells, name):
        return cells.groupBy("family").agg(F.count(F.lit(1)).alias(name))

    both = families(current, "current_cells").join(
        families(wanted, "wanted_cells"), ["family"], "full_outer"
    )
    action = (
        F.when(F.col("current_cells").isNull(), "add")
        .when(F.col("wanted_cells").isNull(), "delete")
        .otherwise("keep")
    )
    return both.select("family", action.alias("action"), "current_cells", "wanted_cells")


def select_tables(cells: DataFrame, pattern: str, names: dict[str, str]) -> DataFrame:
    """Tables whose whole name matches, then renamed."""
    whole = F.col("table").rlike(f"^(?:{pattern})$")
    return cells.where(whole).withColumn("table", rename("table", names))


