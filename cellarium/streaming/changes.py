"""Translation of change-log entries into mutations a copy of the table can apply.

An entry is one atomic write: ``entry`` (its place in the log), ``table``,
``written`` (write time, ms) and ``cells``, an array of
(row, family, qualifier, type, ts, value) in order.  All functions work on batch and
on streaming DataFrames alike, except where they say they aggregate a batch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellarium.functions.bytewise import MILLIS_CEILING, stored_cell_size
from cellarium.model import CELL, LATEST, bytes_lit
from cellarium.operators import importing as imp
from cellarium.operators import mutate as m
from cellarium.plans.greedy import bundles

CELL_FIELDS = (
    "struct<row:binary,family:string,qualifier:binary,type:string,ts:bigint,value:binary>"
)
# The order of a log's cells: the entry above, and below it the place inside the entry, which is
# less than an array can have.  Wide enough for any entry number.
SEQ = T.DecimalType(38, 0)
PLACES = 1 << 31
FAMILY_DELETE_WINDOW_MS = 5 * 60 * 1000
BATCH_BYTES = 500_000
BATCH_CELLS = 99_999

LOG_COLUMNS = ["table", *CELL, "seq", "op", "amount"]


def entry_filter(entries: DataFrame, *tests: Column) -> DataFrame:
    """A chain of tests over whole entries (scope, table, the user's own)."""
    return reduce(DataFrame.where, tests, entries)


def keep_families(entries: DataFrame, families: list[str]) -> DataFrame:
    """Only cells of these families; an entry without any left is dropped."""
    kept = F.filter("cells", lambda cell: cell["family"].isin(*families))
    return entries.withColumn("cells", kept).where(F.size("cells") > 0)


def came_back(tag: bytes | str) -> Column:
    """The entry was written by the other direction's replication: its last cell says so."""
    return F.element_at("cells", -1)["qualifier"] == bytes_lit(tag)


def classify(
    entries: DataFrame,
    loop_tag: bytes | str | None = None,
    family_delete_window: int = FAMILY_DELETE_WINDOW_MS,
) -> DataFrame:
    """One record per cell: the mutation it becomes (``op`` NULL: dropped) and flags.

    With ``loop_tag`` replication goes both ways, and entries with that tag are marked
    ``looped`` and not translated.
    """
    looped = F.lit(False) if loop_tag is None else came_back(loop_tag)
    cells = entries.select(
        "entry",
        "table",
        "written",
        looped.alias("looped"),
        F.size("cells").alias("entry_cells"),
        F.posexplode("cells").alias("place", "cell"),
    ).select("entry", "table", "written", "looped", "entry_cells", "place", "cell.*")
    kind, ts, written = F.col("type"), F.col("ts"), F.col("written")
    put = kind == m.PUT
    delete = kind.isin(*imp.MARKER_SCOPE)
    valid = (
        (kind == imp.DELETE_COLUMN)
        | ((kind == imp.DELETE) & (ts != LATEST))
        | ((kind == imp.DELETE_FAMILY) & (ts == LATEST))
    )
    # A family delete carries the time it was issued; the log is written a little
    # later.  Within the window it means "everything", outside it cannot be kept.
    near = (written >= ts) & (written - ts <= family_delete_window)
    adapted = delete & ~valid & (kind == imp.DELETE_FAMILY) & near
    op = (
        F.when(put, m.PUT)
        .when((kind == imp.DELETE) & valid, m.DELETE_VERSION)
        .when((kind == imp.DELETE_COLUMN) & (ts == LATEST), m.DELETE_COLUMN)
        .when(kind == imp.DELETE_COLUMN, m.DELETE_COLUMN_TO)
        .when((kind == imp.DELETE_FAMILY) & (valid | adapted), m.DELETE_FAMILY)
    )
    live = ~F.col("looped")
    return cells.select(
        "*",
        F.when(live, op).alias("op"),
        (F.col("entry").cast("decimal(20,0)") * F.lit(PLACES).cast("decimal(10,0)") + F.col("place"))
        .cast(SEQ)
        .alias("seq"),
        (live & (ts >= MILLIS_CEILING) & (ts != LATEST)).alias("overflow"),
        (live & put & (ts > written)).alias("future"),
        (live & delete & ~valid).alias("bad_delete"),
        (live & ~put & ~delete).alias("unknown"),
    )


def to_log(classified: DataFrame) -> DataFrame:
    """The mutations to apply, in ``seq`` order."""
    ts = F.when(F.col("op") == m.DELETE_FAMILY, F.lit(LATEST)).otherwise(F.col("ts"))
    return classified.where(F.col("op").isNotNull()).select(
        "table", "row", "family", "qualifier", ts.alias("ts"), "value", "seq", "op",
        F.lit(None).cast("bigint").alias("amount"),
    )


def origin_tags(log: DataFrame, tag: bytes | str) -> DataFrame:
    """Per row of a batch, a delete of a column that does not exist, after its last cell.

    It changes nothing, but lets the other direction see where the batch came from.
    """
    # By family first: numbers are aggregated by hash, where a text of a row's last cell takes a sort of all cells.
    last = log.groupBy("table", "row", "family").agg(F.max("seq").alias("_last"))
    last = last.groupBy("table", "row").agg(
        F.max_by("family", "_last").alias("family"), F.max("_last").alias("_last")
    )
    none = F.lit(None)
    return last.select(
        "table", "row", "family", bytes_lit(tag).alias("qualifier"),
        F.lit(0).cast("bigint").alias("ts"), none.cast("binary").alias("value"),
        (F.col("_last") + 1).cast(log.schema["seq"].dataType).alias("seq"), F.lit(m.DELETE_VERSION).alias("op"),
        none.cast("bigint").alias("amount"),
    )


def metrics(classified: DataFrame, both_ways: bool) -> DataFrame:
    """Counters of a batch as (metric, n)."""
    first = F.col("place") == 0
    looped = F.col("looped")
    way = "both_ways" if both_ways else "one_way"
    counters = {
        "incompatible_mutations": F.count_if("unknown"),
        "incompatible_deletes": F.count_if("bad_delete"),
        "dropped_mutations": F.count_if(F.col("op").isNull() & ~looped),
        "timestamp_overflows": F.count_if("overflow"),
        "puts_in_future": F.count_if("future"),
        f"{way}_eligible_entries": F.count_if(first & ~looped),
        f"{way}_eligible_mutations": F.count_if(~looped),
    }
    if both_ways:
        # The tag itself is not a mutation of the entry.
        counters["both_ways_ineligible_entries"] = F.count_if(first & looped)
        counters["both_ways_ineligible_mutations"] = F.coalesce(
            F.sum(F.when(first & looped, F.col("entry_cells") - 1)), F.lit(0)
        )
    one_row = classified.agg(*[count.alias(name) for name, count in counters.items()])
    return one_row.unpivot([], list(counters), "metric", "n")


def batches(
    log: DataFrame, max_bytes: int = BATCH_BYTES, max_cells: int = BATCH_CELLS
) -> DataFrame:
    """Numbers the write batches of each table: (table, row, batch, bytes, cells).

    Whole rows in key order, so mutations of a row are never in two batches.  A batch ends with the row that
    brings it to one of the limits.
    """
    size = F.coalesce(stored_cell_size(), F.lit(0))
    rows = log.groupBy("table", "row").agg(
        F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("cells")
    )
    limits = {"bytes": max_bytes, "cells": max_cells}
    placed = bundles(rows, ["table"], [F.col("row").asc()], limits, "batch")
    return placed.select("table", "row", "batch", "bytes", "cells")
