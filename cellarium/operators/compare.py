"""Comparing two copies of a table.

The digest of a row is the XOR of the hashes of its cells.  A hash covers the whole
cell key, and a table holds a key once, so equal sets of cells and only those give
equal digests (up to hash collisions).  XOR needs no order: a digest is one partial
aggregate, the same plan for a row of five cells and for a row that is a third of the
table, and digests of rows combine to digests of ranges in the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellarium.functions.bytewise import fast_lanes, md5_lanes, stored_cell_size
from cellarium.model import CELL, COLUMN, ROW, VERSION, version_order
from cellarium.operators.mutate import DELETE_VERSION, PUT, replay
from cellarium.operators.scan import locate
from cellarium.plans.greedy import bundles
from cellarium.plans.scratch import settle
from cellarium.plans.skew import measured, ranked, running

LANES = ["_a", "_b"]


def row_digests(cells: DataFrame, exact: bool = False) -> DataFrame:
    """One record per row: cells, bytes and two hash lanes.

    ``exact`` uses md5, for digests that are kept; otherwise a faster hash.
    """
    lanes = md5_lanes() if exact else fast_lanes()
    hashed = cells.select(
        "row",
        stored_cell_size().alias("_bytes"),
        *[lane.alias(name) for lane, name in zip(lanes, LANES, strict=True)],
    )
    return hashed.groupBy("row").agg(
        F.count(F.lit(1)).alias("cells"),
        F.sum("_bytes").alias("bytes"),
        *[F.bit_xor(name).alias(name) for name in LANES],
    )


def digest_text() -> Column:
    return F.concat(*[F.lpad(F.hex(name), 15, "0") for name in LANES]).alias("hash")


def hash_rows(cells: DataFrame) -> DataFrame:
    return row_digests(cells, exact=True).select("row", "cells", digest_text())


def hash_ranges(cells: DataFrame, batch_bytes: int) -> DataFrame:
    """Cuts the rows, in key order, into ranges and hashes each.

    A range ends with the row that brings it to ``batch_bytes``.  Rows are never split.  The first range
    starts at the empty key.
    """
    rows = row_digests(cells, exact=True)
    numbered = bundles(rows, [], [F.col("row").asc()], {"bytes": batch_bytes}, "_range")
    ranges = numbered.groupBy("_range").agg(
        F.min("row").alias("_first"),
        F.count(F.lit(1)).alias("rows"),
        F.sum("cells").alias("cells"),
        *[F.bit_xor(name).alias(name) for name in LANES],
    )
    start = F.when(F.col("_range") == 0, F.lit(b"")).otherwise(F.col("_first"))
    return ranges.select(start.alias("start"), "rows", "cells", digest_text())


def range_bounds(ranges: DataFrame) -> DataFrame:
    """Adds ``stop``, the start of the next range; the last range has none."""
    return running(
        ranges, [], [F.col("start").desc()], {"stop": ("last", F.col("start"), False)}
    )


def sync_ranges(ranges: DataFrame, target: DataFrame) -> DataFrame:
    """Hashes the target over the source's ranges; ``matches`` is the verdict.

    A range without target rows does not match, nor one with another number of cells.
    """
    rows = row_digests(target, exact=True).select("row", "cells", *LANES)
    spans = ranges.select(F.col("start").alias("span_start"))
    found = locate(rows, "row", spans).where(F.col("span_start").isNotNull())
    theirs = found.groupBy(F.col("span_start").alias("start")).agg(
        F.sum("cells").alias("_cells"), *[F.bit_xor(name).alias(name) for name in LANES]
    )
    theirs = theirs.select("start", "_cells", digest_text().alias("target_hash"))
    # Equal cells cancel in a digest, so their number is compared too.
    same = F.col("hash").eqNullSafe(F.col("target_hash")) & F.col("cells").eqNullSafe(F.col("_cells"))
    return ranges.join(theirs, ["start"], "left").withColumn("matches", same).drop("_cells")


def sync_counts(synced: DataFrame) -> DataFrame:
    return synced.agg(
        F.count_if("matches").alias("matches"),
        F.count_if(~F.col("matches")).alias("mismatches"),
    )


# ---- rows -------------------------------------------------------------------

MATCH, DIFFERENT = "match", "different"
SOURCE_MISSING, TARGET_MISSING = "source missing", "target missing"


def compare_rows(source: DataFrame, target: DataFrame) -> DataFrame:
    """One verdict per row key of either side."""
    ours = row_digests(source).select("row", F.struct("cells", *LANES).alias("_s"))
    theirs = row_digests(target).select("row", F.struct("cells", *LANES).alias("_t"))
    verdict = (
        F.when(F.col("_s").isNull(), SOURCE_MISSING)
        .when(F.col("_t").isNull(), TARGET_MISSING)
        .when(F.col("_s") == F.col("_t"), MATCH)
        .otherwise(DIFFERENT)
    )
    return ours.join(theirs, ["row"], "full_outer").select("row", verdict.alias("verdict"))


def verdict_counts(verdicts: DataFrame) -> DataFrame:
    return verdicts.groupBy("verdict").agg(F.count(F.lit(1)).alias("rows"))


# ---- cells ------------------------------------------------------------------


def _side_by_side(source: DataFrame, target: DataFrame) -> DataFrame:
    """Both versions of every cell of the rows that differ.

    Row digests are compared first; only rows that differ have their cells joined.
    On copies that mostly agree the cells of the tables are not shuffled at all.
    """
    rows = compare_rows(source, target).where(F.col("verdict") != MATCH).select("row")
    rows = measured(settle(rows, "differing"))
    ours = rows.join(source.select(*CELL), ROW, "left_semi").select(*VERSION, F.col("value").alias("source_value"))
    theirs = rows.join(target.select(*CELL), ROW, "left_semi").select(
        *VERSION, F.col("value").alias("target_value")
    )
    return ours.join(theirs, VERSION, "full_outer").withColumn(
        "verdict",
        F.when(F.col("source_value").isNull(), SOURCE_MISSING)
        .when(F.col("target_value").isNull(), TARGET_MISSING)
        .when(F.col("source_value") != F.col("target_value"), DIFFERENT)
        .otherwise(MATCH),
    )


def deliver(diff: DataFrame, detector: Callable[[int, pa.RecordBatch], int]) -> DataFrame:
    """Hands every difference to ``detector``; (part, differences, handled) of every part.

    ``diff`` is written once, and its parts are numbered by what was written: ``detector`` is called in tasks with
    the number of a part and a batch of its rows, and says how many it has dealt with.  A task that is run
    again calls with the same numbers and rows: delivery is at least once, and once a run where no task fails.
    """
    told = settle(diff.withColumn("_at", F.monotonically_increasing_id()), "differences")
    told = told.withColumn("part", F.shiftright("_at", 33)).repartition("part").sortWithinPartitions("part", "_at")

    def call(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            parts = batch.column(batch.num_columns - 1).to_numpy()
            for part in dict.fromkeys(parts.tolist()):
                low, high = parts.searchsorted([part, part + 1])
                own = batch.slice(low, high - low)
                handled = detector(part, own.select(own.schema.names[:-1]))
                yield pa.RecordBatch.from_pylist(
                    [{"part": part, "differences": own.num_rows, "handled": handled}], DELIVERED
                )

    counts = told.select(*diff.columns, "part").mapInArrow(call, "part bigint, differences bigint, handled bigint")
    # Written before anything reads it, so that a look at the counts delivers nothing again.
    return settle(
        counts.groupBy("part").agg(F.sum("differences").alias("differences"), F.sum("handled").alias("handled")),
        "delivered",
    )


DELIVERED = pa.schema([("part", pa.int64()), ("differences", pa.int64()), ("handled", pa.int64())])


def by_version_rank(cells: DataFrame) -> DataFrame:
    """Timestamps replaced by the age rank of the version in its column."""
    placed = ranked(cells.select(*CELL), COLUMN, version_order(), "_rank")
    return placed.withColumn("ts", F.col("_rank")).select(*CELL)


def cell_diff(source: DataFrame, target: DataFrame, ignore_timestamps: bool = False) -> DataFrame:
    """Cells that are missing on one side or differ in value."""
    if ignore_timestamps:
        source, target = by_version_rank(source), by_version_rank(target)
    return _side_by_side(source, target).where(F.col("verdict") != MATCH)


def cell_diff_counts(
    source: DataFrame, target: DataFrame, ignore_timestamps: bool = False
) -> DataFrame:
    if ignore_timestamps:
        source, target = by_version_rank(source), by_version_rank(target)
    verdict = F.col("verdict")
    per_row = (
        _side_by_side(source, target)
        .groupBy("row")
        .agg(
            F.count(F.lit(1)).alias("_cells"),
            F.count_if(verdict == SOURCE_MISSING).alias("_no_source"),
            F.count_if(verdict == TARGET_MISSING).alias("_no_target"),
            F.count_if(verdict == DIFFERENT).alias("_different"),
        )
    )
    missing = F.col("_no_source") + F.col("_no_target")
    return per_row.agg(
        F.count_if(missing + F.col("_different") > 0).alias("rows_with_diffs"),
        F.count_if(F.col("_no_source") == F.col("_cells")).alias("source_missing_rows"),
        F.count_if(F.col("_no_target") == F.col("_cells")).alias("target_missing_rows"),
        F.coalesce(F.sum("_no_source"), F.lit(0)).alias("source_missing_cells"),
        F.coalesce(F.sum("_no_target"), F.lit(0)).alias("target_missing_cells"),
        F.coalesce(F.sum("_different"), F.lit(0)).alias("different_values"),
    )


def repair_log(diff: DataFrame, puts: bool = True, deletes: bool = True) -> DataFrame:
    """Mutations that make the target equal to the source."""
    write = F.col("source_value").isNotNull()
    wanted = (write & F.lit(puts)) | (~write & F.lit(deletes))
    return diff.where(wanted).select(
        *VERSION,
        F.col("source_value").alias("value"),
        F.lit(0).cast("bigint").alias("seq"),
        F.when(write, PUT).otherwise(DELETE_VERSION).alias("op"),
        F.lit(None).cast("bigint").alias("amount"),
    )


def repair(
    source: DataFrame,
    target: DataFrame,
    dry_run: bool = True,
    puts: bool = True,
    deletes: bool = True,
) -> DataFrame:
    """The target after repair; a dry run leaves it as it is."""
    if dry_run:
        return target
    return replay(target, settle(repair_log(cell_diff(source, target), puts, deletes), "repair"))


# ---- batches ----------------------------------------------------------------


def reconcile(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Which side each operation (seq, ok) failed on; one never sent counts as failed."""
    ours = primary.select("seq", F.col("ok").alias("_p"))
    theirs = secondary.select("seq", F.col("ok").alias("_s"))
    first, second = F.coalesce("_p", F.lit(False)), F.coalesce("_s", F.lit(False))
    return ours.join(theirs, ["seq"], "full_outer").select(
        "seq",
        F.when(first & second, "none")
        .when(first, "secondary")
        .when(second, "primary")
        .otherwise("both")
        .alias("failed_on"),
    )
