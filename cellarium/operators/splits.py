"""Key ranges, their sizes, and how work is cut along them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellarium.functions.bytewise import stored_cell_size
from cellarium.operators.scan import locate
from cellarium.plans.greedy import bundles
from cellarium.plans.scratch import settle
from cellarium.plans.skew import running


def split_points(cells: DataFrame, bundle: Column | None = None) -> DataFrame:
    """First key of every input bundle (by default every input file)."""
    bundle = F.input_file_name() if bundle is None else bundle
    firsts = cells.groupBy(bundle.alias("bundle")).agg(F.min("row").alias("split"))
    return firsts.select("split").distinct().where(F.octet_length("split") > 0)


def key_ranges(samples: DataFrame) -> DataFrame:
    """Sampled keys (column ``key``) to ranges; the outermost ends are unbounded.

    Repeated and empty samples bound no range.
    """
    spark = samples.sparkSession
    keys = samples.select("key").where(F.octet_length("key") > 0).distinct()
    starts = spark.createDataFrame([(b"",)], "key binary").unionByName(keys)
    return running(
        starts.withColumnRenamed("key", "start"),
        [],
        [F.col("start").desc()],
        {"stop": ("last", F.col("start"), False)},
    )


def region_sizes(cells: DataFrame, ranges: DataFrame) -> DataFrame:
    """Bytes per range, 0 where it is empty.

    Cells are first added up per row, so what is put into ranges is one record per row.
    """
    rows = cells.groupBy("row").agg(F.sum(stored_cell_size()).alias("bytes"))
    placed = locate(rows, "row", ranges.select(F.col("start").alias("span_start")))
    sizes = placed.groupBy(F.col("span_start").alias("start")).agg(F.sum("bytes").alias("bytes"))
    return ranges.join(sizes, ["start"], "left").withColumn(
        "bytes", F.coalesce("bytes", F.lit(0).cast("bigint"))
    )


def select_shard(df: DataFrame, key: Column, shards: int, index: int) -> DataFrame:
    """The part of the work that belongs to shard ``index``."""
    if not 0 <= index < shards:
        raise ValueError("shard index must be below the number of shards")
    number = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return df.where(F.pmod(number, F.lit(shards)) == index)


def balanced_splits(regions: DataFrame, target_bytes: int) -> DataFrame:
    """Merges neighbouring small ranges (start, stop, bytes) until they reach ``target_bytes``.

    A range of the target size or more stays alone, and ends the bundle before it.  Any other bundle ends with the
    range that fills it, so it stays below twice the target.
    """
    by_start = [F.col("start").asc()]
    big = F.col("bytes") >= target_bytes
    run = {"_run": ("sum", F.when(big, 1).otherwise(0).cast("bigint"))}
    placed = settle(running(regions, [], by_start, run), "placed")
    alone = placed.where(big).withColumn("_bundle", F.lit(-1).cast("bigint"))
    merged = bundles(placed.where(~big), ["_run"], by_start, {"bytes": target_bytes}, "_bundle")
    stop = F.max_by(F.struct("stop"), F.col("start"))["stop"]
    return merged.unionByName(alone).groupBy("_run", "_bundle").agg(
        F.min("start").alias("start"),
        stop.alias("stop"),
        F.sum("bytes").alias("bytes"),
        F.count(F.lit(1)).alias("ranges"),
    ).drop("_run", "_bundle")


def even_cuts(start: bytes, stop: bytes, buckets: int) -> list[tuple[int, bytes]]:
    """The first key of each of ``buckets`` even cuts of [start, stop), with the bucket's number.

    Keys are whole numbers of any length, with eight bytes more than the longer bound, so that keys
    which share a long prefix are cut too.  Buckets too narrow for a key of their own are left out.
    """
    if start >= stop:
        raise ValueError("start must be before stop")
    width = max(len(start), len(stop)) + 8
    low, high = (int.from_bytes(key.ljust(width, b"\x00")) for key in (start, stop))
    firsts = {low - (low - high) * i // buckets: i for i in range(buckets)}  # rounded up
    return [(i, key.to_bytes(width).rstrip(b"\x00")) for key, i in firsts.items()]


def row_sizes(cells: DataFrame) -> DataFrame:
    return cells.groupBy("row").agg(
        F.count(F.lit(1)).alias("cells"), F.sum(stored_cell_size()).alias("bytes")
    )


def uniform_buckets(cells: DataFrame, start: bytes, stop: bytes, buckets: int) -> DataFrame:
    """Cells and bytes in each of ``buckets`` even cuts of the key space [start, stop).

    Rows are added up first, so what is put into buckets is one record per row.
    """
    inside = cells.where((F.col("row") >= F.lit(start)) & (F.col("row") < F.lit(stop)))
    return _in_buckets(row_sizes(inside), start, stop, buckets)


def even_buckets(cells: DataFrame, buckets: int) -> DataFrame:
    """``uniform_buckets`` of the key space from the first key to the last; the cells are read once."""
    rows = settle(row_sizes(cells), "rows")
    first, last = rows.agg(F.min("row"), F.max("row")).first()
    if first is None:
        return rows.select(F.lit(0).cast("bigint").alias("bucket"), "cells", "bytes")
    return _in_buckets(rows, bytes(first), bytes(last) + b"\x00", buckets)


def _in_buckets(rows: DataFrame, start: bytes, stop: bytes, buckets: int) -> DataFrame:
    cuts = rows.sparkSession.createDataFrame(
        even_cuts(start, stop, buckets), "bucket bigint, span_start binary"
    )
    return locate(rows, "row", cuts).groupBy("bucket").agg(
        F.sum("cells").alias("cells"), F.sum("bytes").alias("bytes")
    )
