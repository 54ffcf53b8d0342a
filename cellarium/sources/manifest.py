"""A manifest of a cell table: what the footers of its files tell about row keys and sizes.

One record per row group: file, place in it, cells, stored bytes, first and last row key.  It is
written once after an export (``write_manifest``, again after files were added or removed) and
answers two things without reading a cell: which files may hold given row keys, and how large a key range is.

Footers are read in tasks, a few kilobytes at the end of each file.  A row group whose footer has no key
bounds (other writers; keys over 4 KB) may hold any key.  Tables need not be sorted: ``reach`` is the
largest last key up to a row group, so the groups that may hold a key lie between two places in
the order of first keys; in a sorted table exactly the groups that do.  Null keys are asked for in vain.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyarrow import parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellarium.model import ROW, layout
from cellarium.operators.scan import PREDICATE_SPANS, ScanSpec, locate, scan
from cellarium.plans.keyspace import KeySet
from cellarium.plans.skew import running
from cellarium.sources.tables import ALL_VERSIONS, read_cells

MANIFEST = "_manifest"
GROUPS = "file string, place int, cells bigint, bytes bigint, first_row binary, last_row binary"
PLACED = f"{GROUPS}, nth bigint, reach binary"


def export_indexed(
    cells: DataFrame,
    path: str,
    spec: ScanSpec = ALL_VERSIONS,
    compression: str = "zstd",
    parts: int | None = None,
    keys_per_group: int = 1_000_000,
) -> None:
    """Writes the selected cells in key order with Bloom filters on the row key, and the manifest.

    The filters tell absent keys from present ones where the key bounds do not; ``keys_per_group``
    sizes them.  Row groups whose keys fit a dictionary have that in place of a filter.
    """
    writer = layout(scan(cells, spec), parts).write.option("compression", compression)
    writer = writer.option("parquet.bloom.filter.enabled#row", "true")
    writer.option("parquet.bloom.filter.expected.ndv#row", str(keys_per_group)).parquet(path)
    write_manifest(cells.sparkSession, path)


def write_manifest(spark: SparkSession, path: str) -> None:
    """Reads the footers of all Parquet files under ``path`` and stores the manifest beside them."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    files = listed.option("recursiveFileLookup", "true").load(path).select("path")
    order = [F.col("first_row").asc_nulls_first(), F.col("last_row").asc(), F.col("file"), F.col("place")]
    one = F.lit(1).cast("bigint")
    placed = running(
        files.mapInArrow(_footers, GROUPS), [], order,
        {"nth": ("sum", one), "reach": ("max", F.col("last_row"))},
    )
    placed.write.mode("overwrite").parquet(f"{path}/{MANIFEST}")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PLACED).parquet(f"{path}/{MANIFEST}")


def _open(path: str) -> pa.NativeFile:
    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + path[5:].lstrip("/"))
    store, inside = fs.FileSystem.from_uri(quote(path, safe=":/@=+,~"))
    return store.open_input_file(inside)


def _footers(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("file", pa.string()), ("place", pa.int32()), ("cells", pa.int64()), ("bytes", pa.int64()),
         ("first_row", pa.binary()), ("last_row", pa.binary())]
    )
    for batch in rows:
        for path in batch.column(0).to_pylist():
            with _open(path) as file:
                footer = pq.read_metadata(file)
            groups = [_group(path, k, footer.row_group(k)) for k in range(footer.num_row_groups)]
            yield pa.RecordBatch.from_pylist(groups, schema)


def _group(path: str, place: int, group) -> dict:
    columns = [group.column(k) for k in range(group.num_columns)]
    keys = next((c.statistics for c in columns if c.path_in_schema == ROW[0]), None)
    known = keys is not None and keys.has_min_max
    return {
        "file": path,
        "place": place,
        "cells": group.num_rows,
        "bytes": sum(c.total_compressed_size for c in columns),
        "first_row": keys.min if known else None,
        "last_row": keys.max if known else None,
    }


def groups_holding(groups: DataFrame, keys: DataFrame) -> DataFrame:
    """The row groups of a manifest that may hold one of the ``row`` keys.

    A key opens a stretch of neighbouring groups.  Starts and ends of the stretches are
    counted along the order, so a key over many groups or a group of many keys makes no pairs.
    """
    known = groups.where(F.col("first_row").isNotNull())
    begun = known.groupBy(F.col("first_row").alias("span_start")).agg(F.max("nth").alias("_upto"))
    # A group ends before a key if its reach and a further zero byte, the next key, is not above it.
    ended = known.groupBy(F.concat("reach", F.lit(b"\x00")).alias("span_start")).agg(F.max("nth").alias("_below"))
    rows = keys.select("row").where(F.col("row").isNotNull()).distinct()
    placed = locate(rows, "row", begun).select("row", "_upto")
    placed = locate(placed, "row", ended).select(
        (F.coalesce("_below", F.lit(0)) + 1).alias("_first"), F.col("_upto").alias("_last")
    )
    placed = placed.where(F.col("_first") <= F.col("_last"))
    edge = F.inline(
        F.array(
            F.struct(F.col("_first").alias("nth"), F.lit(1).alias("_step")),
            F.struct((F.col("_last") + 1).alias("nth"), F.lit(-1).alias("_step")),
        )
    )
    edges = placed.select(edge).groupBy("nth").agg(F.sum("_step").alias("_step"))
    walked = running(
        known.unionByName(edges, allowMissingColumns=True),
        [],
        [F.col("nth").asc(), F.col("file").asc_nulls_first()],
        {"_open": ("sum", F.col("_step"))},
    )
    held = walked.where("file IS NOT NULL AND _open > 0").select(*groups.columns)
    return held.unionByName(groups.where(F.col("first_row").isNull()))


def read_holding(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """Cells of the files that may hold one of the ``row`` keys; other files are not opened.

    For ``multi_get``, ``exists_all`` and ``get_row``.  Few keys go into the predicate too, where row
    groups are skipped by bounds, dictionaries and Bloom filters.  The names of the chosen files pass the
    driver, as they do in any read.
    """
    held = groups_holding(read_manifest(spark, path), keys).select("file").distinct()
    files = [name for (name,) in held.collect()]
    if not files:
        return read_cells(spark, f"{path}/{MANIFEST}").where(F.lit(False))
    cells = read_cells(spark, files)
    asked = keys.select("row").where(F.col("row").isNotNull()).distinct().limit(PREDICATE_SPANS + 1)
    asked = [bytes(key) for (key,) in asked.collect()]
    if len(asked) > PREDICATE_SPANS:
        return cells
    return cells.where(KeySet.points(asked).test(F.col("row")))


def estimated_size(groups: DataFrame, rows: KeySet) -> DataFrame:
    """Cells and stored bytes of a key set, from a manifest alone.

    ``*_low`` counts the row groups that lie inside, ``*_high`` all that meet it, and the
    estimate lies half way; they differ by the row groups over an edge of a span.
    """
    spans = rows.spans
    listed = [
        (s.start, s.stop, spans[k + 1].start if k + 1 < len(spans) else None)
        for k, s in enumerate(spans)
    ]
    side = groups.sparkSession.createDataFrame(
        listed, "span_start binary, span_stop binary, _next binary"
    )
    if spans:
        at = locate(groups, "first_row", side)
    else:
        blank = [F.lit(None).cast("binary").alias(c) for c in side.columns]
        at = groups.where(F.lit(False)).select("*", *blank)
    unknown = F.col("first_row").isNull()
    within = F.col("span_start").isNotNull()
    endless = F.col("span_stop").isNull()
    inside = within & (endless | (F.col("last_row") < F.col("span_stop"))) & ~unknown
    # Keys before the first span meet that one.
    later = F.when(within, F.col("_next")).otherwise(F.lit(spans[0].start if spans else None))
    meets = (
        unknown
        | (within & (endless | (F.col("first_row") < F.col("span_stop"))))
        | F.coalesce(later <= F.col("last_row"), F.lit(False))
    )

    def total(name: str, test):
        return F.coalesce(F.sum(F.when(test, F.col(name))), F.lit(0))

    sums = at.agg(
        *[total(c, test).alias(f"{c}_{end}") for c in ("cells", "bytes")
          for end, test in (("low", inside), ("high", meets))]
    )
    middle = [((F.col(f"{c}_low") + F.col(f"{c}_high")) / 2).cast("bigint").alias(c) for c in ("cells", "bytes")]
    return sums.select("*", *middle)
