"""Exported cell tables and snapshots as folders of Parquet files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellarium.model import CELL_SCHEMA, ROW, layout
from cellarium.operators.importing import (
    MAX_MUTATION_CELLS,
    Limits,
    chunk_rows,
    import_filter,
    mask_tombstones,
    rename_families,
    size_guards,
)
from cellarium.operators.scan import ScanSpec, locate, scan, searched_spans
from cellarium.plans.scratch import settle
from cellarium.plans.skew import attach, hot_keys, ranked

ALL_VERSIONS = ScanSpec(max_versions=None)


def export_cells(
    cells: DataFrame,
    path: str,
    spec: ScanSpec = ALL_VERSIONS,
    compression: str = "zstd",
    parts: int | None = None,
) -> None:
    """Writes the selected cells in key order; every version unless the spec says less."""
    chosen = layout(scan(cells, spec), parts)
    chosen.write.option("compression", compression).parquet(path)


def read_cells(spark: SparkSession, paths: str | list[str], typed: bool = False) -> DataFrame:
    """Exported cells; ``paths`` may hold glob patterns."""
    schema = T.StructType(CELL_SCHEMA.fields + [T.StructField("type", T.StringType())] * typed)
    return spark.read.schema(schema).parquet(*([paths] if isinstance(paths, str) else paths))


def import_cells(
    typed: DataFrame,
    row_test=None,
    cell_test=None,
    family_names: dict[str, str] | None = None,
    chunk: int = MAX_MUTATION_CELLS,
) -> DataFrame:
    """Filter, rename families, hide what delete markers cover, number the mutations."""
    # Counted on the input, where only the row keys have to be read.
    hot = hot_keys(typed, ROW)
    kept = import_filter(typed, row_test, cell_test)
    kept = rename_families(kept, family_names or {})
    live = mask_tombstones(kept) if "type" in kept.columns else kept
    return chunk_rows(live, chunk, hot)


def spread(cells: DataFrame, parts: int) -> DataFrame:
    """Spreads neighbouring keys over all writers, and one row's cells too.

    For sinks that suffer when every writer works on the same key range.
    """
    return cells.repartition(parts, F.xxhash64("row", "family", "qualifier", "ts"))


STARTS = "_starts"


def write_regions(cells: DataFrame, splits: DataFrame, path: str) -> None:
    """Sorted files that never cross a split point (column ``start``).

    Folders are named by the number of their region; ``region_starts`` has the keys, which may be of any
    length.  Files are cut by range of the whole cell key, so a region that holds most of the
    data is written by many tasks.  With few split points every cell finds its region where it lies.
    """
    spans = splits.select(F.col("start").alias("span_start")).distinct()
    spans = settle(ranked(spans, [], [F.col("span_start").asc()], "region"), "regions")
    spans.withColumnRenamed("span_start", "start").write.parquet(f"{path}/{STARTS}")
    if spans.count() <= searched_spans(cells):
        placed = locate(cells, "row", spans).drop("span_start")
    else:
        rows = locate(cells.select("row").distinct(), "row", spans)
        placed = attach(cells, settle(rows.select("row", "region"), "regions"), ROW)
    keys = ["region", "row", "family", "qualifier", F.col("ts").desc()]
    placed.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("append").partitionBy(
        "region"
    ).parquet(path)


def region_starts(spark: SparkSession, path: str) -> DataFrame:
    """(start, region) of the regions under ``path``."""
    return spark.read.schema("start binary, region bigint").parquet(f"{path}/{STARTS}")


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """All cells under ``path`` with the number of their region."""
    schema = T.StructType([*CELL_SCHEMA.fields, T.StructField("region", T.LongType())])
    return spark.read.schema(schema).parquet(path)


def write_tables(cells: DataFrame, path: str) -> None:
    """One folder per value of ``table``; a table may be written by many tasks."""
    cells.write.partitionBy("table").parquet(path)


def read_tables(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([*CELL_SCHEMA.fields, T.StructField("table", T.StringType())])
    return spark.read.schema(schema).parquet(path)


# ---- snapshots --------------------------------------------------------------

REGEX_MARKS = "*+?"


def snapshot_tables(spec: str) -> dict[str, str]:
    """``snap1:table1,snap2`` to names of snapshots and of their target tables."""
    chosen = {}
    for item in filter(None, (part.strip() for part in spec.split(","))):
        names = [name.strip() for name in item.split(":")]
        if len(names) > 2 or not all(names):
            raise ValueError(f"bad snapshot {item!r}, expected snapshot:table")
        chosen[names[0]] = names[-1]
    return chosen


def snapshot_pattern(spec: str) -> str | None:
    """``*`` for all, ``prefix*``, a plain name, or a regex found in the name."""
    if spec == "*":
        return None
    if spec.endswith("*") and not any(mark in spec[:-1] for mark in REGEX_MARKS):
        return "^" + re.escape(spec[:-1])
    if not any(mark in spec for mark in REGEX_MARKS):
        return "^" + re.escape(spec) + "$"
    return spec


def select_snapshots(names: DataFrame, spec: str) -> DataFrame:
    """(snapshot, table) for the wanted ones of ``names``."""
    if "," in spec or ":" in spec:
        pairs = list(snapshot_tables(spec).items())
        wanted = names.sparkSession.createDataFrame(pairs, "snapshot string, table string")
        return names.join(wanted, ["snapshot"])
    pattern = snapshot_pattern(spec)
    kept = names if pattern is None else names.where(F.col("snapshot").rlike(pattern))
    return kept.select("snapshot", F.col("snapshot").alias("table"))


def import_snapshots(
    spark: SparkSession, folder: str, tables: dict[str, str], limits: Limits, path: str
) -> None:
    """Reads snapshots ``folder/snapshot=<name>``, guards sizes, writes one table each."""
    schema = T.StructType([*CELL_SCHEMA.fields, T.StructField("snapshot", T.StringType())])
    cells = spark.read.schema(schema).parquet(folder).where(F.col("snapshot").isin(*tables))
    kept = size_guards(cells, limits, by=["snapshot", "row"])
    names = F.create_map(*[F.lit(text) for pair in tables.items() for text in pair])
    write_tables(
        kept.withColumn("table", F.element_at(names, F.col("snapshot"))).drop("snapshot"), path
    )
