"""Point reads and size estimates by a manifest of footers."""

from __future__ import annotations

import os

import pytest
from pyarrow import parquet
from pyspark.sql import functions as F

from cellarium.model import CELL_SCHEMA
from cellarium.operators.scan import exists_all, get_row, multi_get
from cellarium.plans.keyspace import KeySet, Span
from cellarium.sources import manifest as m
from cellarium.sources.tables import read_cells


def key(k):
    return b"r%05d" % k


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Even keys; one row lies over several files."""
    path = str(tmp_path_factory.mktemp("cells") / "indexed")
    cells = spark.range(0, 4000).select(
        F.format_string("r%05d", F.when(F.col("id").between(1000, 2499), 2000).otherwise(F.col("id") * 2))
        .cast("binary").alias("row"),
        F.lit("f").alias("family"), F.col("id").cast("string").cast("binary").alias("qualifier"),
        F.col("id").alias("ts"), F.lit("v").cast("binary").alias("value"),
    )
    m.export_indexed(cells, path, parts=16)
    return path


def keys_of(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "row binary")


def holding(spark, path, keys):
    """By brute force: files with a row group whose bounds take in a key."""
    groups = m.read_manifest(spark, path).collect()
    return {g.file for g in groups if any(g.first_row <= k <= g.last_row for k in keys if k is not None)}


def check_files(spark, stored, keys):
    found = m.groups_holding(m.read_manifest(spark, stored), keys_of(spark, keys))
    assert {r.file for r in found.collect()} == holding(spark, stored, keys)
    wanted = {k for k in keys if k is not None}
    if wanted:
        test = F.col("row").isin(*wanted)
        cells = m.read_holding(spark, stored, keys_of(spark, keys))
        assert cells.where(test).count() == read_cells(spark, stored).where(test).count()


@pytest.mark.parametrize("keys", [
    [key(2000), None], [key(1)], [b"a"], [b"z"], [key(k) for k in (6, 6, 31, 4000, 8000)], [key(k) for k in range(6000, 6600)], [],
], ids=len)
def test_only_files_that_may_hold_a_key_are_read(spark, stored, keys):
    check_files(spark, stored, keys)


def test_hot_paths_choose_the_same_files(spark, stored, skewed):
    check_files(spark, stored, [key(k) for k in (2000, 1, 6, 5001, 7998, 9000)])


def test_one_neighbourhood_is_one_or_two_files(spark, stored):
    assert len(read_cells(spark, stored).inputFiles()) == 16
    assert len(holding(spark, stored, [key(2000)])) > 3
    few = m.read_holding(spark, stored, keys_of(spark, [key(6000), key(6002)]))
    assert len(few.inputFiles()) <= 2


def test_point_reads_agree_with_plain_ones(spark, stored):
    asked = [(k, key(3 * k)) for k in range(700)] + [(900, key(2000)), (901, key(2000)), (902, None)]
    requests = spark.createDataFrame(asked, "request bigint, row binary")
    plain, indexed = read_cells(spark, stored), m.read_holding(spark, stored, requests)
    assert sorted(map(str, multi_get(indexed, requests).collect())) == sorted(
        map(str, multi_get(plain, requests).collect())
    )
    assert sorted(map(str, exists_all(indexed, requests).collect())) == sorted(
        map(str, exists_all(plain, requests).collect())
    )
    one = m.read_holding(spark, stored, keys_of(spark, [key(8)]))
    assert [bytes(r.row) for r in get_row(one, key(8)).collect()] == [key(8)]


def test_an_absent_key_is_told_by_the_filter(spark, tmp_path):
    """Keys between the bounds of a row group that are not in it: no row leaves the scan."""
    path = str(tmp_path / "bloom")
    wide = spark.range(0, 60_000).select(
        F.concat(F.sha2(F.col("id").cast("string"), 512), F.lit("x" * 60)).cast("binary").alias("row"), F.lit("f").alias("family"),
        F.lit(b"q").alias("qualifier"), F.lit(1).cast("bigint").alias("ts"), F.lit(b"v").alias("value"),
    )
    m.export_indexed(wide, path, parts=1, keys_per_group=60_000)
    cells = m.read_holding(spark, path, keys_of(spark, [b"7" * 188]))
    assert cells.collect() == [] and len(cells.inputFiles()) == 1
    # Beside the columns the file holds a filter of 60,000 keys, ten bits or so each.
    file = cells.inputFiles()[0].removeprefix("file://")
    footer = parquet.read_metadata(file)
    columns = [footer.row_group(g).column(c) for g in range(footer.num_row_groups) for c in range(5)]
    assert os.path.getsize(file) > sum(c.total_compressed_size for c in columns) + 60_000


def test_estimate_bounds(spark, stored):
    groups = m.read_manifest(spark, stored)
    cells = read_cells(spark, stored)
    most = max(g.cells for g in groups.collect())
    for rows in (KeySet.all(), KeySet.none(), KeySet.between(key(100), key(5000)), KeySet.prefix("r02"),
                 KeySet.point(key(2000)), KeySet.between("z"), KeySet.between(stop="a"),
                 KeySet([Span(key(k), key(k + 50)) for k in range(0, 8000, 1000)])):
        exact = cells.where(rows.test(F.col("row"))).count()
        found = m.estimated_size(groups, rows).first()
        assert found.cells_low <= exact <= found.cells_high
        assert found.cells_low <= found.cells <= found.cells_high
        assert found.cells_high - found.cells_low <= 2 * most * max(1, len(rows.spans)) or exact >= 1500
        assert found.bytes_low <= found.bytes <= found.bytes_high
    assert m.estimated_size(groups, KeySet.all()).first().cells == 4000


def test_unsorted_files_and_groups_without_bounds(spark, tmp_path):
    path = str(tmp_path / "mixed")
    rows = [(key(k * 37 % 500), "f", b"q", k, b"v") for k in range(500)] + [(b"k" * 5000, "f", b"q", 1, b"v")]
    spark.createDataFrame(rows, CELL_SCHEMA).repartition(5).write.parquet(path)
    m.write_manifest(spark, path)
    groups = m.read_manifest(spark, path)
    assert groups.where("first_row IS NULL").count() == 1
    for keys in ([key(3)], [b"k" * 5000], [key(k) for k in range(0, 500, 9)]):
        cells = m.read_holding(spark, path, keys_of(spark, keys))
        assert cells.where(F.col("row").isin(*keys)).count() == len(keys)
    found = m.estimated_size(groups, KeySet.between(key(10), key(20))).first()
    assert found.cells_low <= 10 <= found.cells_high


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "empty")
    m.export_indexed(spark.createDataFrame([], CELL_SCHEMA), path)
    assert m.read_holding(spark, path, keys_of(spark, [b"a"])).count() == 0
    assert m.estimated_size(m.read_manifest(spark, path), KeySet.all()).first().cells_high == 0
