from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cellarium.model import from_wide, to_wide
from cellarium.operators import compare as c
from cellarium.operators import importing as imp
from cellarium.operators import splits as s
from cellarium.operators.filters import FamilyIs
from cellarium.operators.scan import ScanSpec, locate
from cellarium.sources import tables as t


@pytest.fixture
def typed(spark):
    schema = (
        "row binary, family string, qualifier binary, ts bigint, value binary, type string"
    )

    def make(rows):
        data = [(r.encode(), f, q.encode(), ts, b"v", kind) for r, f, q, ts, kind in rows]
        return spark.createDataFrame(data, schema)

    return make


def test_delete_markers(skewed, typed, listed):
    puts = [("r", f, q, ts, "PUT") for f in ("a", "b") for q in ("x", "y") for ts in (10, 20, 30)]
    live = lambda *marks: {c[1:4] for c in listed(imp.mask_tombstones(typed(puts + list(marks))))}
    everything = {p[1:4] for p in puts}
    assert live() == everything
    assert live(("r", "a", "x", 20, imp.DELETE)) == everything - {("a", "x", 20)}
    assert live(("r", "a", "x", 25, imp.DELETE)) == everything
    assert live(("r", "a", "", 20, imp.DELETE_FAMILY_VERSION)) == everything - {("a", "x", 20), ("a", "y", 20)}
    assert live(("r", "a", "x", 20, imp.DELETE_COLUMN), ("r", "a", "x", 5, imp.DELETE_COLUMN)) == everything - {
        ("a", "x", 10), ("a", "x", 20)}
    assert live(("r", "a", "", 20, imp.DELETE_FAMILY)) == {k for k in everything if k[0] == "b" or k[2] > 20}
    assert live(("other", "a", "", 99, imp.DELETE_FAMILY)) == everything


def test_chunks(skewed, make_cells):
    cells = make_cells([("wide", "f", f"q{i:03d}", 1, "v") for i in range(23)] + [("small", "f", "q", 1, "v")])
    got = imp.chunk_rows(cells, 10).groupBy("row", "chunk").agg(F.count("*").alias("n"), F.min("qualifier").alias("q"))
    found = {(bytes(r.row), r.chunk): (r.n, bytes(r.q)) for r in got.collect()}
    assert found == {(b"wide", 0): (10, b"q000"), (b"wide", 1): (10, b"q010"), (b"wide", 2): (3, b"q020"),
                     (b"small", 0): (1, b"q")}


def guard(cells, **limits):
    all_off = dict(row_key_bytes=None, cell_bytes=None, row_bytes=None, row_cells=None)
    chosen = imp.Limits(**(all_off | limits))
    kept = {(bytes(r.row).decode(), bytes(r.qualifier).decode()) for r in imp.size_guards(cells, chosen).collect()}
    return kept, tuple(imp.size_guard_counts(cells, chosen).first())


def test_size_guards(skewed, make_cells):
    cells = make_cells([("k", "f", "a", 1, "x" * 50), ("k", "f", "b", 1, "y"), ("longkey", "f", "a", 1, "z")])
    both = {("k", "a"), ("k", "b"), ("longkey", "a")}
    assert guard(cells) == (both, (0, 0, 0))
    assert guard(cells, cell_bytes=49) == (both - {("k", "a")}, (0, 1, 0))
    assert guard(cells, row_key_bytes=6) == (both - {("longkey", "a")}, (1, 0, 0))
    # 24 bytes of overhead, then key, family, qualifier and value of each cell.
    size = (24 + 1 + 1 + 1 + 50) + (24 + 1 + 1 + 1 + 1)
    assert guard(cells, row_bytes=size)[1] == (0, 0, 0)
    assert guard(cells, row_bytes=size - 1) == ({("longkey", "a")}, (0, 0, 1))
    # A large cell does not count towards its row.
    assert guard(cells, cell_bytes=49, row_bytes=40) == (both - {("k", "a")}, (0, 1, 0))
    # All cells dropped: the row counts as dropped.
    assert guard(cells.where("row = 'k' AND qualifier = 'a'"), cell_bytes=49) == (set(), (0, 1, 1))


def test_wide_rows_are_dropped_only_over_the_threshold(skewed, make_cells):
    cells = make_cells([("r", "f", f"q{i}", 1, "v" * (99 if i in (1, 8) else 1)) for i in range(10)])
    assert guard(cells, row_cells=10)[1] == (0, 0, 0)
    assert guard(cells, row_cells=9) == (set(), (0, 0, 1))
    # The row is given up at its fourth kept cell: the second large cell is never seen.
    assert guard(cells, row_cells=3, cell_bytes=50) == (set(), (0, 1, 1))


def test_round_trip(spark, make_cells, listed, tmp_path):
    rows = [(r, "column_family", q, ts, f"{q}{ts}") for r in ("row_key_1", "row_key_2")
            for q, ts in (("col1", 1), ("col1", 2), ("col2", 1), ("col2", 3))]
    cells, path = make_cells(rows), str(tmp_path / "out")
    t.export_cells(cells, path)
    read = t.import_cells(t.read_cells(spark, path + "/*.parquet"))
    assert listed(read) == listed(cells) and {r.chunk for r in read.collect()} == {0}
    newest = str(tmp_path / "newest")
    t.export_cells(cells, newest, ScanSpec(filter=FamilyIs("column_family")))
    assert [c[3] for c in listed(t.read_cells(spark, newest))] == [2, 3, 2, 3]


def test_exported_files_are_sorted_and_a_wide_row_spans_files(spark, make_cells, tmp_path):
    cells = make_cells([("wide", "f", f"q{i:04d}", i % 3, "v") for i in range(900)] + [("a", "f", "q", 1, "v")])
    path = str(tmp_path / "out")
    t.export_cells(cells.repartition(3), path, parts=4)
    files = t.read_cells(spark, path).select(F.input_file_name().alias("file"), "row", "qualifier").collect()
    by_file = {}
    for r in files:
        by_file.setdefault(r.file, []).append((bytes(r.row), bytes(r.qualifier)))
    assert len(by_file) >= 3 and all(keys == sorted(keys) for keys in by_file.values())


def test_regions_never_share_a_file(spark, make_cells, tmp_path):
    cells = make_cells([(f"{i:03d}", "f", "q", 1, "v") for i in range(60)])
    splits = spark.createDataFrame([(b"",), (b"020",), (b"045",)], "start binary")
    t.write_regions(cells, splits, str(tmp_path / "out"))
    found = t.read_regions(spark, str(tmp_path / "out")).groupBy("region").agg(
        F.min("row").alias("lo"), F.max("row").alias("hi")
    )
    named = found.join(t.region_starts(spark, str(tmp_path / "out")), "region").collect()
    got = {bytes(r.start): (bytes(r.lo), bytes(r.hi)) for r in named}
    assert got == {b"": (b"000", b"019"), b"020": (b"020", b"044"), b"045": (b"045", b"059")}


@pytest.mark.parametrize("searched", ["200", "1"])
def test_split_keys_of_any_length(spark, make_cells, tmp_path, searched):
    spark.conf.set("spark.cellarium.searchedSpans", searched)
    try:
        cells = make_cells([(f"{'k' * 200}{i}", "f", "q", 1, "v") for i in range(9)])
        splits = spark.createDataFrame([(b"",), (b"k" * 200 + b"4",), (b"z" * 9000,)], "start binary")
        path = str(tmp_path / "out")
        t.write_regions(cells, splits, path)
        found = t.read_regions(spark, path).join(t.region_starts(spark, path), "region").collect()
    finally:
        spark.conf.unset("spark.cellarium.searchedSpans")
    assert len(found) == 9
    assert {bytes(r.start)[-1:] for r in found if bytes(r.row)[-1:] < b"4"} == {b""}
    assert {bytes(r.start)[-1:] for r in found if bytes(r.row)[-1:] >= b"4"} == {b"4"}


def test_few_split_points_cost_no_shuffle_before_the_last_one(spark, make_cells, tmp_path):
    path = str(tmp_path / "cells")
    make_cells([(f"{i:03d}", "f", "q", 1, "v") for i in range(60)]).write.parquet(path)
    spans = spark.createDataFrame([(b"", 1), (b"020", 2)], "span_start binary, region int")
    plan = locate(spark.read.parquet(path), "row", spans)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "ShuffleQueryStage" not in plan and "hashpartitioning" not in plan


def test_doubled_cells_do_not_match(spark, make_cells):
    twice = make_cells([("a", "f", "q", 1, "v"), ("a", "f", "q", 1, "v"), ("b", "f", "q", 1, "v")])
    once = make_cells([("b", "f", "q", 1, "v")])
    ranges = c.hash_ranges(twice, 10_000)
    assert [r.matches for r in c.sync_ranges(ranges, once).collect()] == [False]
    assert [r.matches for r in c.sync_ranges(ranges, twice).collect()] == [True]


def test_snapshot_specs(spark):
    assert t.snapshot_tables("a:x, b ,") == {"a": "x", "b": "b"}
    for bad in ("a:b:c", ":x", "a:"):
        with pytest.raises(ValueError):
            t.snapshot_tables(bad)
    names = spark.createDataFrame([("snap1",), ("snap2",), ("other",), ("my.snap",)], "snapshot string")
    pick = lambda spec: sorted(r.snapshot for r in t.select_snapshots(names, spec).collect())
    assert pick("*") == ["my.snap", "other", "snap1", "snap2"]
    assert pick("snap*") == ["snap1", "snap2"] and pick("snap1") == ["snap1"]
    assert pick("my.*") == ["my.snap"] and pick("snap.+") == ["snap1", "snap2"]
    assert pick("snap1:t,nope") == ["snap1"]


def test_rows_of_two_snapshots_are_guarded_apart(spark, make_cells, tmp_path):
    cells = make_cells([("r", "f", f"q{i}", 1, "v") for i in range(3)])
    both = cells.withColumn("snapshot", F.lit("a")).unionByName(cells.withColumn("snapshot", F.lit("b")))
    both.write.partitionBy("snapshot").parquet(str(tmp_path / "in"))
    t.import_snapshots(spark, str(tmp_path / "in"), {"a": "ta", "b": "tb"}, imp.Limits(row_cells=4), str(tmp_path / "out"))
    counts = imp.multi_table_counts(t.read_tables(spark, str(tmp_path / "out"))).collect()
    assert {(r.table, r.rows, r.cells) for r in counts} == {("ta", 1, 3), ("tb", 1, 3)}


def test_key_ranges(skewed):
    keys = skewed.createDataFrame([(k,) for k in (b"", b"m", b"f", b"m")], "key binary")
    got = sorted((bytes(r.start), r.stop and bytes(r.stop)) for r in s.key_ranges(keys).collect())
    assert got == [(b"", b"f"), (b"f", b"m"), (b"m", None)]
    none = s.key_ranges(keys.limit(0)).collect()
    assert [(bytes(r.start), r.stop) for r in none] == [(b"", None)]


def test_balanced_splits(skewed):
    sizes = [10, 20, 500, 30, 30, 30, 30, 700, 0, 5]
    rows = [(bytes([i]), bytes([i + 1]) if i < 9 else None, n) for i, n in enumerate(sizes)]
    regions = skewed.createDataFrame(rows, "start binary, stop binary, bytes bigint")
    got = sorted(s.balanced_splits(regions, 100).collect(), key=lambda r: bytes(r.start))
    assert [(r.bytes, r.ranges) for r in got] == [(30, 2), (500, 1), (120, 4), (700, 1), (5, 2)]
    for left, right in zip(got, got[1:], strict=False):
        assert bytes(left.stop) == bytes(right.start)
    assert got[-1].stop is None


@pytest.mark.parametrize("prefix", [b"", b"user:", b"a long shared prefix "])
@pytest.mark.parametrize("buckets", [7, 300])
def test_uniform_buckets(spark, make_cells, buckets, prefix):
    keys = [prefix + bytes([a, c]) for a in range(1, 200, 3) for c in (0, 77, 255)] + [prefix + b"\x20"]
    cells = make_cells([(k, "f", "q", 1, "v") for k in keys])
    start, stop = prefix + b"\x20", prefix + b"\xa0"
    width = len(prefix) + 9
    low, high = (int.from_bytes(k.ljust(width, b"\x00")) for k in (start, stop))
    want = {}
    for k in keys:
        n = int.from_bytes(k.ljust(width, b"\x00"))
        if low <= n < high:
            bucket = (n - low) * buckets // (high - low)
            want[bucket] = want.get(bucket, 0) + 1
    got = s.uniform_buckets(cells, start, stop, buckets).collect()
    assert {r.bucket: r.cells for r in got} == want


def test_even_buckets_span_the_keys(spark, make_cells):
    keys = [b"user:" + bytes([a, c]) for a in range(1, 200, 7) for c in (0, 255)]
    cells = make_cells([(k, "f", "q", ts, "v") for k in keys for ts in (1, 2)])
    whole = s.uniform_buckets(cells, min(keys), max(keys) + b"\x00", 7)
    assert sorted(s.even_buckets(cells, 7).collect()) == sorted(whole.collect())
    assert s.even_buckets(cells.limit(0), 7).collect() == []


def test_neighbouring_keys_are_cut_evenly(spark, make_cells):
    cells = make_cells([(f"user:{i:04d}", "f", "q", 1, "v") for i in range(8)])
    got = s.uniform_buckets(cells, b"user:0000", b"user:0008", 4).collect()
    assert {r.bucket: r.cells for r in got} == {0: 2, 1: 2, 2: 2, 3: 2}


def test_shards_cover_everything_once(spark, make_cells):
    cells = make_cells([(f"r{i}", "f", "q", 1, "v") for i in range(50)])
    parts = [{bytes(r.row) for r in s.select_shard(cells, F.col("row"), 3, i).collect()} for i in range(3)]
    assert sum(map(len, parts)) == 50 and len(set().union(*parts)) == 50
    with pytest.raises(ValueError):
        s.select_shard(cells, F.col("row"), 3, 3)


def test_wide_tables(spark, listed):
    df = spark.createDataFrame([(1, "x", None, 5), (2, "y", 7, 6)], "id int, a string, b int, t bigint")
    cells = from_wide(df, F.col("id"), {("f", "a"): F.col("a"), ("f", "b"): F.col("b")}, F.col("t"))
    assert listed(cells) == [("1", "f", "a", 5, "x"), ("2", "f", "a", 6, "y"), ("2", "f", "b", 6, "7")]
    wide = to_wide(cells, {"a": ("f", "a"), "b": ("f", "b")}).collect()
    assert {(bytes(r.row), bytes(r.a), r.b and bytes(r.b)) for r in wide} == {(b"1", b"x", None), (b"2", b"y", b"7")}
