from __future__ import annotations

from pyspark.sql import functions as F

from cellarium.operators import compare as c


def two_tables():
    """100 equal rows, then rows missing, cells missing, values different on either side."""
    source, target = [], []
    for i in range(160):
        row = f"{i:04d}"
        cells = [(row, "cf", q, 1, "v") for q in ("c1", "c2")] + [(row, "cf", "c3", 1, "w")]
        if i < 100:
            source += cells
            target += cells
        elif i < 110:
            source += cells  # not in target
        elif i < 120:
            target += cells  # not in source
        elif i < 130:
            source += cells
            target += cells[:1]  # two cells missing
        elif i < 140:
            source += cells[:1]
            target += cells
        else:
            source += cells
            target += [(*cells[0][:4], "other"), *cells[1:]]
    return source, target


def test_counters(skewed, make_cells):
    source, target = (make_cells(t) for t in two_tables())
    counts = c.cell_diff_counts(source, target).first().asDict()
    assert counts == {
        "rows_with_diffs": 60, "source_missing_rows": 10, "target_missing_rows": 10,
        "source_missing_cells": 50, "target_missing_cells": 50, "different_values": 20,
    }
    verdicts = {r.verdict: r.rows for r in c.verdict_counts(c.compare_rows(source, target)).collect()}
    assert verdicts == {c.MATCH: 100, c.SOURCE_MISSING: 10, c.TARGET_MISSING: 10, c.DIFFERENT: 40}


def test_repair(skewed, make_cells, listed):
    source, target = (make_cells(t) for t in two_tables())
    assert listed(c.repair(source, target)) == listed(target)
    assert listed(c.repair(source, target, dry_run=False)) == listed(source)
    assert c.cell_diff(source, c.repair(source, target, dry_run=False)).isEmpty()
    kept = listed(c.repair(source, target, dry_run=False, deletes=False))
    assert kept == sorted(set(listed(source)) | {x for x in listed(target) if x[4] != "other"})


def test_timestamps_can_be_ignored(skewed, make_cells):
    source = make_cells([("r", "f", "q", ts, v) for ts, v in ((1, "a"), (2, "b"), (3, "b"))])
    shifted = make_cells([("r", "f", "q", ts, v) for ts, v in ((11, "a"), (12, "b"), (13, "b"))])
    assert c.cell_diff(source, shifted).count() == 6
    assert c.cell_diff(source, shifted, ignore_timestamps=True).isEmpty()
    longer = shifted.unionByName(make_cells([("r", "f", "q", 14, "z")]))
    diff = c.cell_diff(source, longer, ignore_timestamps=True).collect()
    assert {(r.ts, r.verdict) for r in diff} == {(1, c.DIFFERENT), (4, c.SOURCE_MISSING)} | {
        (3, c.DIFFERENT)
    }


def ranges_of(make_cells, rows, size=28):
    return c.range_bounds(c.hash_ranges(make_cells(rows), size))


def verdicts(ranges, target):
    return {bytes(r.start): r.matches for r in c.sync_ranges(ranges, target).collect()}


def test_ranges(skewed, make_cells):
    rows = [(k, "f", "q", 1, k) for k in "bdfh"]
    ranges = ranges_of(make_cells, rows)  # one row each
    bounds = sorted((bytes(r.start), r.stop and bytes(r.stop)) for r in ranges.collect())
    assert bounds == [(b"", b"d"), (b"d", b"f"), (b"f", b"h"), (b"h", None)]
    same = dict.fromkeys([b"", b"d", b"f", b"h"], True)
    assert verdicts(ranges, make_cells(rows)) == same
    changed = lambda *extra: make_cells(rows + list(extra))
    # Rows before the first and after the last key belong to the open ends.
    assert verdicts(ranges, changed(("a", "f", "q", 1, "x"))) == same | {b"": False}
    assert verdicts(ranges, changed(("z", "f", "q", 1, "x"))) == same | {b"h": False}
    assert verdicts(ranges, changed(("e", "f", "q", 1, "x"))) == same | {b"d": False}
    assert verdicts(ranges, make_cells(rows[:1] + rows[2:])) == same | {b"d": False}
    assert verdicts(ranges, make_cells([(k, "f", "q", 1, "other") for k in "bdfh"])) == dict.fromkeys(same, False)
    empty = c.sync_counts(c.sync_ranges(ranges, make_cells([]))).first()
    assert (empty.matches, empty.mismatches) == (0, 4)


def test_digest_sees_every_field(spark, make_cells):
    base = ("row", "fam", "qual", 5, "val")
    others = [("rowf", "am", "qual", 5, "val"), ("row", "famq", "ual", 5, "val"),
              ("row", "fam", "qual", 6, "val"), ("row", "fam", "qual", 5, "va"),
              ("row", "fam", "qual5", 5, "val")]
    digest = lambda cell: c.hash_rows(make_cells([cell])).first().hash
    assert len({digest(cell) for cell in [base, *others]}) == 6


def test_digest_is_a_partial_aggregate_without_sort(spark, make_cells):
    plan = c.row_digests(make_cells([("r", "f", "q", 1, "v")]))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan") :]
    assert physical.count("HashAggregate") == 2 and "Sort" not in physical
    assert "collect_list" not in physical


def test_reconcile(spark):
    primary = spark.createDataFrame([(1, True), (2, True), (3, False), (4, False)], "seq bigint, ok boolean")
    secondary = spark.createDataFrame([(1, True), (2, False), (3, True)], "seq bigint, ok boolean")
    got = {r.seq: r.failed_on for r in c.reconcile(primary, secondary).collect()}
    assert got == {1: "none", 2: "secondary", 3: "primary", 4: "both"}


def test_sampled_rows_are_compared_whole(spark, make_cells):
    source, target = (make_cells(t) for t in two_tables())
    some = F.col("row") < F.lit(b"0125")
    counts = c.verdict_counts(c.compare_rows(source.where(some), target.where(some))).collect()
    assert sum(r.rows for r in counts) == 125


def test_each_difference_is_delivered_once(spark, make_cells, tmp_path):
    source, target = (make_cells(t) for t in two_tables())
    diff = c.cell_diff(source, target)
    folder = str(tmp_path)

    def detector(part, rows):
        with open(f"{folder}/{part}", "a") as out:
            for r in rows.to_pylist():
                out.write(f"{r['row'].decode()} {r['qualifier'].decode()} {r['ts']} {r['verdict']}\n")
        return rows.num_rows

    told = c.deliver(diff, detector).collect()
    assert sum(r.differences for r in told) == sum(r.handled for r in told)
    want = sorted(f"{bytes(r.row).decode()} {bytes(r.qualifier).decode()} {r.ts} {r.verdict}" for r in diff.collect())
    assert sorted(line for p in tmp_path.iterdir() for line in p.read_text().splitlines()) == want != []
    assert {int(p.name) for p in tmp_path.iterdir()} == {r.part for r in told}
    assert c.deliver(diff.limit(0), detector).collect() == []
