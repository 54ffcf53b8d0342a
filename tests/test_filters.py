"""The filter algebra against a plain evaluator, and the behaviours users rely on."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cellarium.operators import filters as f
from cellarium.operators.scan import ScanSpec, reversed_rows, scan
from cellarium.plans.keyspace import KeySet

# ---- plain evaluator: a list of (row, family, qualifier, ts, value) in scan order


def order(cells):
    return sorted(cells, key=lambda c: (c[0], c[1], c[2], -c[3]))


def newest(cells, n=1):
    seen, out = {}, []
    for c in order(cells):
        seen[c[:3]] = seen.get(c[:3], 0) + 1
        if seen[c[:3]] <= n:
            out.append(c)
    return out


def place(cells, keep):
    seen, out = {}, []
    for c in order(cells):
        seen[c[0]] = seen.get(c[0], 0) + 1
        if keep(seen[c[0]]):
            out.append(c)
    return out


def rows(cells):
    return sorted({c[0] for c in cells})


def run(flt, cells):
    name = type(flt).__name__
    if name == "All":
        for member in flt.members:
            cells = run(member, cells)
        return cells
    if name == "Any":
        out = {}
        for member in reversed(flt.members):
            out.update({c[:4]: c for c in run(member, cells)})
        return order(out.values())
    if name == "Value":
        ops = {"=": "__eq__", "!=": "__ne__", "<": "__lt__", ">=": "__ge__", ">": "__gt__"}
        return [c for c in cells if getattr(c[4], ops[flt.op])(flt.value)]
    if name == "Qualifier":
        return [c for c in cells if c[2] == flt.value]
    if name == "FamilyIs":
        return [c for c in cells if c[1] == flt.name]
    if name == "Versions":
        return newest(cells, flt.n)
    if name == "FirstCells":
        return place(cells, lambda i: i <= flt.n)
    if name == "SkipCells":
        return place(cells, lambda i: i > flt.n)
    if name == "FirstColumns":
        return place(newest(cells), lambda i: i <= flt.n)
    if name == "ColumnPage":
        return place(newest(cells), lambda i: flt.offset < i <= flt.offset + flt.limit)
    if name == "KeyOnly":
        return [(*c[:4], "") for c in newest(cells)]
    if name == "RowPage":
        return [c for c in cells if c[0] in rows(cells)[: flt.n]]
    if name == "ColumnValue":
        column = [c for c in cells if (c[1], c[2]) == (flt.family, flt.qualifier)]
        tried = column if flt.any_version else newest(column)
        hit = set(rows(run(flt.matches, tried)))
        missing = set(rows(cells)) - set(rows(column))
        kept = [c for c in cells if c[0] in hit or (flt.keep_if_missing and c[0] in missing)]
        return [c for c in kept if not (flt.drop_column and c in column)]
    if name == "Condition":
        yes = set(rows(run(flt.when, cells)))
        then = run(flt.then, [c for c in cells if c[0] in yes])
        return order(then + run(flt.otherwise, [c for c in cells if c[0] not in yes]))
    if name == "WhileMatch":
        after = run(flt.inner, cells)
        for row in rows(cells):
            if sum(c[0] == row for c in cells) != sum(c[0] == row for c in after):
                return [c for c in after if c[0] < row]
        return after
    if name == "Pass":
        return list(cells)
    return []


def random_filter(rng, depth=2):
    leaves = [
        lambda: f.Value(rng.choice(["=", "!=", "<", ">=", ">"]), rng.choice("abc")),
        lambda: f.Qualifier("=", rng.choice("xyz")),
        lambda: f.FamilyIs(rng.choice("fg")),
        lambda: f.Versions(rng.choice([1, 2])),
        lambda: f.FirstCells(rng.choice([1, 2, 4])),
        lambda: f.SkipCells(rng.choice([1, 3])),
        lambda: f.FirstColumns(2),
        lambda: f.ColumnPage(2, offset=1),
        lambda: f.RowPage(3),
        lambda: f.ColumnValue(
            rng.choice("fg"), rng.choice("xyz"), f.Value(rng.choice(["=", "<", ">"]), rng.choice("abc")),
            keep_if_missing=rng.random() < 0.5, any_version=rng.random() < 0.5,
            drop_column=rng.random() < 0.3,
        ),
        lambda: f.WhileMatch(f.Value("!=", rng.choice("abc"))),
    ]
    if depth and rng.random() < 0.6:
        members = [random_filter(rng, depth - 1) for _ in range(rng.choice([1, 2, 3]))]
        kind = rng.random()
        if kind < 0.45:
            return f.All(*members)
        if kind < 0.9:
            return f.Any(*members)
        return f.Condition(members[0], *members[1:3])
    return rng.choice(leaves)()


def random_cells(rng, n=70):
    keys = set()
    while len(keys) < n:
        row = "r1" if rng.random() < 0.33 else f"r{rng.randrange(7)}"
        keys.add((row, rng.choice("fg"), rng.choice("xyz"), rng.randrange(5)))
    return order([(*key, rng.choice("abc")) for key in keys])


@pytest.mark.parametrize("seed", range(6))
def test_random_filters(skewed, make_cells, listed, seed):
    rng = random.Random(seed)
    cells, flt = random_cells(rng), random_filter(rng, 3)
    assert listed(flt.apply(make_cells(cells))) == sorted(run(flt, cells))


# ---- single behaviours


def test_lists_are_chains(spark, make_cells, listed):
    cells = make_cells([("r", "f", "a", 1, "x"), ("r", "f", "b", 1, "y"), ("r", "f", "c", 1, "x")])
    one_way = listed(f.All(f.FirstColumns(2), f.Value("=", "x")).apply(cells))
    other_way = listed(f.All(f.Value("=", "x"), f.FirstColumns(2)).apply(cells))
    assert [c[2] for c in one_way] == ["a"] and [c[2] for c in other_way] == ["a", "c"]
    assert len(listed(f.All().apply(cells))) == 3


def test_any_repeats_no_cell_and_the_first_branch_wins(spark, make_cells, listed):
    cells = make_cells([("r", "f", "a", 1, "x"), ("r", "f", "b", 1, "y")])
    both = listed(f.Any(f.KeyOnly(), f.FirstCells(1), f.Value("=", "x")).apply(cells))
    assert [c[2] for c in both] == ["a", "b"]
    assert listed(f.Any(f.FirstCells(2), f.KeyOnly()).apply(cells)) == listed(cells)


def test_while_match_stops_in_key_order(spark, make_cells, listed):
    rows = [(f"k{i}", "f", "q", 1, "stop" if i == 14 else "go") for i in range(20)]
    cells = make_cells(rows)
    flt = f.WhileMatch(f.Value("!=", "stop"))
    assert [c[0] for c in listed(flt.apply(cells))] == ["k0", "k1", "k10", "k11", "k12", "k13"]
    backwards = listed(scan(cells, ScanSpec(filter=flt, reverse=True)))
    assert [c[0] for c in backwards] == sorted(f"k{i}" for i in (15, 16, 17, 18, 19, *range(2, 10)))


def test_while_match_ignores_rows_emptied_before(spark, make_cells, listed):
    cells = make_cells([("a", "f", "q", 1, "x"), ("b", "g", "q", 1, "stop"), ("c", "f", "q", 1, "x")])
    flt = f.All(f.FamilyIs("f"), f.WhileMatch(f.Value("!=", "stop")))
    assert [c[0] for c in listed(flt.apply(cells))] == ["a", "c"]


def test_fuzzy_rows(spark, make_cells, listed):
    keys = ["a1z", "a2z", "a2zz", "b1z", "a1"]
    cells = make_cells([(k, "f", "q", 1, "v") for k in keys])
    flt = f.FuzzyRow([("a?z", [True, False, True])])
    assert [c[0] for c in listed(flt.apply(cells))] == ["a1z", "a2z", "a2zz"]
    assert flt.keys() == KeySet.prefix("a")
    assert len(listed(f.FuzzyRow([]).apply(cells))) == 5


def test_compare_is_unsigned_and_empty_is_a_value(spark, make_cells, listed):
    cells = make_cells([("a", "f", "q", 1, b"\x80"), ("b", "f", "q", 1, b"\x7f"), ("c", "f", "q", 1, b"")])
    names = lambda flt: [c[0] for c in listed(flt.apply(cells))]
    assert names(f.Value(">", b"\x7f")) == ["a"]
    assert names(f.Value("=", b"")) == ["c"] and names(f.Value("!=", b"")) == ["a", "b"]
    assert names(f.Value("none", b"x")) == []


def test_scan_steps_keep_their_order(spark, make_cells, listed):
    cells = make_cells([("r", "f", "q", 1, "old"), ("r", "f", "q", 5, "new"), ("r", "g", "q", 1, "g1")])
    read = lambda **spec: [c[3:] for c in listed(scan(cells, **spec))]
    # Value filters see only the newest version.
    assert read(filter=f.Value("=", "old")) == []
    # A time range is applied before the version limit, a family's own one at the end.
    assert read(time_range=(0, 3)) == [(1, "old"), (1, "g1")]
    assert read(family_time_ranges={"f": (0, 3)}) == []
    assert read(family_time_ranges={"f": (0, 9)}) == [(5, "new")]
    # A column that is not read counts as missing.
    flt = f.ColumnValue("g", "q", f.Value("=", "other"))
    assert read(filter=flt) == [] and read(filter=flt, columns={"f": None}) == [(5, "new")]


def test_reversed_scan_swaps_its_bounds(spark, make_cells, listed):
    cells = make_cells([(k, "f", "q", 1, "v") for k in "abcde"])
    spec = ScanSpec(rows=reversed_rows("d", "b"), reverse=True, limit=1)
    assert [c[0] for c in listed(scan(cells, spec))] == ["d"]
    spec = ScanSpec(rows=reversed_rows("d", "b"), reverse=True)
    assert [c[0] for c in listed(scan(cells, spec))] == ["c", "d"]


def test_prefix_reaches_the_parquet_scan(spark, make_cells, tmp_path):
    path = str(tmp_path / "cells")
    make_cells([("ab", "f", "q", 1, "v"), ("b", "f", "q", 1, "v")]).write.parquet(path)
    stored = spark.read.parquet(path)
    spec = ScanSpec(filter=f.All(f.RowPrefix("a"), f.FamilyIs("f")), max_versions=None)
    plan = scan(stored, spec).select("ts")._jdf.queryExecution().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(row" in pushed and "LessThan(row" in pushed
    assert "IsNotNull(family)" in pushed and "value" not in pushed.split("ReadSchema")[1]


def test_random_rows_are_whole_and_stable(spark, make_cells, listed):
    cells = make_cells([(f"r{i}", "f", q, 1, "v") for i in range(200) for q in "ab"])
    flt = f.RandomRow(0.3, "seed")
    got = listed(flt.apply(cells))
    assert got == listed(flt.apply(cells.repartition(3)))
    names = [c[0] for c in got]
    assert all(names.count(n) == 2 for n in names) and 30 < len(set(names)) < 90


def test_raw_predicate(spark, make_cells, listed):
    cells = make_cells([("a", "f", "q", 1, "v"), ("b", "f", "q", 2, "v")])
    assert [c[0] for c in listed(scan(cells, filter=f.Raw(F.col("ts") == 2)))] == ["b"]
