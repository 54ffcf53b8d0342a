from __future__ import annotations

import numpy as np
import pytest

from cellarium.llm import hard_negatives

SCHEMA = "vec_id bigint, label int, vector array<bigint>, anchor boolean"


def plain(rows, positives=5, negatives=10, low=30, high=90):
    """All pairs, one by one."""
    whole = [r for r in rows if r[1] is not None and r[2] is not None and None not in r[2]]

    def score(a, b):
        return sum(x * y for x, y in zip(a[2], b[2], strict=False))

    def order(pair):
        return -pair[0], pair[1][0] is None, pair[1][0] or 0

    found = []
    for at, a in enumerate(whole):
        if not a[3] or a[0] is None:
            continue
        met = sorted(((score(a, b), b) for k, b in enumerate(whole) if k != at), key=order)
        for p, b in [m for m in met if m[1][1] == a[1]][:positives]:
            fit = [m for m in met if m[1][1] != a[1] and low * p <= 100 * m[0] <= high * p]
            found += [(a[0], b[0], k, c[0], p, s) for k, (s, c) in enumerate(fit[:negatives], 1)]
    return sorted(found, key=str)


def random_rows(seed, n, width, spread=40, labels=4):
    rng = np.random.default_rng(seed)
    values = rng.integers(-spread, spread + 1, (n, width))
    return [(k, int(rng.integers(labels)), values[k].tolist(), k % 9 == 0) for k in range(n)]


@pytest.mark.parametrize("shelf, group", [(8192, 128), (16, 5)])
def test_same_as_all_pairs(spark, monkeypatch, shelf, group):
    monkeypatch.setattr(hard_negatives, "SHELF", shelf)
    monkeypatch.setattr(hard_negatives, "GROUP", group)
    monkeypatch.setattr(hard_negatives, "FIRST_DEPTH", 2)
    rows = random_rows(1, 160, 3, spread=4)  # few values: many ties
    rows += [rows[9], rows[9], rows[12]]  # repeated rows, anchors among them
    rows += [(None, 1, [9, 9, 9], True), (501, None, [1, 1, 1], True), (502, 1, None, True),
             (503, 2, [1, None, 3], True), (504, 2, [], True), (505, 3, [7], True), (506, 3, [0, 0, 0], None)]
    found = hard_negatives.mine(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, found), key=str) == plain(rows)


def test_sums_beyond_doubles_are_exact(spark):
    rows = [(k, k % 2, [2**28 + k, 2**28 - 3 * k, 1], k % 5 == 0) for k in range(30)]
    rows = [(k, y, [x * 8 for x in v], a) for k, y, v, a in rows]
    found = hard_negatives.mine(spark.createDataFrame(rows, SCHEMA), high=101).collect()
    assert sorted(map(tuple, found), key=str) == plain(rows, high=101)


def test_reading_stops_at_the_threshold():
    rng = np.random.default_rng(3)
    values = rng.integers(-100, 100, (4000, 2))
    ids = np.arange(4000)
    shelf = hard_negatives.Shelf(
        ids.tobytes(), ids.tobytes(), np.zeros(4000, np.int64).tobytes(), values.tobytes(), "<i8", 2
    )
    anchor = np.array([3, -2])
    best = hard_negatives.Best(5, *hard_negatives.ANY)
    scored = shelf.walk(anchor, np.ones(4000, bool), [best])
    assert scored < 1000
    score = values @ anchor
    assert list(best.id) == sorted(range(4000), key=lambda k: (-score[k], k))[:5]


def test_empty_table(spark):
    assert hard_negatives.mine(spark.createDataFrame([], SCHEMA)).collect() == []
    lone = spark.createDataFrame([(0, 1, [1, 2], True), (1, 2, [1, 2], False)], SCHEMA)
    assert hard_negatives.mine(lone).collect() == []
