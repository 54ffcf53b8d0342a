from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellarium.plans import greedy


def fold(rows, limits):
    """Bundle numbers, one row after the other."""
    numbers, number, sums = [], 0, [0] * len(limits)
    for row in rows:
        sums = [a + b for a, b in zip(sums, row, strict=True)]
        numbers.append(number)
        if any(a >= limit for a, limit in zip(sums, limits, strict=True)):
            number, sums = number + 1, [0] * len(limits)
    return numbers, number, sums


@pytest.mark.parametrize("seed", range(25))
def test_pieces_compose_to_the_fold(seed):
    rng = random.Random(seed)
    limits = [rng.choice([1, 5, 30, 1000]), rng.choice([3, 10, 500])]
    rows = [(rng.choice([0, 1, 2, 7, 40]), rng.choice([0, 1, 3])) for _ in range(60)]
    cuts = sorted(rng.sample(range(1, 60), 4))
    number, sums = 0, np.zeros(2, np.int64)
    for start, stop in zip([0, *cuts], [*cuts, 60], strict=True):
        piece = greedy.Piece(np.array(rows[start:stop], np.int64), limits)
        assert len(piece.first) <= stop - start
        number, sums = piece.after(number, sums)
        _, want, left = fold(rows[:stop], limits)
        assert (number, sums.tolist()) == (want, left)


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_bundles_are_the_fold(skewed, keys):
    rng = random.Random(3)
    rows = [("big" if rng.random() < 0.8 else f"k{rng.randrange(3)}", n, rng.choice([0, 3, 9, 50]), 1) for n in range(120)]
    df = skewed.createDataFrame(rows, "k string, n int, size bigint, one int")
    found = greedy.bundles(df, keys, [F.col("n").desc()], {"size": 60, "one": 9}, "bundle").collect()
    assert len(found) == 120
    for key in {r[0] for r in rows} if keys else [None]:
        own = sorted((r for r in rows if key in (None, r[0])), key=lambda r: -r[1])
        got = sorted((r for r in found if key in (None, r.k)), key=lambda r: -r.n)
        assert [r.bundle for r in got] == fold([r[2:] for r in own], [60, 9])[0]


def test_an_empty_table_has_no_bundles(spark):
    df = spark.createDataFrame([], "k string, size bigint")
    for keys in ([], ["k"]):
        assert greedy.bundles(df, keys, [F.col("size").asc()], {"size": 5}, "bundle").collect() == []
