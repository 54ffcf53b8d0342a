from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellarium.llm import itq

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, cosine):
    """n_links and component_id by all pairs."""
    n = len(rows)
    able = [
        v is not None and None not in v and all(map(math.isfinite, v)) and any(v) for _, v, _ in rows
    ]
    root = list(range(n))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    count = [0] * n
    for a in range(n):
        for b in range(a):
            x, y = (np.array(rows[k][1] if able[k] else [1], np.float64) for k in (a, b))
            if able[a] and able[b] and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
                count[a] += 1
                count[b] += 1
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for k in range(n):
        ids = [i for i in (least.get(find(k)), rows[k][0]) if i is not None]
        least[find(k)] = min(ids, default=None)
    return sorted(((rows[k][0], count[k], least[find(k)]) for k in range(n)), key=str)


def found(spark, rows, **kw):
    data = [(i, None if v is None else [None if x is None else float(x) for x in v], y) for i, v, y in rows]
    got = itq.dedup(spark.createDataFrame(data, SCHEMA), **kw).collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    return sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str)


def clustered(seed, centres, each, width, spread):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(centres):
        centre = rng.standard_normal(width)
        for _ in range(each):
            rows.append((centre + spread * rng.standard_normal(width)).astype(np.float32).tolist())
    return [(k, rows[at], k % 3) for k, at in enumerate(rng.permutation(len(rows)))]


def test_clusters_about_the_limit_by_all_pairs(spark):
    # Cosines of about 0.9 inside a cluster: some linked, some not.
    rows = clustered(5, 20, 12, 24, 0.33)
    got, wanted = found(spark, rows), plain(rows, 0.9)
    assert sum(n for _, n, _ in wanted) > 100
    assert all(a[1] <= b[1] for a, b in zip(got, wanted, strict=True))
    assert sum(n for _, n, _ in got) >= 0.95 * sum(n for _, n, _ in wanted)


@pytest.mark.parametrize("spread", [0.05, 0.3])
def test_dense_groups_go_as_balls(spark, monkeypatch, spread):
    monkeypatch.setattr(itq, "CROWD", 8)
    monkeypatch.setattr(itq, "CHUNK", 16)
    rows = clustered(6, 2, 120, 16, spread)
    wanted = plain(rows, 0.9)
    got = found(spark, rows)
    assert all(a[1] <= b[1] for a, b in zip(got, wanted, strict=True))
    assert sum(n for _, n, _ in got) >= 0.98 * sum(n for _, n, _ in wanted)


def test_keys_with_many_balls_are_met_in_blocks(spark, monkeypatch):
    rows = clustered(7, 3, 40, 8, 0.2)
    wanted = found(spark, rows)
    monkeypatch.setattr(itq, "BLOCK", 5)
    assert found(spark, rows) == wanted


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    v = [rng.standard_normal(6).astype(np.float32).tolist() for _ in range(4)]
    rows = [
        (3, v[0], 1), (1, v[0], 2), (2, [2 * x for x in v[0]], 1), (4, [-x for x in v[0]], 1),
        (5, v[1], None), (5, v[1], 1), (None, v[1], 1), (None, v[2], 1), (6, None, 1), (7, [], 1),
        (8, [0.0] * 6, 1), (9, [*v[0][:5], None], 1), (10, [*v[0][:5], float("nan")], 1),
        (11, [*v[0][:5], float("inf")], 1), (12, v[0][:5], 1), (13, [1e-30] * 6, 1), (14, [1e30] * 6, 1), (15, [1.0], 1),
    ]
    data = [(i, x, y) for i, x, y in rows]
    df = spark.createDataFrame(data, SCHEMA).withColumns({c: F.lit("x") for c in ("h1", "size", "n_links", "place")})
    got = itq.dedup(df).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str) == plain(rows, 0.9)
    assert [r["kept"] for r in got if r["vec_id"] == 2] == [False]


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [1.0, 2.0], 1)]])
def test_small_tables(spark, rows):
    assert found(spark, rows) == [(i, 0, i) for i, _, _ in rows]


def test_a_learned_rotation_beats_a_random_one():
    rng = np.random.default_rng(2)
    mixed = rng.standard_normal((4000, 32)) * np.linspace(2, 0.2, 32)
    sample = itq.units(mixed)
    near = itq.turned(sample, math.acos(0.9), rng)
    index = itq.Index(sample, 4000, 0.9)
    learned = np.bitwise_count(index.code(sample, 0) ^ index.code(near, 0)).mean()
    turn, _ = np.linalg.qr(rng.standard_normal((32, 32)))
    mean = sample.mean(axis=0)
    random = (((sample - mean) @ turn > 0) != ((near - mean) @ turn > 0)).sum(axis=1).mean()
    assert learned < random
    assert index.recall >= itq.RECALL
