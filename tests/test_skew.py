from __future__ import annotations

import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from cellarium.operators.filters import All, ColumnValue, FirstCells, Value
from cellarium.operators.scan import locate
from cellarium.plans import scratch, skew
from cellarium.plans.skew import (
    BROADCAST_ROWS_SETTING,
    HOT_ROWS_SETTING,
    first_rows,
    hot_keys,
    last_before,
    lookup,
    ranked,
    running,
    topmost,
)


def sample(n=300, seed=3):
    """A third of all rows under one key."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(40)}"
        rows.append((key, i, rng.choice([None, rng.randrange(100)])))
    rng.shuffle(rows)
    return rows


def test_running(skewed):
    rows = sample()
    df = skewed.createDataFrame(rows, "k string, at bigint, v bigint")
    got = running(
        df,
        ["k"],
        [F.col("at").asc()],
        {
            "total": ("sum", F.col("v")),
            "before": ("sum", F.col("v"), False),
            "high": ("max", F.col("v")),
            "low_before": ("min", F.col("v"), False),
            "last": ("last", F.col("v")),
            "last_before": ("last", F.col("v"), False),
        },
    )
    want = {}
    for key, group in groupby(sorted(rows), key=lambda r: r[0]):
        seen = []
        for _, at, v in group:
            old = [x for x in seen if x is not None]
            seen.append(v)
            now = [x for x in seen if x is not None]
            want[key, at] = (sum(now), sum(old), max(now, default=None), min(old, default=None),
                             now[-1] if now else None, old[-1] if old else None)
    found = {(r.k, r.at): tuple(r)[3:] for r in got.collect()}
    assert found == want


def test_running_over_the_whole_table(skewed):
    df = skewed.createDataFrame(sample(), "k string, at bigint, v bigint")
    got = running(df, [], [F.col("at").desc()], {"n": ("sum", F.lit(1).cast("bigint"))})
    assert {r.at: r.n for r in got.collect()} == {i: 300 - i for i in range(300)}


def test_ranked_and_topmost(skewed):
    df = skewed.createDataFrame(sample(), "k string, at bigint, v bigint")
    order = [F.col("at").desc()]
    all_ranks = {(r.k, r.at): r["rank"] for r in ranked(df, ["k"], order).collect()}
    for n in (2, 150):
        got = {(r.k, r.at): r["rank"] for r in topmost(df, ["k"], order, n).collect()}
        assert got == {key: rank for key, rank in all_ranks.items() if rank <= n}


def test_small_limits_are_applied_before_the_shuffle(spark):
    df = spark.createDataFrame(sample(), "k string, at bigint, v bigint")
    plan = topmost(df, ["k"], [F.col("at").desc()], 3)._jdf.queryExecution().toString()
    exchange = plan.rindex("Exchange")
    assert "WindowGroupLimit" in plan[:exchange] and "WindowGroupLimit" in plan[exchange:]


def test_last_before(skewed):
    rng = random.Random(9)
    events = [("hot" if i % 3 else "cold", i, i * 10) for i in range(0, 200, 2)]
    asked = [("hot" if rng.random() < 0.7 else "cold", i, f"q{i}") for i in range(1, 200, 3)]
    told = skewed.createDataFrame(events, "k string, seq bigint, x bigint").select(
        "k", "seq", F.struct("x").alias("_event")
    )
    df = skewed.createDataFrame(asked, "k string, seq bigint, name string")
    got = {(r.k, r.seq, r.name): r.found and r.found.x
           for r in last_before(df, told, ["k"], "found").collect()}
    want = {}
    for k, seq, name in asked:
        before = [x for kk, s, x in events if kk == k and s < seq]
        want[k, seq, name] = before[-1] if before else None
    assert got == want


def test_lookup(skewed):
    left = skewed.createDataFrame(sample(), "k string, at bigint, v bigint")
    right = skewed.createDataFrame([("hot", 1), ("k3", 2), ("k7", 3)], "k string, x int")
    got = {(r.k, r.at): r.x for r in lookup(left, right, ["k"]).collect()}
    names = {"hot": 1, "k3": 2, "k7": 3}
    assert got == {(k, at): names.get(k) for k, at, _ in sample()}


def test_locate(skewed):
    starts = [b"", b"b", b"bb", b"f"]
    keys = [b"a", b"b", b"ba", b"bb", b"c", b"f", b"zz"]
    spans = skewed.createDataFrame([(s,) for s in starts], "span_start binary")
    df = skewed.createDataFrame([(k, i) for i, k in enumerate(keys)], "key binary, i int")
    got = {bytes(r.key): bytes(r.span_start) for r in locate(df, "key", spans).collect()}
    assert got == {k: max(s for s in starts if s <= k) for k in keys}


def test_hot_keys_are_counted(spark):
    df = spark.createDataFrame(sample(), "k string, at bigint, v bigint")
    assert hot_keys(df, ["k"]) == (None, 0)
    spark.conf.set(HOT_ROWS_SETTING, "60")
    hot, pieces = hot_keys(df, ["k"])
    spark.conf.unset(HOT_ROWS_SETTING)
    assert [r.k for r in hot.collect()] == ["hot"] and pieces == 2


@pytest.mark.parametrize("ordered_keys", [100_000, 0])
def test_first_rows(spark, make_cells, listed, ordered_keys, monkeypatch):
    monkeypatch.setattr(skew, "ORDERED_KEYS", ordered_keys)
    cells = make_cells([(f"r{i}", "f", "q", t, "v") for i in range(6) for t in range(3)])
    assert {c[0] for c in listed(first_rows(cells, 2))} == {"r0", "r1"}
    assert {c[0] for c in listed(first_rows(cells, 2, reverse=True))} == {"r5", "r4"}
    assert len(listed(first_rows(cells, 99))) == 18
    assert listed(first_rows(cells, 0)) == []


def test_hot_row_is_split_in_a_join_although_a_window_follows(spark):
    """A row with a third of all cells must not pass a row filter in one task."""
    cells = spark.range(120_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).cast("binary").alias("row"),
        F.lit("f").alias("family"),
        F.col("id").cast("string").cast("binary").alias("qualifier"),
        F.col("id").alias("ts"),
        F.sha2(F.col("id").cast("string"), 256).cast("binary").alias("value"),
    )
    settings = {
        BROADCAST_ROWS_SETTING: "0",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    old = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    # Files of many tasks, as a stored table has: a skewed partition is cut by map output.
    cells = scratch.settle(cells.repartition(8, F.xxhash64("ts")))
    chain = All(ColumnValue("f", "7", Value("=", "x")), FirstCells(2))
    out = chain.apply(cells)
    n = out.count()
    plan = out._jdf.queryExecution().executedPlan()  # final once collected
    out.collect()
    text = plan.toString()
    for name, value in old.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    assert n == 80_000 + 2 - 1
    # The join key is salted, so first cells are picked before the rows meet again.
    join, limits = text.index("SortMergeJoin"), text.index("WindowGroupLimit")
    assert "_copy" in text[join : join + 200] and limits < join
    assert "Exchange" in text[limits:join] and "Partial" in text[limits:join]
    assert "skew=true" in text


def test_a_run_deletes_its_own_tables_only(spark):
    kept = scratch.settle(spark.range(3).toDF("n"))
    with scratch.run(spark):
        cut = scratch.settle(spark.range(5).toDF("n"))
        assert cut.count() == 5
        gone = scratch.new_path(spark)
        spark.range(1).write.parquet(gone)
    assert kept.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(gone)


def test_more_hot_keys_than_are_listed(spark):
    rows = [(f"k{i % 30}", i, i) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, at bigint, v bigint")
    spark.conf.set(HOT_ROWS_SETTING, "5")
    spark.conf.set(skew.HOT_KEYS_SETTING, "7")
    try:
        hot, pieces = hot_keys(df, ["k"])
        assert hot.count() == 30 and pieces == 600 // 5 + 1
        got = running(df, ["k"], [F.col("at").asc()], {"n": ("sum", F.lit(1).cast("bigint"))}).collect()
        assert {(r.k, r.at): r.n for r in got} == {(k, at): at // 30 + 1 for k, at, _ in rows}
        found = lookup(df, spark.createDataFrame([("k3", "x")], "k string, w string"), ["k"])
        assert found.where("w = 'x'").count() == 20 and found.count() == 600
    finally:
        spark.conf.unset(HOT_ROWS_SETTING)
        spark.conf.unset(skew.HOT_KEYS_SETTING)


def test_a_stage_deletes_what_the_one_before_cut(spark):
    with scratch.run(spark):
        scratch.next_stage(spark)
        cut = scratch.new_path(spark)
        spark.range(4).write.parquet(cut)
        result = scratch.settle(spark.read.parquet(cut), "result", outlive=True)
        scratch.next_stage(spark)
        assert result.count() == 4
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            spark.read.parquet(cut)
        scratch.end_stage(spark)
        assert result.count() == 4


def test_records_over_the_limit_are_never_broadcast(spark):
    """Adaptive execution would, as they are few bytes once shuffled."""
    left = spark.range(5000).select((F.col("id") % 50).alias("k"), "id")
    right = spark.range(50).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    joined = skew.Side(right, False).join(left, ["k"])
    keys = skew.Side(right.select("k"), False).join(left.select("k"), ["k"], "left_semi")
    for found, n in ((joined, 5000), (keys, 5000)):
        assert len(found.collect()) == n
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
