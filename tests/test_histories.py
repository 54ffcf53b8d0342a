from __future__ import annotations

import pickle
import random

import pytest

from cellarium.operators import histories, mutate as m
from cellarium.operators.sequential import Versions
from tests.test_mutate import any_log, number, one_by_one


def any_events(rng, size, ops, most=9):
    events = []
    for _ in range(size):
        op, ts = rng.choice(ops), rng.randrange(most)
        value = amount = None
        if op == m.PUT:
            value = number(rng.randrange(99)) if rng.random() < 0.6 else b"+" * rng.choice([0, 3, 7, 20])
        elif op == m.APPEND:
            value = b"x" * rng.choice([0, 0, 1, 5, 8])
        elif op == m.INCREMENT:
            amount = rng.randrange(-5, 5)
        events.append((op, ts, value, amount))
    return events


@pytest.mark.parametrize("seed", range(30))
def test_a_summary_tells_what_any_incoming_version_becomes(seed):
    rng = random.Random(seed)
    ops = [m.PUT, m.INCREMENT, m.INCREMENT, m.APPEND, m.APPEND, m.DELETE_COLUMN_TO]
    for size in (1, 2, 3, 5, 9, 20):
        events = any_events(rng, size, ops + [m.DELETE_COLUMN] * (seed % 5 == 0))
        summary = histories.Summary(max_bytes=60)
        for op, ts, value, amount in events:
            summary.apply(op, ts, value, amount, None)
        summary = pickle.loads(pickle.dumps(summary))
        for ts in [None, *range(-1, 11)]:
            for value in (b"", b"abc", b"abcdefg", number(5), b"123456789", b"y" * 30):
                live, failed = Versions(), False
                if ts is not None:
                    live.put(ts, value, False)
                for op, at, v, amount in events:
                    failed |= live.apply(op, at, v, amount, 60, False)[2] == "appended cell too large"
                state = [] if ts is None else [(ts, value, False)]
                got = summary.after(state)
                if got is None:
                    assert failed or len(value) + sum(len(v or b"") for op, _, v, _ in events if op == m.APPEND) > 60
                else:
                    assert got == histories.kept(live), (events, state)


@pytest.mark.parametrize("seed", range(20))
def test_versions_nothing_can_bring_back_are_not_kept(seed):
    rng = random.Random(seed)
    ops = [m.PUT] * 3 + [m.INCREMENT, m.APPEND, m.DELETE_COLUMN_TO, m.DELETE_VERSION, m.DELETE_COLUMN]
    events = any_events(rng, 60, ops, most=30)
    named = {ts for op, ts, _, _ in events if op == m.DELETE_VERSION}
    every, few, most = Versions(), Versions(), 0
    for op, ts, value, amount in events:
        assert every.apply(op, ts, value, amount, 99) == few.apply(op, ts, value, amount, 99, ts in named)
        assert every.newest() == few.newest()
        most = max(most, len(few.values))
    assert most <= len(named) + 1


@pytest.mark.parametrize("seed, points", [(0, False), (1, False), (2, True)])
def test_hot_columns_in_pieces_are_the_one_by_one_result(spark, make_cells, make_log, listed, seed, points):
    spark.conf.set("spark.cellarium.hotGroupRows", "5")
    try:
        rng = random.Random(50 + seed)
        log = any_log(rng, 150, lambda: "hot" if rng.random() < 0.8 else "cold", counters_only=False)
        for x in log:
            x["qualifier"] = "x" if x["row"] == "hot" else x["qualifier"]
            if not points and x["op"] == m.DELETE_VERSION:
                x.update(op=m.APPEND, value=b"!")
        base = [("hot", "f", "x", 3, number(5)), ("hot", "g", "x", 2, b"old"), ("hot", "g", "x", 1, b"older")]
        assert listed(m.replay(make_cells(base), make_log(log))) == one_by_one(base, log)
        results = {}
        one_by_one(base, log, results, max_bytes=30)
        found = m.read_modify_write(make_cells(base), m.by_op(make_log(log)), max_bytes=30).collect()
        assert {r.seq: r.value and bytes(r.value) for r in found} == results
    finally:
        spark.conf.unset("spark.cellarium.hotGroupRows")


def test_a_hot_appended_column_runs_in_many_tasks(spark, make_cells, make_log, monkeypatch):
    spark.conf.set("spark.cellarium.hotGroupRows", "50")
    seen = []
    monkeypatch.setattr(histories, "settle", lambda df, label: seen.append((label, settle(df, label))) or seen[-1][1])
    try:
        log = [{"row": "r", "family": "f", "qualifier": "q", "ts": 5, "value": f"{k}.", "seq": k, "op": m.APPEND}
               for k in range(600)]
        got = {r.seq: bytes(r.value) for r in m.appends(make_cells([]), make_log(log)).collect()}
        assert got[599] == "".join(f"{k}." for k in range(600)).encode() and len(got) == 600
        laid = next(df for label, df in seen if label == "history")
        sizes = [r["count"] for r in laid.selectExpr("shiftright(pos, 33) AS piece").groupBy("piece").count().collect()]
        assert len(sizes) >= 10 and max(sizes) <= 150
        # All pieces ran at once: one pass, no waves.
        assert [label for label, _ in seen].count("walked") == 1
    finally:
        spark.conf.unset("spark.cellarium.hotGroupRows")


settle = histories.settle
