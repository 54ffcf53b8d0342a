from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cellarium.model import LATEST
from cellarium.operators import mutate as m
from cellarium.operators.conditional import CHECK, check_and_mutate


def number(n):
    return n.to_bytes(8, "big", signed=True)


def one_by_one(base, log, results=None, max_bytes=m.MAX_CELL_BYTES):
    """Applies every kind of mutation in order, as a store would."""
    table = {c[:4]: c[4] if isinstance(c[4], bytes) else c[4].encode() for c in base}
    for x in sorted(log, key=lambda x: x["seq"]):
        op, ts = x["op"], x.get("ts")
        where = (x["row"], x.get("family"), x.get("qualifier"))
        value = x.get("value")
        value = value.encode() if isinstance(value, str) else value
        if op == m.PUT:
            table[(*where, ts)] = value
            continue
        if op in (m.INCREMENT, m.APPEND):
            newest = max((key[3] for key in table if key[:3] == where), default=None)
            before = table[(*where, newest)] if newest is not None else None
            if op == m.APPEND:
                after = (before or b"") + value
                failed = len(after) > max_bytes
            else:
                failed = before is not None and len(before) != 8
                after = None if failed else number(int.from_bytes(before or b"", "big", signed=True) + x["amount"])
            if results is not None:
                results[x["seq"]] = None if failed else after
            if not failed:
                table[(*where, ts if newest is None else max(ts, newest))] = after
            continue
        for key in list(table):
            row, family, qualifier, at = key
            column = (family, qualifier) == where[1:]
            if row == x["row"] and (
                op == m.DELETE_ROW
                or (op == m.DELETE_FAMILY and family == x["family"])
                or (op == m.DELETE_COLUMN and column)
                or (op == m.DELETE_COLUMN_TO and column and at <= ts)
                or (op == m.DELETE_VERSION and column and at == ts)
            ):
                del table[key]
    return sorted((*key, value.decode("latin1")) for key, value in table.items())


def any_log(rng, size, rows, counters_only):
    """Every kind of operation at explicit timestamps, on few columns."""
    ops = [m.PUT] * 4 + [m.INCREMENT] * 5 + [m.DELETE_ROW, m.DELETE_FAMILY, m.DELETE_COLUMN]
    if not counters_only:
        ops += [m.APPEND] * 3 + [m.DELETE_COLUMN_TO] * 2 + [m.DELETE_VERSION] * 2
    log = []
    for i in range(size):
        op = rng.choice(ops)
        x = {"row": rows(), "family": rng.choice("fg"), "qualifier": rng.choice("xy"),
             "ts": rng.randrange(8), "seq": i, "op": op}
        if op == m.PUT:
            x["value"] = number(rng.randrange(-50, 50)) if counters_only or rng.random() < 0.8 else b"odd"
        elif op == m.APPEND:
            x["value"] = b"+" * rng.choice([0, 1, 8])
        elif op == m.INCREMENT:
            x["amount"] = rng.randrange(-9, 9)
        log.append(x)
    return log


@pytest.mark.parametrize("seed", range(2))
def test_replay_is_the_one_by_one_result(skewed, make_cells, make_log, listed, seed):
    rng = random.Random(seed)
    row = lambda: "hot" if rng.random() < 0.4 else f"r{rng.randrange(4)}"
    base = {(row(), rng.choice("fg"), rng.choice("xy"), rng.randrange(8)): number(7) for _ in range(20)}
    base = [(*key, value) for key, value in base.items()]
    log = any_log(rng, 120, row, counters_only=seed % 2 == 0)
    want = one_by_one(base, log)
    assert listed(m.replay(make_cells(base), make_log(log))) == want


@pytest.mark.parametrize("seed", range(1))
def test_results_of_a_batch_are_the_one_by_one_results(skewed, make_cells, make_log, seed):
    rng = random.Random(10 + seed)
    base = [("hot", "f", "x", 3, number(5)), ("r", "f", "x", 9, number(1)), ("r", "g", "y", 2, b"text")]
    log = any_log(rng, 100, lambda: rng.choice(["hot", "hot", "r"]), counters_only=False)
    for x in log:
        if x["op"] in (m.DELETE_ROW, m.DELETE_FAMILY):
            x["ts"] = LATEST
    results = {}
    one_by_one(base, log, results, max_bytes=20)
    out = m.batch_results(make_cells(base), make_log(log), max_bytes=20).collect()
    assert {r.seq: r.result and bytes(r.result) for r in out if r.seq in results} == results
    assert all(r.ok == (results[r.seq] is not None) for r in out if r.seq in results)
    assert any(v is None for v in results.values())


STARTS = [
    (m.PUT, 50, number(999), number(11)),
    (m.PUT, 150, number(999), number(1000)),
    (m.DELETE_COLUMN_TO, 150, None, number(1)),
    (m.DELETE_COLUMN_TO, 50, None, number(11)),
    (m.DELETE_VERSION, 100, None, number(1)),
]


def test_a_counter_starts_from_the_newest_version(skewed, make_cells, make_log):
    log = []
    for i, (op, ts, value, _) in enumerate(STARTS):
        column = {"row": f"r{i}", "family": "f", "qualifier": "q"}
        log.append({**column, "ts": ts, "value": value, "seq": 2 * i, "op": op})
        log.append({**column, "ts": 200, "seq": 2 * i + 1, "op": m.INCREMENT, "amount": 1})
    base = make_cells([(f"r{i}", "f", "q", 100, number(10)) for i in range(len(STARTS))])
    got = {bytes(r.row).decode(): (r.ts, bytes(r.value)) for r in m.increments(base, make_log(log)).collect()}
    assert got == {f"r{i}": (200, want) for i, (*_, want) in enumerate(STARTS)}


def test_many_undominated_marks_are_walked(skewed, make_cells, make_log, listed, monkeypatch):
    monkeypatch.setattr(m, "CARRIED_MARKS", 2)
    log = []
    for i in range(12):  # every later mark reaches less far, so none replaces another
        log.append({"row": "r", "family": "f", "qualifier": "q", "ts": 5 * i, "value": "v",
                    "seq": 2 * i, "op": m.PUT})
        log.append({"row": "r", "family": "f", "qualifier": "q", "ts": 40 - 3 * i,
                    "seq": 2 * i + 1, "op": m.DELETE_COLUMN_TO})
    got = listed(m.replay(make_cells([]), make_log(log)))
    assert got == one_by_one([], log) and got


def test_a_later_put_with_an_older_timestamp_lives(spark, make_cells, make_log, listed):
    log = [
        {"row": "r", "family": "f", "qualifier": "q", "ts": 9, "seq": 1, "op": m.DELETE_COLUMN_TO},
        {"row": "r", "family": "f", "qualifier": "q", "ts": 3, "value": "v", "seq": 2, "op": m.PUT},
    ]
    assert listed(m.replay(make_cells([("r", "f", "q", 5, "old")]), make_log(log))) == [
        ("r", "f", "q", 3, "v")
    ]


def test_counters(skewed, make_cells, make_log):
    base = make_cells([("a", "f", "n", 1, number(5)), ("a", "f", "n", 2, number(7)), ("b", "f", "n", 1, number(1))])
    inc = lambda seq, row, n: {"row": row, "family": "f", "qualifier": "n", "ts": 100 + seq,
                               "seq": seq, "op": m.INCREMENT, "amount": n}
    log = [inc(i, "a", 1) for i in range(20)] + [
        inc(30, "b", -4),
        {"row": "b", "seq": 31, "op": m.DELETE_ROW, "ts": LATEST},
        inc(32, "b", 2),
        inc(33, "c", 3),
        {"row": "c", "family": "f", "qualifier": "n", "ts": 999, "value": number(50), "seq": 34, "op": m.PUT},
        inc(35, "c", 1),
        {"row": "c", "family": "f", "qualifier": "n", "ts": 9, "value": number(0), "seq": 36, "op": m.PUT},
        inc(37, "c", 1),
    ]
    found = m.increments(base, make_log(log)).collect()
    returned = {r.seq: int.from_bytes(bytes(r.value), "big", signed=True) for r in found}
    assert [returned[i] for i in range(20)] == list(range(8, 28))
    assert [returned[i] for i in (30, 32, 33, 35, 37)] == [-3, 2, 3, 51, 52]
    assert {r.seq: r.ts for r in found if r.seq > 30} == {32: 132, 33: 133, 35: 999, 37: 999}


@pytest.mark.parametrize("op", [m.INCREMENT, m.APPEND])
def test_only_the_columns_of_the_operation_are_walked(spark, make_cells, make_log, monkeypatch, op):
    """On rows that are not hot; columns of the other operation alone are left out."""
    rng = random.Random(8)
    log = any_log(rng, 200, lambda: f"r{rng.randrange(12)}", counters_only=False)
    held = []
    whole = m.histories.walk
    monkeypatch.setattr(m.histories, "walk", lambda events, most: held.append(events) or whole(events, most))
    results: dict = {}
    one_by_one([], log, results)
    step = m.increments if op == m.INCREMENT else m.appends
    found = {r["seq"]: bytes(r["value"]) for r in step(make_cells([]), make_log(log)).collect()}
    assert found == {x["seq"]: results[x["seq"]] for x in log if x["op"] == op and results[x["seq"]] is not None}
    named = {(x["row"], x["family"], x["qualifier"]) for x in log if x["op"] == op}
    walked = {(bytes(r[0]).decode(), r[1], bytes(r[2]).decode()) for r in held[0].select(*m.COLUMN).distinct().collect()}
    assert walked <= named


def test_appends(skewed, make_cells, make_log):
    base = make_cells([("a", "f", "q", 1, "start-"), ("b", "f", "q", 1, "gone")])
    add = lambda seq, row, v: {"row": row, "family": "f", "qualifier": "q", "ts": seq,
                               "value": v, "seq": seq, "op": m.APPEND}
    log = [add(i, "a", f"{i}.") for i in range(23)] + [
        add(40, "b", "x"),
        {"row": "b", "family": "f", "seq": 41, "op": m.DELETE_FAMILY, "ts": LATEST},
        add(42, "b", ""),
        add(43, "b", "y"),
    ]
    got = {r.seq: bytes(r.value) for r in m.appends(base, make_log(log)).collect()}
    assert got[22] == ("start-" + "".join(f"{i}." for i in range(23))).encode()
    assert (got[40], got[42], got[43]) == (b"gonex", b"", b"y")
    short = {r.seq: bytes(r.value) for r in m.appends(base, make_log(log), max_bytes=8).collect()}
    assert {k: v for k, v in short.items() if k < 40} == {0: b"start-0."}


def test_a_failed_action_is_a_row_of_its_own(spark, make_cells, make_log):
    column = {"row": "r", "family": "f", "qualifier": "q", "ts": 5}
    log = make_log([
        {**column, "seq": 0, "op": m.INCREMENT, "amount": 1},
        {**column, "seq": 1, "op": m.APPEND, "value": "x" * 50},
        {**column, "seq": 2, "op": m.APPEND, "value": "yz"},
        {**column, "seq": 3, "op": m.PUT, "ts": 9, "value": number(4)},
        {**column, "seq": 4, "op": m.INCREMENT, "amount": 1},
    ])
    base = make_cells([("r", "f", "q", 1, b"\x00\x00\x00\x07")])
    out = m.batch_results(base, log, max_bytes=20).collect()
    got = {r.seq: (r.ok, r.result and bytes(r.result)) for r in out}
    assert got == {0: (False, None), 1: (False, None), 2: (True, b"\x00\x00\x00\x07yz"), 3: (True, None),
                   4: (True, number(5))}
    assert {r.seq: r.error for r in out if not r.ok} == {
        0: "increment of a value that is not 8 bytes", 1: "appended cell too large"
    }


def test_refused_actions_do_not_stop_others(spark, make_cells, make_log):
    log = make_log([
        {"row": "r", "family": "f", "qualifier": "q", "ts": 5, "seq": 0, "op": m.PUT},
        {"row": "r", "family": "f", "qualifier": "q", "ts": 5, "value": "x" * 99, "seq": 1, "op": m.PUT},
        {"row": "r", "family": "f", "ts": 5, "seq": 2, "op": m.DELETE_FAMILY},
        {"row": "r", "family": "f", "qualifier": "q", "ts": LATEST, "seq": 3, "op": m.DELETE_VERSION},
        {"row": "r", "family": "f", "qualifier": "q", "ts": 1, "seq": 4, "op": m.GET},
        {"row": "z", "family": "f", "qualifier": "q", "ts": 1, "seq": 5, "op": m.GET},
        {"row": "r", "seq": 6, "op": "MERGE"},
        {"row": "r", "family": "f", "qualifier": "n", "ts": 1, "seq": 7, "op": m.INCREMENT, "amount": 4},
    ])
    out = m.batch_results(make_cells([("r", "f", "q", 1, "stored")]), log, max_put_bytes=60).collect()
    got = {r.seq: (r.ok, r.result and bytes(r.result)) for r in out}
    assert got == {0: (False, None), 1: (False, None), 2: (False, None), 3: (False, None),
                   4: (True, b"stored"), 5: (True, None), 6: (False, None), 7: (True, number(4))}


def test_retention(spark, make_cells, listed):
    cells = make_cells([("r", f, "q", ts, "v") for f in "abcd" for ts in (10, 20, 30, 40)])
    rules = {"a": (2, None, None), "b": (None, None, 15), "c": (3, 1, 5), "d": (None, 3, 15)}
    got = listed(m.apply_retention(cells, rules, now=50))
    kept = {f: [c[3] for c in got if c[1] == f] for f in "abcd"}
    assert kept == {"a": [30, 40], "b": [40], "c": [40], "d": [20, 30, 40]}
    with pytest.raises(ValueError):
        m.apply_retention(cells, {"a": (2, 2, 5)}, now=50)


def test_last_of_each_and_runs(skewed, make_log):
    log = make_log([{"row": "r", "seq": i, "op": op} for i, op in enumerate("PPDDDPD")])
    runs = {r.seq: r.run for r in m.runs(log, F.col("op")).collect()}
    assert [runs[i] for i in range(7)] == [1, 1, 2, 2, 2, 3, 4]
    last = m.last_of_each(log.select("row", "op", "seq"), ["row", "op"]).collect()
    assert {(r.op, r.seq) for r in last} == {("P", 5), ("D", 6)}


# ---- conditional mutations

KIND = ("seq bigint, row binary, family string, qualifier binary, op string, expected binary, "
        "not_before bigint, before bigint")  # fmt: skip


def checks_of(spark, rows):
    data = [(s, r.encode(), "f", q.encode(), op, None if e is None else e.encode(), lo, hi)
            for s, r, q, op, e, lo, hi in rows]
    return spark.createDataFrame(data, KIND).select(*CHECK)


@pytest.mark.parametrize(
    "op,expected,result",
    [
        ("=", "5", True), ("!=", "5", False), ("<", "6", False), ("<", "4", True),
        ("<=", "5", True), (">", "6", True), (">", "5", False), (">=", "5", True),
        ("=", None, False), ("!=", None, True), ("=", "", False), ("none", "5", False),
    ],
)
def test_check_compares_expected_with_stored(spark, make_cells, make_log, op, expected, result):
    base = make_cells([("r", "f", "q", 1, "9"), ("r", "f", "q", 2, "5")])
    checks = checks_of(spark, [(1, "r", "q", op, expected, None, None)])
    puts = make_log([{"row": "r", "family": "f", "qualifier": "x", "value": "v", "seq": 1, "op": m.PUT}])
    flags, applied = check_and_mutate(base, checks, puts, now=99)
    assert [r.applied for r in flags.collect()] == [result]
    assert [r.ts for r in applied.collect()] == ([99] if result else [])


def test_time_range_is_tested_on_the_newest_version(spark, make_cells, make_log):
    base = make_cells([("r", "f", "q", 1, "5"), ("r", "f", "q", 20, "5")])
    rows = [(1, "r", "q", "=", "5", 0, 10), (2, "r", "q", "=", "5", 15, 30), (3, "r", "q", "=", None, 0, 10)]
    flags, _ = check_and_mutate(base, checks_of(spark, rows), make_log([]), now=99)
    assert {r.seq: r.applied for r in flags.collect()} == {1: False, 2: True, 3: True}


def test_mutations_must_stay_in_the_checked_row(spark, make_cells, make_log):
    checks = checks_of(spark, [(1, "r", "q", "=", "5", None, None)])
    puts = make_log([{"row": "s", "family": "f", "qualifier": "x", "value": "v", "seq": 1, "op": m.PUT}])
    with pytest.raises(ValueError, match="stay in the checked row"):
        check_and_mutate(make_cells([]), checks, puts, now=99)


@pytest.mark.parametrize("plain", [True, False])
@pytest.mark.parametrize("seed", range(1))
def test_chained_checks(skewed, make_cells, make_log, seed, plain):
    """Each check sees what earlier ones did, with explicit timestamps and all kinds of mutations."""
    rng = random.Random(seed)
    base = [("hot", "f", "x", 4, "5"), ("cold", "f", "y", 2, "7")]
    rows, log, applied_log, want = [], [], [], {}
    kinds = [m.PUT] * 5 + [m.DELETE_COLUMN, m.DELETE_FAMILY, m.DELETE_ROW]
    kinds += [] if plain else [m.DELETE_COLUMN_TO, m.DELETE_VERSION, m.APPEND, m.APPEND]
    for seq in range(60):
        row = "hot" if rng.random() < 0.6 else "cold"
        q, op, expected = rng.choice("xy"), rng.choice(["=", "<", ">", "!="]), rng.choice([None, *"3579"])
        rows.append((seq, row, q, op, expected, None, None))
        state = one_by_one(base, applied_log)
        stored = [c for c in state if (c[0], c[2]) == (row, q)]
        stored = max(stored, key=lambda c: c[3])[4] if stored else None
        if expected is None:
            want[seq] = (stored is not None) if op == "!=" else stored is None
        else:
            want[seq] = stored is not None and {
                "=": expected == stored, "!=": expected != stored,
                "<": expected < stored, ">": expected > stored,
            }[op]
        kind = rng.choice(kinds)
        x = {"row": row, "family": "f", "qualifier": rng.choice("xy"), "ts": rng.randrange(8),
             "seq": seq, "op": kind}
        if kind in (m.PUT, m.APPEND):
            x["value"] = rng.choice("3579")
        log.append(x)
        if want[seq]:
            applied_log.append(x)
    flags, applied = check_and_mutate(make_cells(base), checks_of(skewed, rows), make_log(log), now=50)
    assert {r.seq: r.applied for r in flags.collect()} == want
    assert {r.seq for r in applied.collect()} == {s for s, yes in want.items() if yes}


def test_a_long_chain_of_compare_and_set_is_one_pass(spark, make_cells, make_log):
    n = 3000
    rows = [(s, "r", "q", "=", str(s), None, None) for s in range(n)]
    puts = [{"row": "r", "family": "f", "qualifier": "q", "value": str(s + 1), "ts": s + 2, "seq": s, "op": m.PUT}
            for s in range(n)]
    flags, _ = check_and_mutate(make_cells([("r", "f", "q", 1, "0")]), checks_of(spark, rows), make_log(puts), now=9)
    assert flags.where("applied").count() == n


def test_rows_the_log_does_not_name_are_not_shuffled(spark, make_cells, make_log, tmp_path):
    path = str(tmp_path / "base")
    make_cells([(f"r{i}", "f", "q", 1, "v") for i in range(20)]).write.parquet(path)
    log = make_log([{"row": "r1", "family": "f", "qualifier": "q", "ts": 2, "value": "w", "seq": 1, "op": m.PUT}])
    out = m.replay(spark.read.parquet(path), log)
    assert out.count() == 21
    plan = out._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan") :]
    passed_through = physical[: physical.index("LeftSemi")]
    assert "BroadcastHashJoin" in passed_through and "LeftAnti" in passed_through
    above = passed_through[: passed_through.index("LeftAnti")]
    assert "Exchange" not in above


def test_a_hot_chain_of_compare_and_set_is_stitched(spark, make_cells, make_log):
    """Pieces depend on each other, and on deletes that bring older versions back."""
    spark.conf.set("spark.cellarium.hotGroupRows", "300")
    try:
        n = 400
        rows = [(s, "r", "q", "=", str(s), None, None) for s in range(n)]
        log = [{"row": "r", "family": "f", "qualifier": "q", "value": str(s + 1), "ts": s + 2, "seq": s, "op": m.PUT}
               for s in range(n)]
        rows += [(n, "r", "q", "=", str(n), None, None), (n + 1, "r", "q", "=", str(n - 1), None, None)]
        log.append({"row": "r", "family": "f", "qualifier": "q", "ts": n + 1, "seq": n, "op": m.DELETE_VERSION})
        base = make_cells([("r", "f", "q", 1, "0")])
        flags, _ = check_and_mutate(base, checks_of(spark, rows), make_log(log), now=9)
        assert flags.where("applied").count() == n + 2
    finally:
        spark.conf.unset("spark.cellarium.hotGroupRows")
