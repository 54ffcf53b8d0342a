from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cellarium.model import CELL_SCHEMA, LATEST
from cellarium.operators import mutate as m
from cellarium.operators.filters import newest
from cellarium.streaming import changes as ch
from cellarium.streaming import jobs as st
from tests.test_mutate import any_log

ENTRY = f"entry bigint, table string, written bigint, cells array<{ch.CELL_FIELDS}>"


def cell(kind, ts=10, row="r", family="f", qualifier="q", value="v"):
    return (row.encode(), family, qualifier.encode(), kind, ts, value.encode())


@pytest.fixture
def entries(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), ENTRY)

    return make


@pytest.fixture
def as_stream(spark, tmp_path):
    """A stream of the rows of a DataFrame, one micro-batch per given part."""

    def make(df, parts):
        folder = str(tmp_path / "in")
        for i, part in enumerate(parts):
            df.where(part).coalesce(1).write.mode("append").parquet(f"{folder}/{i}")
        reader = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1)
        return reader.parquet(f"{folder}/*")

    return make


def ops(entries, tag=None):
    return {r.seq: r.op for r in ch.classify(entries, tag).collect()}


def counted(entries, tag=None):
    return {r.metric: r.n for r in ch.metrics(ch.classify(entries, tag), tag is not None).collect()}


def test_kinds_of_mutations(spark, entries):
    minute = 60_000
    log = entries(
        (1, "t", 20, [cell("PUT"), cell("DELETE"), cell("DELETE", LATEST), cell("DELETE_COLUMN"),
                      cell("DELETE_COLUMN", LATEST), cell("DELETE_FAMILY", LATEST)]),
        (2, "t", 10 + 5 * minute, [cell("DELETE_FAMILY")]),
        (3, "t", 11 + 5 * minute, [cell("DELETE_FAMILY")]),
        (4, "t", 9, [cell("DELETE_FAMILY"), cell("DELETE_FAMILY_VERSION"), cell("APPEND")]),
        (5, "t", 20, [cell("PUT", 21), cell("PUT", 2**63 // 1000), cell("PUT", LATEST)]),
    )
    n = ch.PLACES
    assert ops(log) == {
        n: m.PUT, n + 1: m.DELETE_VERSION, n + 2: None, n + 3: m.DELETE_COLUMN_TO,
        n + 4: m.DELETE_COLUMN, n + 5: m.DELETE_FAMILY, 2 * n: m.DELETE_FAMILY, 3 * n: None,
        4 * n: None, 4 * n + 1: None, 4 * n + 2: None,
        5 * n: m.PUT, 5 * n + 1: m.PUT, 5 * n + 2: m.PUT,
    }
    assert counted(log) == {
        "incompatible_mutations": 1, "incompatible_deletes": 5, "dropped_mutations": 5,
        "timestamp_overflows": 1, "puts_in_future": 3,
        "one_way_eligible_entries": 5, "one_way_eligible_mutations": 14,
    }


def test_loops_are_cut_by_the_last_cell(spark, entries):
    tag = cell("DELETE", 0, qualifier="TAG")
    log = entries(
        (1, "t", 20, [cell("PUT"), cell("PUT"), tag]),
        (2, "t", 20, [tag, cell("PUT")]),
    )
    assert list(ops(log, "TAG").values()) == [None, None, None, m.DELETE_VERSION, m.PUT]
    counts = counted(log, "TAG")
    assert counts["both_ways_ineligible_entries"] == 1
    assert counts["both_ways_ineligible_mutations"] == 2
    assert counts["both_ways_eligible_mutations"] == 2
    kept = ch.keep_families(ch.entry_filter(log, ~ch.came_back("TAG")), ["g"])
    assert kept.count() == 0


def test_origin_tag_follows_the_last_cell_of_a_row(spark, entries):
    log = entries(
        (1, "t", 20, [cell("PUT", family="a"), cell("PUT", row="s", family="b")]),
        (2, "t", 20, [cell("PUT", family="c")]),
    )
    tags = ch.origin_tags(ch.to_log(ch.classify(log)), "ME").collect()
    got = {bytes(r.row): (r.family, r.seq, bytes(r.qualifier), r.ts, r.op) for r in tags}
    n = ch.PLACES
    assert got == {b"r": ("c", 2 * n + 1, b"ME", 0, m.DELETE_VERSION),
                   b"s": ("b", n + 2, b"ME", 0, m.DELETE_VERSION)}


def test_batches_hold_whole_rows_of_one_table(skewed, entries):
    rows = [(i, "big" if i % 3 else "small", 20, [cell("PUT", row=f"r{i:03d}")] * (1 + i % 4)) for i in range(60)]
    log = ch.to_log(ch.classify(entries(*rows)))
    found = ch.batches(log, max_bytes=300, max_cells=7).collect()
    assert len({(r.table, bytes(r.row)) for r in found}) == len(found) == 60
    groups = {}
    for r in found:
        groups.setdefault((r.table, r.batch), []).append(r)
    for group in groups.values():
        last = max(group, key=lambda r: bytes(r.row))
        assert sum(r.bytes for r in group) - last.bytes < 300
        assert sum(r.cells for r in group) - last.cells < 7
    assert len(groups) > 10


def test_replication_in_micro_batches(spark, entries, as_stream, listed, tmp_path):
    rows = [(i, "t" if i % 2 else "u", 100, [cell("PUT", i, row=f"r{i % 4}", value=f"v{i}")]) for i in range(12)]
    rows += [(12, "t", 100, [cell("DELETE_COLUMN", 5, row="r1")]), (13, "t", 100, [cell("PUT", 3, row="r1", value="late")])]
    log = entries(*rows)
    stream = as_stream(log, [F.col("entry") < 5, F.col("entry").between(5, 11), F.col("entry") > 11])
    copy = st.Copy(spark, str(tmp_path / "copy"))
    st.replicate(stream, copy, str(tmp_path / "progress"), origin_tag="ME")
    assert copy.log().select("batch_id").distinct().count() == 3
    batch = {t: listed(m.replay(spark.createDataFrame([], copy.read(t).schema),
                                ch.to_log(ch.classify(log)).where(F.col("table") == t)))
             for t in "tu"}
    assert {t: listed(copy.read(t)) for t in "tu"} == batch
    assert ("r1", "f", "q", 3, "late") in batch["t"] and ("r1", "f", "q", 5, "v5") not in batch["t"]
    # A repeated micro-batch changes nothing, and neither does folding the log.
    again = copy.log().where("batch_id = 1").drop("batch_id").collect()
    copy.append(spark.createDataFrame(again, st.LOG_SCHEMA), 1)
    assert {t: listed(copy.read(t)) for t in "tu"} == batch
    copy.compact(1)
    assert {t: listed(copy.read(t)) for t in "tu"} == batch
    copy.compact(2)
    assert {t: listed(copy.read(t)) for t in "tu"} == batch
    everything = copy.read_all()
    assert {t: listed(everything.where(F.col("table") == t)) for t in "tu"} == batch


def test_table_and_row_key_come_apart_again(spark):
    rows = [("t", b""), ("t", b"\x00\x00"), ("t\u00e4\u4e2d", b"\xff\x00a"), ("", b"r")]
    df = spark.createDataFrame(rows, "table string, row binary")
    back = st.split_key(st.table_key(df)).collect()
    assert sorted((r.table, bytes(r.row)) for r in back) == sorted(rows)


def test_dry_run_writes_nothing(spark, entries, as_stream, tmp_path):
    log = entries(*[(i, "t", 20, [cell("PUT"), cell("APPEND")]) for i in range(4)])
    counters = st.dry_run(as_stream(log, [F.col("entry") < 2, F.col("entry") >= 2]), str(tmp_path / "progress"))
    assert counters["incompatible_mutations"] == 4 and counters["one_way_eligible_entries"] == 4


def test_a_dry_run_goes_on_from_its_counters(spark, entries, as_stream, tmp_path):
    log = entries(*[(i, "t", 20, [cell("PUT"), cell("APPEND")]) for i in range(6)])
    progress = str(tmp_path / "progress")
    assert st.dry_run(as_stream(log, [F.col("entry") < 2]), progress)["one_way_eligible_entries"] == 2
    more = as_stream(log, [F.lit(False), F.col("entry") >= 2])
    assert st.dry_run(more, progress)["one_way_eligible_entries"] == 6
    assert st.dry_run(more, progress)["incompatible_mutations"] == 6


@pytest.fixture
def mutations(make_log):
    def make(rows):
        return make_log(rows).withColumn("table", F.lit("t")).select(*st.LOG_SCHEMA.fieldNames())

    return make


def test_dual_write(spark, mutations, as_stream, listed, tmp_path):
    at = {"row": "r", "family": "f"}
    log = mutations([
        at | {"qualifier": "n", "ts": 1, "seq": 0, "op": m.INCREMENT, "amount": 5},
        at | {"qualifier": "q", "ts": 2, "value": "good", "seq": 1, "op": m.PUT},
        at | {"qualifier": "n", "ts": 3, "seq": 2, "op": m.INCREMENT, "amount": 2},
        at | {"qualifier": "a", "ts": 4, "value": "x", "seq": 3, "op": m.APPEND},
        at | {"qualifier": "q", "ts": 5, "value": "bad", "seq": 4, "op": m.PUT},
        at | {"qualifier": "q", "ts": 6, "seq": 5, "op": m.PUT},
        at | {"qualifier": "a", "ts": 7, "value": "y", "seq": 6, "op": m.APPEND},
    ])
    stream = as_stream(log, [F.col("seq") < 2, F.col("seq").between(2, 4), F.col("seq") > 4])
    one, two = (st.Copy(spark, str(tmp_path / name)) for name in ("one", "two"))
    letters = str(tmp_path / "letters")
    refuses = F.when(F.col("value") == F.lit(b"bad"), F.lit("refused"))
    st.dual_write(stream, one, two, letters, str(tmp_path / "progress"), refuses)
    newest = lambda cells: {c[2]: c[4] for c in listed(cells)}
    seven = (7).to_bytes(8, "big").decode("latin1")
    assert newest(one.read("t"))["n"] == seven and newest(one.read("t"))["a"] == "xy"
    second = newest(two.read("t"))
    assert second == {"n": seven, "a": "xy", "q": "good"}
    assert {r.op for r in two.log().collect()} == {m.PUT}
    lost = st.read_dead_letters(spark, letters)
    assert [(r.seq, r.op, bytes(r.value)) for r in lost.collect()] == [(4, m.PUT, b"bad")]
    raw = spark.read.json(letters).first()
    assert (raw.reason, raw.op, raw.batch) == ("refused", m.PUT, 1)
    both = two.log().drop("batch_id").unionByName(lost).drop("table")
    assert newest(m.replay(spark.createDataFrame([], two.read("t").schema), both))["q"] == "bad"


def test_failed_writes_go_to_a_callable(spark, mutations, as_stream, tmp_path):
    at = {"row": "r", "family": "f", "qualifier": "q"}
    log = mutations([at | {"ts": 1, "value": v, "seq": i, "op": m.PUT} for i, v in enumerate(("a", "bad"))])
    one, two = (st.Copy(spark, str(tmp_path / name)) for name in ("one", "two"))
    seen = []
    refuses = F.when(F.col("value") == F.lit(b"bad"), F.lit("refused"))
    consume = lambda failed, batch_id: seen.extend((batch_id, r.seq, r.error) for r in failed.collect())
    st.dual_write(as_stream(log, [F.lit(True)]), one, two, consume, str(tmp_path / "p"), refuses)
    assert seen == [(0, 1, "refused")]


def test_a_batch_reads_back_its_own_rows_only(spark, mutations, monkeypatch, tmp_path):
    put = lambda row, seq, op, **more: {"row": row, "family": "f", "qualifier": "n", "ts": seq, "seq": seq,
                                        "op": op, **more}
    one = st.Copy(spark, str(tmp_path / "one"))
    first = [put(f"r{i}", i, m.INCREMENT, amount=i) for i in range(50)]
    one.append(mutations(first), 0)
    replayed = []
    real = m.replay
    monkeypatch.setattr(st.m, "replay", lambda base, log: replayed.append((base.count(), log.count())) or real(base, log))
    images = st._images(one, mutations([put("r7", 99, m.INCREMENT, amount=1)]), 1).collect()
    assert replayed == [(0, 1)]
    assert [(bytes(r.row), int.from_bytes(bytes(r.value), "big")) for r in images] == [(b"r7", 8)]


def test_an_entry_of_many_cells_keeps_its_own_order(spark, entries):
    log = entries((1, "t", 20, [cell("PUT")] * 100_002), (2, "t", 20, [cell("PUT")]), (2**62, "t", 20, [cell("PUT")]))
    order = ch.to_log(ch.classify(log))
    assert order.select("seq").distinct().count() == 100_004
    top = [int(r.seq) for r in order.orderBy(F.col("seq").desc()).limit(2).collect()]
    assert top == [2**62 * ch.PLACES, 2 * ch.PLACES]


def test_a_concurrent_dual_write_offers_what_can_be_written(spark, mutations, as_stream, tmp_path):
    at = {"row": "r", "family": "f", "qualifier": "q"}
    puts = [at | {"ts": 1, "value": "v", "seq": 1}, at | {"ts": 1, "seq": 2}, at | {"ts": 1, "value": "v" * 99, "seq": 3}]
    log = mutations([put | {"op": m.PUT} for put in puts])
    one, two = (st.Copy(spark, str(tmp_path / name)) for name in ("one", "two"))
    never = F.lit(None).cast("string")
    st.dual_write(as_stream(log, [F.lit(True)]), one, two, str(tmp_path / "l"), str(tmp_path / "p"), never,
                  concurrent=True, max_put_bytes=60)
    assert [[r.seq for r in copy.log().collect()] for copy in (one, two)] == [[1], [1]]


def test_counters_over_micro_batches(spark, mutations, as_stream, tmp_path):
    rows = [{"row": f"r{i % 2}", "family": "f", "qualifier": "n", "ts": i, "seq": i, "op": m.INCREMENT, "amount": i}
            for i in range(9)]
    stream = as_stream(mutations(rows), [F.col("seq") < 4, F.col("seq") >= 4])
    st.count_stream(stream, str(tmp_path / "totals"), str(tmp_path / "progress"))
    got = {bytes(r.row): r.total for r in st.read_counts(spark, str(tmp_path / "totals")).collect()}
    assert got == {b"r0": 20, b"r1": 16}


def test_a_stream_of_all_mutations_is_the_replay(spark, mutations, as_stream, listed, tmp_path):
    rng = random.Random(8)
    log = any_log(rng, 90, lambda: rng.choice(["r", "s"]), counters_only=False)
    for x in log:
        if x["op"] in (m.DELETE_ROW, m.DELETE_FAMILY):
            x["ts"] = LATEST
    df = mutations(log)
    path, progress = str(tmp_path / "out"), str(tmp_path / "p")
    st.follow(as_stream(df, [F.col("seq") < 30, (F.col("seq") >= 30) & (F.col("seq") < 50)]), path, progress)
    early = listed(st.read_newest(spark, path))
    assert early == listed(newest(m.replay(spark.createDataFrame([], CELL_SCHEMA), df.where("seq < 50").drop("table"))))
    # A later start goes on from the state of the one before.
    st.follow(as_stream(df, [F.lit(False), F.lit(False), F.col("seq") >= 50]), path, progress)
    want = listed(newest(m.replay(spark.createDataFrame([], CELL_SCHEMA), df.drop("table"))))
    assert listed(st.read_newest(spark, path)) == want != early


def test_origin_tags_are_summed_by_hash(entries):
    """Sorting is left to one record per row and family."""
    log = entries((1, "t", 20, [cell("PUT", family="a"), cell("PUT", family="b")]))
    tags = ch.origin_tags(ch.to_log(ch.classify(log)), "ME")
    assert "HashAggregate" in tags._jdf.queryExecution().executedPlan().toString().replace("ObjectHashAggregate", "")
