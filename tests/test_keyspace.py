from __future__ import annotations

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellarium.functions import bytewise as bw
from cellarium.plans.keyspace import KeySet, Span

keys = st.binary(max_size=3)
spans = st.builds(Span, keys, st.one_of(st.none(), keys))
sets = st.lists(spans, max_size=4).map(KeySet)


def holds(keyset, key):
    return any(s.start <= key and (s.stop is None or key < s.stop) for s in keyset.spans)


@given(sets, sets, keys)
def test_set_algebra(a, c, key):
    assert holds(a.union(c), key) == (holds(a, key) or holds(c, key))
    assert holds(a.intersect(c), key) == (holds(a, key) and holds(c, key))
    assert holds(a.complement(), key) != holds(a, key)


@given(keys, keys)
def test_prefix_is_its_range(prefix, key):
    assert holds(KeySet.prefix(prefix), key) == key.startswith(prefix)


def test_bounds():
    closed = KeySet.between("b", "b", stop_inclusive=True)
    assert closed == KeySet.point("b")
    assert KeySet.between("b", "b") == KeySet.none()
    assert KeySet.between("", "") == KeySet.all()
    assert not holds(KeySet.between("b", "d", start_inclusive=False), b"b")
    assert holds(KeySet.between("b", "d", start_inclusive=False), b"b\x00")


def test_successor():
    assert bw.successor(b"ab") == b"ac"
    assert bw.successor(b"a\xff\xff") == b"b"
    assert bw.successor(b"\xff") is None


def test_byte_columns(spark):
    rows = [(k,) for k in (b"ab", b"a\xff", b"\xaf\xff", b"\xff\xff", b"", b"\x00")]
    df = spark.createDataFrame(rows, "k binary").select("k", bw.successor_of(F.col("k")).alias("s"))
    for row in df.collect():
        key = bytes(row["k"])
        want = bw.successor(key)
        assert (None if row["s"] is None else bytes(row["s"])) == want
    numbers = [0, 1, -1, 2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    out = df.select("n", bw.long_to_bytes(F.col("n")).alias("b")).select(
        "n", "b", bw.bytes_to_long(F.col("b")).alias("back")
    )
    for row in out.collect():
        assert bytes(row["b"]) == row["n"].to_bytes(8, "big", signed=True)
        assert row["back"] == row["n"]


def test_timestamp_units(spark):
    df = spark.createDataFrame([(5,), (2**63 - 1,), (2**63 // 1000 - 1,)], "t bigint")
    out = [r[0] for r in df.select(bw.to_micros(F.col("t"))).collect()]
    clamp = (2**63 - 1) - (2**63 - 1) % 1000
    assert out == [5000, clamp, (2**63 // 1000 - 1) * 1000]
    back = spark.createDataFrame([(5999,), (clamp,)], "t bigint")
    assert [r[0] for r in back.select(bw.to_millis(F.col("t"))).collect()] == [5, 2**63 - 1]


def test_found_sees_bytes(spark):
    df = spark.createDataFrame([(b"\x80a\nb",), (b"",), (b"xyz",)], "v binary")
    hits = lambda p: [r[0] for r in df.select(bw.found(F.col("v"), p)).collect()]
    assert hits("a.b") == [True, False, False]
    assert hits("\\x80") == [True, False, False]
    assert hits("") == [False, True, False]
    assert hits("y") == [False, False, True]
